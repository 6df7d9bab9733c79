"""The queries of this subpackage, by name: (spark, sf_dir) -> DataFrame, with SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablekit.llm.chat import OP4_SQL, op4_chat_formatting
from tablekit.llm.collocations import OP11_SQL, op11_phrase_collocations
from tablekit.llm.fingerprint import op10_fingerprints
from tablekit.llm.langid import op3_language_id
from tablekit.llm.license_scan import op13_license_scans
from tablekit.llm.manifest import OP12_SQL, op12_merkle_manifest
from tablekit.llm.mixing import op6_source_mixing
from tablekit.llm.ngram_join import op1_ngram_jaccard_join
from tablekit.llm.outliers import op9_quality_outliers
from tablekit.llm.packing import op2_best_fit_packing
from tablekit.llm.rule_ensemble import op8_quality_rules
from tablekit.llm.token_orc import op5_token_orc
from tablekit.llm.toxicity import op7_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_language_id": op3_language_id,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_token_orc": op5_token_orc,
    "op6_source_mixing": op6_source_mixing,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_outliers": op9_quality_outliers,
    "op10_fingerprints": op10_fingerprints,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_license_scans": op13_license_scans,
}

ORACLE_SQL: dict[str, str] = {
    "op4_chat_formatting": OP4_SQL,
    "op11_phrase_collocations": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
