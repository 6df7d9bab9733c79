"""Collations, charset audit / conversion, and BM25 against brute force."""

import math
import re

import pytest
from pyspark.sql import functions as F

from tablekit.operators import text as X


def test_collation_equalities(spark):
    df = spark.createDataFrame([("e",), ("É",), ("A",), ("a",)], "s string")
    ai = X.with_collation(df, ["s"], "ai_ci")
    assert ai.select("s").distinct().count() == 2                 # e = É, A = a
    assert X.with_collation(df, ["s"], "as_cs").distinct().count() == 4
    assert X.with_collation(df, ["s"], "bin").filter(F.col("s") == "e").count() == 1
    j = ai.alias("x").join(ai.alias("y"), F.col("x.s") == F.col("y.s"))
    assert j.count() == 8


def test_charset_audit_and_convert(spark):
    df = spark.createDataFrame([(1, "plain café"), (2, "smile \U0001F600"), (3, "مرحبا")], "id int, t string")
    a = X.charset_audit(df.withColumn("g", F.lit(1)), "t", ["g"]).first()
    assert (a.n_rows, a.utf8mb3_loss, a.latin1_loss) == (3, 1, 2)
    with pytest.raises(ValueError):
        X.convert_charset(df, ["t"], "latin1", "strict")
    kept = X.convert_charset(df, ["t"], "latin1", "ignore").collect()
    assert [r.id for r in kept] == [1] and kept[0].t == "plain café"
    assert [r.id for r in X.convert_charset(df, ["t"], "utf8mb3", "ignore").collect()] == [1, 3]
    b = X.convert_charset(df, ["t"], "binary").first()
    assert bytes(b.t) == "plain café".encode()


DOCS = [(1, "the cat sat on the mat"), (2, "the dog"), (3, "cats and dogs and the cat"),
        (4, "nothing here"), (5, "Cat CAT cat!")]


def _brute_bm25(docs, query, k1=1.2, b=0.75):
    toks = {i: re.findall(r"[^\W_]+", t.lower()) for i, t in docs}
    n = len(docs)
    avgdl = sum(len(t) for t in toks.values()) / n
    terms = set(re.findall(r"[^\W_]+", query.lower()))
    scores = {}
    for t in terms:
        df = sum(1 for ts in toks.values() if t in ts)
        if not df:
            continue
        idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
        for i, ts in toks.items():
            tf = ts.count(t)
            if tf:
                scores[i] = scores.get(i, 0) + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(ts) / avgdl))
    from decimal import Decimal
    rounded = ((i, Decimal(repr(round(s, 6))).quantize(Decimal("0.000001"))) for i, s in scores.items())
    return sorted(rounded, key=lambda x: (-x[1], x[0]))


def test_bm25_matches_brute_force(spark):
    df = spark.createDataFrame(DOCS, "id long, text string")
    got = [(r.id, r.score) for r in X.bm25_search(df, "id", "text", "cat the", k=10).collect()]
    assert got == _brute_bm25(DOCS, "cat the")


def test_text_index(spark):
    df = spark.createDataFrame(DOCS, "id long, text string")
    postings, lengths = X.build_text_index(df, "id", "text")
    p = {(r.term, r.id): r.tf for r in postings.collect()}
    assert p[("cat", 5)] == 3 and p[("the", 1)] == 2
    assert {r.id: r.dl for r in lengths.collect()}[3] == 6


def test_persisted_index_search_equals_adhoc(spark, tmpdir_fresh):
    import os
    from tests.conftest import SF001
    from tablekit.sources.tables import scan
    docs = scan(spark, SF001, "documents")
    p, l = X.write_text_index(docs, "doc_id", "text", os.path.join(tmpdir_fresh, "idx"))
    postings, lengths = spark.read.parquet(p), spark.read.parquet(l)
    q = "the eau der que ment"
    got = X.search_index(postings, lengths, q, k=10, id_col="doc_id").collect()
    want = X.bm25_search(docs, "doc_id", "text", q, k=10).collect()
    assert got == want and len(got) == 10
    plan = postings.filter(F.col("term").isin(["der", "the"]))._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [der,the])" in plan
