"""Registered queries for text operators (T1-T6) over the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablekit.operators import text as X
from tablekit.plans.catalog import register
from tablekit.sources.tables import scan

_WORDS_SQL = r"""
WITH w AS (SELECT lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word FROM documents)
"""
# The oracle's stand-in for UNICODE_CI_AI: lower-case, strip accents, and the
# primary-strength expansion of sharp s.
_FOLD = "replace(strip_accents(lower(word)), 'ß', 'ss')"


@register("collation_word_counts", _WORDS_SQL + f"""
SELECT lang, COUNT(*) AS n_tokens, COUNT(DISTINCT word) AS n_bin,
       COUNT(DISTINCT word) AS n_as_cs, COUNT(DISTINCT {_FOLD}) AS n_ai_ci
FROM w GROUP BY lang
""", "T1 T2 T3")
def collation_word_counts(spark, d):
    docs = scan(spark, d, "documents").select("lang", "text")
    w = X.explode_tokens(docs.select("lang", X.tokens("text").alias("__t")), "__t", "word")
    # pre-aggregate to distinct (lang, word) before the three distinct counts,
    # so the collation-keyed Expand sees the vocabulary, not every token
    vocab = w.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    return vocab.groupBy("lang").agg(
        F.sum("n").alias("n_tokens"),
        F.count(F.lit(1)).alias("n_bin"),
        F.countDistinct(X.collated("word", "as_cs")).alias("n_as_cs"),
        F.countDistinct(X.collated("word", "ai_ci")).alias("n_ai_ci"))


@register("collation_cased_words", r"""
WITH v AS (SELECT DISTINCT lang, unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS word FROM documents),
     w AS (SELECT lang, word FROM v
           UNION SELECT lang, replace(replace(word, 'é', 'e' || chr(769)), 'ü', 'u' || chr(776)) FROM v)
SELECT lang, COUNT(DISTINCT word) AS n_bin, COUNT(DISTINCT nfc_normalize(word)) AS n_as_cs,
       COUNT(DISTINCT replace(strip_accents(lower(word)), 'ß', 'ss')) AS n_ai_ci
FROM w GROUP BY lang
""", "T1 T2 T3")
def collation_cased_words(spark, d):
    """Words as written, some also with their accents as marks of their own: bin
    tells all apart, as_cs joins the two spellings of an accent but no cases and
    no letters, ai_ci joins all of them."""
    docs = scan(spark, d, "documents").select("lang", "text")
    vocab = X.explode_tokens(docs.select("lang", X.tokens("text", lower=False).alias("__t")), "__t", "word").distinct()
    marks = F.replace(F.replace(F.col("word"), F.lit("é"), F.lit("e\u0301")), F.lit("ü"), F.lit("u\u0308"))
    both = vocab.select("lang", "word").union(vocab.select("lang", marks)).distinct()
    return both.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_bin"),
        F.countDistinct(X.collated("word", "as_cs")).alias("n_as_cs"),
        F.countDistinct(X.collated("word", "ai_ci")).alias("n_ai_ci"))


@register("collation_lookup", r"""
WITH w AS (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS word FROM documents)
SELECT word, COUNT(*) AS n FROM w
WHERE replace(strip_accents(lower(word)), 'ß', 'ss') = 'ere'
GROUP BY word
""", "T1")
def collation_lookup(spark, d):
    docs = scan(spark, d, "documents").select("text")
    w = X.explode_tokens(docs.select(X.tokens("text", lower=False).alias("__t")), "__t", "word")
    hit = X.collated("word", "ai_ci") == F.lit("ERE")
    return w.filter(hit).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@register("charset_audit", r"""
SELECT lang, COUNT(*) AS n_rows,
       CAST(SUM(CASE WHEN regexp_matches(text, '[\x{10000}-\x{10FFFF}]') THEN 1 ELSE 0 END) AS BIGINT) AS utf8mb3_loss,
       CAST(SUM(CASE WHEN regexp_matches(text, '[^\x{00}-\x{FF}]') THEN 1 ELSE 0 END) AS BIGINT) AS latin1_loss
FROM documents GROUP BY lang
""", "T4")
def charset_audit(spark, d):
    return X.charset_audit(scan(spark, d, "documents"), "text", ["lang"])


@register("convert_latin1", """
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS utf8_bytes, CAST(length(text) AS BIGINT) AS latin1_bytes,
       text
FROM documents WHERE NOT regexp_matches(text, '[^\\x{00}-\\x{FF}]')
""", "T5")
def convert_latin1(spark, d):
    docs = scan(spark, d, "documents").select("doc_id", "text")
    conv = X.convert_charset(docs, ["text"], "latin1", mode="ignore")
    return conv.select("doc_id", F.octet_length("text").cast("bigint").alias("utf8_bytes"),
                       F.octet_length(F.encode("text", "ISO-8859-1")).cast("bigint").alias("latin1_bytes"),
                       "text")


@register("text_index_terms", r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents),
     p AS (SELECT term, doc_id, COUNT(*) AS tf FROM t GROUP BY term, doc_id)
SELECT term, COUNT(*) AS df, CAST(SUM(tf) AS BIGINT) AS cf, MAX(tf) AS max_tf FROM p GROUP BY term
""", "T6")
def text_index_terms(spark, d):
    postings, _ = X.build_text_index(scan(spark, d, "documents"), "doc_id", "text")
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"),
                                        F.max("tf").alias("max_tf"))


SEARCH_TEXT = "the eau der que ment"


_FULLTEXT_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS toks FROM documents),
     s AS (SELECT COUNT(*) AS n, AVG(len(toks)) AS avgdl FROM d),
     q AS (SELECT DISTINCT unnest(regexp_extract_all(lower('""" + SEARCH_TEXT + r"""'), '[\p{L}\p{N}]+')) AS term),
     t AS (SELECT doc_id, len(toks) AS dl, unnest(toks) AS term FROM d),
     tf AS (SELECT term, doc_id, dl, COUNT(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY term, doc_id, dl),
     df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term),
     sc AS (SELECT tf.doc_id,
                   SUM(ln(1 + (s.n - df.df + 0.5) / (df.df + 0.5)) * tf.tf * 2.2
                       / (tf.tf + 1.2 * (1 - 0.75 + 0.75 * tf.dl / s.avgdl))) AS score
            FROM tf JOIN df USING (term) CROSS JOIN s GROUP BY tf.doc_id)
SELECT doc_id, CAST(round(score, 6) AS DECIMAL(18,6)) AS score FROM sc ORDER BY round(score, 6) DESC, doc_id LIMIT 10
"""


@register("fulltext_search", _FULLTEXT_SQL, "T6")
def fulltext_search(spark, d):
    return X.bm25_search(scan(spark, d, "documents"), "doc_id", "text", SEARCH_TEXT, k=10)


@register("fulltext_search_index", _FULLTEXT_SQL, "T6 S5")
def fulltext_search_index(spark, d):
    """T6 as ADD FULLTEXT INDEX + search: postings are written term-sorted to a
    fresh folder under the shared checkpoint folder, then searched without
    reading the texts again."""
    from tablekit.sources.sinks import scratch_dir
    p, l = X.write_text_index(scan(spark, d, "documents"), "doc_id", "text", scratch_dir(spark, "fulltext"))
    return X.search_index(spark.read.parquet(p), spark.read.parquet(l), SEARCH_TEXT, k=10, id_col="doc_id")
