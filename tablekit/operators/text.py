"""Text operators (T1-T6): collations, charset audit and conversion, and a
full-text index with ranked natural-language search (BM25).

All of it stays JVM-side: ``collate``, ``rlike``, ``encode``,
``regexp_extract_all`` + ``explode`` and ordinary aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.session import reliable_checkpoint
from tablekit.spec import COLLATIONS

# What each target charset cannot hold.
#   utf8mb3 stores at most 3 bytes per character (no U+10000..U+10FFFF);
#   latin1 holds U+0000..U+00FF only.
UTF8MB3_LOSS = r"[\x{10000}-\x{10FFFF}]"
LATIN1_LOSS = r"[^\x{00}-\x{FF}]"

# Word rule for the text index: maximal runs of letters and digits.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def collated(c: Column | str, kind: str) -> Column:
    """The column under a collation: 'ai_ci' (e = É, a = A),
    'as_cs' (accent and case sensitive) or 'bin' (byte order)."""
    return F.collate(F.col(c) if isinstance(c, str) else c, COLLATIONS[kind])


def with_collation(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    """Re-type string columns so =, GROUP BY, joins and ORDER BY follow ``kind``."""
    return df.select(*[collated(c, kind).alias(c) if c in cols else F.col(c) for c in df.columns])


def charset_audit(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """T4: per group, how many rows a utf8mb3 or latin1 column would damage."""
    v = F.col(column)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(v.rlike(UTF8MB3_LOSS), 1).otherwise(0)).cast("bigint").alias("utf8mb3_loss"),
        F.sum(F.when(v.rlike(LATIN1_LOSS), 1).otherwise(0)).cast("bigint").alias("latin1_loss"),
    )


def convert_charset(df: DataFrame, cols: Sequence[str], charset: str, mode: str = "strict") -> DataFrame:
    """T5: CONVERT TO CHARACTER SET.

    'utf8mb4' is Spark's native string: nothing to do.  'latin1' and
    'utf8mb3' first audit the row (T4); strict mode raises on a row that
    would lose characters, ignore mode drops it.  'binary' turns the column
    into its UTF-8 bytes.
    """
    if charset == "utf8mb4":
        return df
    if charset == "binary":
        return df.select(*[F.encode(F.col(c), "UTF-8").alias(c) if c in cols else F.col(c)
                           for c in df.columns])
    loss = {"latin1": LATIN1_LOSS, "utf8mb3": UTF8MB3_LOSS}[charset]
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.coalesce(F.col(c).rlike(loss), F.lit(False))
    if mode == "strict":
        sample = df.filter(bad).limit(1).collect()
        if sample:
            raise ValueError(f"rows hold characters {charset} cannot store")
        kept = df
    else:
        kept = df.filter(~bad)
    if charset == "latin1":
        return kept.select(*[F.decode(F.encode(F.col(c), "ISO-8859-1"), "ISO-8859-1").alias(c)
                             if c in cols else F.col(c) for c in kept.columns])
    return kept


def tokens(text: Column | str, lower: bool = True) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    if lower:
        t = F.lower(t)
    return F.regexp_extract_all(t, F.lit(TOKEN_PATTERN), 0)


def explode_tokens(df: DataFrame, arr: str, name: str) -> DataFrame:
    """One row per token.  ``explode_outer`` + a NULL filter instead of
    ``explode``: for ``explode`` Catalyst infers a "non-empty array" filter
    and pushes it below the projection (and below the next exchange), which would
    tokenize every text twice."""
    keep = [c for c in df.columns if c != arr]
    return df.select(*keep, F.explode_outer(arr).alias(name)).filter(F.col(name).isNotNull())


def _tokenized(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = df.select(F.col(id_col).alias("id"), tokens(text_col).alias("__t"))
    return docs.select("id", F.size("__t").cast("bigint").alias("dl"), "__t")


def _index_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    postings = explode_tokens(docs, "__t", "term") \
        .groupBy("term", "id", "dl").agg(F.count(F.lit(1)).alias("tf"))
    return postings, docs.select("id", "dl")


def build_text_index(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """T6 (FULLTEXT INDEX): postings (term, id, dl, tf) and document lengths (id, dl).

    Tokens are exploded per document; (term, id) counting is a partial +
    final aggregate, so a very common term is still spread by document id.
    Each posting carries its document length, so ranking needs no join.
    """
    return _index_of(_tokenized(df, id_col, text_col))


def write_text_index(df: DataFrame, id_col: str, text_col: str, path: str) -> tuple[str, str]:
    """ADD FULLTEXT INDEX, persisted: postings range-partitioned and sorted by
    (term, id) -- row-group min/max statistics then skip every file that holds
    none of a query's terms, and a very common term fills several files -- plus
    one length row per document.  Texts are tokenized once."""
    postings, lengths = _index_of(reliable_checkpoint(_tokenized(df, id_col, text_col)))
    p_path, l_path = f"{path}/postings", f"{path}/lengths"
    postings.repartitionByRange("term", "id").sortWithinPartitions("term", "id") \
        .write.mode("errorifexists").parquet(p_path)
    lengths.write.mode("errorifexists").parquet(l_path)
    return p_path, l_path


def _score(hits: DataFrame, n_docs: Column, avgdl: Column, k1: float, b: float) -> DataFrame:
    dfreq = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = dfreq.select("term", F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    tf = F.col("tf")
    contrib = F.col("idf") * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / avgdl))
    # idf has a row per query term at most, a number bounded by the query text
    return hits.join(F.broadcast(idf), "term").groupBy("id").agg(F.sum(contrib).alias("score"))


def search_index(postings: DataFrame, lengths: DataFrame, query: str, k: int = 10,
                 k1: float = 1.2, b: float = 0.75, id_col: str = "id") -> DataFrame:
    """T6 over a persisted index: the query's terms (a list bounded by the
    query text) become an IN filter pushed into the postings scan, N and
    avgdl come from the small lengths table; the raw text is never read."""
    spark = postings.sparkSession
    terms = [r.term for r in query_terms(spark, query).collect()]
    hits = postings.filter(F.col("term").isin(terms)).select("term", "id", "dl", "tf")
    stats = lengths.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl")).alias("s")).scalar()
    scored = _score(hits, stats.getField("n"), stats.getField("avgdl"), k1, b) \
        .select(F.col("id").alias(id_col), F.round("score", 6).cast("decimal(18,6)").alias("score"))
    return scored.orderBy(F.col("score").desc(), F.col(id_col).asc()).limit(k)


def query_terms(spark, query: str) -> DataFrame:
    """Distinct terms of the search text, cut by the same rule as the documents."""
    return explode_tokens(spark.range(1).select(tokens(F.lit(query)).alias("__t")), "__t", "term") \
        .select("term").distinct()


def bm25_search(df: DataFrame, id_col: str, text_col: str, query: str, k: int = 10,
                k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """Natural-language search ranked by Okapi BM25, top k by
    (score DESC, id ASC); scores rounded to 6 decimals before ranking and
    returned as DECIMAL(18,6) so equal scores compare exactly across engines.

    score(d) = sum over query terms t of
        idf(t) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl)),
    idf(t) = ln(1 + (N - df + 0.5) / (df + 0.5)).

    Each text is tokenized ONCE into a compact per-document row (id, length,
    only the tokens that are query terms) behind a hash exchange on id; the
    (N, avgdl) scalar and the term hits both read that exchange (AQE reuses
    it), only matching tokens are ever exploded, and the texts themselves are
    never shuffled by key.  The term list is bounded by the query text.
    For repeated searches, build the index once (``write_text_index``) and
    use ``search_index``, which never reads the texts.
    """
    spark = df.sparkSession
    terms = [r.term for r in query_terms(spark, query).collect()]
    toks = tokens(text_col)
    per_doc = df.select(id_col, text_col).select(F.col(id_col).alias("id"), toks.alias("__t")).select(
        "id", F.size("__t").alias("dl"),
        F.filter("__t", lambda t: t.isin(terms)).alias("__m")).repartition("id")
    # the scalar reads every column of per_doc (``matched`` counts query-term
    # occurrences) so both consumers share one exchange and texts are
    # tokenized once
    stats = per_doc.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"),
                                 F.sum(F.size("__m")).alias("matched"),
                                 F.count("id").alias("ids")).alias("s")).scalar()
    n_docs, avgdl = stats.getField("n"), stats.getField("avgdl")
    hits = explode_tokens(per_doc.select("id", "dl", "__m"), "__m", "term") \
        .groupBy("term", "id", "dl").agg(F.count(F.lit(1)).alias("tf"))
    scored = _score(hits, n_docs, avgdl, k1, b) \
        .select(F.col("id").alias(id_col), F.round("score", 6).cast("decimal(18,6)").alias("score"))
    return scored.orderBy(F.col("score").desc(), F.col(id_col).asc()).limit(k)
