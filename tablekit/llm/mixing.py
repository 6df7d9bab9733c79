"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, repeated for a
second epoch.  A document's virtual finish time is the source's cumulative
size up to and including it, divided by the source's target.  All queue
entries are range-sorted by that time and the sorted stream is cut where its
running size reaches the total budget, so every source has then received its
target to within a document or two.

The few documents that hold over 1/50 of their source stand first in its
queue, largest first, so the cut falls among smaller ones.

A source may hold any share of the rows: running sums are taken inside
``QUEUE_BUCKETS`` hash ranges of a source, on top of sums over the ranges.

Edge cases: NULL texts have size 0; NULL sources are one source, last in
order; rows without words are never taken words (``taken`` 0); equal rows keep
separate places; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablekit.llm.common import checkpointed, table, text_or_empty

QUEUE_BUCKETS = 1024
SALTS = 64                            # shares of a source in joins on the source
WEIGHTS = (3, 1, 2)                   # by source in code point order, repeating
BUDGET_SHARE = 1.5                    # of all sizes
LARGE_SHARE = 50                      # a document above 1/50 of its source is large
MAX_EPOCHS = 2                        # no source, so no document, beyond this multiple
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = BUDGET_SHARE) -> DataFrame:
    """(source, source_rank, source_size, target), one row per source.

    Filling by weight under caps in closed form: with sources in order of
    cap / weight, the capped ones are those whose cap is at most weight times
    the level that the rest of the budget gives to the rest of the weights.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("source_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          F.pmod(F.col("source_rank") - 1, F.lit(len(weights))) + 1)
    cap = F.col("source_size") * float(MAX_EPOCHS)
    by_cap = Window.orderBy("__ratio", "source_rank")
    before, onward = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (ranked.withColumn("__weight", weight).withColumn("__cap", cap)
            .withColumn("__ratio", F.col("__cap") / F.col("__weight"))
            .withColumn("__budget", F.sum("source_size").over(everything) * float(share))
            .withColumn("__level", (F.col("__budget") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
                        / F.sum("__weight").over(onward))
            .withColumn("__first", F.min(F.when(F.col("__ratio") > F.col("__level"), F.struct("__ratio", "source_rank", "__level")))
                        .over(everything))
            .select("source", "source_rank", "source_size",
                    F.when(F.col("__first").isNull()
                           | (F.struct("__ratio", "source_rank") < F.struct("__first.__ratio", "__first.source_rank")),
                           F.col("__cap")).otherwise(F.col("__weight") * F.col("__first.__level")).alias("target")))


def queue_places(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Add targets and ``queued``: the source's size up to and including the row, in shuffled order."""
    keyed = (targets.withColumn("__source", F.struct("source")).drop("source")
             .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    large = F.col("size") * LARGE_SHARE > F.col("source_size")
    first = (F.shiftleft(F.lit((1 << 40) - 1) - F.least("size", F.lit((1 << 40) - 1)), 9)
             .bitwiseOR(F.shiftrightunsigned("shuffle_key", 55)))
    rows = (sized.withColumn("__source", F.struct("source"))
            .withColumn("__salt", F.pmod("shuffle_key", F.lit(SALTS)).cast("int"))
            .join(keyed, ["__source", "__salt"]).drop("__salt")
            .withColumn("shuffle_key", F.when(large, first).otherwise(F.col("shuffle_key")))
            .withColumn("__bucket", F.shiftrightunsigned("shuffle_key", 64 - QUEUE_BUCKETS.bit_length() + 1)))
    sums = rows.groupBy("__source", "__bucket").agg(F.sum("size").alias("__sum"))
    before = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("__source", "__bucket", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    inside = (Window.partitionBy("__source", "__bucket").orderBy("shuffle_key", "row_id")
              .rowsBetween(Window.unboundedPreceding, 0))
    return (rows.withColumn("__in", F.sum("size").over(inside)).join(bases, ["__source", "__bucket"])
            .withColumn("queued", F.col("__base") + F.col("__in")).drop("__source", "__bucket", "__in", "__base"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = BUDGET_SHARE, seed: int = 11,
        row: tuple[str, ...] = ("doc_id", "source", "text")) -> DataFrame:
    """Rows (doc_id, source, row_key, size, source_size, target, copies): how often the mix takes each document.

    ``row_key`` identifies the columns ``row``.
    """
    size = word_count(text_or_empty())
    key = F.xxhash64(*row)
    sized = checkpointed(docs.select(
        "doc_id", "source", size.alias("size"), key.alias("row_key"),
        F.xxhash64(F.lit(seed), key, "doc_id").alias("shuffle_key")))
    sized = sized.withColumn("row_id", F.monotonically_increasing_id())
    targets = checkpointed(source_targets(sized, weights, share))
    queues = checkpointed(queue_places(sized, targets))

    order = ["finish", "epoch", "source_rank", "shuffle_key", "row_id"]
    finish = (F.col("queued") + F.col("epoch") * F.col("source_size")) / F.col("target")
    entries = (queues.filter("target > 0 AND size > 0")
               .withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(MAX_EPOCHS)])))
               .withColumn("finish", finish).select(*order, "size", "target"))
    stream = checkpointed(entries.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    part_sums = stream.groupBy("part").agg(F.sum("size").alias("__sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)          # one row per range
    bases = part_sums.select("part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = stream.withColumn("__in", F.sum("size").over(inside)).join(bases, "part")
    budget = targets.agg(F.sum("target")).first()[0] or 0.0
    last = (running.filter(F.col("__base") + F.col("__in") <= F.lit(budget) + 0.5)
            .agg(F.max(F.struct(*order)).alias("last")))                                # the cut, one row
    cut = last.first()["last"]
    if cut is None:
        taken = F.lit(0)
    else:
        at = F.struct(*[F.lit(cut[c]).alias(c) for c in order])
        taken = sum(
            (F.when(F.struct(((F.col("queued") + e * F.col("source_size")) / F.col("target")).alias("finish"),
                             F.lit(e).alias("epoch"), "source_rank", "shuffle_key", "row_id") <= at, 1).otherwise(0)
             for e in range(MAX_EPOCHS)), F.lit(0))
        taken = F.when((F.col("size") > 0) & (F.col("target") > 0), taken).otherwise(0)
    return queues.select("doc_id", "source", "row_key", "size", "source_size", "target",
                         taken.cast("int").alias("copies"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = BUDGET_SHARE,
                    seed: int = 11) -> DataFrame:
    """The rows of ``docs`` that the mix takes, as often as it takes them; rows that differ in any column are apart."""
    copies = (mix(docs, weights, share, seed, tuple(docs.columns)).filter("copies > 0")
              .groupBy(F.struct("doc_id", "row_key").alias("__key")).agg(F.sum("copies").cast("int").alias("__copies")))
    cols = docs.columns
    keyed = docs.withColumn("__key", F.struct("doc_id", F.xxhash64(*docs.columns).alias("row_key")))
    return (keyed.dropDuplicates(["__key"]).join(copies, "__key")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(*cols))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes of each."""
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
