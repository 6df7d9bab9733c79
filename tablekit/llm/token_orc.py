"""Token ids as ORC files, one row per document in ascending id order.

The files use ORC's own layout: stripes of run-length encoded integers, a row
index every ``row_index_stride`` rows and Bloom filters on ``doc_id``.  Readers
split by stripe, and a filter on ``doc_id`` is pushed into the scan, where
stripe statistics and Bloom filters skip what cannot match.

Edge cases: a NULL or empty text is the end id alone; NULL ids sort first;
rows that repeat an id follow each other ordered by text; an empty table makes
a readable empty file set; other columns of the input are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablekit.llm.common import checkpointed, ensure_checkpoint_dir, shipped, table
from tablekit.llm.tokens import DEFAULT_VOCABULARY, END_ID, batch_tokenizer
from tablekit.llm.words import pieces, spread

IDS_SCHEMA = "doc_id long, part int, place long, n_tokens long, ids array<int>"


def with_end_id(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Append END_ID to every document of a flat id array."""
    n = np.diff(bounds)
    out_bounds = bounds + np.arange(len(bounds))
    out = np.full(int(out_bounds[-1]), END_ID, dtype=np.uint32)
    out[spread(out_bounds[:-1], n)] = ids
    return out, out_bounds


def token_rows(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Documents in ascending id order, tokenized; ``part`` is the range, ``place`` the row in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part, place = batch_tokenizer(vocabulary), TaskContext.get().partitionId(), 0
        for b in batches:
            for row, buf, offs in pieces(b.column(1)):
                ids, bounds = with_end_id(*tok.encode(buf, offs))
                n = len(offs) - 1
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(row, n), pa.array(np.full(n, part, np.int32)),
                    pa.array(np.arange(place, place + n)), pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))],
                    names=["doc_id", "part", "place", "n_tokens", "ids"])
                place += n

    shipped(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # rows of one id are spread by their text: its first characters, then its hash
    order = ["doc_id", F.substring("text", 1, 32), F.xxhash64("text")]
    return (src.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
            .mapInArrow(run, IDS_SCHEMA))


def write_token_orc(docs: DataFrame, path: str, vocabulary: str = DEFAULT_VOCABULARY,
                    stripe_bytes: int = 64 << 20, row_index_stride: int = 1000,
                    bloom_fpp: float = 0.01) -> None:
    """Write ``docs(doc_id, text)`` as token-id ORC files below ``path`` (which must not exist)."""
    (token_rows(docs, vocabulary).write
     .option("orc.stripe.size", stripe_bytes)
     .option("orc.create.index", "true")
     .option("orc.row.index.stride", row_index_stride)
     .option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", bloom_fpp)
     .option("compression", "zstd")
     .orc(path))


def read_token_orc(spark: SparkSession, path: str, first_id: int | None = None,
                   last_id: int | None = None) -> DataFrame:
    """Rows of the files; bounds on ``doc_id`` prune stripes and row groups by their metadata."""
    df = spark.read.schema(IDS_SCHEMA).orc(path)
    if first_id is not None:
        df = df.filter(F.col("doc_id") >= first_id)
    if last_id is not None:
        df = df.filter(F.col("doc_id") <= last_id)
    return df


def lookup_tokens(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """One document by id: an equality filter, answered through the Bloom filters."""
    return read_token_orc(spark, path).filter(F.col("doc_id") == doc_id)


def checksums(rows: DataFrame) -> DataFrame:
    """(doc_id, part, place, n_tokens, ids_crc32) of token rows; n_tokens counted from the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(3)
            offs = ids.offsets.to_numpy()
            flat = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).view(np.uint32))).cast("B")
            crc = [zlib.crc32(flat[4 * s:4 * e]) for s, e in zip(offs[:-1].tolist(), offs[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(np.diff(offs).astype(np.int64)),
                 pa.array(crc, type=pa.int64())], names=["doc_id", "part", "place", "n_tokens", "ids_crc32"])

    shipped(rows.sparkSession)
    return (rows.select("doc_id", "part", "place", "ids")
            .mapInArrow(run, "doc_id long, part int, place long, n_tokens long, ids_crc32 long"))


def with_starts(rows: DataFrame) -> DataFrame:
    """Add ``start``: ids of all earlier documents, from totals per range and a running sum inside each."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("__total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row per file range
    bases = totals.select("part", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("__in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(bases, "part").withColumn("start", F.col("__base") + F.col("__in")))


def delete_path(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def op5_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written and read back: doc_id, start, n_tokens, ids_crc32."""
    path = f"{ensure_checkpoint_dir(spark)}/token-orc-{uuid.uuid4().hex}"
    write_token_orc(table(spark, sf_dir, "documents"), path)
    rows = checkpointed(checksums(read_token_orc(spark, path)))
    delete_path(spark, path)
    return with_starts(rows).select("doc_id", "start", "n_tokens", "ids_crc32")
