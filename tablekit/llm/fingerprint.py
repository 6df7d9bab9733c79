"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A text is cut into paragraphs (lines, and inside a long line wherever a word's
hash says so, so that cuts depend on nearby words alone; a run of over ``RUN``
bytes without white space is first cut into parts where the bytes before say
so).  Every paragraph is hashed to a wide vector, and the vectors are summed
lane by lane modulo 2 ** 32.  The sum does not depend on the order of
paragraphs; adding or subtracting a paragraph's vector inserts or deletes it.

A vector has two parts.  ``WIDE`` lanes hold numbers of 32 random bits: they
decide equality.  ``SIGNS`` lanes hold +1 or -1; read as signed numbers they
estimate likeness.  The mean square of a lane estimates the sum of the squared
paragraph counts, so likeness is 1 - |p - q|^2 / (|p|^2 + |q|^2) of the two
texts' vectors of counts: 1 for equal multisets, 0 for texts that share nothing,
2 / 3 for a line repeated 2n times against that line n times and another one n
times.

``edited_pairs`` pairs each document with the next one by id.  Documents are
dealt to id ranges (bounds from a quantile sketch of the ids); a range's first
document also goes to the range before it.  So each text is shuffled once and
read in id order, one document after another.

Edge cases: NULL texts read as empty (fingerprint of no paragraph, and two
empty fingerprints are alike to degree 1); NULL ids sort first; rows that
repeat an id follow each other ordered by text; a single document is its own
next; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablekit.llm.common import shipped, shuffle_partitions, table
from tablekit.llm.words import mix64, span_hashes, spread, word_spans

WIDE = 32                             # lanes of 32 random bits
SIGNS = 128                           # lanes of +1 and -1
CUT = 8                               # inside a line, one word in CUT ends a paragraph
RUN = 64                              # longer runs without white space are cut into parts
RUN_CUT = 32                          # one byte in RUN_CUT ends a part
PIECE_CHARS = 1 << 20
_U = np.uint64


def run_parts(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans with those of over RUN bytes cut where the eight bytes before say so -> (start, end, continues)."""
    runs = np.flatnonzero(end - start > RUN)
    if len(runs) == 0:
        return start, end, np.zeros(len(start), bool)
    eights = np.ndarray(shape=(len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))
    at = spread(start[runs] + 8, (end - start)[runs] - 8)
    cuts = at[mix64(eights[at - 8]) % _U(RUN_CUT) == 0]
    starts = np.concatenate((start, cuts))
    order = np.argsort(starts, kind="stable")
    return starts[order], np.sort(np.concatenate((end, cuts))), order >= len(start)


def paragraph_hashes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row bounds) of the paragraphs of each text."""
    start, end, bounds = word_spans(buf, offs)
    if len(start) == 0:
        return np.zeros(0, _U), np.zeros(len(offs), np.int64)
    start, end, continues = run_parts(buf, start, end)
    bounds = np.searchsorted(start, offs)
    h = span_hashes(buf, start, end)
    h[continues] = mix64(h[continues] ^ _U(0xA0761D6478BD642F))
    last = (mix64(h) % _U(CUT)) == 0
    lines = np.concatenate(([0], np.cumsum(buf[:int(offs[-1])] == 10)))
    last[:-1] |= lines[start[1:]] != lines[start[:-1]]
    last[bounds[1:][np.diff(bounds) > 0] - 1] = True
    ends = np.flatnonzero(last)
    begins = np.concatenate(([0], ends[:-1] + 1))
    place = np.arange(len(h)) - np.repeat(begins, ends - begins + 1)
    sums = np.add.reduceat(mix64(h + place.astype(_U) * _U(0x9E3779B97F4A7C15)), begins)
    return mix64(sums ^ (ends - begins + 1).astype(_U)), np.searchsorted(ends, bounds)


def vector_sums(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the paragraphs' vectors for every row, lane by lane modulo 2 ** 32."""
    n = len(bounds) - 1
    out = np.zeros((n, WIDE + SIGNS), np.uint32)
    if len(hashes) == 0:
        return out
    some = np.flatnonzero(np.diff(bounds) > 0)
    at = bounds[some]

    def entries(k: int) -> np.ndarray:
        return mix64(hashes + _U((2 * k + 1) * 0xD1B54A32D192ED03 % (1 << 64)))

    for k in range(WIDE // 2):                          # 64-bit sums wrap at a multiple of 2 ** 32
        pair = entries(k)
        out[some, 2 * k] = np.add.reduceat(pair & _U(0xFFFFFFFF), at).astype(np.uint32)
        out[some, 2 * k + 1] = np.add.reduceat(pair >> _U(32), at).astype(np.uint32)
    for k in range(SIGNS // 64):
        bits = np.unpackbits(entries(WIDE // 2 + k)[:, None].view(np.uint8), axis=1)
        ones = np.add.reduceat(bits, at, axis=0, dtype=np.int64)
        out[some, WIDE + 64 * k:WIDE + 64 * (k + 1)] = (2 * ones - np.diff(bounds)[some, None]).astype(np.uint32)
    return out


def fingerprints(texts: list[str]) -> np.ndarray:
    """Fingerprint vectors of texts."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64)
    buf = np.zeros(int(offs[-1]) + 8, np.uint8)
    buf[:-8] = np.frombuffer(b"".join(raw), np.uint8)
    return vector_sums(*paragraph_hashes(buf, offs))


def combine(a: np.ndarray, b: np.ndarray, sign: int = 1) -> np.ndarray:
    """The fingerprint after inserting (sign 1) or deleting (sign -1) what ``b`` stands for."""
    return a + b if sign > 0 else a - b


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated likeness of the paragraph counts behind two fingerprints (rows), 0 to 1."""

    def square(v: np.ndarray) -> np.ndarray:
        return (np.ascontiguousarray(v[:, WIDE:]).view(np.int32).astype(float) ** 2).mean(axis=1)

    total = square(a) + square(b)
    near = np.clip(1 - square(a - b) / np.where(total > 0, total, 1), 0, 1)
    return np.where(total > 0, near, (a == b).all(axis=1).astype(float))


def as_text(vectors: np.ndarray) -> list[str]:
    return [v.astype("<u4").tobytes().hex() for v in vectors]


def fingerprinted(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with the fingerprint of ``text``."""
    schema = docs.select(*keep).schema.add("fingerprint", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                found = as_text(fingerprints([t or "" for t in part.column(len(keep)).to_pylist()]))
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(keep))], pa.array(found)],
                                                 names=[*keep, "fingerprint"])

    shipped(docs.sparkSession)
    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)


PAIR_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, guest, doc_id, text) in order of range and id -> a row for each document but the guests."""
    ids: list = []
    texts: list[str] = []
    ranges: list[int] = []
    guests: list[bool] = []

    def flush() -> pa.RecordBatch | None:
        """All buffered rows but the last, whose next document may still come."""
        own = [i for i in range(len(ids) - 1) if not guests[i]]
        if any(ranges[i] != ranges[i + 1] for i in own):
            raise ValueError("a range of ids ends without the next document")
        if not own:
            return None
        edited, counts = [], []
        for i in own:
            n = len(texts[i])
            counts.append(n)
            edited.append(texts[i][:n - n // 2] + texts[i + 1][:n // 2])
        base, changed = fingerprints(texts), fingerprints(edited)
        here, after = base[own], base[[i + 1 for i in own]]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i in own], pa.int64()), pa.array(counts, pa.int64()),
             pa.array([hashlib.sha256(e.encode("utf-8", "replace")).hexdigest() for e in edited]),
             pa.array(as_text(here)), pa.array(as_text(changed)),
             pa.array(likeness(here, changed)), pa.array(likeness(here, after))],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    size = 0
    for b in batches:
        for r, g, i, t in zip(*[b.column(k).to_pylist() for k in range(4)]):
            ranges.append(r), guests.append(g), ids.append(i), texts.append(t)
            size += len(t)
            if size > PIECE_CHARS:
                if (out := flush()) is not None:
                    yield out
                del ids[:-1], texts[:-1], ranges[:-1], guests[:-1]
                size = len(texts[0])
    if ids and (out := flush()) is not None:
        yield out


def _constants(values: list, kind: str) -> Column:
    """An array literal: one string that the optimizer folds, not an expression for each value."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")


def _count_up_to(cuts: list[int], value: Column) -> Column:
    """How many of the sorted ``cuts`` are at most ``value``: about 2 sqrt(n) comparisons a row."""
    step = math.isqrt(len(cuts)) + 1
    block = F.size(F.filter(_constants(cuts[::step], "long"), lambda c: c <= value))
    start = F.greatest(block - 1, F.lit(0)) * step
    inside = F.slice(_constants(cuts, "long"), start + 1, F.lit(step))
    return start + F.size(F.filter(inside, lambda c: c <= value))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """The rows of PAIR_SCHEMA for all of ``docs(doc_id, text)``."""
    spark = shipped(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n_ranges = shuffle_partitions(spark)
    # bounds are ids of documents: one number a range, by a mergeable sketch over all ids
    shares = _constants([i / n_ranges for i in range(1, n_ranges + 1)], "double")
    found = src.agg(F.min("doc_id"), F.percentile_approx("doc_id", shares, 100 * n_ranges)).first()
    cuts = [] if found[0] is None else sorted({found[0], *found[1][:-1]})
    # range k holds the ids in [cut k, cut k + 1); NULL ids are in range 0
    placed = src.withColumn("range", F.when(F.col("doc_id").isNull(), 0)
                            .otherwise(F.greatest(_count_up_to(cuts, F.col("doc_id")), F.lit(1)) - 1))
    # the first row of each range, of NULL ids too, is the next of the last row before it
    heads = placed.filter((F.get(_constants(cuts, "long"), F.col("range")) == F.col("doc_id")) | F.col("doc_id").isNull())
    order = Window.partitionBy("range").orderBy("doc_id", "text")
    heads = heads.withColumn("__k", F.row_number().over(order)).filter("__k = 1").drop("__k")
    last = max(len(cuts) - 1, 0)
    guests = heads.withColumn("range", F.when(F.col("range") == 0, last).otherwise(F.col("range") - 1))
    rows = (placed.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
            .select("range", "guest", "doc_id", "text"))
    return (rows.repartitionById(max(len(cuts), 1), F.col("range").cast("int")).sortWithinPartitions("range", "guest", "doc_id", "text")
            .mapInArrow(_paired, PAIR_SCHEMA))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edited_pairs(table(spark, sf_dir, "documents"))
