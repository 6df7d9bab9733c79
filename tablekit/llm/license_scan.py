"""License scan: ordered signature rules behind a keyword filter.

A text is read as its words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` in lower
case (A-Z), one space apart.  One pass of an Aho-Corasick automaton finds which
keywords occur; only rules whose keyword occurs are tried.  Their detections,
intervals of words, overlap: they are taken by priority, within a priority by
length and then by the rules' order, and a detection inside the interval of one
taken before goes.

The base phrases are searched the same way; their places are reported
whatever the rules make of them.

Edge cases: a NULL or empty text has no words and no detections; repeated rows
and ids are scanned as often as they stand there; an empty table gives no
rows; other columns pass through unread.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm.common import shipped, table
from tablekit.llm.license_rules import BASE_PHRASES, CONFIDENCE, Rule, rules

#: lower case for A-Z, spaces for all that separates words
_READ = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_GAPS = re.compile(rb" {2,}")
DETECTION = "struct<label:string,priority:int,start:bigint,end:bigint>"
SCAN_SCHEMA = f"n_words bigint, base array<{DETECTION}>, found array<{DETECTION}>"

Detection = tuple[str, int, int, int]                 # label, priority, first word, word after the last


def words_in_line(text: bytes) -> bytes:
    """The words of a text, a space before and after each (one between two)."""
    line = _GAPS.sub(b" ", b" " + text.translate(_READ) + b" ")
    return line if line != b" " else b""


@cache
def _automaton() -> ahocorasick.Automaton:
    """Keywords and base phrases -> the rules behind them."""
    behind: dict[bytes, list[Rule | str]] = {}
    for r in rules():
        behind.setdefault(r.keyword, []).append(r)
    for phrase in BASE_PHRASES:
        behind.setdefault(b" " + phrase.encode() + b" ", []).append(phrase)
    out = ahocorasick.Automaton()
    for keyword, what in behind.items():
        out.add_word(keyword.decode("latin-1"), (keyword, what))
    out.make_automaton()
    return out


def _in_words(line: bytes, spans: list[tuple[int, int]]) -> dict[int, int]:
    """Number of the word at, or before, every position that begins or ends a span."""
    out, at, n = {}, 0, 0
    for p in sorted({p for s in spans for p in s}):
        n += line.count(b" ", at, p)
        out[p], at = n, p
    return out


def resolved(found: list[tuple[int, int, int, int, str]]) -> list[Detection]:
    """Drop detections (priority, order, start, end, label) inside one that comes before them."""
    kept: list[Detection] = []
    starts: list[int] = []                             # of kept intervals of earlier priorities, ascending
    reach: list[int] = []                              # the largest end up to each of them
    by_priority: dict[int, list] = {}
    for d in found:
        by_priority.setdefault(d[0], []).append(d)
    for priority in sorted(by_priority):
        own, last = [], -1
        # longest first and then the rules' order: in order of starts, whatever ends within reach is inside one before
        for _, _, s, e, label in sorted(by_priority[priority], key=lambda d: (d[2], -d[3], d[1])):
            before = bisect_right(starts, s)
            if e > last and not (before and reach[before - 1] >= e):
                own.append((label, priority, s, e))
            last = max(last, e)
        kept += own
        spans = sorted((s, e) for _, _, s, e in kept)
        starts, reach, far = [s for s, _ in spans], [], -1
        for _, e in spans:
            far = max(far, e)
            reach.append(far)
    return sorted(kept, key=lambda d: (d[2], d[3], d[0]))


def scan_text(text: bytes) -> tuple[int, list[Detection], list[Detection]]:
    """(words, places of base phrases, detections) of a text."""
    line = words_in_line(text)
    n_words = max(0, line.count(b" ") - 1)
    seen: set[bytes] = set()
    tried: list[Rule] = []
    base: list[tuple[str, int, int]] = []
    for end, (keyword, what) in _automaton().iter(line.decode("latin-1")):
        for w in what:
            if isinstance(w, str):
                base.append((BASE_PHRASES[w], end + 2 - len(keyword), end))
            elif keyword not in seen:
                tried.append(w)
        seen.add(keyword)
    raw = [(r, m.span()) for r in tried for m in r.pattern.finditer(line)]
    word = _in_words(line, [s for _, s in raw] + [(s, e) for _, s, e in base])
    found = resolved([(r.priority, r.order, word[s] - 1, word[e], r.label) for r, (s, e) in raw])
    return n_words, [(label, 0, word[s] - 1, word[e]) for label, s, e in base], found


def _scan(keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("label", pa.string()), ("priority", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
        names = [f.name for f in kind.value_type]
        for b in batches:
            got = [scan_text(t or b"") for t in b.column(keep).cast(pa.large_binary()).to_pylist()]
            lists = [pa.array([[dict(zip(names, d)) for d in g[k]] for g in got], kind) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:keep], pa.array([g[0] for g in got], pa.int64()), *lists],
                names=[*b.schema.names[:keep], "n_words", "base", "found"])

    return run


def license_detections(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with ``n_words``, ``base`` (places of base phrases) and ``found`` (detections).

    A detection is (label, priority, start, end), ``start`` and ``end`` numbers of words from 0.
    """
    shipped(docs.sparkSession)
    src = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    schema = ", ".join([f"`{n}` {t}" for n, t in src.dtypes[:-1]] + [SCAN_SCHEMA])
    return src.mapInArrow(_scan(len(keep)), schema)


def _joined(labels: str) -> str:
    return f"array_join(array_sort(array_distinct({labels})), ',')"


def op13_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License detections of all documents, as labels, places of base phrases and a score."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sure = "map(" + ", ".join(f"{p}, {c}D" for p, c in CONFIDENCE.items()) + ")"
    return license_detections(docs, ["doc_id"]).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.expr("array_min(base.start)").alias("first_word"), F.expr("array_max(base.start)").alias("last_word"),
        F.expr(_joined("base.label")).alias("base_labels"), F.expr(_joined("concat(base.label, found.label)")).alias("labels"),
        # one vote for each priority that found something
        F.expr(f"1D - aggregate(array_distinct(found.priority), 1D, (a, p) -> a * (1D - {sure}[p]))").alias("score"))
