"""Best-fit packing of tokenized documents into sequences of fixed length.

Only lengths travel: texts are tokenized where they are read, and each piece
(at most ``capacity`` ids) becomes a row of numbers.  Pieces are dealt by hash
into cells of about ``CELL_ITEMS``; a cell is packed by best fit in decreasing
length, then improved by a local search: between any two underfull bins
documents move, change places one for one, two for one or one for two, while
that raises the sum of squared fills, so that bins fill up and others end
empty.  Partners are found by the sizes, and sums of two sizes, that bins hold,
so bins of any number of documents take part.  Each cell's least full bins (a tenth of its
bins at most) are pooled and packed again, round by round, until the pool fits
into one cell.

Edge cases: a NULL or empty text is the end id alone; repeated rows and ids
are packed as often as they stand there; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm.common import checkpointed, shipped, table
from tablekit.llm.token_orc import with_end_id
from tablekit.llm.tokens import DEFAULT_VOCABULARY, batch_tokenizer
from tablekit.llm.words import pieces, spread

CAPACITY = 2048
CELL_ITEMS = 8192
OPEN_SHARE = 10                       # one bin in so many, the least full, is pooled for the next round
PIECES_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Pieces of every document: longer ones are cut so that only the first piece is short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = batch_tokenizer(vocabulary)
        for b in batches:
            for row, buf, offs in pieces(b.column(1)):
                ids, bounds = with_end_id(*tok.encode(buf, offs))
                n = np.diff(bounds)
                k = -(-n // capacity)
                piece = spread(np.zeros(len(n), np.int64), k)
                of = np.repeat(np.arange(len(n)), k)
                first = n - (k - 1) * capacity
                start = np.where(piece == 0, 0, first[of] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[of], capacity)
                flat, at = memoryview(ids).cast("B"), bounds[of] + start
                crc = [zlib.crc32(flat[4 * s:4 * e]) for s, e in zip(at.tolist(), (at + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(row, len(n)).take(pa.array(of)), pa.array(piece.astype(np.int32)),
                     pa.array(start), pa.array(length), pa.array(crc, type=pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    shipped(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, PIECES_SCHEMA))


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best fit, longest first: every item goes to the fullest bin that holds it."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    rooms = 0                                          # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fit = rooms >> lengths[i]
        if fit:
            room = (fit & -fit).bit_length() - 1 + lengths[i]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        left = room - lengths[i]
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins


class _Underfull:
    """Bins that are neither empty nor full, found by the sizes, and sums of two sizes, that they hold."""

    def __init__(self, bins: list[list[int]], size: list[int], capacity: int) -> None:
        self.size, self.capacity = size, capacity
        self.items: list[dict[int, list[int]]] = []    # bin -> size -> its items
        self.fill: list[int] = []
        self.bins: dict[int, tuple[list[int], dict[int, tuple[int, int]]]] = {}
        self.by: tuple[list[set[int]], list[set[int]]] = tuple([set() for _ in range(capacity + 1)] for _ in range(2))
        self.bits = [0, 0]                             # bit s: a bin holds the size, the sum, s
        for b in bins:
            own: dict[int, list[int]] = {}
            for i in b:
                own.setdefault(size[i], []).append(i)
            self.items.append(own)
            self.fill.append(sum(size[i] for i in b))
            self.enter(len(self.items) - 1)

    def enter(self, b: int) -> None:
        if not 0 < self.fill[b] < self.capacity:
            return
        own = self.items[b]
        sizes = sorted(own)
        sums = {x + y: (x, y) for k, x in enumerate(sizes) for y in sizes[k:] if x != y or len(own[x]) > 1}
        self.bins[b] = sizes, sums
        for kind, keys in enumerate((sizes, sums)):
            for s in keys:
                self.by[kind][s].add(b)
                self.bits[kind] |= 1 << s

    def leave(self, b: int) -> None:
        for kind, keys in enumerate(self.bins.pop(b)):
            for s in keys:
                self.by[kind][s].discard(b)
                if not self.by[kind][s]:
                    self.bits[kind] ^= 1 << s

    def best(self, y: int) -> tuple[int, int, tuple[int, ...], tuple[int, ...]] | None:
        """(gain, x, sizes to y, sizes back to x): of moves, one for one, two for one and one for two, the best for ``y``."""
        fill, room = self.fill[y], self.capacity - self.fill[y]
        sizes, sums = self.bins[y]
        back = [(0, ())] + [(s, (s,)) for s in sizes] + list(sums.items())
        best = None
        for o, out in back:
            for kind in range(2 if len(out) < 2 else 1):
                left = (self.bits[kind] & ((1 << min(o + room, self.capacity) + 1) - 1)) >> (o + 1)
                while left:
                    d = left.bit_length()              # what y gains in fill
                    if best and 2 * d * (self.capacity - 1) <= best[0]:
                        break
                    x = min((b for b in self.by[kind][o + d] if b != y), key=self.fill.__getitem__, default=None)
                    if x is not None and fill + d > self.fill[x]:
                        gain = 2 * d * (fill - self.fill[x] + d)
                        if best is None or gain > best[0]:
                            best = gain, x, (o + d,) if kind == 0 else self.bins[x][1][o + d], out
                        break
                    left ^= 1 << d - 1
        return best

    def exchange(self, y: int, x: int, into: tuple[int, ...], out: tuple[int, ...]) -> None:
        for b in (x, y):
            self.leave(b)
        for a, b, moved in ((x, y, into), (y, x, out)):
            for s in moved:
                own = self.items[a][s]
                self.items[b].setdefault(s, []).append(own.pop())
                if not own:
                    del self.items[a][s]
                self.fill[a] -= s
                self.fill[b] += s
        for b in (x, y):
            self.enter(b)


def local_search(bins: list[list[int]], size: list[int], capacity: int) -> list[list[int]]:
    """Exchange between any two underfull bins while the sum of squared fills rises; bins that end empty go."""
    state = _Underfull(bins, size, capacity)
    rises = True
    while rises:
        rises = False
        for y in sorted(state.bins, key=lambda b: (-state.fill[b], b)):
            while y in state.bins:
                room = sum(capacity - state.fill[b] for b in state.bins)
                if room < capacity:                    # not even all room together makes a bin empty
                    break
                found = state.best(y)
                if not found:
                    break
                state.exchange(y, *found[1:])
                rises = True
    return [[i for own in b.values() for i in own] for b in state.items if b]


def _cell_packer(capacity: int, level: int, last: bool):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        size = pdf["length"].astype(int).tolist()
        bins = local_search(best_fit(size, capacity), size, capacity)
        seq, off = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        is_open = np.zeros(len(pdf), bool)
        fill = [sum(size[i] for i in own) for own in bins]
        again = sorted((b for b in range(len(bins)) if fill[b] < capacity), key=lambda b: (fill[b], b))
        again = set() if last else set(again[:max(1, len(bins) // OPEN_SHARE)])
        for b, own in enumerate(bins):
            seq[own] = (level << 58) + (int(key[0]) << 22) + b
            off[own] = np.cumsum([0] + [size[i] for i in own[:-1]])
            is_open[own] = b in again
        return pdf.drop(columns="__cell").assign(sequence_id=seq, offset=off, __open=is_open)

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, cell_items: int = CELL_ITEMS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``."""
    shipped(items.sparkSession)
    schema = ", ".join([f"`{n}` {t}" for n, t in items.dtypes] + ["sequence_id long", "offset long", "__open boolean"])
    done, rest, level = [], items, 0
    while True:
        n = rest.count()
        cells = -(-n // cell_items)
        dealt = rest.withColumn("__cell", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(cells, 1))))
        packed = checkpointed(dealt.repartition(max(cells, 1), "__cell").groupBy("__cell").applyInPandas(_cell_packer(capacity, level, cells <= 1), schema))
        done.append(packed.filter(~F.col("__open")).drop("__open"))
        if cells <= 1:
            break
        rest, level = packed.filter("__open").drop("__open", "sequence_id", "offset"), level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """One row per piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(checkpointed(token_pieces(docs, capacity, vocabulary)), capacity)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))
