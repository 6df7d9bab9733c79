"""Phrase collocations by direct-address tiling of ranked word ids.

1. Blocks.  Tasks cut texts into pieces and words and emit blocks of at most
   ``BLOCK_TOKENS`` words of one language: numbers into the block's own word
   list.  The lists travel packed, by hash bucket of the word, and are summed
   there; words of at least ``least`` places are ranked by falling frequency in
   their bucket, and the buckets' ranks, interleaved, are the word ids.  Each
   block gets the ids of its own words back, so no task holds a vocabulary.
2. Pairs.  A block's neighbours (left id, right id) fall into tiles of ``TILE``
   x ``TILE`` ids.  As ids are ranks, the first tiles are crowded: those are
   counted by ``bincount`` into a dense array, addressed by the pair itself;
   the rest are sorted COO, run lengths of sorted pairs.  Counts travel packed,
   by hash bucket of the pair, and are summed there.
3. Recursion.  Frequent pairs go back to the blocks that hold them, are ranked
   again by frequency, and take the place of words: two frequent pairs that
   overlap in a word are a pair of ranked units, counted in tiles like before.
   That gives the triples.
4. Scores are exact decimals; pairs inside frequent enough triples go; each
   language's best are taken in two steps over shares of its candidates.

Buckets follow from the counted words, blocks from the texts' size; nothing is
sampled, capped or broadcast by hand.

Edge cases: a NULL or empty text has no words; a NULL language is ``und`` (and
counted with rows that say ``und``); repeated rows count as often as they stand
there; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm.common import checkpointed, shipped, table
from tablekit.llm.words import LOWER_AZ, HashTable, mix64, pieces, span_hashes, spread
from tablekit.operators.window import top_k
from tablekit.session import materialize

MIN_COUNT, SHARE, BEST, SCALE = 10, 50, 2000, 1_000_000
BLOCK_TOKENS = 1 << 21
TILE = 512                            # ids a side
DENSE_FROM = 16                       # a tile with a pair for every so many cells is counted densely
BUCKET_TOKENS = 1 << 21               # words of the corpus for each bucket of pairs
BREAK = -1
_U = np.uint64
_SOLID = np.ones(256, dtype=bool)     # bytes of words: all but space, tab and what ends a piece
_SOLID[[0x20, 0x09]] = False
_ENDS = np.zeros(256, dtype=bool)     # [.,;:!?\x0A-\x0D]
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SOLID &= ~_ENDS


# ---------------------------------------------------------------- packing

def _pack(values: np.ndarray) -> bytes:
    """Non-negative integers as byte planes, least byte first, as many as the largest needs."""
    if len(values) == 0:
        return b""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values, np.int64).view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(planes.T).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(packed, np.uint8, offset=1).reshape(packed[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :packed[0]] = planes.T
    return out.view(np.int64).ravel()


def _buckets(n: int) -> int:
    """Buckets for a language of ``n`` words."""
    return max(1, -(-n // BUCKET_TOKENS))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


# ---------------------------------------------------------------- blocks of words

def piece_words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row bounds, piece number) of the words of each document."""
    size = int(offs[-1])
    solid = _SOLID[buf[:size]]
    edge = np.zeros(size + 1, dtype=bool)
    edge[offs] = True
    before, after = np.concatenate(([False], solid)), np.concatenate((solid, [False]))
    start = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    cut = edge[:size].astype(np.int64)
    cut[_ENDS[buf[:size]]] = 1
    return start, end, np.searchsorted(start, offs), np.cumsum(cut)[start] if size else start


class _Block:
    """Words of a number of documents, as numbers into one list."""

    def __init__(self) -> None:
        self.table, self.words, self.tokens, self.size = HashTable(16), [], {}, 0

    def add(self, buf: np.ndarray, offs: np.ndarray, langs: list[str]) -> None:
        start, end, bounds, piece = piece_words(buf, offs)
        slot, new = self.table.slots(span_hashes(buf, start, end))
        if len(new):
            raw, base = buf.tobytes(), len(self.words)
            own = [raw[s:e] for s, e in zip(start[new].tolist(), end[new].tolist())]
            self.words += [b""] * len(new)
            for s, w in zip(slot[new].tolist(), own):
                self.words[s] = w
            assert len(self.words) == base + len(new) == self.table.size
        broken = np.ones(len(slot), dtype=bool)        # a break before the first word of every piece
        broken[1:] = piece[1:] != piece[:-1]
        row = np.searchsorted(bounds, np.arange(len(slot)), side="right") - 1
        names, of = np.unique(np.array(langs, dtype=object).astype(str), return_inverse=True) if langs else ([], [])
        of = np.asarray(of)[row] if len(slot) else np.zeros(0, np.int64)
        for k, name in enumerate(names):
            mine = np.flatnonzero(of == k)
            if len(mine) == 0:
                continue
            # positions of words after those of breaks have been put in between
            at = np.arange(len(mine)) + np.cumsum(broken[mine])
            out = np.full(int(at[-1]) + 1, BREAK, np.int32)
            out[at] = slot[mine]
            self.tokens.setdefault(str(name), []).append(out)
            self.size += len(out)

    def rows(self, first: int) -> Iterator[tuple]:
        """(block, lang, tokens, words, counts) for every language; words by falling frequency."""
        for k, (lang, parts) in enumerate(sorted(self.tokens.items())):
            tokens = np.concatenate(parts)
            count = np.bincount(tokens[tokens >= 0], minlength=len(self.words))
            order = np.argsort(-count, kind="stable")[:np.count_nonzero(count)]
            number = np.full(len(self.words) + 1, -1, np.int64)     # the last cell is the break's
            number[order] = np.arange(len(order))
            yield (first + k, lang, _pack(number[tokens] + 1),
                   [self.words[w].decode("utf-8", "replace") for w in order.tolist()], count[order])


BLOCKS = "block long, lang string, tokens binary, words array<string>, counts array<long>"


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = TaskContext.get().partitionId() << 32
    block = _Block()

    def flush() -> pa.RecordBatch:
        nonlocal made, block
        rows = list(block.rows(made))
        made, block = made + len(rows), _Block()
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                          names=["block", "lang", "tokens", "words", "counts"])

    for b in batches:
        for row, buf, offs in pieces(b.column(1)):
            block.add(LOWER_AZ[buf], offs, b.column(0).slice(row, len(offs) - 1).to_pylist())
            if block.size >= BLOCK_TOKENS:
                yield flush()
    if block.size:
        yield flush()


LISTED = "lang string, bucket int, block long, n long, words array<string>, pos binary, counts binary"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word lists (block, lang, n, words, counts) -> a packed row for each bucket of words."""
    for b in batches:
        for k in range(b.num_rows):
            block, lang, n = (b.column(c)[k] for c in range(3))
            words = b.column(3).slice(k, 1).flatten().cast(pa.large_binary())
            count = b.column(4).slice(k, 1).flatten().to_numpy()
            offs = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
            buf = np.frombuffer(words.buffers()[2], np.uint8)
            buckets = _buckets(n.as_py())
            bucket = _bucket(span_hashes(np.concatenate((buf, np.zeros(8, np.uint8))), offs[:-1], offs[1:]), buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(cuts))
            parts = [order[cuts[u]:cuts[u + 1]] for u in used]
            lists = pa.ListArray.from_arrays(pa.array(np.append(cuts[used], len(order)), pa.int32()),
                                             words.take(pa.array(order)).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(used)), pa.array(used, pa.int32()), pa.repeat(block, len(used)), pa.repeat(n, len(used)),
                 lists, pa.array([_pack(o) for o in parts], pa.binary()), pa.array([_pack(count[o]) for o in parts], pa.binary())],
                names=["lang", "bucket", "block", "n", "words", "pos", "counts"])


WORDS = "lang string, block long, words array<string>, pos binary, ids binary, counts binary"


def _ids(least: int):
    """A bucket's packed word rows -> its frequent words with ids (block NULL), and each block's places and ids."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        flat = pa.chunked_array([c.flatten() for c in t["words"].chunks]).combine_chunks().dictionary_encode()
        which, words = flat.indices.to_numpy(), flat.dictionary
        each = [_unpack(c) for c in t["counts"].to_pylist()]
        total = np.zeros(len(words), np.int64)
        np.add.at(total, which, np.concatenate(each))
        often = np.flatnonzero(total >= least)
        names = words.take(pa.array(often)).to_pylist()
        ranked = often[sorted(range(len(often)), key=lambda i: (-total[often[i]], names[i]))]
        bucket, buckets = key[1].as_py(), _buckets(t["n"][0].as_py())
        ids = np.zeros(len(words), np.int64)
        ids[ranked] = np.arange(len(ranked)) * buckets + bucket + 1
        rows = [(None, words.take(pa.array(ranked)).to_pylist(), None, _pack(ids[ranked]), _pack(total[ranked]))] if len(ranked) else []
        cuts = np.concatenate(([0], np.cumsum([len(e) for e in each])))
        for block, pos, s, e in zip(t["block"].to_pylist(), t["pos"].to_pylist(), cuts[:-1], cuts[1:]):
            own = ids[which[s:e]]
            at = np.flatnonzero(own)
            if len(at):
                rows.append((block, None, _pack(_unpack(pos)[at]), _pack(own[at]), None))
        kinds = [pa.int64(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary()]
        return pa.table({"lang": pa.array([key[0].as_py()] * len(rows), pa.string()),
                         **{c: pa.array([r[k] for r in rows], kinds[k])
                            for k, c in enumerate(("block", "words", "pos", "ids", "counts"))}})

    return run


def _opened_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed words (lang, words, ids, counts) -> a row for each."""
    for b in batches:
        for k in range(b.num_rows):
            words = b.column(1).slice(k, 1).flatten()
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(b.column(0)[k], len(words)), pa.array(_unpack(b.column(2)[k].as_py())), words,
                 pa.array(_unpack(b.column(3)[k].as_py()))], names=["lang", "id", "word", "f"])


def _encoded(key: tuple, block: pa.Table, words: pa.Table) -> pa.Table:
    """A block's tokens and the ids of its words -> runs of ids from 1, a zero before each."""
    tokens = _unpack(block["tokens"][0].as_py())
    of = np.zeros(int(tokens.max()) + 1, np.int64)
    for pos, ids in zip(words["pos"].to_pylist(), words["ids"].to_pylist()):
        of[_unpack(pos) + 1] = _unpack(ids)
    out = of[tokens]
    known = out > 0
    beside = known & (np.concatenate(([False], known[:-1])) | np.concatenate((known[1:], [False])))
    out[~beside] = 0                                   # a word alone is in no phrase
    keep = out > 0
    keep[:-1] |= out[1:] > 0                           # of a row of breaks the last
    return pa.table({"block": block["block"], "lang": block["lang"], "n": block["n"],
                     "ids": pa.array([_pack(out[keep])], pa.binary())})


# ---------------------------------------------------------------- tiles

def _code(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Two numbers under 2 ** 32 as one."""
    return left.astype(_U) << _U(32) | right.astype(_U)


def _halves(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (code >> _U(32)).astype(np.int64), (code & _U(0xFFFFFFFF)).astype(np.int64)


def tile_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ranked numbers, by dense tiles and sorted COO: (left, right, count)."""
    tile = _code(left // TILE, right // TILE)
    names, size = np.unique(tile, return_counts=True)
    dense = names[size >= TILE * TILE // DENSE_FROM]
    out: list[tuple] = []
    rest = np.ones(len(tile), dtype=bool)
    for t in dense:
        own = np.flatnonzero(tile == t)
        i, j = _halves(t)
        rest[own] = False
        cells = np.bincount(left[own] % TILE * TILE + right[own] % TILE, minlength=TILE * TILE)
        at = np.flatnonzero(cells)
        out.append((i * TILE + at // TILE, j * TILE + at % TILE, cells[at]))
    pair = np.sort(_code(left[rest], right[rest]))
    first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else np.zeros(0, np.int64)
    out.append((*_halves(pair[first]), np.diff(np.append(first, len(pair)))))
    return tuple(np.concatenate([o[k] for o in out]).astype(np.int64) for k in range(3))


def _hashed(columns: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(columns[0]), _U)
    for c in columns:
        h = mix64(h * _U(0x9E3779B97F4A7C15) + c.view(_U) + _U(1))
    return h


ENCODED = "block long, lang string, n long, ids binary"
PACKED = "lang string, bucket int, block long, phrases array<binary>, counts binary"


def _by_bucket(lang: str, block: int, columns: list[np.ndarray], count: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Phrases (a column of ids for each word) with counts -> a packed row for each bucket."""
    bucket = _bucket(_hashed(columns), buckets)
    order = np.lexsort((*columns[::-1], bucket))
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(cuts)):
        own = order[cuts[b]:cuts[b + 1]]
        rows.append((int(b), [_pack(c[own]) for c in columns], _pack(count[own])))
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int32()),
         pa.array([block] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.binary())),
         pa.array([r[2] for r in rows], pa.binary())], names=["lang", "bucket", "block", "phrases", "counts"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Encoded blocks (block, lang, n, ids) -> their pairs, counted."""
    for b in batches:
        for block, lang, n, ids in zip(*[b.column(k) for k in range(4)]):
            seq = _unpack(ids.as_py())
            at = np.flatnonzero((seq[:-1] > 0) & (seq[1:] > 0))
            left, right, count = tile_counts(seq[at] - 1, seq[at + 1] - 1)
            if len(left):
                yield _by_bucket(lang.as_py(), block.as_py(), [left + 1, right + 1], count, _buckets(n.as_py()))


def _triples(key: tuple, block: pa.Table, pairs: pa.Table) -> pa.Table:
    """An encoded block and its frequent pairs -> triples, counted over pairs ranked again."""
    seq, n = _unpack(block["ids"][0].as_py()), block["n"][0].as_py()
    cols = [np.concatenate([_unpack(p[k]) for p in pairs["phrases"].to_pylist()]) for k in range(2)]
    total = np.concatenate([_unpack(c) for c in pairs["counts"].to_pylist()])
    code = _code(*cols)
    order = np.argsort(code)
    code, total = code[order], total[order]
    rank = np.empty(len(code), np.int64)
    by_rank = np.lexsort((code, -total))
    rank[by_rank] = np.arange(len(code))
    own = _code(seq[:-1], seq[1:])
    at = np.minimum(np.searchsorted(code, own), len(code) - 1)
    unit = np.where(code[at] == own, rank[at], BREAK)
    at = np.flatnonzero((unit[:-1] >= 0) & (unit[1:] >= 0))
    first, second, count = tile_counts(unit[at], unit[at + 1])
    one, two = _halves(code[by_rank[first]])
    three = _halves(code[by_rank[second]])[1]
    out = _by_bucket(key[1].as_py(), key[0].as_py(), [one, two, three], count, _buckets(n))
    return pa.Table.from_batches([out])


def _summed(words: int, least: int, back: bool):
    """A bucket's packed rows -> its frequent phrases (block NULL), and with ``back`` those of each block."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        each = [[_unpack(c) for c in p] for p in t["phrases"].to_pylist()]
        counts = [_unpack(c) for c in t["counts"].to_pylist()]
        cols = [np.concatenate([e[k] for e in each]) for k in range(words)]
        if words == 2:
            order = np.argsort(_code(*cols), kind="stable")
        else:
            order = np.lexsort(cols[::-1])
        differs = np.zeros(max(0, len(order) - 1), dtype=bool)
        for c in cols:
            differs |= c[order][1:] != c[order][:-1]
        first = np.flatnonzero(np.concatenate(([True], differs)))
        total = np.add.reduceat(np.concatenate(counts)[order], first)
        rows = []
        often = np.flatnonzero(total >= least)
        if len(often):
            rows.append((None, [_pack(c[order][first[often]]) for c in cols], _pack(total[often])))
        if back and len(often):
            group = np.empty(len(order), np.int64)
            group[order] = np.cumsum(np.concatenate(([0], differs)))
            mine = total[group]
            cuts = np.concatenate(([0], np.cumsum([len(c) for c in counts])))
            for block, s, e in zip(t["block"].to_pylist(), cuts[:-1], cuts[1:]):
                at = s + np.flatnonzero(mine[s:e] >= least)
                if len(at):
                    rows.append((block, [_pack(c[at]) for c in cols], _pack(mine[at])))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(rows), pa.string()),
                         "bucket": pa.array([key[1].as_py()] * len(rows), pa.int32()),
                         "block": pa.array([r[0] for r in rows], pa.int64()),
                         "phrases": pa.array([r[1] for r in rows], pa.list_(pa.binary())),
                         "counts": pa.array([r[2] for r in rows], pa.binary())})

    return run


def _opened(words: int):
    """Packed phrases (lang, phrases, counts) -> a row for each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, phrases, counts in zip(*[b.column(k).to_pylist() for k in range(3)]):
                cols = [_unpack(p) for p in phrases] + [_unpack(counts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(cols[0]), pa.string()), *[pa.array(c, pa.int64()) for c in cols]],
                    names=["lang", *[f"w{k + 1}" for k in range(words)], "a"])

    return run


def _rows(packed: DataFrame, words: int) -> DataFrame:
    schema = "lang string, " + ", ".join(f"w{k + 1} long" for k in range(words)) + ", a long"
    return packed.filter("block IS NULL").select("lang", "phrases", "counts").mapInArrow(_opened(words), schema)


# ---------------------------------------------------------------- candidates

def phrase_counts(docs: DataFrame, least: int = MIN_COUNT) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(totals(lang, n), words(lang, id, word, f), pairs(lang, w1, w2, a), triples(lang, w1, w2, w3, a)).

    The last three hold what has ``least`` or more places; ``n`` counts the
    language's words, frequent or not.
    """
    shipped(docs.sparkSession)
    src = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    blocks = materialize(src.mapInArrow(_blocked, BLOCKS))
    # written as a table, so that the planner knows how small it is
    totals = materialize(blocks.groupBy("lang").agg(F.sum(F.expr("aggregate(counts, 0L, (a, c) -> a + c)")).alias("n")))
    lists = blocks.select("block", "lang", "words", "counts").join(totals, "lang").select("block", "lang", "n", "words", "counts")
    ranked = materialize(lists.mapInArrow(_listed, LISTED).groupBy("lang", "bucket").applyInArrow(_ids(least), WORDS))
    words = checkpointed(ranked.filter("block IS NULL").select("lang", "words", "ids", "counts")
                         .mapInArrow(_opened_words, "lang string, id long, word string, f long"))
    own = ranked.filter("block IS NOT NULL").select(F.col("block").alias("of"), F.col("lang").alias("in"), "pos", "ids")
    encoded = materialize(blocks.select("block", "lang", "tokens").join(totals, "lang").groupBy("block", "lang")
                          .cogroup(own.groupBy("of", "in")).applyInArrow(_cogrouped(_encoded, ENCODED), ENCODED))
    pairs = materialize(encoded.mapInArrow(_pairs, PACKED).groupBy("lang", "bucket")
                        .applyInArrow(_summed(2, least, True), PACKED))
    back = pairs.filter("block IS NOT NULL").select(F.col("block").alias("of"), F.col("lang").alias("in"), "phrases", "counts")
    triples = (encoded.groupBy("block", "lang").cogroup(back.groupBy("of", "in"))
               .applyInArrow(_cogrouped(_triples, PACKED), PACKED))
    triples = triples.groupBy("lang", "bucket").applyInArrow(_summed(3, least, False), PACKED)
    return totals, words, checkpointed(_rows(pairs, 2)), checkpointed(_rows(triples, 3))


def _cogrouped(fn, schema: str):
    """``fn`` where both sides have rows; nothing for a block without frequent words or pairs."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    empty = to_arrow_schema(StructType.fromDDL(schema)).empty_table()

    def run(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        return fn(key, a, b) if a.num_rows and b.num_rows else empty

    return run


def _score(a: str, left: str, right: str) -> str:
    """floor(SCALE * a * a / (left * right)), exact: the decimals hold counts of up to 10 ** 15."""
    wide = {n: f"CAST({n} AS DECIMAL(16,0))" for n in (a, left, right)}
    return (f"CAST((CAST({SCALE} AS DECIMAL(7,0)) * ({wide[a]} * {wide[a]})) "
            f"DIV ({wide[left]} * {wide[right]}) AS BIGINT)")


def collocations(docs: DataFrame, least: int = MIN_COUNT, share: int = SHARE, best: int = BEST) -> DataFrame:
    """The ``best`` collocations of every language: lang, rank, phrase, a, l, r, n, score."""
    totals, words, pairs, triples = phrase_counts(docs, least)

    def word(k: int) -> DataFrame:
        return words.select("lang", F.col("id").alias(f"w{k}"), F.col("word").alias(f"s{k}"), F.col("f").alias(f"f{k}"))

    def pair(k: int) -> DataFrame:
        return pairs.select("lang", F.col("w1").alias(f"w{k}"), F.col("w2").alias(f"w{k + 1}"), F.col("a").alias(f"p{k}"))

    inside = triples.select("lang", "w1", "w2", "a").union(triples.select("lang", "w2", "w3", "a"))
    longest = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    two = (pairs.join(longest, ["lang", "w1", "w2"], "left").filter(f"longer IS NULL OR 100 * longer < {share} * a")
           .join(word(1), ["lang", "w1"]).join(word(2), ["lang", "w2"])
           .select("lang", F.concat_ws(" ", "s1", "s2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
                   F.expr(_score("a", "f1", "f2")).alias("score")))
    cut = (triples.join(pair(1), ["lang", "w1", "w2"]).join(pair(2), ["lang", "w2", "w3"])
           .join(word(1), ["lang", "w1"]).join(word(2), ["lang", "w2"]).join(word(3), ["lang", "w3"])
           .withColumn("c1", F.expr(_score("a", "f1", "p2"))).withColumn("c2", F.expr(_score("a", "p1", "f3"))))
    three = cut.select("lang", F.concat_ws(" ", "s1", "s2", "s3").alias("phrase"), "a",
                       F.when(F.col("c1") <= F.col("c2"), F.col("f1")).otherwise(F.col("p1")).alias("l"),
                       F.when(F.col("c1") <= F.col("c2"), F.col("p2")).otherwise(F.col("f3")).alias("r"),
                       F.least("c1", "c2").alias("score"))
    ranked = top_k(two.unionByName(three), ["lang"], ["score DESC", "a DESC", "phrase"], best)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2,000 phrases of two or three words of every language."""
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
f AS (
  SELECT lang, k, CASE k WHEN 1 THEN w[i] WHEN 2 THEN w[i] || ' ' || w[i + 1] ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS phrase,
         count(*) AS f
  FROM places, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, j, array_to_string(w[:j], ' ') AS lp, array_to_string(w[j + 1:], ' ') AS rp
  FROM cand c, (SELECT unnest([1, 2]) AS j) WHERE j < c.k),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, j, l.f AS l, r.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = lp AND l.k = j
              JOIN f r ON r.lang = c.lang AND r.phrase = rp AND r.k = c.k - j),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, k, phrase ORDER BY score, j) = 1),
inner_pairs AS (
  SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM cand WHERE k = 3
  UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM cand WHERE k = 3),
gone AS (SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN inner_pairs i ON i.lang = c.lang AND i.phrase = c.phrase
         WHERE c.k = 2 AND 100 * i.a >= 50 * c.a),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
  FROM lowest s LEFT JOIN gone g ON g.lang = s.lang AND g.phrase = s.phrase AND s.k = 2 WHERE g.phrase IS NULL)
SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""
