"""N-gram Jaccard join with signature trees.

The join finds all documents whose sets of word n-grams reach a Jaccard
similarity, and returns connected components instead of pairs.

1. Counting.  Tasks hash the n-grams of whole texts and send them, packed, to
   hash buckets, where the documents of every n-gram are counted.  N-grams of
   one document can't be shared, so a document stays only if enough of its
   n-grams return; for the others the join is over.
2. Equal sets become one representative.
3. Near order.  Representatives, sorted by a min-hash, are cut into signature
   trees: nodes hold the OR of token bitmaps and ranges of sizes, and a dual
   traversal of a tree with itself drops node pairs whose greatest possible
   overlap is too small.  Exact checks of the surviving leaf pairs give links;
   pairs already connected are skipped, so a group of n near copies costs
   about n checks.
4. Completion.  Two sets that reach the similarity share an n-gram among the
   rarest of each (prefix filter).  For every such n-gram whose documents are
   not yet in one component, signature trees over those documents are
   traversed again, skipping node pairs of one component; the surviving pairs
   are checked exactly.  Groups of over ``CELL`` documents are split into
   cells, each a pair of chunks; chunks of one component are never paired.
   Where a cell has more surviving pairs than documents, no pair is written:
   the sets of its documents are brought together (once for all n-grams with
   the same documents), and the checks run there, those of already connected
   documents skipped.

Bounds: a pair needs ``den * overlap >= num * (a + b - overlap)``.

Edge cases: texts without words (NULL, empty) have an empty set, linked with
nothing; fewer than n words are one n-gram; rows are told apart even when ids
repeat or are NULL (a component is named by its smallest non-NULL id); equal
rows are linked; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm.common import checkpointed, release, shipped, table
from tablekit.llm.components import connected_components
from tablekit.llm.words import (LOWER_AZ, mix64, ngram_hashes, pieces, sorted_sets, span_hashes, spread, word_spans)

WORDS, NUM, DEN = 4, 85, 100
BLOCK_GRAMS = 1 << 20                 # n-grams that a task packs at once
TREE = 256                            # representatives in a tree of the near order
TREE_GRAMS = 1 << 18
CARRY = 8                             # that a tree shares with the one before
CELL = 2048
FANOUT = 8
MAX_WIDTH = 1 << 16                   # bits of the widest signature
PART_BYTES = 16 << 20                 # text for each part of the documents
CROWD_GRAMS = 1 << 20                 # n-grams of a chunk of sets that meet
_U = np.uint64
HASH_BITS = ~_U(0xFF)                 # n-grams are told apart by 56 bits


# ---------------------------------------------------------------- packing

def _pack_hashes(h: np.ndarray) -> bytes:
    """Sorted hashes (their low byte is zero) as first value and steps of as few bytes as the widest needs."""
    steps = np.diff(h) >> _U(8)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([width]) + h[:1].tobytes() + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpack_hashes(b: bytes) -> np.ndarray:
    steps = np.zeros(((len(b) - 9) // b[0], 8), np.uint8)
    steps[:, :b[0]] = np.frombuffer(b, np.uint8, offset=9).reshape(-1, b[0])
    return np.cumsum(np.concatenate((np.frombuffer(b, _U, 1, 1), steps.view(_U).ravel() << _U(8))), dtype=_U)


def _pack_nodes(node: np.ndarray) -> tuple[bytes, bytes]:
    """Documents of entries as a list of them and places in it, of two bytes if that is enough."""
    here, back = np.unique(node, return_inverse=True)
    return here.tobytes(), back.astype(np.uint16 if len(here) < 1 << 16 else np.uint32).tobytes()


def _unpack_nodes(nodes: bytes, rows: bytes) -> np.ndarray:
    own = np.frombuffer(nodes, np.int64)
    return own[np.frombuffer(rows, np.uint16 if len(own) < 1 << 16 else np.uint32)]


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    """Equal ranges of the hash space: ascending with the hash."""
    return (((h >> _U(32)) * _U(n)) >> _U(32)).astype(np.int64)


def _pack_places(place: np.ndarray, n: int) -> bytes:
    """Places in a run of n documents, of two bytes if that is enough."""
    return place.astype(np.uint16 if n <= 1 << 16 else np.uint32).tobytes()


def _unpack_run(run: bytes, rows: bytes) -> np.ndarray:
    """Documents of entries from their run (first document, how many) and places in it."""
    first, n = np.frombuffer(run, np.int64)
    return first + np.frombuffer(rows, np.uint16 if n <= 1 << 16 else np.uint32).astype(np.int64)


BLOCKS = "bucket int, hashes binary, nodes binary, rows binary"


def _blocks(words: int, buckets: int):
    """Documents (doc_id, key, text) -> n-gram blocks by bucket, and their documents (bucket >= buckets)."""

    def emit(node: np.ndarray, doc: list, key: list, values: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        n = np.diff(bounds)
        of = np.repeat(np.arange(len(n)), n)
        mixed = mix64(values ^ _U(0xA0761D6478BD642F))
        sums = [np.concatenate((np.zeros(1, _U), np.cumsum(x, dtype=_U))) for x in (mixed, mix64(mixed))]
        d1, d2 = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
        ids = np.array([i if i is not None else 0 for i in doc], np.int64)
        known = np.array([i is not None for i in doc], np.uint8)
        meta = np.column_stack([node, ids, known, np.array(key, np.int64), n, d1.view(np.int64), d2.view(np.int64)])
        out = [(buckets + int(node[0]) % buckets, b"", b"", np.ascontiguousarray(meta, np.int64).tobytes())]
        order = np.argsort(values, kind="stable")
        values, of = values[order], of[order]
        cuts = np.searchsorted(_bucket(values, buckets), np.arange(buckets + 1))
        run = np.array([node[0], len(node)], np.int64).tobytes()          # a list of them in each bucket would outgrow the n-grams
        for b in np.flatnonzero(np.diff(cuts)):
            s, e = cuts[b], cuts[b + 1]
            out.append((int(b), _pack_hashes(values[s:e]), run, _pack_places(of[s:e], len(node))))
        return pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int32()), *[pa.array([o[k] for o in out], pa.binary()) for k in (1, 2, 3)]],
            names=["bucket", "hashes", "nodes", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seen = TaskContext.get().partitionId() << 36, 0
        held: list = []
        grams = 0

        def flush() -> pa.RecordBatch:
            bounds = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(h[4]) for h in held]))))
            return emit(np.concatenate([h[0] for h in held]), [i for h in held for i in h[1]],
                        [i for h in held for i in h[2]], np.concatenate([h[3] for h in held]), bounds)

        for b in batches:
            for row, buf, offs in pieces(b.column(2)):
                n = len(offs) - 1
                buf = LOWER_AZ[buf]
                start, end, bounds = word_spans(buf, offs)
                values, bounds = ngram_hashes(span_hashes(buf, start, end), bounds, words)
                values, bounds = sorted_sets(values & HASH_BITS, bounds)
                held.append((base + seen + np.arange(n), b.column(0).slice(row, n).to_pylist(),
                             b.column(1).slice(row, n).to_pylist(), values, bounds))
                seen += n
                grams += len(values) + n
                if grams >= BLOCK_GRAMS:
                    yield flush()
                    held, grams = [], 0
        if held:
            yield flush()

    return run


SHARED = "part int, hashes binary, nodes binary, rows binary, counts binary, meta binary"


def _count(buckets: int, parts: int):
    """A bucket's blocks -> entries of n-grams that several documents have, by document part."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if key[0].as_py() >= buckets:
            meta = np.concatenate([np.frombuffer(r, np.int64).reshape(-1, 7) for r in t["rows"].to_pylist()])
            part = (mix64(meta[:, 0].view(_U)) % _U(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            meta, part = meta[order], part[order]
            cuts = np.searchsorted(part, np.arange(parts + 1))
            out = [(int(p), None, None, None, None, meta[cuts[p]:cuts[p + 1]].tobytes()) for p in np.flatnonzero(np.diff(cuts))]
        else:
            hs, nodes = [], []
            for h, nd, r in zip(t["hashes"].to_pylist(), t["nodes"].to_pylist(), t["rows"].to_pylist()):
                hs.append(_unpack_hashes(h))
                nodes.append(_unpack_run(nd, r))
            h, node = np.concatenate(hs), np.concatenate(nodes)
            order = np.argsort(h, kind="stable")
            h, node = h[order], node[order]
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            size = np.diff(np.append(first, len(h)))
            count = np.repeat(size, size)
            keep = count > 1
            h, node, count = h[keep], node[keep], np.minimum(count[keep], 65535).astype(np.uint16)
            part = (mix64(node.view(_U)) % _U(parts)).astype(np.int64)
            order = np.lexsort((h, part))
            h, node, count, part = h[order], node[order], count[order], part[order]
            cuts = np.searchsorted(part, np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cuts)):
                s, e = cuts[p], cuts[p + 1]
                out.append((int(p), _pack_hashes(h[s:e]), *_pack_nodes(node[s:e]), count[s:e].tobytes(), None))
        return pa.table({"part": pa.array([o[0] for o in out], pa.int32()),
                         **{c: pa.array([o[i + 1] for o in out], pa.binary())
                            for i, c in enumerate(("hashes", "nodes", "rows", "counts", "meta"))}})

    return run


SETS = ("node long, doc_id long, key long, n long, d1 long, d2 long, grams binary, prefix array<long>, "
        "near1 long, near2 long, signature binary")


def _signature(grams: np.ndarray, n: int) -> bytes:
    """Token bitmap of a set, about two bits a token, a power of two wide."""
    width = max(64, min(MAX_WIDTH, 1 << int(2 * max(n, 1) - 1).bit_length()))
    bits = np.zeros(width, np.uint8)
    bits[(grams >> _U(8) & _U(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _gather(num: int, den: int):
    """A part's entries -> a row for every document; grams, prefix and signature if it can have a partner."""

    def run(t: pa.Table) -> pa.Table:
        metas = [np.frombuffer(m, np.int64).reshape(-1, 7) for m in t["meta"].to_pylist() if m is not None]
        meta = np.concatenate(metas)
        meta = meta[np.argsort(meta[:, 0])]
        rows = [r for r in zip(*[t[c].to_pylist() for c in ("hashes", "nodes", "rows", "counts")]) if r[0]]
        h = np.concatenate([_unpack_hashes(r[0]) for r in rows]) if rows else np.zeros(0, _U)
        node = np.concatenate([_unpack_nodes(r[1], r[2]) for r in rows]) if rows else np.zeros(0, np.int64)
        count = np.concatenate([np.frombuffer(r[3], np.uint16) for r in rows]) if rows else np.zeros(0, np.uint16)
        at = np.searchsorted(meta[:, 0], node)
        order = np.lexsort((h, at))
        h, count, at = h[order], count[order], at[order]
        bounds = np.searchsorted(at, np.arange(len(meta) + 1))
        shared, n = np.diff(bounds), meta[:, 4]
        grams, prefix, near1, near2, sign = ([None] * len(meta) for _ in range(5))
        for i in np.flatnonzero((n > 0) & (den * shared >= num * n)):
            own, c = h[bounds[i]:bounds[i + 1]], count[bounds[i]:bounds[i + 1]]
            least = -(-num * int(n[i]) // den)
            k = int(n[i]) - least + 1 - (int(n[i]) - len(own))        # of the prefix, what others may have
            grams[i], sign[i] = own.tobytes(), _signature(own, int(n[i]))
            prefix[i] = own[np.lexsort((own, c))[:k]].view(np.int64).tolist()
            near1[i] = int(mix64(own ^ _U(0x1F83D9ABFB41BD6B)).min() >> _U(1))
            near2[i] = int(mix64(own ^ _U(0x5BE0CD19137E2179)).min() >> _U(1))
        return pa.table({
            "node": pa.array(meta[:, 0]), "doc_id": pa.array(meta[:, 1], mask=meta[:, 2] == 0),
            "key": pa.array(meta[:, 3]), "n": pa.array(n), "d1": pa.array(meta[:, 5]), "d2": pa.array(meta[:, 6]),
            "grams": pa.array(grams, pa.binary()), "prefix": pa.array(prefix, pa.list_(pa.int64())),
            "near1": pa.array(near1, pa.int64()), "near2": pa.array(near2, pa.int64()),
            "signature": pa.array(sign, pa.binary())})

    return run


def gram_sets(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """A row (SETS) for every row of ``docs(doc_id, text)``; grams are those that other documents have too."""
    shipped(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"),
                      F.col("text").cast("string").alias("text"))
    blocks = src.mapInArrow(_blocks(words, 2 * parts), BLOCKS)
    shared = blocks.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_count(2 * parts, parts), SHARED)
    return shared.repartition(parts, "part").groupBy("part").applyInArrow(_gather(num, den), SETS)


# ---------------------------------------------------------------- signature trees

class UnionFind:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _levels(bits: np.ndarray, size: np.ndarray, shared: np.ndarray, comp: np.ndarray) -> list[dict]:
    """Tree levels from the leaves up; a node is FANOUT consecutive nodes of the level below."""
    excess = shared - np.bitwise_count(bits).sum(axis=1)
    levels = [dict(bits=bits, low=size, high=size, shared=shared, excess=excess, comp=comp)]
    while len(levels[-1]["low"]) > FANOUT:
        b = levels[-1]
        at = np.arange(0, len(b["low"]), FANOUT)
        lo, hi = np.minimum.reduceat(b["comp"], at), np.maximum.reduceat(b["comp"], at)
        levels.append(dict(
            bits=np.bitwise_or.reduceat(b["bits"], at, axis=0), low=np.minimum.reduceat(b["low"], at),
            high=np.maximum.reduceat(b["high"], at), shared=np.maximum.reduceat(b["shared"], at),
            excess=np.maximum.reduceat(b["excess"], at), comp=np.where(lo == hi, lo, -1)))
    return levels


def _possible(level: dict, i: np.ndarray, j: np.ndarray, num: int, den: int, leaf: bool) -> np.ndarray:
    """Which node pairs may hold a pair that links two components."""
    ok = ~((level["comp"][i] == level["comp"][j]) & (level["comp"][i] >= 0))
    ok &= (den * level["high"][i] >= num * level["low"][j]) & (den * level["high"][j] >= num * level["low"][i])
    at = np.flatnonzero(ok)
    step = max(1, (1 << 22) // level["bits"].shape[1])
    for s in range(0, len(at), step):
        a, b = i[at[s:s + step]], j[at[s:s + step]]
        common = np.bitwise_count(level["bits"][a] & level["bits"][b]).sum(axis=1).astype(np.int64)
        most = common + np.minimum(level["excess"][a], level["excess"][b])
        most = np.minimum(most, np.minimum(level["shared"][a], level["shared"][b]))
        # overlap >= num / (num + den) * (a + b)
        ok[at[s:s + step]] = (num + den) * most >= num * (level["low"][a] + level["low"][b])
    return ok


def dual_traversal(bits: np.ndarray, size: np.ndarray, shared: np.ndarray, comp: np.ndarray,
                   num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaf pairs i < j of different components that no bound excludes."""
    levels = _levels(bits, size, shared, comp)
    top = len(levels[-1]["low"])
    i, j = np.triu_indices(top)
    for depth in range(len(levels) - 1, -1, -1):
        if depth == 0:
            apart = i < j
            i, j = i[apart], j[apart]
        ok = _possible(levels[depth], i, j, num, den, depth == 0)
        i, j = i[ok], j[ok]
        if depth == 0 or len(i) == 0:
            return i, j
        below = len(levels[depth - 1]["low"])
        ci = (i[:, None] * FANOUT + np.arange(FANOUT))
        cj = (j[:, None] * FANOUT + np.arange(FANOUT))
        a = np.repeat(ci, FANOUT, axis=1).ravel()
        b = np.tile(cj, (1, FANOUT)).ravel()
        keep = (a < below) & (b < below) & (a <= b)
        i, j = a[keep], b[keep]
    return i, j


def candidate_pairs(signs: list[bytes], size: np.ndarray, shared: np.ndarray, comp: np.ndarray,
                    num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Dual traversals by signature width; the next wider signatures are folded to join in."""
    width = np.array([len(s) for s in signs])
    out_i, out_j = [], []
    for w in np.unique(width):
        own = np.flatnonzero((width == w) | (width == 2 * w))
        if len(own) < 2:
            continue
        bits = np.zeros((len(own), max(1, w // 8)), _U)
        for k, m in enumerate(own):
            v = np.frombuffer(signs[m], _U)
            bits[k] = v if len(signs[m]) == w else v[:len(v) // 2] | v[len(v) // 2:]
        order = np.lexsort((np.arange(len(own)), size[own] // 16))
        own, bits = own[order], bits[order]
        i, j = dual_traversal(bits, size[own], shared[own], comp[own], num, den)
        i, j = own[i], own[j]
        narrow = (width[i] == w) | (width[j] == w)
        out_i.append(i[narrow])
        out_j.append(j[narrow])
    if not out_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_i), np.concatenate(out_j)


def linked(a: np.ndarray, b: np.ndarray, na: int, nb: int, num: int, den: int) -> bool:
    """The exact check on sorted distinct n-grams."""
    at = np.searchsorted(b, a)
    overlap = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return (num + den) * overlap >= num * (na + nb)


# ---------------------------------------------------------------- joins

def _tree_links(num: int, den: int):
    """Representatives in near order (rep, n, grams, signature) -> links inside each tree."""

    def links(rows: list[tuple]) -> list[tuple]:
        sets = [np.frombuffer(r[2], _U) for r in rows]
        size, shared = np.array([r[1] for r in rows]), np.array([len(s) for s in sets])
        i, j = candidate_pairs([r[3] for r in rows], size, shared, np.arange(len(rows)), num, den)
        uf, found = UnionFind(len(rows)), []
        for a, b in zip(i.tolist(), j.tolist()):
            if uf.find(a) != uf.find(b) and linked(sets[a], sets[b], size[a], size[b], num, den):
                uf.join(a, b)
                found.append((rows[a][0], rows[b][0]))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        total = carried = 0
        found: list[tuple] = []
        for b in batches:
            for r in zip(*[b.column(k).to_pylist() for k in range(4)]):
                rows.append(r)
                total += len(r[2]) // 8
                if len(rows) >= TREE or total >= TREE_GRAMS and len(rows) > carried + 1:
                    found += links(rows)
                    rows = rows[-CARRY:]
                    total, carried = sum(len(x[2]) // 8 for x in rows), len(rows)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])
                found = []
        found += links(rows) if len(rows) > carried else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def near_links(reps: DataFrame, by: str, num: int, den: int) -> DataFrame:
    """Links (a, b) of trees over the order of one min-hash."""
    return (reps.select("rep", "n", "grams", "signature", by).repartitionByRange(by, "rep")
            .sortWithinPartitions(by, "rep").select("rep", "n", "grams", "signature")
            .mapInArrow(_tree_links(num, den), "a long, b long"))


def _each_cell(batches: Iterator[pa.RecordBatch], width: int, close) -> Iterator[pa.RecordBatch]:
    """``close(rows)`` for the rows of every cell; rows come ordered by their first two columns, key and cell."""
    rows: list[tuple] = []
    for b in batches:
        for r in zip(*[b.column(k).to_pylist() for k in range(width)]):
            if rows and rows[-1][:2] != r[:2]:
                yield close(rows)
                rows = []
            rows.append(r)
    if rows:
        yield close(rows)


def _cell_pairs(num: int, den: int):
    """Rows (key, cell, rep, comp, n, shared, signature) -> candidate pairs (a, b, NULL); where they crowd, members (a, a, crowd)."""

    def close(rows: list[tuple]) -> pa.RecordBatch:
        a = b = np.zeros(0, np.int64)
        crowd: list[int | None] = []
        if len({r[3] for r in rows}) > 1:
            comp = np.unique([r[3] for r in rows], return_inverse=True)[1]
            size, shared = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
            i, j = candidate_pairs([r[6] for r in rows], size, shared, comp, num, den)
            rep = np.array([r[2] for r in rows], np.int64)
            if len(i) > len(rows):                     # not the pairs, n * n of them, but who has to meet
                own = np.unique(np.concatenate((i, j)))
                own = own[np.argsort(rep[own])]
                met = list(_meetings(rep[own], shared[own]))
                a = b = np.concatenate([m for _, m in met])
                crowd = [name for name, m in met for _ in m]
            else:
                a, b, crowd = np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j]), [None] * len(i)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(crowd, pa.int64())], names=["a", "b", "crowd"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _each_cell(batches, 7, close)

    return run


def _meetings(rep: np.ndarray, shared: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(name, members) of a crowd, in pairs of chunks when its sets are many n-grams; the same members have the same name."""
    chunk = np.cumsum(shared) // CROWD_GRAMS
    parts = [rep[chunk == c] for c in np.unique(chunk)]
    for k, x in enumerate(parts):
        for y in parts[k + 1:] or ([None] if len(parts) == 1 else []):
            members = x if y is None else np.concatenate((x, y))
            yield xxhash.xxh64_intdigest(members.tobytes()) - (1 << 63), members


def _cell_links(num: int, den: int):
    """Rows (key, cell, rep, comp, n, grams, signature) -> links between components, at most one less than there are rows."""

    def close(rows: list[tuple]) -> pa.RecordBatch:
        comp = np.unique([r[3] for r in rows], return_inverse=True)[1]
        sets = [np.frombuffer(r[5], _U) for r in rows]
        size, shared = np.array([r[4] for r in rows]), np.array([len(x) for x in sets])
        i, j = candidate_pairs([r[6] for r in rows], size, shared, comp, num, den)
        uf, found = UnionFind(int(comp.max()) + 1), []
        for a, b in zip(i.tolist(), j.tolist()):
            if uf.find(comp[a]) != uf.find(comp[b]) and linked(sets[a], sets[b], size[a], size[b], num, den):
                uf.join(comp[a], comp[b])
                found.append((rows[a][2], rows[b][2]))
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _each_cell(batches, 7, close)

    return run


def _checked(num: int, den: int):
    """Pairs with both sets (a, b, na, nb, ga, gb) -> those that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = [linked(np.frombuffer(x, _U), np.frombuffer(y, _U), na, nb, num, den)
                  for na, nb, x, y in zip(*[t.column(k).to_pylist() for k in (2, 3, 4, 5)])]
            yield t.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def completing_links(reps: DataFrame, comps: DataFrame, num: int, den: int) -> DataFrame:
    """All links between different components, found through shared rare n-grams."""
    rows = (reps.select("rep", F.explode("prefix").alias("key"))
            .join(comps, "rep", "left").withColumn("comp", F.coalesce("component", "rep")).drop("component"))
    by_comp = checkpointed(rows.groupBy("key", "comp").agg(F.count("*").alias("c")))
    mixed = (by_comp.groupBy("key").agg(F.sum("c").alias("total"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .filter("lo != hi").select("key", "total"))
    # a chunk of a large group: part of a large component, or several small components
    chunk = F.when(F.col("total") <= CELL, F.lit(0)).when(
        F.col("c") > CELL // 2, F.xxhash64("comp", F.pmod(F.xxhash64("rep"), F.ceil(F.col("c") / (CELL // 2)))))
    chunk = chunk.otherwise(F.pmod(F.xxhash64("comp"), F.ceil(F.col("total") / (CELL // 2))))
    only = F.when((F.col("total") > CELL) & (F.col("c") > CELL // 2), F.col("comp"))
    kept = checkpointed(rows.join(mixed, "key").join(by_comp, ["key", "comp"])
                        .select("key", "rep", "comp", chunk.cast("long").alias("chunk"), only.alias("only"), "total"))
    chunks = kept.filter(F.col("total") > CELL).select("key", "chunk", "only").distinct()
    left, right = chunks.alias("l"), chunks.alias("r")
    cells = (left.join(right, (F.col("l.key") == F.col("r.key")) & (F.col("l.chunk") <= F.col("r.chunk"))
                       & ~F.coalesce((F.col("l.only") == F.col("r.only")), F.lit(False)))
             .select(F.col("l.key").alias("key"), F.col("l.chunk").alias("c1"), F.col("r.chunk").alias("c2"),
                     F.xxhash64("l.chunk", "r.chunk").alias("cell"))
             .withColumn("chunk", F.explode(F.array_distinct(F.array("c1", "c2")))).select("key", "chunk", "cell"))
    small = kept.filter(F.col("total") <= CELL).select("key", F.lit(0).cast("long").alias("cell"), "rep", "comp")
    large = (kept.filter(F.col("total") > CELL).join(cells, ["key", "chunk"]).select("key", "cell", "rep", "comp"))
    signs = reps.select("rep", "n", (F.octet_length("grams") / 8).cast("long").alias("shared"), "signature")
    dealt = (small.unionByName(large).join(signs, "rep")
             .select("key", "cell", "rep", "comp", "n", "shared", "signature"))
    pairs = checkpointed(dealt.repartition("key", "cell").sortWithinPartitions("key", "cell", "rep")
                         .mapInArrow(_cell_pairs(num, den), "a long, b long, crowd long").distinct())
    sets = reps.select("rep", "n", "grams")
    both = (pairs.filter("crowd IS NULL")
            .join(sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga")), "a")
            .join(sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb")), "b")
            .select("a", "b", "na", "nb", "ga", "gb"))
    crowds = (pairs.filter("crowd IS NOT NULL").select(F.col("crowd").alias("key"), F.lit(0).alias("cell"), F.col("a").alias("rep"))
              .join(reps.select("rep", "n", "grams", "signature"), "rep").join(comps, "rep", "left")
              .select("key", "cell", "rep", F.coalesce("component", "rep").alias("comp"), "n", "grams", "signature"))
    return (both.mapInArrow(_checked(num, den), "a long, b long")
            .union(crowds.repartition("key").sortWithinPartitions("key", "cell", "rep")
                   .mapInArrow(_cell_links(num, den), "a long, b long")))


def jaccard_components(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """(node, doc_id, key, n_shingles, component, component_id) for every row of ``docs(doc_id, text)``.

    ``key`` is the xxhash64 of the text; ``component`` numbers components of
    rows; ``component_id`` is the smallest id in the component.
    """
    if 2 * num < den:
        raise ValueError("similarities under one half are out of range: signatures fold one width only")
    sets = checkpointed(gram_sets(docs, words, num, den))
    release(docs.sparkSession)                         # the packed n-grams, by far the largest shuffle
    every = checkpointed(sets.select("node", "doc_id", "key", "n", "d1", "d2", F.col("grams").isNotNull().alias("able")))
    reps = checkpointed(sets.filter(F.col("grams").isNotNull()).groupBy("n", "d1", "d2").agg(
        F.min("node").alias("rep"),
        F.min_by(F.struct("grams", "prefix", "near1", "near2", "signature"), "node").alias("s"))
        .select("rep", "n", "d1", "d2", "s.*"))
    del sets                                           # from here on the representatives' are enough
    release(docs.sparkSession)
    links = None
    for by in ("near1", "near2"):                      # one after the other: each order is a shuffle of all sets
        found = checkpointed(near_links(reps, by, num, den))
        links = found if links is None else links.union(found)
        release(docs.sparkSession)
    comps = connected_components(links).withColumnRenamed("node", "rep")
    more = completing_links(reps, comps, num, den)
    final = connected_components(links.union(checkpointed(more))).withColumnRenamed("node", "rep")
    of_rep = reps.select("rep", "n", "d1", "d2").join(final, "rep", "left").select(
        "n", "d1", "d2", F.coalesce("component", "rep").alias("component"))
    rows = every.filter("able").join(of_rep, ["n", "d1", "d2"])
    named = checkpointed(rows.select("node", "doc_id", "key", F.col("n").alias("n_shingles"), "component"))
    names = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    alone = every.filter("NOT able").select(
        "node", "doc_id", "key", F.col("n").alias("n_shingles"), F.col("node").alias("component"),
        F.col("doc_id").alias("component_id"))
    return alone.unionByName(named.join(names, "component").select(alone.columns))


def one_of_each(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs``, one of each component: that of the smallest id, then text hash (NULL ids last).

    Of rows that differ in other columns only, the one with the smallest hash stays.
    """
    keyed = docs.withColumn("__row", F.struct(F.col("doc_id").cast("long").alias("doc_id"),
                                              F.xxhash64("text").alias("key"))).withColumn("__all", F.xxhash64(*docs.columns))
    found = jaccard_components(docs, words, num, den)
    best = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("b"))
    best = best.select(F.struct(F.col("b.doc_id").alias("doc_id"), F.col("b.key").alias("key")).alias("__row")).distinct()
    # the choice is made on keys and the join's files go; then the texts move, once
    keep = checkpointed(keyed.select("__row", "__all").join(best, "__row", "left_semi")
                        .groupBy("__row").agg(F.min("__all").alias("__all")))
    del found, best
    release(docs.sparkSession)
    return keyed.join(keep, ["__row", "__all"], "left_semi").dropDuplicates(["__row", "__all"]).select(docs.columns)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 4-word shingles at a similarity of 0.85."""
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
