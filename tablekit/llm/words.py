"""Whole-batch word work in numpy: spans, 64-bit word hashes, n-gram hashes.

An Arrow string column is one byte buffer with offsets, so words of thousands
of documents are found and hashed with a handful of array operations instead
of a Python loop per word.  Batches are cut into pieces of ``PIECE_BYTES`` of
text (or one document, when that is longer) to bound a task's memory.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

PIECE_BYTES = 1 << 20
LONG_WORD = 512                       # bytes; longer words are hashed one by one
WHITE = np.zeros(256, dtype=bool)     # bytes [\x20\x09-\x0D]
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[65:91] += 32
M_TRIM_THRESHOLD, M_MMAP_THRESHOLD = -1, -3       # of mallopt
_U = np.uint64
_BLOCK = _U(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=_U)


def _give_back_arrays() -> None:
    """Let the C library return freed arrays to the system at once.

    Left alone it keeps ever larger ones, and a Python worker, which lives
    through many stages, never shrinks again.
    """
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(M_MMAP_THRESHOLD, 1 << 20)
        libc.mallopt(M_TRIM_THRESHOLD, 4 << 20)
    except (OSError, AttributeError):                  # another C library: its own ways
        return


_give_back_arrays()


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalising mixer: every input bit reaches every output bit."""
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive row ranges of about PIECE_BYTES.

    NULL texts read as empty.  ``bytes`` has 8 spare zero bytes at its end.
    """
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offs, offs[row] + PIECE_BYTES, side="right")) - 1
        end = min(n, max(row + 1, end))
        lo, hi = int(offs[row]), int(offs[end])
        buf = np.zeros(hi - lo + 8, dtype=np.uint8)
        buf[:hi - lo] = data[lo:hi]
        yield row, buf, offs[row:end + 1] - lo
        row = end


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row bounds): byte spans of the words ``[^\\x20\\x09-\\x0D]+``.

    Words of row r are the spans ``bounds[r]:bounds[r + 1]``.
    """
    size = int(offs[-1])
    solid = ~WHITE[buf[:size]]
    edge = np.zeros(size + 1, dtype=bool)
    edge[offs] = True                                   # a word never crosses a document
    before = np.concatenate(([False], solid))           # solid[i - 1]
    after = np.concatenate((solid, [False]))            # solid[i]
    start = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    return start, end, np.searchsorted(start, offs)


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span, eight bytes at a time."""
    length = end - start
    h = mix64(length.astype(_U) + _U(0x5851F42D4C957F2D))
    eights = np.ndarray(shape=(len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))
    which, at, left = None, start, length
    while True:
        if which is None:
            h = (h ^ (eights[at] & _MASKS[np.minimum(left, 8)])) * _BLOCK
            h ^= h >> _U(29)
        else:
            part = (h[which] ^ (eights[at] & _MASKS[np.minimum(left, 8)])) * _BLOCK
            h[which] = part ^ (part >> _U(29))
        more = np.flatnonzero((left > 8) & (left <= LONG_WORD)) if which is None else np.flatnonzero(left > 8)
        if len(more) == 0:
            break
        which = more if which is None else which[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(length > LONG_WORD):
        h[i] = xxhash.xxh64_intdigest(buf[start[i]:end[i]].tobytes(), seed=17)
    return mix64(h)


def ngram_hashes(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row bounds) of the n-word windows; a shorter row is one window."""
    counts = np.diff(bounds)
    m = len(words)
    grams = np.zeros(0, dtype=_U)
    if m >= n:
        grams = np.zeros(m - n + 1, dtype=_U)
        for k in range(n):
            grams += words[k:m - n + 1 + k] * _U((2 * k + 1) * 0x9E3779B97F4A7C15 % (1 << 64) | 1)
            grams ^= grams >> _U(31)
    per_row = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate(([0], np.cumsum(per_row)))
    out = np.empty(int(out_bounds[-1]), dtype=_U)
    rows = np.flatnonzero(counts >= n)
    if len(rows):
        out[spread(out_bounds[rows], per_row[rows])] = mix64(grams[spread(bounds[rows], per_row[rows])])
    for r in np.flatnonzero((counts > 0) & (counts < n)):
        h = _U(int(counts[r]) + 0x1234567)
        for w in words[bounds[r]:bounds[r + 1]]:
            h = mix64(np.array([h ^ w]))[0]
        out[out_bounds[r]] = h
    return out, out_bounds


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges start..start+count."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - first, counts)


def sorted_sets(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of every row in ascending order, with new bounds."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(rows[order], kind="stable")]
    values, rows = values[order], rows[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[keep], rows[keep]
    return values, np.searchsorted(rows, np.arange(len(bounds)))


class HashTable:
    """Open-addressed map from 64-bit hashes to dense slots, looked up in bulk.

    ``slots(h)`` gives a slot for every hash, and the positions of first
    occurrences whose slot is new, so the caller computes each distinct key once.
    """

    def __init__(self, bits: int = 16) -> None:
        self._resize(bits)
        self.size = 0

    def _resize(self, bits: int) -> None:
        self.mask = _U((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, dtype=_U)
        self.vals = np.full(1 << bits, -1, dtype=np.int32)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Slot of each hash, -1 where absent."""
        at = h & self.mask
        out = self.vals[at]
        todo = np.flatnonzero((out >= 0) & (self.keys[at] != h))
        while len(todo):
            at_t = (at[todo] + _U(1)) & self.mask
            at[todo] = at_t
            out[todo] = self.vals[at_t]
            todo = todo[(out[todo] >= 0) & (self.keys[at_t] != h[todo])]
        return out

    def _put(self, h: np.ndarray, vals: np.ndarray) -> None:
        """Insert distinct absent hashes."""
        at, left = h & self.mask, np.arange(len(h))
        while len(left):
            free = self.vals[at[left]] < 0
            try_ = left[free]
            self.vals[at[try_]] = vals[try_]            # the last of several writers wins a cell
            self.keys[at[try_]] = h[try_]
            lost = np.ones(len(left), dtype=bool)
            lost[free] = self.vals[at[try_]] != vals[try_]
            left = left[lost]
            at[left] = (at[left] + _U(1)) & self.mask

    def slots(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = self._find(h)
        absent = np.flatnonzero(out < 0)
        if len(absent) == 0:
            return out, absent
        new, first, back = np.unique(h[absent], return_index=True, return_inverse=True)
        vals = np.arange(self.size, self.size + len(new), dtype=np.int32)
        if 2 * (self.size + len(new)) > len(self.keys):
            used = self.vals >= 0
            keys, old = self.keys[used], self.vals[used]
            bits = int(self.mask).bit_length()
            while 2 * (self.size + len(new)) > (1 << bits):
                bits += 2
            self._resize(bits)
            self._put(keys, old)
        self._put(new, vals)
        self.size += len(new)
        out[absent] = vals[back]
        return out, absent[first]
