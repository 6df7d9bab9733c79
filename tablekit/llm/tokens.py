"""Token ids of whole batches with the ``tokenizers`` library.

Byte-level BPE never merges across a change from text to white space, so each
stretch "white space + following word" has ids of its own wherever it stands;
so has punctuation right after a letter.
Every distinct stretch is encoded once by the library; the ids of a document
are those of its stretches in a row.  A change to white space counts only
when the character before it is no Unicode space itself.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from tablekit.llm.words import WHITE, HashTable, span_hashes, spread

PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[ord(c) for c in '.,;:!?|"()#$%&*']] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
MAX_STRETCHES = 460_000               # cached stretches of a worker, about 25 MB; then those met once go
DEFAULT_VOCABULARY = "byte_bpe_50k.json"
END_ID = 0


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    """Path of a public vocabulary file on this machine (executors resolve it themselves)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def stretches(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row bounds) of the stretches of each document."""
    size = int(offs[-1])
    white = WHITE[buf[:size]]
    cut = np.zeros(size + 1, dtype=bool)
    cut[1:size] = white[1:] & ~white[:-1] if size > 1 else False
    at = np.flatnonzero(cut)
    if len(at):                                        # after a multi-byte Unicode space: no cut
        last = buf[at - 1]
        odd = np.flatnonzero(last >= 0x80)
        if len(odd):
            p = at[odd]
            c, b, a = buf[p - 1], buf[np.maximum(p - 2, 0)], buf[np.maximum(p - 3, 0)]
            space = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
            space |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
            space |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
            space |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
            space |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
            cut[p[space]] = False
    # before punctuation that follows a letter (ASCII or Latin-1): another class of the
    # pattern begins there; apostrophes stay, they begin contractions
    if size > 2:
        p = np.flatnonzero(PUNCTUATION[buf[1:size]]) + 1
        last, b = buf[p - 1], buf[np.maximum(p - 2, 0)]
        cut[p[LETTER[last] | ((b == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7))]] = True
    cut[offs] = True
    cut[size] = False
    start = np.flatnonzero(cut)
    return start, np.append(start[1:], size) if len(start) else start, np.searchsorted(start, offs)


class BatchTokenizer:
    """Encodes document batches; keeps the ids of stretches it has seen."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True     # their strings are ordinary text
        self.reset()

    def reset(self) -> None:
        self.table = HashTable(18)
        self.used = 0                                  # ids in flat
        self.counts = np.zeros(1 << 16, dtype=np.int32)
        self.first = np.zeros(1 << 16, dtype=np.int32)
        self.flat = np.zeros(1 << 18, dtype=np.uint32)
        self.again = np.zeros(1 << 16, dtype=bool)     # stretches that a later piece met

    def thin(self) -> None:
        """Keep the stretches that were met again since the last time, half of the room at most."""
        size, table = self.table.size, self.table
        keep = np.flatnonzero(self.again[:size])[-(MAX_STRETCHES // 2):]
        counts, first, flat = self.counts[keep], self.first[keep].astype(np.int64), self.flat
        keys, used = np.zeros(size, dtype=np.uint64), table.vals >= 0
        keys[table.vals[used]] = table.keys[used]
        self.reset()
        if len(keep):
            self.table.slots(np.sort(keys[keep]))      # slots follow the order of the keys
            order = np.argsort(keys[keep])
            self.used = int(counts.sum())
            self.first, self.counts, self.again = (_with_room(x, len(keep)) for x in (self.first, self.counts, self.again))
            self.flat = _with_room(self.flat, self.used)
            self.counts[:len(keep)] = counts[order]
            self.first[:len(keep)] = np.cumsum(counts[order]) - counts[order]
            self.flat[:self.used] = flat[spread(first[order], counts[order].astype(np.int64))]

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, row bounds): the ids of all documents one after another."""
        start, end, bounds = stretches(buf, offs)
        if len(start) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        if self.table.size > MAX_STRETCHES:
            self.thin()
        known = self.table.size
        slot, new = self.table.slots(span_hashes(buf, start, end))
        self.again = _with_room(self.again, self.table.size)
        self.again[slot[slot < known]] = True
        if len(new):
            new = new[np.argsort(slot[new])]            # slots of new stretches are dense and ascending
            raw = buf.tobytes()
            ids = [x.ids for x in self.tokenizer.encode_batch_fast(
                [raw[s:e].decode("utf-8", "replace") for s, e in zip(start[new].tolist(), end[new].tolist())],
                add_special_tokens=False)]
            counts = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids))
            total = int(counts.sum())
            self.first, self.counts = (_with_room(x, self.table.size) for x in (self.first, self.counts))
            self.flat = _with_room(self.flat, self.used + total)
            self.counts[known:self.table.size] = counts
            self.first[known:self.table.size] = self.used + np.cumsum(counts) - counts
            self.flat[self.used:self.used + total] = np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=total)
            self.used += total
        n = self.counts[slot].astype(np.int64)
        total = np.concatenate(([0], np.cumsum(n)))
        return self.flat[spread(self.first[slot].astype(np.int64), n)], total[bounds]


def _with_room(x: np.ndarray, size: int) -> np.ndarray:
    """``x``, doubled until it has ``size`` places."""
    room = len(x)
    while room < size:
        room *= 2
    return x if room == len(x) else np.concatenate((x, np.zeros(room - len(x), x.dtype)))


_KEPT: dict[str, BatchTokenizer] = {}


def batch_tokenizer(name: str) -> BatchTokenizer:
    """The worker's tokenizer for a vocabulary file (made once per process)."""
    path = name if os.path.sep in name else vocabulary_path(name)
    if path not in _KEPT:
        _KEPT[path] = BatchTokenizer(path)
    return _KEPT[path]
