"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input joins a word embedding with the mean embedding of its character
n-grams (``<`` and ``>`` mark the word's ends), both hashed.  A document is cut
into overlapping windows of ``WINDOW`` words; the network reads each window in
both directions, attention pools the states, and the document's logit is that
of its worst window.  Training (numpy, on the driver) uses a bounded sample of
labelled documents: about ``SAMPLE`` of each class by hash, one row an id, of
texts over ``SAMPLE_CHARS`` characters an excerpt.  Embeddings start from the smoothed log-odds
of their features, and of each document only the most suspicious windows and a
few others are trained on.  Features of too few sample documents are silent.  Scoring reads all windows of whole texts.

Edge cases: NULL and empty texts and texts without letters score 0, as does
every text when a class has no labelled document; repeated rows score alike;
labels of several rows for one id count once, at their largest; an empty table
gives no rows; other columns are ignored.  A run of letters of over ``LONG_RUN``
bytes (scripts without spaces, glued text) is read as overlapping words of about
``PART`` bytes, cut at code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm.common import crc32_of_id, excerpt, shipped, table
from tablekit.llm.words import HashTable, mix64, pieces, span_hashes, spread, word_spans

TOXIC_FROM = 0.3                      # a document is toxic from this score on, here and in the pipeline
WINDOW, STRIDE = 24, 12
WORD_BITS, CHAR_BITS = 15, 17
EMBED, HIDDEN, ATTEND = 6, 8, 8       # a word's input has 2 * EMBED numbers
GRAMS = (3, 5, 7)
LONG_RUN = 64                         # bytes; a longer run of letters is read in parts
PART, PART_STEP = 32, 16
SAMPLE = 1200
SAMPLE_CHARS = 30_000
EPOCHS, RATE = 5, 0.02
LEAST_STEPS = 110
LEAST_DOCS = (4, 6)                   # sample documents that must share a word, a character n-gram
SMOOTH = 0.3
TRAIN_WINDOWS, TRAIN_OTHERS = 4, 4
MAX_WORDS = 400_000                   # cached words of a worker
BLOCK = 8192                          # windows scored at once
_U, _F = np.uint64, np.float32


def _letters() -> np.ndarray:
    lut = np.arange(256, dtype=np.uint8)
    lut[:128] = 32
    lut[97:123] = np.arange(97, 123)
    lut[65:91] = np.arange(97, 123)
    return lut


LETTERS = _letters()


def words_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(folded bytes, start, end, row bounds): runs of letters, ASCII in lower case, long ones in parts."""
    folded = np.zeros_like(buf)
    size = int(offs[-1])
    folded[:size] = LETTERS[buf[:size]]
    return (folded, *_in_parts(folded, *word_spans(folded, offs)))


def _in_parts(buf: np.ndarray, start: np.ndarray, end: np.ndarray,
              bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with every run of over LONG_RUN bytes replaced by overlapping parts that cover it."""
    length = end - start
    if not (length > LONG_RUN).any():
        return start, end, bounds
    count = np.where(length > LONG_RUN, -(-(length - PART) // PART_STEP) + 1, 1)
    run = np.repeat(np.arange(len(start)), count)
    at = spread(np.zeros(len(start), np.int64), count) * PART_STEP
    last = at == ((count - 1) * PART_STEP)[run]
    first = _code_point(buf, start[run] + at, start[run])
    after = np.where(last, end[run], _code_point(buf, np.minimum(start[run] + at + PART, end[run]), start[run]))
    return first, after, np.concatenate(([0], np.cumsum(count)))[bounds]


def _code_point(buf: np.ndarray, at: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Where the UTF-8 character that has byte ``at`` begins, not before ``least``."""
    for _ in range(3):
        at = np.where((at > least) & (buf[at] & 0xC0 == 0x80), at - 1, at)
    return at


def char_grams(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of the distinct places of character n-grams in the given words."""
    length = end - start
    room = length + 2
    at = np.concatenate(([0], np.cumsum(room)))
    packed = np.zeros(int(at[-1]) + 8, np.uint8)
    packed[at[:-1]] = ord("<")
    packed[at[1:] - 1] = ord(">")
    packed[spread(at[:-1] + 1, length)] = buf[spread(start, length)]
    eights = np.ndarray(shape=(len(packed) - 7,), dtype="<u8", buffer=packed, strides=(1,))
    buckets, owners = [], []
    for k in GRAMS:
        n = np.maximum(room - k + 1, 1)
        p = spread(at[:-1], n)
        owner = np.repeat(np.arange(len(start)), n)
        own = np.minimum(room, k)[owner]                # a word shorter than k is one n-gram by itself
        key = (eights[p] & ((_U(1) << (_U(8) * own.astype(_U))) - _U(1))) + _U(k << 56)
        buckets.append((mix64(key) >> _U(64 - CHAR_BITS)).astype(np.int64))
        owners.append(owner)
    return np.concatenate(buckets), np.concatenate(owners)


def window_starts(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, document) of the overlapping windows of each document."""
    n = np.diff(bounds)
    count = np.where(n > 0, np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1), 0)
    doc = np.repeat(np.arange(len(n)), count)
    first = bounds[doc] + spread(np.zeros(len(n), np.int64), count) * STRIDE
    return first, np.minimum(WINDOW, bounds[doc + 1] - first), doc


@dataclass
class Network:
    """Parameters; gates are stacked as update, reset, candidate for each direction."""

    words: np.ndarray
    chars: np.ndarray
    w_in: np.ndarray                  # (2, 2 * EMBED, 3 * HIDDEN)
    w_rec: np.ndarray                 # (2, HIDDEN, 3 * HIDDEN)
    bias: np.ndarray                  # (2, 3 * HIDDEN)
    w_att: np.ndarray                 # (2 * HIDDEN, ATTEND)
    v_att: np.ndarray                 # (ATTEND,)
    w_out: np.ndarray                 # (2 * HIDDEN,)
    b_out: np.ndarray                 # (1,)

    def params(self) -> dict[str, np.ndarray]:
        return dict(vars(self))

    def inputs(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Input vectors of distinct words."""
        bucket, at = _grams_by_word(buf, start, end)
        return np.concatenate((self.words[(hashes >> _U(64 - WORD_BITS)).astype(np.int64)],
                               _mean_rows(self.chars, bucket, np.diff(at))), axis=1)

    def logits(self, x: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Logit of every window over the word inputs ``x``."""
        out = np.empty(len(first), _F)
        for s in range(0, len(first), BLOCK):
            out[s:s + BLOCK] = self.forward(x, first[s:s + BLOCK], length[s:s + BLOCK])[0]
        return out

    def forward(self, x: np.ndarray, first: np.ndarray, length: np.ndarray, keep: bool = False):
        n, steps = len(first), int(length.max())
        states = np.zeros((steps, n, 2 * HIDDEN), _F)
        tape = []
        for d in (0, 1):
            h = np.zeros((n, HIDDEN), _F)
            half = states[:, :, d * HIDDEN:(d + 1) * HIDDEN]
            for t in (range(steps) if d == 0 else range(steps - 1, -1, -1)):
                live = (length > t).astype(_F)[:, None]
                xt = x[np.minimum(first + t, len(x) - 1)]
                a = xt @ self.w_in[d] + self.bias[d]
                r = h @ self.w_rec[d]
                gates = _sigmoid(a[:, :2 * HIDDEN] + r[:, :2 * HIDDEN])
                z, g = gates[:, :HIDDEN], gates[:, HIDDEN:]
                c = np.tanh(a[:, 2 * HIDDEN:] + g * r[:, 2 * HIDDEN:])
                new = h + live * z * (c - h)
                if keep:
                    tape.append((d, t, live, xt, h, r, z, g, c))
                h = new
                half[t] = h * live
        mask = (np.arange(steps)[:, None] < length[None, :])
        u = np.tanh(states @ self.w_att)
        e = np.where(mask, u @ self.v_att, -1e9)
        e = np.exp(e - e.max(axis=0))
        alpha = (e / e.sum(axis=0)).astype(_F)
        pooled = (alpha[:, :, None] * states).sum(axis=0)
        return pooled @ self.w_out + self.b_out[0], (states, u, alpha, pooled, tape)

    def backward(self, cache, d_logit: np.ndarray, x_shape: tuple[int, int], first: np.ndarray):
        """Gradients of the parameters, and of ``x``."""
        states, u, alpha, pooled, tape = cache
        g = {k: np.zeros_like(v) for k, v in self.params().items() if k not in ("words", "chars")}
        dx = np.zeros(x_shape, _F)
        g["w_out"] = pooled.T @ d_logit
        g["b_out"] = np.array([d_logit.sum()], _F)
        d_pooled = d_logit[:, None] * self.w_out
        d_alpha = (states * d_pooled).sum(axis=2)
        d_states = alpha[:, :, None] * d_pooled
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
        g["v_att"] = np.einsum("tn,tna->a", d_e, u)
        d_u = (d_e[:, :, None] * self.v_att) * (1 - u * u)
        g["w_att"] = np.einsum("tnh,tna->ha", states, d_u)
        d_states = d_states + d_u @ self.w_att.T
        carry = [np.zeros_like(states[0, :, :HIDDEN]) for _ in (0, 1)]
        for d, t, live, xt, h, r, z, gate, c in reversed(tape):
            dh = carry[d] + d_states[t, :, d * HIDDEN:(d + 1) * HIDDEN] * live
            step = dh * live
            dc = step * z * (1 - c * c)
            dz = step * (c - h) * z * (1 - z)
            dg = dc * r[:, 2 * HIDDEN:] * gate * (1 - gate)
            da = np.concatenate((dz, dg, dc), axis=1)
            dr = np.concatenate((dz, dg, dc * gate), axis=1)
            carry[d] = dh - step * z + dr @ self.w_rec[d].T
            g["w_rec"][d] += h.T @ dr
            g["w_in"][d] += xt.T @ da
            g["bias"][d] += da.sum(axis=0)
            np.add.at(dx, np.minimum(first + t, x_shape[0] - 1), da @ self.w_in[d].T * live)
        return g, dx


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float) -> None:
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, params: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            m, v = self.m[k] / (1 - 0.9 ** self.t), self.v[k] / (1 - 0.999 ** self.t)
            params[k] -= self.rate * m / (np.sqrt(v) + 1e-8)


class _LogOdds:
    """Counts documents of either label by feature, chunk by chunk."""

    def __init__(self, y: np.ndarray, size: int) -> None:
        self.y, self.size = y, size
        self.seen = np.zeros((2, size), np.int64)

    def add(self, feature: np.ndarray, doc: np.ndarray) -> None:
        both = np.unique(doc.astype(np.int64) * self.size + feature)
        f, label = both % self.size, self.y[both // self.size]
        for v in (0, 1):
            self.seen[v] += np.bincount(f[label == v], minlength=self.size)

    def result(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(smoothed log-odds of label 1 given the feature, at least ``least`` documents have it)."""
        (neg, pos), n1 = self.seen, self.y.sum()
        odds = (np.log((pos + SMOOTH) / (n1 + 2 * SMOOTH)) - np.log((neg + SMOOTH) / (len(self.y) - n1 + 2 * SMOOTH)))
        usual = pos + neg >= least
        return np.where(usual, odds, 0).astype(_F), usual


def _grams_by_word(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, bounds): the character n-grams of each word, word after word."""
    buckets, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for s in range(0, len(start), 20_000):
        bucket, owner = char_grams(buf, start[s:s + 20_000], end[s:s + 20_000])
        buckets.append(bucket[np.argsort(owner, kind="stable")].astype(np.int32))
        counts.append(np.bincount(owner, minlength=len(start[s:s + 20_000])))
    return np.concatenate(buckets), np.concatenate(([0], np.cumsum(np.concatenate(counts))))


def _mean_rows(table: np.ndarray, bucket: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean of the table rows that each of the consecutive groups names."""
    return (np.add.reduceat(table[bucket], np.cumsum(counts) - counts, axis=0)
            / counts.reshape(-1, *[1] * (table.ndim - 1))).astype(_F)


def train(texts: list[str], labels: list[int], prior_weight: float = 1.0, seed: int = 5) -> Network | None:
    """Fit on labelled texts.  ``prior_weight`` is what a negative stands for relative to a positive."""
    y_all = np.array(labels, dtype=np.int64)
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    raw = [t.encode() for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(t) for t in raw])))
    buf = np.zeros(int(offs[-1]) + 8, np.uint8)
    buf[:-8] = np.frombuffer(b"".join(raw), np.uint8)
    buf, start, end, bounds = words_of(buf, offs)
    kinds = HashTable(16)
    hashes = span_hashes(buf, start, end)
    slot, new = kinds.slots(hashes)
    order = new[np.argsort(slot[new])]
    s, e, h = start[order], end[order], hashes[order]
    word_bucket = (h >> _U(64 - WORD_BITS)).astype(np.int64)
    g_bucket, g_at = _grams_by_word(buf, s, e)
    g_count = np.diff(g_at)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(_F)

    net = Network(
        draw(1 << WORD_BITS, EMBED, scale=0.1), draw(1 << CHAR_BITS, EMBED, scale=0.1),
        draw(2, 2 * EMBED, 3 * HIDDEN, scale=0.3), draw(2, HIDDEN, 3 * HIDDEN, scale=0.2),
        np.zeros((2, 3 * HIDDEN), _F), draw(2 * HIDDEN, ATTEND, scale=0.3), draw(ATTEND, scale=0.3),
        draw(2 * HIDDEN, scale=0.3), np.array([-2.0], _F))
    by_word, by_gram = _LogOdds(y_all, 1 << WORD_BITS), _LogOdds(y_all, 1 << CHAR_BITS)
    for d0 in range(0, len(raw), 64):
        d1 = min(len(raw), d0 + 64)
        doc_of = np.repeat(np.arange(d0, d1), np.diff(bounds[d0:d1 + 1]))
        pair = np.unique(doc_of * kinds.size + slot[bounds[d0]:bounds[d1]])
        pd, pw = pair // kinds.size, pair % kinds.size
        by_word.add(word_bucket[pw], pd)
        by_gram.add(g_bucket[spread(g_at[pw], g_count[pw])], np.repeat(pd, g_count[pw]))
    net.words[:, 0], usual_words = by_word.result(LEAST_DOCS[0])
    net.chars[:, 0], usual_chars = by_gram.result(LEAST_DOCS[1])
    net.words[~usual_words], net.chars[~usual_chars] = 0, 0      # rare features stay silent: nothing to memorise

    first, length, doc = window_starts(bounds)
    prior = net.words[word_bucket, 0] + _mean_rows(net.chars[:, 0], g_bucket, g_count)
    worst = np.array([prior[slot[f:f + n]].max() for f, n in zip(first, length)])
    rank = np.lexsort((-worst, doc))
    place = np.empty(len(doc), np.int64)
    place[rank] = np.arange(len(doc)) - np.searchsorted(doc, doc[rank])
    chosen = np.flatnonzero((place < TRAIN_WINDOWS)
                            | (rng.random(len(doc)) < TRAIN_OTHERS / np.bincount(doc, minlength=len(raw))[doc]))
    first, length, doc = first[chosen], length[chosen], doc[chosen]
    present = np.unique(doc)
    adam = _Adam(net.params(), RATE)
    batches = max(1, len(present) // 128)
    epochs = max(EPOCHS, -(-LEAST_STEPS // batches))
    for epoch in range(epochs):
        adam.rate = RATE * 0.5 ** (5 * epoch / (3 * epochs))
        for batch in np.array_split(rng.permutation(present), batches):
            own = np.flatnonzero(np.isin(doc, batch))
            places = spread(first[own], length[own])
            used, back = np.unique(slot[places], return_inverse=True)
            b_sel = g_bucket[spread(g_at[used], g_count[used])]
            vec = np.concatenate((net.words[word_bucket[used]], _mean_rows(net.chars, b_sel, g_count[used])), axis=1)
            x = vec[back]
            at = np.concatenate(([0], np.cumsum(length[own])[:-1]))
            logit = net.logits(x, at, length[own])
            d_own = doc[own]
            heads = np.flatnonzero(np.concatenate(([True], d_own[1:] != d_own[:-1])))
            top = np.lexsort((-logit, d_own))[heads]      # the worst window of each document
            logit_top, cache = net.forward(x, at[top], length[own][top], keep=True)
            y = y_all[d_own[top]]
            weight = np.where(y == 1, 1.0, prior_weight)
            d_logit = ((_sigmoid(logit_top) - y) * weight / len(top)).astype(_F)
            grads, dx = net.backward(cache, d_logit, x.shape, at[top])
            dv = np.zeros_like(vec)
            np.add.at(dv, back, dx)
            dw, dc = np.zeros_like(net.words), np.zeros_like(net.chars)
            np.add.at(dw, word_bucket[used], dv[:, :EMBED])
            np.add.at(dc, b_sel, np.repeat(dv[:, EMBED:] / g_count[used][:, None], g_count[used], axis=0))
            dw[~usual_words], dc[~usual_chars] = 0, 0
            grads |= {"words": dw, "chars": dc}
            adam.step(net.params(), grads)
    return net


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[str], list[int], float]:
    """(texts, labels, weight of a negative): a bounded sample by hash of the learning rows."""
    ids = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
           .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
           .withColumn("h", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000))))
    sizes = {r["y"]: r["count"] for r in ids.groupBy("y").count().collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    take_pos, take_neg = min(1.0, sample / max(pos, 1)), min(1.0, 2 * sample / max(neg, 1))
    chosen = (ids.filter(F.col("h") < F.when(F.col("y") == 1, int(1e6 * take_pos)).otherwise(int(1e6 * take_neg)))
              .limit(4 * sample))                       # a hash sample of 3 * sample rows in expectation
    rows = (docs.filter("text IS NOT NULL").select("doc_id", excerpt(SAMPLE_CHARS).alias("text"))
            .join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("y").alias("y"))   # a row an id
            .groupBy("text").agg(F.max("y").alias("y"), F.min("doc_id").alias("doc_id"))
            .orderBy("doc_id").collect())
    return [r["text"] for r in rows], [r["y"] for r in rows], take_pos / max(take_neg, 1e-9)


def scored(docs: DataFrame, net: Network | None, keep: list[str], name: str = "score") -> DataFrame:
    """``keep`` columns of ``docs`` with the toxicity score of ``text`` as ``name``."""
    schema = docs.select(*keep).schema.add(name, "double")
    spark = shipped(docs.sparkSession)
    shared = spark.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        kinds, vectors = HashTable(16), np.zeros((0, 2 * EMBED), _F)
        for b in batches:
            for row, buf, offs in pieces(b.column(len(keep))):
                n = len(offs) - 1
                score = np.zeros(n)
                buf, start, end, bounds = words_of(buf, offs)
                if net is not None and len(start):
                    if kinds.size > MAX_WORDS:
                        kinds, vectors = HashTable(16), np.zeros((0, 2 * EMBED), _F)
                    hashes = span_hashes(buf, start, end)
                    slot, new = kinds.slots(hashes)
                    if len(new):
                        new = new[np.argsort(slot[new])]
                        vectors = np.concatenate((vectors, net.inputs(buf, start[new], end[new], hashes[new])))
                    first, length, doc = window_starts(bounds)
                    worst = np.full(n, -np.inf)
                    for s in range(0, len(first), BLOCK):
                        f, size = first[s:s + BLOCK], length[s:s + BLOCK]
                        lo = int(f[0])
                        x = vectors[slot[lo:int((f + size).max())]]
                        np.maximum.at(worst, doc[s:s + BLOCK], net.forward(x, f - lo, size)[0])
                    score = np.where(np.isfinite(worst), _sigmoid(worst), 0.0)
                own = [b.column(i).slice(row, n) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(score)], names=[*keep, name])

    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)


def held_out() -> Column:
    return crc32_of_id() % 4 == 2


def toxicity_scores(docs: DataFrame, labels: DataFrame, keep: list[str], score: str = "score") -> DataFrame:
    """Train on the labelled rows that are not held out and score all of ``docs``."""
    return scored(docs, train(*labelled_sample(docs, labels)), keep, score)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    out = toxicity_scores(docs, table(spark, sf_dir, "labels"), ["doc_id", "held_out"])
    return out.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))
