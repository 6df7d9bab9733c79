"""Quality classifier: a sparse ensemble of rules over document statistics.

Statistics of whole texts are counted where the texts are read.  On a bounded
sample of labelled rows (about ``SAMPLE``, by hash) small trees are grown by
gradient boosting; every path from a root becomes a conjunctive rule, and a
lasso logistic regression over rules and clipped linear terms keeps a few.
The kept rules are compiled into one Spark column expression.

Edge cases: NULL and empty texts are scored like any other vector (all
counts 0); without labels of both classes every score is 0; repeated rows
score alike; several labels of one id count once, at their least; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm.common import checkpointed, crc32_of_id, shipped, table
from tablekit.llm.words import LOWER_AZ, ngram_hashes, pieces, span_hashes, word_spans

SAMPLE = 12_000
TREES, DEPTH, MIN_LEAF, SHRINK = 60, 3, 12, 0.2
BINS = 32
PENALTIES = (0.02, 0.01, 0.005, 0.002, 0.001)
#: byte classes counted for every document
CLASSES = {"upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "symbol": "#*$%&|<>",
           "bang": "!?", "stop": ".", "comma": ",;:", "bracket": "()[]{}/\\=+_@~^`\"'-"}
STATS = ["log_words", "word_chars", "long_words", "distinct_words", "repeat_grams", "dup_lines", "words_per_line",
         "words_per_stop", *[f"{c}_share" for c in CLASSES], "non_ascii_share"]


def _class_table() -> np.ndarray:
    lut = np.zeros(256, np.uint8)
    for i, chars in enumerate(CLASSES.values()):
        lut[[ord(c) for c in chars]] = i + 1
    lut[128:] = len(CLASSES) + 1
    return lut


CLASS_OF = _class_table()


def _distinct_per_row(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Distinct values in each row."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)).astype(np.uint64)
    order = np.argsort(hashes ^ (row * np.uint64(0x9E3779B97F4A7C15)))
    h, r = hashes[order], row[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return np.bincount(r[first].astype(np.int64), minlength=len(bounds) - 1)


def text_statistics(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of STATS for each document."""
    n, size = len(offs) - 1, int(offs[-1])
    start, end, bounds = word_spans(buf, offs)
    words = np.diff(bounds).astype(float)
    many = np.maximum(words, 1)
    sums = lambda x: np.diff(np.concatenate(([0], np.cumsum(x, dtype=np.int64)))[bounds])
    chars = sums(end - start).astype(float)
    folded = LOWER_AZ[buf]
    hashes = span_hashes(folded, start, end)
    grams, gram_bounds = ngram_hashes(hashes, bounds, 3)
    n_grams = np.maximum(np.diff(gram_bounds), 1)
    newline = buf[:size] == 10
    edges = np.zeros(size + 1, bool)
    edges[1:][newline] = True
    edges[offs] = True
    edges[size] = False
    line_start = np.flatnonzero(edges)
    line_end = np.append(line_start[1:], size) if len(line_start) else line_start
    line_bounds = np.searchsorted(line_start, offs)
    trimmed = line_end - (newline[np.maximum(line_end - 1, 0)] if size else 0)
    lines = np.diff(line_bounds)
    dup_lines = lines - _distinct_per_row(span_hashes(folded, line_start, np.maximum(trimmed, line_start)), line_bounds)
    row = np.repeat(np.arange(n), np.diff(offs))
    k = len(CLASSES) + 2
    counts = np.bincount(row * k + CLASS_OF[buf[:size]], minlength=n * k).reshape(n, k)
    solid = np.maximum(chars, 1)
    stops = counts[:, 1 + list(CLASSES).index("stop")]
    return np.column_stack([
        np.log1p(words), chars / many, sums((end - start) > 12) / many,
        _distinct_per_row(hashes, bounds) / many, 1 - _distinct_per_row(grams, gram_bounds) / n_grams,
        dup_lines / np.maximum(lines, 1), words / np.maximum(lines, 1), words / (stops + 1),
        *[counts[:, 1 + i] / solid for i in range(len(CLASSES))], counts[:, k - 1] / solid])


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and the STATS of ``text``."""
    schema = docs.select(*keep).schema
    for s in STATS:
        schema = schema.add(s, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, buf, offs in pieces(b.column(len(keep))):
                stats = text_statistics(buf, offs)
                own = [b.column(i).slice(row, len(stats)) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*own, *[pa.array(np.ascontiguousarray(stats[:, j])) for j in range(len(STATS))]],
                    names=[*keep, *STATS])

    shipped(docs.sparkSession)
    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """A conjunction: each condition is (statistic, upper bound?, threshold), x <= t or x > t."""

    conditions: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for j, upper, t in self.conditions:
            out &= (x[:, j] <= t) if upper else (x[:, j] > t)
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for j, upper, t in self.conditions:
            out = out & ((F.col(STATS[j]) <= t) if upper else (F.col(STATS[j]) > t))
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    bias: float
    rules: tuple[tuple[Rule, float], ...]
    linear: tuple[tuple[int, float, float, float], ...] = field(default=())   # statistic, low, high, weight

    def logit(self) -> Column:
        total = F.lit(self.bias)
        for rule, w in self.rules:
            total = total + F.when(rule.column(), w).otherwise(0.0)
        for j, low, high, w in self.linear:
            total = total + F.least(F.greatest(F.col(STATS[j]), F.lit(low)), F.lit(high)) * w
        return total

    def logits(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for rule, w in self.rules:
            total += w * rule.holds(x)
        for j, low, high, w in self.linear:
            total += w * np.clip(x[:, j], low, high)
        return total


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _grow(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, rows: np.ndarray,
          features: np.ndarray, path: tuple, depth: int, rules: set, leaves: list) -> None:
    """Split where the squared gradient sums gain most; note every path."""
    if path:
        rules.add(Rule(path))
    best = None
    if depth < DEPTH and len(rows) >= 2 * MIN_LEAF:
        total, n = grad[rows].sum(), len(rows)
        for j in features:
            if len(cuts[j]) == 0:
                continue
            size = len(cuts[j]) + 1
            c = np.cumsum(np.bincount(bins[rows, j], minlength=size))[:-1]
            g = np.cumsum(np.bincount(bins[rows, j], weights=grad[rows], minlength=size))[:-1]
            ok = (c >= MIN_LEAF) & (n - c >= MIN_LEAF)
            if ok.any():
                gain = np.where(ok, g * g / np.maximum(c, 1) + (total - g) ** 2 / np.maximum(n - c, 1), -1)
                k = int(gain.argmax())
                if best is None or gain[k] > best[0]:
                    best = (gain[k], j, k)
        if best is not None and best[0] <= total * total / n + 1e-9:
            best = None
    if best is None:
        leaves.append((rows, grad[rows].mean() if len(rows) else 0.0))
        return
    _, j, k = best
    t = float(cuts[j][k])
    low = x[rows, j] <= t
    for side, upper in ((rows[low], True), (rows[~low], False)):
        _grow(x, bins, cuts, grad, side, features, (*path, (int(j), upper, t)), depth + 1, rules, leaves)


def _tree_rules(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> list[Rule]:
    """Paths of boosted trees on bootstrap parts of the rows and half of the statistics."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    score, rules = np.zeros(len(y)), set()
    for _ in range(TREES):
        grad = y - _sigmoid(score)
        rows = np.flatnonzero(rng.random(len(y)) < 0.5)
        leaves: list = []
        own: set = set()
        features = rng.permutation(x.shape[1])[: max(2, x.shape[1] // 2)]
        _grow(x, bins, cuts, grad, rows, features, (), 0, own, leaves)
        rules |= own
        for part, mean in leaves:
            score[part] += SHRINK * 4 * mean
    return sorted(rules, key=lambda r: (len(r.conditions), r.conditions))


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 300) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty, by accelerated proximal gradient."""
    n, d = z.shape
    lip = 0.25 * np.linalg.norm(z, 2) ** 2 / n + 0.25
    bias = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    w = np.zeros(d)
    v, vb, t = w.copy(), bias, 1.0
    for _ in range(steps):
        r = _sigmoid(z @ v + vb) - y
        new = v - (z.T @ r) / n / lip
        new = np.sign(new) * np.maximum(np.abs(new) - penalty / lip, 0)
        nb = vb - r.mean() / lip
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t2 * (new - w), nb + (t - 1) / t2 * (nb - bias)
        w, bias, t = new, nb, t2
    return bias, w


def fit(x: np.ndarray, y: np.ndarray, seed: int = 3) -> RuleEnsemble | None:
    """Rules and weights from a sample; the penalty with the best loss on a fifth of it."""
    if len(y) == 0 or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    rules, columns, seen = [], [], set()
    for r in _tree_rules(x, y, rng):
        h = r.holds(x)
        if MIN_LEAF <= h.sum() <= len(y) - MIN_LEAF and (k := h.tobytes()) not in seen:
            seen.add(k)
            rules.append(r)
            columns.append(h)
    low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    clipped = np.clip(x, low, high)
    scale = clipped.std(axis=0)
    use = np.flatnonzero(scale > 1e-9)
    z = np.column_stack([*columns, *[0.4 * (clipped[:, j] - clipped[:, j].mean()) / scale[j] for j in use]]).astype(float)
    test = rng.random(len(y)) < 0.2
    if y[test].min(initial=1) == y[test].max(initial=0) or y[~test].min() == y[~test].max():
        test[:] = False

    def loss(p: float) -> float:
        b, w = _lasso(z[~test], y[~test], p)
        q = np.clip(_sigmoid(z[test] @ w + b), 1e-6, 1 - 1e-6)
        return -float((y[test] * np.log(q) + (1 - y[test]) * np.log(1 - q)).mean())

    penalty = min(PENALTIES, key=loss) if test.any() else PENALTIES[0]
    bias, w = _lasso(z, y, penalty, 600)
    linear = []
    for i, j in enumerate(use):
        if w[len(rules) + i]:
            slope = 0.4 * w[len(rules) + i] / scale[j]
            linear.append((int(j), float(low[j]), float(high[j]), float(slope)))
            bias -= slope * clipped[:, j].mean()
    return RuleEnsemble(float(bias), tuple((r, float(c)) for r, c in zip(rules, w) if c), tuple(linear))


def held_out() -> Column:
    return crc32_of_id() % 4 == 2


def learned_ensemble(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleEnsemble | None:
    """Fit on a bounded hash sample of the labelled rows that are not held out."""
    ids = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
           .groupBy("doc_id").agg(F.min("quality").cast("int").alias("y")))
    share = min(1.0, sample / max(1, ids.count()))
    chosen = (ids.filter(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1_000_000)) < int(1e6 * share) + 1)
              .limit(2 * sample))                       # a hash sample of ``sample`` rows in expectation
    rows = (stats.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct(*STATS)).alias("s"))   # a row an id
            .select("y", *[F.col("s")[c].alias(c) for c in STATS]).distinct().toPandas())
    rows = rows.sort_values(["y", *STATS])
    return fit(rows[STATS].to_numpy(float), rows["y"].to_numpy(float))


def quality_scores(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns (``doc_id`` among them) of ``docs`` with the quality score of ``text``."""
    stats = checkpointed(with_statistics(docs, keep))
    model = learned_ensemble(stats, labels)
    score = F.lit(0.0) if model is None else 1 / (1 + F.exp(-model.logit()))
    return stats.select(*keep, score.alias("score"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    out = quality_scores(docs, table(spark, sf_dir, "labels"), ["doc_id", "held_out"])
    return out.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
