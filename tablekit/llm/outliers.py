"""Quality rules with robust multivariate outliers, by DataFrame functions only.

Base statistics come from whole texts.  Documents that fail a base rule are
out at once; the others are judged by the Mahalanobis distance of their
transformed statistic vector from a minimum-covariance-determinant (MCD)
estimate of their language and source.

The estimate: three deterministic starts about the medians (MADs alone; the
correlation of tanh of the standardized values; that of their spatial signs),
``FIRST_STEPS`` concentration steps for each (keep the share ``SUPPORT`` of rows
that are closest, take their mean and covariance), then the start with the least
determinant goes on until its determinant stands still.  The covariance is
scaled for consistency.  Every group's figures
are sums and quantile sketches, so a group of any size is pre-aggregated by
the tasks that read it; joins with a group's figures are salted.  Sources with
under ``MIN_GROUP`` rows of a language are pooled, and so are languages whose
pool is still that small.

Edge cases: a NULL or empty text has no words and fails; NULL languages and
sources are groups of their own; rows that repeat an id are judged one by one;
variances have a floor, so constant statistics reject nothing by rounding;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablekit.llm.common import checkpointed, table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_GROUP = 60
SALTS = 16
SUPPORT = 0.75
FIRST_STEPS = 2                       # concentration steps of every start; the best one goes on
LAST_STEPS = 30                       # at most, while the log determinant falls by more than STILL
STILL = 1e-6
SHRINK = 0.99                         # of a start's correlations, so that it has an inverse
TAIL = 1e-9                           # chance of a normal vector beyond the cutoff
ACCURACY = 20_000
#: transformed statistic -> least standard deviation
VECTOR = {"v_length": 0.5, "v_word": 0.15, "v_symbol": 0.6, "v_lines": 0.12, "v_repeat": 0.12}
WHITE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the array ``words``."""

    def from_windows(grams: Column) -> Column:
        placed = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def covered(o: Column) -> Column:
            twice = F.filter(o, lambda s, k: (s["h"] == F.get(o, k - 1)["h"]) | (s["h"] == F.get(o, k + 1)["h"]))
            return F.size(F.array_distinct(F.flatten(F.transform(
                twice, lambda s: F.array(s["i"], s["i"] + 1, s["i"] + 2)))))

        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(let(placed, covered))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                          lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, 0).otherwise(let(windows, from_windows)).cast("long")


def base_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    solid = F.regexp_replace(text, WHITE, "")
    words = F.filter(F.split(text, WHITE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_replace(x, WHITE, "") != "")
    return (docs.select(
        "doc_id", "lang", "source", F.length(solid).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                      (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d"))).alias("__l"),
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))).alias("__w"))
        .select("doc_id", "lang", "source", F.col("__w.n").alias("n_words"), "word_chars", "n_symbols",
                F.col("__l.d").alias("n_dup_lines"), F.col("__l.n").alias("n_lines"),
                F.col("__w.r").alias("n_repeat_words")))


def transformed(stats: DataFrame) -> DataFrame:
    """Add ``base_failed`` and the statistic vector (defined for rows with words)."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return stats.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        "v_length": F.log(n),
        "v_word": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "v_symbol": F.log1p(1000.0 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "v_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "v_repeat": F.sqrt(F.col("n_repeat_words") / n),
    })


def chi2_cdf(x: float, d: float) -> float:
    """Chi-squared distribution function by the series of the lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, half, term, total, k = d / 2, x / 2, 1.0, 1.0, 0
    while term > 1e-17 * total:
        k += 1
        term *= half / (a + k)
        total += term
    return min(1.0, total * math.exp(a * math.log(half) - half - math.lgamma(a + 1)))


def chi2_quantile(p: float, d: float) -> float:
    lo, hi = 0.0, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, d) < p else (lo, mid)
    return hi


def consistency(d: int, share: float = SUPPORT) -> float:
    """What the covariance of the closest share of normal rows must be multiplied by."""
    return share / chi2_cdf(chi2_quantile(share, d), d + 2)


def _factor_frame(frame: DataFrame, cov: list[list[Column]], keep: list[str]) -> DataFrame:
    """``keep`` and l_i_j: the Cholesky factor, one column of it after another (small expressions)."""
    d = len(cov)
    names = {(i, j): f"c_{i}_{j}" for i in range(d) for j in range(i + 1)}
    frame = frame.select(*keep, *[cov[i][j].alias(n) for (i, j), n in names.items()])
    for j in range(d):
        pivot = F.sqrt(F.greatest(F.col(f"c_{j}_{j}"), F.lit(1e-12)))
        frame = frame.withColumn(f"l_{j}_{j}", pivot)
        frame = frame.withColumns({f"l_{i}_{j}": F.col(f"c_{i}_{j}") / F.col(f"l_{j}_{j}") for i in range(j + 1, d)}) \
            if j + 1 < d else frame
        rest = {f"c_{i}_{k}": F.col(f"c_{i}_{k}") - F.col(f"l_{i}_{j}") * F.col(f"l_{k}_{j}")
                for i in range(j + 1, d) for k in range(j + 1, i + 1)}
        frame = frame.withColumns(rest) if rest else frame
    return frame.select(*keep, *[f"l_{i}_{j}" for (i, j) in names])


def _with_distance(rows: DataFrame, d: int) -> DataFrame:
    """Add ``dist``: squared Mahalanobis distance by forward substitution."""
    for i in range(d):
        solved = (F.col(list(VECTOR)[i]) - F.col(f"m_{i}")) - sum(
            (F.col(f"l_{i}_{j}") * F.col(f"z_{j}") for j in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"z_{i}", solved / F.col(f"l_{i}_{i}"))
    dist = sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(d)), F.lit(0.0))
    return rows.withColumn("dist", dist).drop(*[f"z_{i}" for i in range(d)])


def with_groups(stats: DataFrame) -> DataFrame:
    """Add ``grp``, the group whose estimate judges the row, and ``salt``.

    Sizes count the rows that pass the base rules.
    """
    lang, source = F.col("lang").cast("string"), F.col("source").cast("string")
    rows = stats.withColumn("own", F.struct(lang.alias("lang"), source.alias("source")))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", *VECTOR), F.lit(SALTS)).cast("int"))
    sizes = rows.groupBy("own").agg(F.count(F.when(~F.col("base_failed"), 1)).alias("n"))
    small = F.when(F.col("n") < MIN_GROUP, F.col("n")).otherwise(0)
    pool = F.sum(small).over(Window.partitionBy("own.lang"))

    def grp(level: int, lang: Column, source: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), lang.alias("lang"), source.alias("source"))

    none = F.lit(None).cast("string")
    group = (F.when(F.col("n") >= MIN_GROUP, grp(0, F.col("own.lang"), F.col("own.source")))
             .when(pool >= MIN_GROUP, grp(1, F.col("own.lang"), none)).otherwise(grp(2, none, none)))
    return rows.join(_salted(sizes.select("own", group.alias("grp"))), ["own", "salt"]).drop("own")


def _salted(small: DataFrame) -> DataFrame:
    """A row for every salt, so that the rows of one group may meet it in many tasks."""
    return small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _estimates(frame: DataFrame, cov: list[list[Column]], keep: list[str]) -> DataFrame:
    """``keep``, the Cholesky factor and ``logdet``, the covariance's log determinant."""
    log_pivots = (F.log(F.col(f"l_{i}_{i}")) for i in range(len(cov)))
    return _factor_frame(frame, cov, keep).withColumn("logdet", 2 * sum(log_pivots, F.lit(0.0)))


def _starts(rows: DataFrame) -> DataFrame:
    """(grp, start, n, m_i, l_i_j, logdet): three starting estimates of every group."""
    names, floors = list(VECTOR), list(VECTOR.values())
    d = len(names)
    lower = [(i, j) for i in range(d) for j in range(i + 1)]
    middle = rows.groupBy("grp").agg(
        F.count("*").alias("n"), *[F.percentile_approx(c, 0.5, ACCURACY).alias(f"m_{i}") for i, c in enumerate(names)])
    spread = rows.join(_salted(middle), ["grp", "salt"]).groupBy("grp").agg(
        F.first("n").alias("n"), *[F.first(f"m_{i}").alias(f"m_{i}") for i in range(d)],
        *[F.percentile_approx(F.abs(F.col(c) - F.col(f"m_{i}")), 0.5, ACCURACY).alias(f"s_{i}")
          for i, c in enumerate(names)])
    scale = {f"s_{i}": F.greatest(1.4826 * F.col(f"s_{i}"), F.lit(floors[i])) for i in range(d)}
    spread = checkpointed(spread.withColumns(scale))
    rows = rows.join(_salted(spread), ["grp", "salt"]).select(
        "grp", *[((F.col(c) - F.col(f"m_{i}")) / F.col(f"s_{i}")).alias(f"u_{i}") for i, c in enumerate(names)])
    rows = rows.withColumns({f"t_{i}": F.tanh(f"u_{i}") for i in range(d)})
    length = sum((F.col(f"u_{i}") ** 2 for i in range(d)), F.lit(1e-12))
    moments = rows.groupBy("grp").agg(
        *[F.avg(F.col(f"t_{i}") * F.col(f"t_{j}")).alias(f"q_{i}_{j}") for i, j in lower],
        *[F.avg(f"t_{i}").alias(f"b_{i}") for i in range(d)],
        *[F.avg(F.col(f"u_{i}") * F.col(f"u_{j}") / length).alias(f"g_{i}_{j}") for i, j in lower])
    tanh = {(i, j): F.col(f"q_{i}_{j}") - F.col(f"b_{i}") * F.col(f"b_{j}") for i, j in lower}
    signs = {(i, j): F.col(f"g_{i}_{j}") for i, j in lower}
    found = checkpointed(spread.join(moments, "grp"))

    def covariance(scatter: dict[tuple[int, int], Column] | None) -> list[list[Column]]:
        def entry(i: int, j: int) -> Column:
            if i == j:
                return F.col(f"s_{i}") ** 2
            if scatter is None:
                return F.lit(0.0)
            both = F.sqrt(F.greatest(scatter[i, i], F.lit(1e-9)) * F.greatest(scatter[j, j], F.lit(1e-9)))
            return SHRINK * scatter[i, j] / both * F.col(f"s_{i}") * F.col(f"s_{j}")
        return [[entry(i, j) for j in range(i + 1)] for i in range(d)]

    keep = ["grp", "start", "n", *[f"m_{i}" for i in range(d)]]
    one, two, three = (_estimates(found.withColumn("start", F.lit(k)), covariance(scatter), keep)
                       for k, scatter in enumerate((None, tanh, signs)))
    return checkpointed(one.unionByName(two).unionByName(three))


def _concentrated(rows: DataFrame, now: DataFrame) -> DataFrame:
    """One concentration step of the estimates ``now`` (grp, start, ...)."""
    names, floors = list(VECTOR), list(VECTOR.values())
    d = len(names)
    near = _with_distance(rows.join(_salted(now), ["grp", "salt"]), d)
    cut = near.groupBy("grp", "start").agg(F.percentile_approx("dist", SUPPORT, ACCURACY).alias("cut"))
    cut = checkpointed(now.join(cut, ["grp", "start"]))
    inner = _with_distance(rows.join(_salted(cut), ["grp", "salt"]), d).filter("dist <= cut")
    moved = [F.col(c) - F.col(f"m_{i}") for i, c in enumerate(names)]      # about the last centre: no cancellation
    sums = inner.groupBy("grp", "start").agg(
        F.first("n").alias("n"), *[F.first(f"m_{i}").alias(f"o_{i}") for i in range(d)],
        *[F.avg(moved[i]).alias(f"a_{i}") for i in range(d)],
        *[F.avg(moved[i] * moved[j]).alias(f"p_{i}_{j}") for i in range(d) for j in range(i + 1)])
    cov = [[(F.col(f"p_{i}_{j}") - F.col(f"a_{i}") * F.col(f"a_{j}")) * consistency(d)
            + (floors[i] ** 2 if i == j else 0.0) for j in range(i + 1)] for i in range(d)]
    sums = sums.withColumns({f"m_{i}": F.col(f"o_{i}") + F.col(f"a_{i}") for i in range(d)})
    return checkpointed(_estimates(sums, cov, ["grp", "start", "n", *[f"m_{i}" for i in range(d)]]))


def mcd_estimates(rows: DataFrame) -> DataFrame:
    """(grp, n, m_i, l_i_j): centre and Cholesky factor of every group's scaled MCD covariance.

    ``rows`` have grp, salt and the vector.  A step that does not lower a group's
    determinant is not taken, and the group is done.
    """
    rows = rows.select("grp", "salt", *VECTOR)
    now = _starts(rows)
    for _ in range(FIRST_STEPS):
        now = _concentrated(rows, now)
    cols = now.columns
    now = checkpointed(now.groupBy("grp").agg(F.min_by(F.struct(*cols), F.struct("logdet", "start")).alias("e"))
                       .select("e.*", F.lit(True).alias("moving")))
    for _ in range(LAST_STEPS):
        step = _concentrated(rows, now.filter("moving").drop("moving")).select("grp", F.struct(*cols).alias("e"))
        falls = F.coalesce(F.col("e.logdet") < F.col("logdet") - STILL, F.lit(False))
        now = checkpointed(now.join(step, "grp", "left")
                           .select(F.when(falls, F.col("e")).otherwise(F.struct(*cols)).alias("e"), falls.alias("moving"))
                           .select("e.*", "moving"))
        if now.filter("moving").isEmpty():
            break
    return now.drop("moving", "start", "logdet")


def judged(stats: DataFrame, tail: float = TAIL) -> DataFrame:
    """Add ``distance`` (squared, from the row's estimate) and ``kept`` to transformed statistics."""
    d = len(VECTOR)
    rows = checkpointed(with_groups(stats))
    found = mcd_estimates(rows.filter(~F.col("base_failed"))).drop("n")
    near = _with_distance(rows.join(_salted(found), ["grp", "salt"], "left"), d)
    cutoff = chi2_quantile(1 - tail, d)
    return (near.withColumn("distance", F.col("dist"))
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("dist") <= cutoff, F.lit(True)))
            .select(*stats.columns, "distance", "kept"))


def op9_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of all documents, the base verdict and the method's."""
    return judged(checkpointed(transformed(base_statistics(table(spark, sf_dir, "documents"))))).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                "base_failed", "kept", "distance")
