"""Query operators: joins (J1-J8), aggregates (A1-A7), sorts and pages (O1-O4),
set operations (U1).

Joins are left to Catalyst + AQE: a side is broadcast only when the planner's
size estimate (or AQE's runtime statistics) is under
``spark.sql.autoBroadcastJoinThreshold``; nothing is broadcast by hand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.functions.exprs import hit, order_cols

def _on(on: str | Sequence[str] | Column):
    return [on] if isinstance(on, str) else on


def join(a: DataFrame, b: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-joins; strategy chosen by the planner (BHJ / SMJ / SHJ)."""
    return a.join(b, _on(on), how)


def left_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """J2."""
    return a.join(b, _on(on), "left")


def right_join(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Written as the swapped LEFT join the reference advises."""
    res = b.join(a, _on(on), "left")
    keys = [on] if isinstance(on, str) else list(on)
    cols = keys + [c for c in a.columns if c not in keys] + [c for c in b.columns if c not in keys]
    return res.select(*cols)


def full_join(a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """FULL OUTER as LEFT JOIN  UNION ALL  (B anti-join A's distinct keys).

    AQE splits a skewed key in a LEFT join but not in a FULL OUTER one, so a
    key that holds a third of A stays spread.  Output keeps both key columns,
    like ``a.join(b, a_key == b_key, 'full')``.
    """
    left = a.join(b, a[a_key] == b[b_key], "left")
    only_b = b.join(a.select(F.col(a_key).alias("__k")).distinct(), b[b_key] == F.col("__k"), "left_anti")
    return left.unionByName(only_b, allowMissingColumns=True)


full_via_union = full_join


def grid(df: DataFrame, row: str, col: str, domain: Sequence, name: str = "n") -> DataFrame:
    """The dense grid (every value of ``row``) x (every value of the
    declared ``domain`` of ``col``) with the number of rows of ``df`` in each
    cell.  ``domain`` is a declared list, NULL (None) may be in it; values
    outside it raise nothing and are not in the grid."""
    cells = df.select(row).distinct().withColumn(
        col, F.explode(F.array(*[F.lit(v).cast(df.schema[col].dataType) for v in domain])))
    counts = df.groupBy(row, col).agg(F.count(F.lit(1)).alias(name))
    r, c = F.col("__row"), F.col("__col")
    counts = counts.select(F.col(row).alias("__row"), F.col(col).alias("__col"), name)
    return cells.join(counts, cells[row].eqNullSafe(r) & cells[col].eqNullSafe(c), "left") \
        .select(cells[row], cells[col], F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name))


def semi(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Rows of A with a match in B; A is never multiplied."""
    return a.join(b, _on(on), "left_semi")


def anti(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Rows of A without a match in B."""
    return a.join(b, _on(on), "left_anti")


def union(a: DataFrame, b: DataFrame, distinct: bool = False) -> DataFrame:
    """UNION ALL by name (or UNION when ``distinct``)."""
    u = a.unionByName(b)
    return u.distinct() if distinct else u


def summarize(df: DataFrame, by: Sequence[str], value: str, prefix: str = "") -> DataFrame:
    """COUNT(*), COUNT(col), SUM, AVG, MIN, MAX in one partial+final
    hash aggregate (map-side combine keeps hot keys cheap)."""
    v = F.col(value)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias(f"{prefix}n_rows"),
        F.count(v).alias(f"{prefix}n_values"),
        F.sum(v).alias(f"{prefix}sum_value"),
        F.avg(v).alias(f"{prefix}avg_value"),
        F.min(v).alias(f"{prefix}min_value"),
        F.max(v).alias(f"{prefix}max_value"),
    )


def having(agg: DataFrame, cond: Column | str) -> DataFrame:
    """HAVING is a filter after the aggregate."""
    return agg.filter(F.expr(cond) if isinstance(cond, str) else cond)


def page(df: DataFrame, order: Sequence[str | Column], n: int, offset: int = 0) -> DataFrame:
    """O2: ORDER BY .. LIMIT n OFFSET m.

    Offset before limit; Spark plans a TakeOrderedAndProject, i.e. a
    per-partition top-(m+n) before the single merge, so only
    (m+n) x partitions rows ever meet in one place.
    """
    sorted_df = df.orderBy(*order_cols(order))
    if offset:
        sorted_df = sorted_df.offset(offset)
    return sorted_df.limit(n)


def page_narrow(df: DataFrame, order: Sequence[str], n: int, offset: int, key: str) -> DataFrame:
    """O2 for rows carrying large values (TEXT / LOB columns): sort and page
    only the order columns and ``key`` (unique), then join the full rows back
    for the n keys of the page.  The top-(offset+n) merge then moves narrow
    rows instead of texts; the planner broadcasts the n page keys when they are few.
    Output is ordered like ``page``."""
    from tablekit.functions.exprs import order_names
    cols = list(dict.fromkeys([c for c, _ in order_names(order)] + [key]))
    keys = page(df.select(*cols), order, n, offset).select(key)
    return df.join(keys, key, "left_semi").orderBy(*order_cols(order))


def _after(c: str, desc: bool, v) -> Column:
    """Rows strictly after value ``v`` of column ``c`` in Spark's default
    NULL order (ASC: NULLs first; DESC: NULLs last)."""
    col_ = F.col(c)
    if v is None:
        return F.lit(False) if desc else col_.isNotNull()
    after = col_ < F.lit(v) if desc else col_ > F.lit(v)
    return (after | col_.isNull()) if desc else after


def _same(c: str, v) -> Column:
    return F.col(c).isNull() if v is None else F.col(c) == F.lit(v)


def page_after(df: DataFrame, order: Sequence[str], last: Sequence, n: int) -> DataFrame:
    """Keyset page: rows strictly after ``last`` in (ascending/descending)
    ``order``, then the first n.  A pushed-down range filter replaces the
    scan-and-discard of a deep OFFSET.  NULL keys follow Spark's default
    order (ASC puts them first, DESC last), so paging never skips or repeats
    a row; the last order column should be unique."""
    from tablekit.functions.exprs import order_names
    names = order_names(order)
    cond = F.lit(False)
    for i, (c, desc) in enumerate(names):
        term = _after(c, desc, last[i])
        for j in range(i):
            term = term & _same(names[j][0], last[j])
        cond = cond | term
    return page(df.filter(cond), order, n)


def oldest(df: DataFrame, where, order: Sequence[str], key: str, n: int) -> DataFrame:
    """O3: the first n rows by age among the rows hit by ``where``
    (key as the last sort key, so a chunk is deterministic)."""
    return df.filter(hit(where)).orderBy(*order_cols(list(order) + [key])).limit(n)
