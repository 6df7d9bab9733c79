"""AUTO_INCREMENT ids for a whole frame without a global window.

The frame is range-partitioned on a unique order, each partition numbers
its rows locally, a prefix sum over the per-partition counts (one row per
partition) gives each partition's offset.  The tagged frame is checkpointed
so both passes see the same rows (see ``window._numbered``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.operators.window import _numbered, parse_order


def assign_ids(df: DataFrame, order: Sequence[str], start: int | Column = 1,
               name: str = "id", num_partitions: int | None = None) -> DataFrame:
    """Dense ids ``start, start+1, ...`` in ``order`` (which must be unique).

    ``start`` may be a Column such as a scalar subquery
    (``T.select(F.max('id') + 1).scalar()``).  Like any counter taken from the
    rows that are there, it gives the id of a deleted last row out again; keep
    the counter with the published version where that matters.
    """
    keys = parse_order(order)
    base = start if isinstance(start, Column) else F.lit(start)
    numbered = _numbered(df, [], keys[:-1], [k.name for k in keys[-1:]], num_partitions) \
        if not keys[-1].desc else _numbered(df, [], keys, [], num_partitions)
    return numbered.withColumn(name, (base + F.col("__rn") - 1).cast("bigint")) \
        .drop("__pid", "__loc", "__rn")


def next_id(table: DataFrame, column: str) -> Column:
    """max(column) + 1 over ``table`` (1 when empty), as a lazy scalar subquery."""
    return table.select(F.coalesce(F.max(column), F.lit(0)) + 1).scalar()
