"""O2 by fence: a page at any offset reads the ranges that hold it.

The table is written once, range-partitioned and sorted on a unique order, a
folder for each range.  The fence table, one row a range, has the range's rows
and the rows before it.  A page looks its ranges up there; partition pruning
then leaves the other folders unread, however deep the page is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablekit.functions.exprs import order_cols
from tablekit.operators.query import page


def write_fenced(df: DataFrame, path: str, order: Sequence[str | Column], ranges: int | None = None) -> None:
    """Write ``path/rows``, ``path/fence`` and ``path/shape`` (no rows: the columns, also
    of an empty table).  ``order`` must be unique; without
    ``ranges`` the session's shuffle partitions and AQE decide how many there are."""
    spark, keys = df.sparkSession, order_cols(order)
    ranged = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    (ranged.withColumn("__range", F.spark_partition_id()).sortWithinPartitions("__range", *keys)
     .write.partitionBy("__range").parquet(f"{path}/rows"))
    df.limit(0).write.parquet(f"{path}/shape")
    sizes = _rows(spark, path).groupBy("__range").agg(F.count(F.lit(1)).alias("n_rows"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)      # a row a range
    (sizes.withColumn("rows_before", F.coalesce(F.sum("n_rows").over(before), F.lit(0)))
     .coalesce(1).write.parquet(f"{path}/fence"))


def _rows(spark: SparkSession, path: str) -> DataFrame:
    shape = spark.read.parquet(f"{path}/shape").schema
    return spark.read.schema(shape.add("__range", "integer")).parquet(f"{path}/rows")


def fenced_rows(spark: SparkSession, path: str) -> int:
    """Rows of the table, from the fence alone."""
    return spark.read.parquet(f"{path}/fence").agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]


def page_by_fence(spark: SparkSession, path: str, order: Sequence[str | Column], n: int, offset: int) -> DataFrame:
    """ORDER BY .. LIMIT n OFFSET offset over a fenced table, in the same order."""
    fence = spark.read.parquet(f"{path}/fence")
    # at most n ranges hold n rows
    held = fence.filter((F.col("rows_before") < offset + n) & (F.col("rows_before") + F.col("n_rows") > offset)).collect()
    rows = _rows(spark, path).filter(F.col("__range").isin([r["__range"] for r in held])).drop("__range")
    return page(rows, order, n, offset - min((r.rows_before for r in held), default=offset))
