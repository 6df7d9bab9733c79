"""S5 by partition: copy on write of the partitions that a mutation touches.

The table is an external, partitioned catalog table.  A mutation reads and
rewrites only the partitions that hold a row it hits, into a fresh folder; the
catalog then points those partitions there (ALTER TABLE .. PARTITION .. SET
LOCATION).  Bytes written follow the chunk's partitions, not the table.

A reader sees each partition before or after the change.  A crash between two
catalog calls leaves some partitions unchanged; running the mutation again
finds what is left of its rows.  Old folders stay, as old versions do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"      # fixed value: Spark's folder name of a NULL partition


def save_partitioned(df: DataFrame, table: str, by: str, location: str) -> str:
    """Write ``df`` as the external table ``table``, partitioned by column ``by``."""
    df.write.partitionBy(by).mode("errorifexists").option("path", f"{location}/v0").saveAsTable(table)
    return table


def partition_locations(spark: SparkSession, table: str) -> dict[str | None, str]:
    """Partition value (as text, NULL as None) -> folder."""
    found = {}
    for (name,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        column, value = name.split("=", 1)
        value = None if value == NULL_FOLDER else unquote(value)
        info = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION ({_spec(column, value)})").collect()
        found[value] = next(r.data_type for r in info if r.col_name == "Location")      # the table's follows
    return found


def _spec(column: str, value: str | None) -> str:
    if value is None:
        return f"`{column}` = NULL"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"`{column}` = '{escaped}'"


def _in(column: str, values: list) -> Column:
    """A filter on partition values that prunes folders."""
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known


def _folders(spark: SparkSession, path: str) -> dict[str | None, str]:
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for st in fs.listStatus(base):
        name = st.getPath().getName()
        if st.isDirectory() and "=" in name:
            value = name.split("=", 1)[1]
            found[None if value == NULL_FOLDER else unquote(value)] = st.getPath().toString()
    return found


def rewrite_partitions(spark: SparkSession, table: str, by: str, hit_rows: DataFrame, location: str,
                       change: Callable[[DataFrame], DataFrame]) -> list:
    """Replace the partitions of ``hit_rows`` by ``change(rows of these partitions)``.

    ``hit_rows`` are rows of the table (``by`` is enough).  Returns the values of
    the partitions replaced, at most one driver row for each.  A partition left
    without rows is dropped.  Rows may move into a partition that is rewritten
    too, or that does not exist yet; any other raises before the catalog changes.
    """
    values = [r[0] for r in hit_rows.select(by).distinct().collect()]
    if not values:
        return []
    old = spark.table(table)
    fresh = f"{location}/v{uuid.uuid4().hex}"
    new = change(old.filter(_in(by, values))).select(*old.columns)
    new.write.partitionBy(by).parquet(fresh)
    as_text = spark.createDataFrame([(v,) for v in values], old.select(by).schema) \
        .select(F.col(by).cast("string")).collect()
    touched, written = {r[0] for r in as_text}, _folders(spark, fresh)
    there = {None if p.endswith(NULL_FOLDER) else unquote(p.split("=", 1)[1])
             for (p,) in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    if lost := [v for v in written if v in there and v not in touched]:
        raise ValueError(f"rows move into partitions that are not rewritten: {lost}")
    for value, path in written.items():
        if value in there:
            spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(by, value)}) SET LOCATION '{path}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({_spec(by, value)}) LOCATION '{path}'")
    for value in touched - written.keys():
        spark.sql(f"ALTER TABLE {table} DROP PARTITION ({_spec(by, value)})")
    spark.catalog.refreshTable(table)
    return values
