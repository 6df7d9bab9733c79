"""Scans (S1) and literal row sources."""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Resolved scans per path for the CURRENT session: the footer / schema is
# read once per session, as with a catalog table; the DataFrame stays lazy.
_SCANS: dict[str, tuple[SparkSession, DataFrame]] = {}


def scan(spark: SparkSession, sf_dir: str, name: str, alias: str | None = None,
         fresh: bool = False) -> DataFrame:
    """Base-table scan.  Parquet keeps pushdown and column pruning.

    The resolved relation is reused within a session (the driver tables are
    read-only); ``fresh=True`` lists the files again.
    """
    path = os.path.join(sf_dir, f"{name}.parquet")
    hit = None if fresh else _SCANS.get(path)
    if hit is not None and hit[0] is spark and spark.sparkContext._jsc is not None:
        df = hit[1]
    else:
        df = spark.read.parquet(path)
        _SCANS[path] = (spark, df)
    return df.alias(alias) if alias else df


def rows(spark: SparkSession, schema: T.StructType | str,
         data: Iterable[Sequence]) -> DataFrame:
    """A literal row source with an explicit schema (never inferred).

    Literal batches are small by nature (the statement text holds them);
    large batches arrive as files and go through :func:`scan`.
    """
    return spark.createDataFrame(list(data), schema=schema)
