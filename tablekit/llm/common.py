"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.session import ensure_checkpoint_dir, reliable_checkpoint

__all__ = ["checkpointed", "crc32_of_id", "excerpt", "ensure_checkpoint_dir", "release", "shipped", "table", "text_or_empty"]

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Make this package importable on executors (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "tablekit_src.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(PACKAGE):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(PACKAGE)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise into the shared checkpoint folder; later plans read it back."""
    return reliable_checkpoint(df)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of frames that nothing refers to any more.

    Its cleaner acts when the driver's JVM collects garbage, which a job with
    few objects and large shuffles may never come to do by itself.  The last
    frame's shuffles are garbage only some time after what stood on them has been
    collected: one collection, or two at once, leave them in place.
    """
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(0.5)
    gc.collect()
    spark._jvm.System.gc()


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def excerpt(limit: int, col: str = "text") -> Column:
    """A text, or of a longer one ``limit`` characters from a place that its hash gives."""
    text = F.col(col)
    start = F.pmod(F.xxhash64(text, F.lit(limit)), F.greatest(F.length(text) - limit, F.lit(0)) + 1) + 1
    return F.when(F.length(text) <= limit, text).otherwise(F.substring(text, start.cast("int"), F.lit(limit)))


def crc32_of_id(col: str = "doc_id") -> Column:
    """crc32 of the id as text (NULL id: of the empty string)."""
    return F.crc32(F.encode(F.coalesce(F.col(col).cast("string"), F.lit("")), "UTF-8"))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
