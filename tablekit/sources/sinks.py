"""Sinks and table DDL.

Writes always go to a FRESH directory: a job may not overwrite the path it
reads, and a version directory written through Spark's commit protocol is
either complete or absent, so readers never see half a mutation.
"""

from __future__ import annotations

import bisect
import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.session import scratch_path
from tablekit.spec import NOW, TableSpec


def _require_known(df: DataFrame, names: list[str], what: str) -> None:
    unknown = [c for c in df.columns if c not in names]
    if unknown:
        raise ValueError(f"unknown columns for {what}: {unknown}")


def append(df: DataFrame, path: str, spec: TableSpec | None = None, now=None) -> None:
    """INSERT by column NAME into an existing parquet table (never by
    position): the batch is projected onto the table's column order.  Absent
    columns take the defaults of ``spec`` (NULL without one); a column that
    the table lacks raises."""
    from tablekit.operators.mutate import default_value
    target = df.sparkSession.read.parquet(path)
    _require_known(df, target.columns, path)
    cols = []
    for f in target.schema.fields:
        if f.name in df.columns:
            value = F.col(f.name)
        elif spec is not None and f.name in spec.names:
            value = default_value(spec.column(f.name), now)
        else:
            value = F.lit(None)
        cols.append(value.cast(f.dataType).alias(f.name))
    df.select(*cols).write.mode("append").parquet(path)


def version_path(base_dir: str, version: int) -> str:
    return f"{base_dir.rstrip('/')}/v{version:06d}"


def _counter_path(base_dir: str, version: int) -> str:
    return f"{base_dir.rstrip('/')}/counters/v{version:06d}"


def publish(df: DataFrame, base_dir: str, version: int, partition_by: list[str] | None = None,
            next_ids: dict[str, int] | None = None) -> str:
    """Write the whole new state as version ``version`` (fails if it exists).
    ``next_ids`` are its AUTO_INCREMENT counters (column -> next id), written
    before the rows, so that a complete version has them."""
    path = version_path(base_dir, version)
    if next_ids is not None:
        spark = df.sparkSession
        if version in published_versions(spark, base_dir):
            raise ValueError(f"version {version} exists below {base_dir}")
        spark.createDataFrame(list(next_ids.items()), "name string, next_id long") \
            .coalesce(1).write.mode("overwrite").parquet(_counter_path(base_dir, version))
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def published_versions(spark: SparkSession, base_dir: str) -> list[int]:
    """Complete versions below ``base_dir`` (those with a ``_SUCCESS`` mark), ascending."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(base_dir)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for st in fs.listStatus(base) if fs.exists(base) else []:
        name = st.getPath().getName()
        if name[:1] == "v" and name[1:].isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            found.append(int(name[1:]))
    return sorted(found)


def read_latest(spark: SparkSession, base_dir: str) -> DataFrame:
    """S5, reading: the newest complete version."""
    versions = published_versions(spark, base_dir)
    if not versions:
        raise FileNotFoundError(f"no complete version below {base_dir}")
    return spark.read.parquet(version_path(base_dir, versions[-1]))


def next_ids(spark: SparkSession, base_dir: str) -> dict[str, int]:
    """The counters of the newest complete version (empty if published without)."""
    versions = published_versions(spark, base_dir)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_counter_path(base_dir, versions[-1] if versions else 0))
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return {}
    return {r.name: r.next_id for r in spark.read.parquet(path.toString()).collect()}


def counted(df: DataFrame, counters: dict[str, int]) -> dict[str, int]:
    """``counters`` raised above the largest ids in ``df``: what to publish with it.
    A counter never falls, so the id of a deleted last row is not given out again."""
    if not counters:
        return {}
    top = df.agg(*[F.max(c).alias(c) for c in counters]).first()
    return {c: max(n, (top[c] or 0) + 1) for c, n in counters.items()}


def truncate(df: DataFrame, children: Sequence[tuple[DataFrame, str]] = ()) -> DataFrame:
    """TRUNCATE: no rows, same schema; no scan of the old data, and ids
    given afterwards start at 1 again.  Refused while a child table's foreign
    key column holds any reference."""
    for child, fk_col in children:
        if child.filter(F.col(fk_col).isNotNull()).limit(1).count():
            raise ValueError(f"TRUNCATE refused: {fk_col} references the table")
    return df.sparkSession.createDataFrame([], df.schema)


def truncate_table(spark: SparkSession, table: str) -> None:
    """S6 on a catalog table: TRUNCATE TABLE removes the files, keeps the
    definition; no row is read."""
    spark.sql(f"TRUNCATE TABLE {table}")


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def compact(spark: SparkSession, path: str, out_path: str, target_bytes: int = 128 << 20,
            order: list[str] | None = None) -> int:
    """S7 (OPTIMIZE TABLE): rewrite into ~target_bytes files.  With ``order``
    the rows are range-partitioned and sorted, which also restores pruning."""
    n = max(1, math.ceil(path_bytes(spark, path) / target_bytes))
    df = spark.read.parquet(path)
    if order:
        df = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    else:
        df = df.repartition(n)
    df.write.mode("errorifexists").parquet(out_path)
    return n


def write_clustered(df: DataFrame, path: str, by: list, tiebreak: str, n: int | None = None) -> None:
    """The composite index (department_id, base_salary DESC) re-aimed as a
    layout: range-partitioned and sorted files whose row-group min/max
    statistics let a filter on the leading key skip most of the data.  The
    unique ``tiebreak`` spreads one hot key over several files; without ``n``
    the session's shuffle partitions and AQE decide how many there are."""
    order = [*by, F.col(tiebreak)]
    ranged = df.repartitionByRange(n, *order) if n else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)


def _range_rank(value: Column, cuts: list, ranks: list[int]) -> Column:
    """ranks[k] for a value at or above k of the sorted ``cuts``: a balanced tree of comparisons."""
    if not cuts:
        return F.lit(ranks[0])
    m = len(cuts) // 2
    return F.when(value < F.lit(cuts[m]), _range_rank(value, cuts[:m], ranks[:m + 1])) \
        .otherwise(_range_rank(value, cuts[m + 1:], ranks[m + 1:]))


def write_curve(df: DataFrame, path: str, columns: Sequence[str], tiebreak: str, n: int | None = None,
                bits: int = 8) -> None:
    """A layout that serves a filter on any of ``columns`` (numbers, dates, times).

    Each column's value becomes its rank among 2 ** bits quantile ranges (NULL:
    rank 0); the ranks' bits are interleaved, highest first, and files are ranges
    of that number.  So a file is narrow in every column, where the sorted layout
    is narrow in the first.  Where files are few, the column named first is cut
    more finely.  Rows of one cell are sorted by ``columns`` and ``tiebreak``."""
    if not columns or bits * len(columns) > 62:
        raise ValueError("the interleaved ranks must fit 62 bits")
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(c, shares, 100 << bits).alias(c) for c in columns]).first()
    ranked = {}
    for i, c in enumerate(columns):
        quantiles = sorted(found[c] or [])
        cuts = sorted(set(quantiles))
        ranks = [0, *(bisect.bisect_right(quantiles, v) for v in cuts)]
        ranked[f"__rank_{i}"] = F.when(F.col(c).isNull(), 0).otherwise(_range_rank(F.col(c), cuts, ranks)).cast("long")
    curve = F.lit(0).cast("long")
    for i in range(len(columns)):
        for k in range(bits):
            bit = F.shiftright(F.col(f"__rank_{i}"), k).bitwiseAND(F.lit(1))
            curve = curve.bitwiseOR(F.shiftleft(bit, k * len(columns) + len(columns) - 1 - i))
    order = ["__curve", *columns, tiebreak]
    placed = df.withColumns(ranked).withColumn("__curve", curve).drop(*ranked)
    ranged = placed.repartitionByRange(n, *order) if n else placed.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).drop("__curve").write.mode("errorifexists").parquet(path)


def index_columns(spec: TableSpec, name: str) -> list:
    """The order columns of a declared index, for ``write_clustered``."""
    parts = next(p for n, p in spec.indexes if n == name)
    return [F.col(w[0]).desc() if w[1:] and w[1].upper() == "DESC" else F.col(w[0]) for w in map(str.split, parts)]


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, sort_by: list[str]) -> None:
    """S8 (hash variant): a bucketed, sorted catalog table; joins and
    aggregates on ``key`` against another table bucketed the same way skip
    the shuffle."""
    df.write.bucketBy(buckets, key).sortBy(*sort_by).mode("errorifexists").saveAsTable(table)


def _ddl_type(c) -> str:
    if c.char_len:
        return f"CHAR({c.char_len})"
    if c.max_len:
        return f"VARCHAR({c.max_len})"
    return c.dtype.upper()


def _ddl_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ddl_default(c) -> str:
    if not c.has_default or c.default is None:
        return ""
    if c.default is NOW:
        return " DEFAULT current_timestamp()"
    return f" DEFAULT CAST({_ddl_text(str(c.default))} AS {_ddl_type(c)})"


def create_table(spark: SparkSession, spec: TableSpec, database: str | None = None,
                 location: str | None = None) -> str:
    """CREATE TABLE IF NOT EXISTS from a spec (types, NOT NULL, DEFAULT, comment).
    Keys and checks stay in the spec: Spark parquet tables reject them."""
    name = f"{database}.{spec.name}" if database else spec.name
    cols = ", ".join(
        f"{c.name} {_ddl_type(c)}" + ("" if c.nullable else " NOT NULL") + _ddl_default(c)
        + (f" COMMENT {_ddl_text(c.comment)}" if c.comment else "") for c in spec.columns)
    comment = f" COMMENT {_ddl_text(spec.comment)}" if spec.comment else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{comment}{loc}")
    return name


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS (database and schema are synonyms)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def insert_by_name(df: DataFrame, table: str) -> None:
    """S4 on a catalog table: columns are matched by NAME; absent ones take
    the table's DEFAULT, unknown ones raise."""
    target = df.sparkSession.table(table)
    _require_known(df, target.columns, table)
    names = [f.name for f in target.schema.fields if f.name in df.columns]
    view = f"__batch_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    listed = ", ".join(f"`{n}`" for n in names)
    df.sparkSession.sql(f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {view}")
    df.sparkSession.catalog.dropTempView(view)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's shared checkpoint folder, for tables
    a job writes and reads back (never a machine-local temp folder); deleted
    when the application ends."""
    return scratch_path(spark, label)
