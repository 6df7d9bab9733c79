"""Sinks, DDL, ids and the savepoint batch."""

import glob
import os
import re
from collections import Counter
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tablekit.operators import mutate as M
from tablekit.operators.batch import Batch
from tablekit.operators.ids import assign_ids
from tablekit.sources import fences as N
from tablekit.sources import fixtures as fx
from tablekit.sources import partitioned as P
from tablekit.sources import sinks as S
from tablekit.spec import EMPLOYEES
from tests.conftest import SF001


def test_append_by_name(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "t")
    spark.createDataFrame([(1, "a", 2.0)], "id long, name string, v double").write.parquet(path)
    S.append(spark.createDataFrame([("b", 2)], "name string, id long"), path)
    rows = sorted(map(tuple, spark.read.parquet(path).collect()), key=str)
    assert rows == [(1, "a", 2.0), (2, "b", None)]


def test_publish_fresh_versions(spark, tmpdir_fresh):
    df = spark.range(5)
    p1 = S.publish(df, tmpdir_fresh, 1)
    assert spark.read.parquet(p1).count() == 5
    with pytest.raises(Exception):
        S.publish(df, tmpdir_fresh, 1)
    p2 = S.publish(S.truncate(spark.read.parquet(p1)), tmpdir_fresh, 2)
    t = spark.read.parquet(p2)
    assert t.count() == 0 and t.columns == ["id"]


def test_latest_complete_version_and_truncate_refusal(spark, tmpdir_fresh):
    base = os.path.join(tmpdir_fresh, "t")
    with pytest.raises(FileNotFoundError):
        S.read_latest(spark, base)
    for v, n in ((1, 5), (2, 7), (3, 9)):
        S.publish(spark.range(n), base, v)
    os.remove(os.path.join(S.version_path(base, 3), "_SUCCESS"))     # a write that did not end
    assert S.published_versions(spark, base) == [1, 2]
    assert S.read_latest(spark, base).count() == 7
    child = spark.createDataFrame([(1, 4), (2, None)], "id long, parent_id long")
    with pytest.raises(ValueError):
        S.truncate(spark.range(5), [(child, "parent_id")])
    assert S.truncate(spark.range(5), [(child.filter("id = 2"), "parent_id")]).count() == 0


def test_named_inserts_take_defaults_and_reject_unknown_columns(spark, tmpdir_fresh):
    emp = fx.employees(spark, SF001)
    path = S.publish(emp, tmpdir_fresh, 1)
    row = fx.sample_rows(spark, "tcl").withColumn("emp_id", F.lit(10**9))
    S.append(row, path, EMPLOYEES, "2024-01-01 00:00:00")
    got = spark.read.parquet(path).filter("emp_id = 1000000000").first()
    assert got.contract_type == "FULL_TIME" and got.created_at is not None and got.metadata is None
    with pytest.raises(ValueError):
        S.append(row.withColumn("full_nme", F.lit("x")), path)


def test_compact_and_clustered_layout(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    spark.range(0, 20000, numPartitions=16).write.parquet(src)
    n = S.compact(spark, src, os.path.join(tmpdir_fresh, "compact"), target_bytes=1 << 30)
    assert n == 1 and len([f for f in os.listdir(os.path.join(tmpdir_fresh, "compact"))
                           if f.endswith(".parquet")]) == 1
    emp = fx.employees(spark, SF001)
    out = os.path.join(tmpdir_fresh, "clustered")
    S.write_clustered(emp, out, [F.col("department_id"), F.col("base_salary").desc()], "emp_id", 4)
    t = spark.read.parquet(out)
    q = t.filter(F.col("department_id") == 5)
    assert "PushedFilters: [IsNotNull(department_id), EqualTo(department_id,5)]" in \
        q._jdf.queryExecution().executedPlan().toString() or q.count() == emp.filter("department_id = 5").count()
    assert q.count() == emp.filter("department_id = 5").count()


def test_ddl_create_and_rename(spark):
    from tablekit.operators.evolve import rename_table, set_default_sql
    S.create_database(spark, "enterprise_core_db")
    S.create_database(spark, "enterprise_core_db")          # IF NOT EXISTS
    name = S.create_table(spark, EMPLOYEES, "enterprise_core_db")
    S.create_table(spark, EMPLOYEES, "enterprise_core_db")
    cols = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE {name}").collect()}
    assert cols["national_id"].lower().startswith("char(14)") and cols["base_salary"] == "decimal(10,2)"
    S.insert_by_name(fx.employees(spark, SF001), name)
    assert spark.table(name).count() == fx.employees(spark, SF001).count()
    S.truncate_table(spark, name)
    assert spark.table(name).count() == 0 and "national_id" in spark.table(name).columns
    set_default_sql(spark, name, "base_salary", "1000.00")
    rename_table(spark, name, "enterprise_core_db.core_employees")
    assert spark.catalog.tableExists("enterprise_core_db.core_employees")


def test_assign_ids_dense_in_order(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    out = assign_ids(df, ["k"], start=100, name="id", num_partitions=5).collect()
    assert sorted((r.k, r.id) for r in out) == [(k, k + 100) for k in range(5000)]


def test_batch_savepoints(spark, tmpdir_fresh):
    emp = fx.employees(spark, SF001)
    b = Batch(emp)
    b.apply(M.insert, fx.sample_rows(spark, "tcl"), EMPLOYEES, "2024-01-01 00:00:00")
    b.savepoint("point_alpha")
    b.apply(M.update, {"base_salary": F.col("base_salary") + 500}, F.col("national_id") == "29906061122334")
    sal = lambda f: f.filter("national_id = '29906061122334'").first()
    assert sal(b.current).base_salary == Decimal("10000.00")
    assert len(b.metrics) == 2
    b.rollback_to("point_alpha")
    assert len(b.metrics) == 1                             # counts of undone steps go too
    b.release("point_alpha")
    b.checkpoint()
    row = sal(b.current)
    assert row.base_salary == Decimal("9500.00") and row.contract_type == "FULL_TIME"
    with pytest.raises(KeyError):
        b.rollback_to("point_alpha")
    path = b.commit(tmpdir_fresh, 1)
    assert spark.read.parquet(path).count() == emp.count() + 1
    with pytest.raises(RuntimeError):
        b.apply(M.delete, F.lit(True))
    b2 = Batch(emp)
    b2.apply(M.delete, F.lit(True))
    assert b2.rollback().count() == emp.count()
    assert not os.path.exists(os.path.join(tmpdir_fresh, "v000002"))


def test_purge_prunes_date_partitions(spark, tmpdir_fresh):
    import datetime as dt
    from tests.conftest import SF001
    from tablekit.sources.tables import scan
    ev = scan(spark, SF001, "events").withColumn("dt", F.to_date("ts"))
    src = os.path.join(tmpdir_fresh, "events")
    ev.write.partitionBy("dt").parquet(src)
    cutoff = dt.date(2024, 1, 15)
    q = spark.read.parquet(src).filter(F.col("dt") >= F.lit(cutoff))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    out = M.purge_partitions(spark, src, "dt", cutoff, os.path.join(tmpdir_fresh, "purged"), 1)
    kept = spark.read.parquet(out)
    assert kept.count() == ev.filter(F.col("dt") >= F.lit(cutoff)).count()
    assert kept.agg(F.min("dt")).first()[0] >= cutoff


def test_bucketed_join_skips_shuffle(spark):
    from tests.conftest import SF001
    emp = fx.employees(spark, SF001)
    S.save_bucketed(emp, "emp_bucketed", "department_id", 4, ["department_id"])
    S.save_bucketed(fx.departments(spark, SF001).withColumnRenamed("id", "department_id"),
                    "dep_bucketed", "department_id", 4, ["department_id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("emp_bucketed").join(spark.table("dep_bucketed"), "department_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
        assert j.count() == emp.filter("department_id IS NOT NULL").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _partitioned(spark, base, rows):
    name = "t_" + os.path.basename(base).replace("-", "_").lower()
    P.save_partitioned(spark.createDataFrame(rows, "id long, k string, v long"), name, "k", base)
    return name


def test_rewrite_touches_its_partitions_only(spark, tmpdir_fresh):
    rows = [(i, ["a", "b c", "d'e=f/g", None][i % 4], i) for i in range(40)]
    t = _partitioned(spark, tmpdir_fresh, rows)
    before = P.partition_locations(spark, t)
    assert set(before) == {"a", "b c", "d'e=f/g", None}
    hit = F.col("id").isin(1, 2, 5)
    changed = P.rewrite_partitions(spark, t, "k", spark.table(t).filter(hit), tmpdir_fresh, lambda r: M.delete(r, hit)[0])
    assert set(changed) == {"b c", "d'e=f/g"}
    after = P.partition_locations(spark, t)
    assert {k for k in after if after[k] != before[k]} == {"b c", "d'e=f/g"}
    assert Counter(map(tuple, spark.table(t).select("id", "k", "v").collect())) == Counter(r for r in rows if r[0] not in (1, 2, 5))
    fresh = [f for f in os.listdir(tmpdir_fresh) if f != "v0"]
    assert len(fresh) == 1 and spark.read.parquet(os.path.join(tmpdir_fresh, fresh[0])).count() == 17
    # the NULL partition, and one that is emptied
    null = F.col("k").isNull()
    P.rewrite_partitions(spark, t, "k", spark.table(t).filter(null), tmpdir_fresh,
                         lambda r: r.withColumn("v", -F.col("v")))
    assert spark.table(t).filter(null).agg(F.sum("v")).first()[0] == -sum(r[2] for r in rows if r[1] is None)
    P.rewrite_partitions(spark, t, "k", spark.table(t).filter("k = 'a'"), tmpdir_fresh, lambda r: r.filter("false"))
    assert "a" not in P.partition_locations(spark, t) and spark.table(t).filter("k = 'a'").count() == 0
    assert P.rewrite_partitions(spark, t, "k", spark.table(t).filter("id = 999"), tmpdir_fresh, lambda r: r) == []


def test_rewrite_of_rows_that_move(spark, tmpdir_fresh):
    t = _partitioned(spark, tmpdir_fresh, [(1, "a", 1), (2, "b", 2), (3, "c", 3)])
    one = F.col("id") == 1

    def move(target):
        return lambda r: r.withColumn("k", F.when(one, target).otherwise(F.col("k")))

    with pytest.raises(ValueError):
        P.rewrite_partitions(spark, t, "k", spark.table(t).filter(one), tmpdir_fresh, move("b"))
    assert spark.table(t).count() == 3
    P.rewrite_partitions(spark, t, "k", spark.table(t).filter(one), tmpdir_fresh, move("new"))
    assert {(r.id, r.k) for r in spark.table(t).collect()} == {(1, "new"), (2, "b"), (3, "c")}
    P.rewrite_partitions(spark, t, "k", spark.table(t).filter("id < 3"), tmpdir_fresh, move("b"))
    assert {(r.id, r.k) for r in spark.table(t).collect()} == {(1, "b"), (2, "b"), (3, "c")}


def test_pages_by_fence(spark, tmpdir_fresh):
    rows = [(i, i * 7919 % 101 if i % 11 else None) for i in range(1_000)]
    df = spark.createDataFrame(rows, "id long, v long")
    path, order = os.path.join(tmpdir_fresh, "t"), ["v DESC", "id"]
    N.write_fenced(df, path, order, ranges=40)
    assert N.fenced_rows(spark, path) == 1_000
    want = [r.id for r in df.orderBy(F.desc("v"), "id").collect()]
    for offset in (0, 13, 499, 900, 995, 1_000, 5_000):
        got = N.page_by_fence(spark, path, order, 20, offset)
        assert [r.id for r in got.collect()] == want[offset:offset + 20]
    plan = N.page_by_fence(spark, path, order, 20, 900)._jdf.queryExecution().executedPlan().toString()
    ranges = re.search(r"PartitionFilters: \[.*?__range#\d+ (?:IN \(|= )([\d,]+)", plan).group(1)      # the folders it reads
    assert spark.read.parquet(f"{path}/rows").filter(f"__range IN ({ranges})").count() < 100
    empty = os.path.join(tmpdir_fresh, "e")
    N.write_fenced(df.filter("id < 0"), empty, order, ranges=4)
    assert N.fenced_rows(spark, empty) == 0 and N.page_by_fence(spark, empty, order, 20, 0).count() == 0


def test_counters_never_fall(spark, tmpdir_fresh):
    base = os.path.join(tmpdir_fresh, "t")
    ids = lambda n: spark.range(1, n + 1)
    assert S.next_ids(spark, base) == {}
    S.publish(ids(5), base, 1, next_ids=S.counted(ids(5), {"id": 1}))
    S.publish(ids(3), base, 2, next_ids=S.counted(ids(3), S.next_ids(spark, base)))
    assert S.next_ids(spark, base) == {"id": 6}
    with pytest.raises(ValueError):
        S.publish(ids(9), base, 2, next_ids={"id": 10})
    assert S.next_ids(spark, base) == {"id": 6}
    S.publish(ids(9), base, 3, next_ids=S.counted(ids(9), S.next_ids(spark, base)))
    os.remove(os.path.join(S.version_path(base, 3), "_SUCCESS"))     # a write that did not end
    assert S.next_ids(spark, base) == {"id": 6}
    S.publish(S.truncate(ids(3)), base, 4, next_ids={"id": 1})       # TRUNCATE resets it
    assert S.next_ids(spark, base) == {"id": 1}


def _rows_met(path, column, least):
    """(rows in row groups whose statistics meet ``column >= least``, all rows)."""
    met = total = 0
    for f in glob.glob(os.path.join(path, "*.parquet")):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            stats = next(group.column(i).statistics for i in range(group.num_columns)
                         if group.column(i).path_in_schema == column)
            total += group.num_rows
            met += group.num_rows if stats is None or not stats.has_min_max or stats.max >= least else 0
    return met, total


def test_curve_serves_the_second_column(spark, tmpdir_fresh):
    df = spark.range(20_000).select(
        "id", F.when(F.col("id") % 10 != 9, F.pmod(F.xxhash64("id"), F.lit(25))).alias("dep"),
        F.pmod(F.xxhash64(F.col("id") + 7), F.lit(100_000)).alias("salary"))
    flat, curve = os.path.join(tmpdir_fresh, "sorted"), os.path.join(tmpdir_fresh, "curve")
    S.write_clustered(df, flat, [F.col("dep"), F.col("salary").desc()], "id", n=32)
    S.write_curve(df, curve, ["salary", "dep"], "id", n=32)
    assert Counter(map(tuple, spark.read.parquet(curve).collect())) == Counter(map(tuple, df.collect()))
    by_salary, all_rows = _rows_met(curve, "salary", 97_000)
    assert all_rows == 20_000 and 3 * by_salary <= _rows_met(flat, "salary", 97_000)[0]
    assert _rows_met(curve, "dep", 23)[0] <= all_rows / 2           # the index's first column still prunes
    # ties, NULLs alone and no rows
    for k, odd in enumerate((df.limit(50).withColumn("dep", F.lit(None).cast("long")).withColumn("salary", F.lit(3)), df.limit(0))):
        path = os.path.join(tmpdir_fresh, f"odd{k}")
        S.write_curve(odd, path, ["dep", "salary"], "id", n=4, bits=3)
        assert spark.read.parquet(path).count() == odd.count()
    with pytest.raises(ValueError):
        S.write_curve(df, os.path.join(tmpdir_fresh, "wide"), ["dep", "salary"], "id", bits=32)
