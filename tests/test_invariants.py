"""Invariants over whole fixture tables and
property tests for the split window path."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablekit.operators import mutate as M
from tablekit.operators.window import rank_within
from tablekit.sources import fixtures as fx
from tablekit.spec import EMPLOYEES
from tests.conftest import SF001

NOW = "2024-06-01 12:00:00"


@pytest.fixture(scope="module")
def tables(spark):
    return fx.employees(spark, SF001), fx.orders_batch(spark, SF001)


def test_row_count_identities(spark, tables):
    t, b = tables
    n = t.count()
    new, m = M.upsert(t, b, EMPLOYEES, "national_id", ["full_name", "base_salary"], "seq", NOW)
    r = m.first()
    assert new.count() == n + r.inserted
    assert r.updated == t.join(b.select("national_id").distinct(), "national_id", "left_semi").count()
    new, m, _ = M.replace(t, b, EMPLOYEES, "national_id", "seq", NOW)
    r = m.first()
    assert new.count() == n - r.deleted + r.inserted
    new, m, _ = M.insert_ignore(t, b, EMPLOYEES, "national_id", "seq", NOW)
    r = m.first()
    assert new.count() == n + r.inserted and r.inserted + r.ignored == b.count()
    new, m = M.delete(t, F.col("status") == "TERMINATED")
    assert new.count() == n - m.first().deleted
    new, m = M.delete_join(t, fx.departments(spark, SF001), "department_id", "id", F.col("status") == "CLOSED_DOWN")
    assert new.count() == n - m.first().deleted


def test_ids_stay_unique_after_every_insert_path(spark, tables):
    t, b = tables
    for new in (M.upsert(t, b, EMPLOYEES, "national_id", ["full_name"], "seq", NOW)[0],
                M.replace(t, b, EMPLOYEES, "national_id", "seq", NOW)[0],
                M.insert_ignore(t, b, EMPLOYEES, "national_id", "seq", NOW)[0],
                M.insert(t, fx.sample_rows(spark, "bulk"), EMPLOYEES, NOW)[0]):
        assert new.select("emp_id").distinct().count() == new.count()
        assert new.select("national_id").distinct().count() == new.count()


def test_update_then_rollback_restores(spark, tables):
    from tablekit.operators.batch import Batch
    t, _ = tables
    bt = Batch(t)
    bt.savepoint("s")
    bt.apply(M.update, {"base_salary": F.col("base_salary") * 2}, F.lit(True))
    bt.apply(M.delete, F.col("emp_id") < 50)
    bt.rollback_to("s")
    assert sorted(map(tuple, bt.current.collect())) == sorted(map(tuple, t.collect()))


rows = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 4))),
                min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, buckets=st.integers(1, 5), parts=st.integers(1, 6))
def test_split_window_equals_native(spark, data, buckets, parts):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "id long, g string, v int")
    got = rank_within(df, ["g"], ["v"], ["id"], row_number="rn", rank="rk", dense_rank="dr",
                      ntile=("nt", buckets), lag=[("lg", "v", 1)], lead=[("ld", "id", 2)],
                      num_partitions=parts)
    w = Window.partitionBy("g").orderBy("v", "id")
    wr = Window.partitionBy("g").orderBy("v")
    want = df.select("id", "g", "v", F.row_number().over(w).cast("long").alias("rn"),
                     F.rank().over(wr).cast("long").alias("rk"), F.dense_rank().over(wr).cast("long").alias("dr"),
                     F.ntile(buckets).over(w).cast("long").alias("nt"), F.lag("v", 1).over(w).alias("lg"),
                     F.lead("id", 2).over(w).alias("ld"))
    cols = want.columns
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
