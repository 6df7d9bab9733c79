"""Complements that reach the scan; names taken from parsed expressions."""

import pytest
from pyspark.sql import functions as F

from tablekit.functions.exprs import miss, names_in, rename_in
from tablekit.operators import evolve as E
from tablekit.operators import mutate as M
from tablekit.spec import TableSpec, col
from tests.conftest import SF001

CONDS = ["a = 1", "a = b", "a = NULL", "a IN (1, 2)", "a IN (1, NULL)", "a = 1 AND s = 'x'", "a = 1 OR s = 'x'",
         "NOT a = 1", "a < 2 OR (b = 1 AND s IN ('x', 'y'))", "s LIKE 'x%'", "coalesce(a, 1) = 1", "a IS NULL", "true"]


@pytest.mark.parametrize("cond", CONDS)
def test_miss_is_the_complement_in_three_valued_logic(spark, cond):
    vals = [None, 1, 2]
    df = spark.createDataFrame([(a, b, s) for a in vals for b in vals for s in (None, "x", "z")],
                               "a int, b int, s string")
    want = df.filter(~F.coalesce(F.expr(cond), F.lit(False)))
    assert sorted(map(str, df.filter(miss(cond)).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("make", [lambda: F.col("a") == 1, lambda: F.col("a") == F.col("b"),
                                  lambda: (F.col("a") == 1) & (F.col("s") == "x"),
                                  lambda: F.col("a").isin(1, 2) | (F.col("s") == "x"),
                                  lambda: F.col("a").isin(1, None)])
def test_miss_of_columns(spark, make):
    vals = [None, 1, 2]
    df = spark.createDataFrame([(a, b, s) for a in vals for b in vals for s in (None, "x", "z")],
                               "a int, b int, s string")
    want = df.filter(~F.coalesce(make(), F.lit(False)))
    assert sorted(map(str, df.filter(miss(make())).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("where", ["o_orderstatus = 'F'", F.col, "o_orderstatus IN ('F', 'O')"])
def test_delete_by_equality_reaches_the_scan(spark, where):
    where = F.col("o_orderstatus") == "F" if where is F.col else where
    new, _ = M.delete(spark.read.parquet(f"{SF001}/orders.parquet"), where)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "IsNull(o_orderstatus)" in plan.split("PushedFilters: ")[1].split("ReadSchema")[0]


def test_names_are_columns_only(spark):
    assert names_in("length(name) < 10") == {"name"}
    assert names_in("d > DATE '2020-01-01'") == {"d"}
    assert names_in("`date` = 'x y' AND exists(tags, length -> length > k)") == {"date", "tags", "k"}
    assert rename_in("length(name) < length", "length", "size_cm") == "length(name) < size_cm"
    assert rename_in("addr.city = 'addr' AND Addr IS NOT NULL", "addr", "a b") == "`a b`.city = 'addr' AND `a b` IS NOT NULL"
    assert rename_in("s <> '\U0001F600' AND q = 1", "q", "r") == "s <> '\U0001F600' AND r = 1"


def test_rename_and_drop_follow_columns_not_words(spark):
    spec = TableSpec("t", (col("length", "int"), col("name", "string"), col("date", "date"), col("d", "date")),
                     checks=(("short", "length(name) < 10"), ("late", "d > DATE '2020-01-01'"),
                             ("both", "length > 0 AND `date` < d")))
    df = spark.createDataFrame([], "length int, name string, date date, d date")
    _, renamed = E.rename_column(df, spec, "length", "size_cm")
    assert dict(renamed.checks) == {"short": "length(name) < 10", "late": "d > DATE '2020-01-01'",
                                    "both": "size_cm > 0 AND `date` < d"}
    _, dropped = E.drop_column(df, spec, "date")
    assert [n for n, _ in dropped.checks] == ["short", "late"]
