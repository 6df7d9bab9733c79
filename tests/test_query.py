"""Literal cases for joins, aggregates, windows, sorts and pages."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablekit.operators import query as Q
from tablekit.operators.window import rank_within, top_k


def test_rank_sequences(spark):
    # worked values: ROW_NUMBER 1,2,3,4 / RANK 1,2,2,4 / DENSE_RANK 1,2,2,3
    df = spark.createDataFrame([(1, "r", 10), (2, "r", 20), (3, "r", 20), (4, "r", 30)], "id long, g string, v int")
    out = rank_within(df, ["g"], ["v"], ["id"], row_number="rn", rank="rk", dense_rank="dr") \
        .orderBy("id").collect()
    assert [r.rn for r in out] == [1, 2, 3, 4]
    assert [r.rk for r in out] == [1, 2, 2, 4]
    assert [r.dr for r in out] == [1, 2, 2, 3]


def test_rank_within_equals_native_window_on_hot_group(spark):
    from pyspark.sql import Window
    # one group holds most rows; values repeat; NULLs in the order column
    df = spark.range(0, 3000).select(
        F.col("id"),
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
        F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise(F.col("id") % 37).alias("v"))
    mine = rank_within(df, ["g"], ["v DESC"], ["id"], row_number="rn", rank="rk", dense_rank="dr",
                       ntile=("nt", 5), lag=[("lg", "id", 2)], lead=[("ld", "v", 1)], num_partitions=6)
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("id"))
    wr = Window.partitionBy("g").orderBy(F.col("v").desc())
    native = df.select("id", "g", "v",
                       F.row_number().over(w).cast("long").alias("rn"), F.rank().over(wr).cast("long").alias("rk"),
                       F.dense_rank().over(wr).cast("long").alias("dr"), F.ntile(5).over(w).cast("long").alias("nt"),
                       F.lag("id", 2).over(w).alias("lg"), F.lead("v", 1).over(w).alias("ld"))
    cols = ["id", "g", "v", "rn", "rk", "dr", "nt", "lg", "ld"]
    assert sorted(map(tuple, mine.select(cols).collect())) == sorted(map(tuple, native.select(cols).collect()))


@pytest.mark.parametrize("size,buckets", [(1, 4), (3, 4), (4, 4), (10, 3), (17, 5)])
def test_ntile_edges(spark, size, buckets):
    df = spark.range(size).select(F.lit("g").alias("g"), F.col("id"))
    from pyspark.sql import Window
    mine = rank_within(df, ["g"], ["id"], [], ntile=("nt", buckets)).orderBy("id").collect()
    native = df.select(F.ntile(buckets).over(Window.partitionBy("g").orderBy("id")).alias("nt")) \
        .orderBy("nt").collect()
    assert [r.nt for r in mine] == [r.nt for r in native]


def test_top_k_plans_window_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id"))
    out = top_k(df, ["g"], ["id DESC"], 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted((r.g, r.id) for r in out.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]


def test_page_offset_then_limit(spark):
    df = spark.range(50)
    assert [r.id for r in Q.page(df, ["id DESC"], 5, 10).collect()] == [39, 38, 37, 36, 35]


def test_keyset_page_equals_offset_page(spark):
    df = spark.range(200).select((F.col("id") % 17).alias("a"), F.col("id").alias("b"))
    first = Q.page(df, ["a DESC", "b"], 30).collect()
    last = first[-1]
    nxt = Q.page_after(df, ["a DESC", "b"], [last.a, last.b], 30).collect()
    assert nxt == Q.page(df, ["a DESC", "b"], 30, 30).collect()


def test_null_order(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    assert [r.x for r in Q.page(df, ["x"], 3).collect()] == [None, 1, 3]
    assert [r.x for r in Q.page(df, ["x DESC"], 3).collect()] == [3, 1, None]


def test_right_is_swapped_left_and_full_via_union(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, x string")
    b = spark.createDataFrame([(2, "B"), (3, "C")], "k2 int, y string")
    full = a.join(b, a.k == b.k2, "full_outer")
    emul = Q.full_via_union(a, b, "k", "k2").select(*full.columns)
    assert sorted(map(str, full.collect())) == sorted(map(str, emul.collect()))
    r = Q.right_join(a.withColumnRenamed("k", "key"), b.withColumnRenamed("k2", "key"), "key")
    native = a.withColumnRenamed("k", "key").join(b.withColumnRenamed("k2", "key"), "key", "right")
    assert sorted(map(tuple, r.collect())) == sorted(map(tuple, native.select(*r.columns).collect()))


def test_grid_over_a_declared_domain(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x"), (None, "y"), ("a", "x")], "g string, s string")
    got = {(r.g, r.s): r.n for r in Q.grid(df, "g", "s", ["x", "y", None]).collect()}
    assert got == {("a", "x"): 2, ("a", "y"): 0, ("a", None): 1, ("b", "x"): 1, ("b", "y"): 0, ("b", None): 0,
                   (None, "x"): 0, (None, "y"): 1, (None, None): 0}


@pytest.mark.parametrize("kind", ["row_number", "rank", "dense_rank"])
def test_top_k_in_two_stages_equals_one_window(spark, kind):
    from pyspark.sql import Window
    from tablekit.operators.window import top_k
    df = spark.range(0, 3000, numPartitions=6).selectExpr("id", "id % 2 as g", "hash(id) % 50 as v")
    order = ["v DESC", "id"] if kind == "row_number" else ["v DESC"]
    w = Window.partitionBy("g").orderBy(*[F.col("v").desc(), *([F.col("id")] if kind == "row_number" else [])])
    for k in (1, 7, 1200):
        want = df.withColumn("rank", getattr(F, kind)().over(w).cast("bigint")).filter(F.col("rank") <= k)
        assert sorted(top_k(df, ["g"], order, k, kind=kind).collect()) == sorted(want.collect())


def test_avg_ignores_nulls_and_empty_sum_is_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 3), ("b", None)], "g string, v int")
    out = {r.g: r for r in Q.summarize(df, ["g"], "v").collect()}
    assert out["a"].avg_value == 2.0 and out["a"].n_rows == 3 and out["a"].n_values == 2
    assert out["b"].sum_value is None and out["b"].n_values == 0


def test_float_vs_decimal(spark):
    r = spark.sql("SELECT 0.1D + 0.2D AS f, 0.1BD + 0.2BD AS d").first()
    assert r.f == 0.30000000000000004 and r.d == Decimal("0.3")


@pytest.mark.parametrize("order", [["a", "b"], ["a DESC", "b"], ["a", "b DESC"], ["a DESC", "b DESC"]])
def test_keyset_pages_cover_everything_with_nulls(spark, order):
    df = spark.range(0, 97).select(
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 5).alias("a"),
        F.col("id").alias("b"))
    want = [tuple(r) for r in Q.page(df, order, 1000).collect()]
    got, last = [], None
    while True:
        chunk = Q.page(df, order, 10) if last is None else Q.page_after(df, order, last, 10)
        rows = [tuple(r) for r in chunk.collect()]
        if not rows:
            break
        got += rows
        last = rows[-1]
    assert got == want


def test_page_narrow_equals_page(spark):
    from tests.conftest import SF001
    from tablekit.sources.tables import scan
    docs = scan(spark, SF001, "documents").select("doc_id", "n_chars", "text")
    order = ["n_chars DESC", "doc_id"]
    assert Q.page_narrow(docs, order, 15, 30, "doc_id").collect() == Q.page(docs, order, 15, 30).collect()
    plan = Q.page_narrow(docs, order, 15, 30, "doc_id")._jdf.queryExecution().executedPlan().toString()
    topk = [l for l in plan.split("\n") if "TakeOrderedAndProject" in l][0]
    assert "text" not in topk.split("output=")[-1]            # the top-k merge carries no text
