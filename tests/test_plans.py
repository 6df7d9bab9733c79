"""Plan-shape checks: the properties the scale design relies on."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

QUERIES = E.queries()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()       # let AQE finish re-planning
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_pushdown_topk_and_pruning(spark):
    df = QUERIES["flagship"](spark, SF001)
    plan = final_plan(df)
    assert "WindowGroupLimit" in plan                      # partial top-k before the region shuffle
    assert "GreaterThanOrEqual(o_orderdate,1999-01-01T00:00)" in plan   # cutoff reaches the scan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    assert "TakeOrderedAndProject" in plan
    assert "BroadcastHashJoin" in plan                     # fixed-size dimensions


@pytest.mark.parametrize("name", ["update_where", "update_case", "delete_where", "soft_delete", "purge_events"])
def test_condition_mutations_do_not_shuffle(spark, name):
    plan = final_plan(QUERIES[name](spark, SF001))
    assert "Exchange" not in plan


def test_update_chunk_broadcasts_only_the_bounded_chunk(spark):
    plan = final_plan(QUERIES["update_chunk"](spark, SF001))
    assert "TakeOrderedAndProject" in plan and "BroadcastExchange" in plan
    assert "Exchange hashpartitioning" not in plan         # the table itself is not shuffled


def test_upsert_keeps_table_partitioning(spark):
    plan = final_plan(QUERIES["upsert"](spark, SF001))
    assert "LeftOuter, BuildRight" in plan                 # reduced batch is the broadcast side
    assert "max_by" not in plan                            # the batch is reduced once, beforehand


def test_check_row_rules_single_pass(spark):
    plan = final_plan(QUERIES["check_constraints"](spark, SF001))
    assert plan.count("Generate explode") == 1             # all row rules in one pass
    assert "partial_count" in plan                         # key rules combine map-side


def test_search_filters_terms_before_shuffle(spark):
    plan = final_plan(QUERIES["fulltext_search"](spark, SF001))
    # only query-term tokens are exploded: the token array is filtered in the
    # projection, before the exchange on document id
    assert "filter(__t" in plan and "lambdafunction" in plan and "REPARTITION_BY_COL" in plan
    assert "Generate explode" not in plan.split("REPARTITION_BY_COL")[-1]


def test_window_split_path_has_no_group_sized_window(spark):
    plan = final_plan(QUERIES["window_rankings_split"](spark, SF001))
    # rows come from the checkpointed range partitioning; no ranking window
    # function runs over a whole group (windows only sum / min small
    # per-partition tables)
    assert "Scan ExistingRDD" in plan
    for fn in ("row_number()", "rank(", "dense_rank(", "ntile(", "lag(", "lead("):
        assert fn not in plan, fn
    plain = final_plan(QUERIES["window_rankings"](spark, SF001))
    assert "row_number()" not in plain                     # one path, whatever the size


@pytest.mark.parametrize("name", ["assign_ids", "order_multi_key", "insert_bulk", "insert_select"])
def test_no_rows_in_one_task(spark, name):
    """Numbering never gathers the rows: only totals per range (and the
    scalar maximum id) meet in one partition."""
    plan = final_plan(QUERIES[name](spark, SF001))
    assert "row_number()" not in plan


def test_full_join_splits_its_hot_key(spark):
    plan = final_plan(QUERIES["join_full"](spark, SF001))
    assert "FullOuter" not in plan and "LeftAnti" in plan


def test_search_tokenizes_once(spark):
    df = QUERIES["fulltext_search"](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan                        # scalar and hits share the per-doc exchange


def test_hot_fk_value_is_split_by_aqe_skew_join(spark):
    """90% of child rows share one FK value; with broadcast off the join-based
    mutations still finish with the hot partition split (skew=true)."""
    from pyspark.sql import functions as F
    from tablekit.operators import mutate as M
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        child = spark.range(0, 200000).select(
            "id", F.when(F.col("id") % 10 < 9, F.lit(7)).otherwise(F.col("id") % 1000).alias("fk"),
            (F.col("id") * 3).alias("v"))
        parent = spark.range(0, 1000).select(F.col("id").alias("pid"),
                                             F.when(F.col("id") % 2 == 1, "CLOSED").otherwise("OPEN").alias("st"))
        deleted, _ = M.delete_join(child, parent, "fk", "pid", F.col("st") == "OPEN")
        updated, _ = M.update_join(child, parent, "fk", "pid", {"v": F.lit(0)}, other_where=F.col("st") == "OPEN")
        for df in (deleted, updated):
            df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
        assert deleted.count() == child.filter("fk % 2 = 1").count()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
