"""Mutations: sequential replay (M3-M5), literal cases and invariants."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablekit.operators import mutate as M
from tablekit.spec import EMPLOYEES, TableSpec, col

SPEC = TableSpec(
    name="t",
    columns=(col("id", "bigint", nullable=False, auto_increment=True), col("k", "string"),
             col("a", "int"), col("b", "int", default=7)),
    primary_key=("id",), unique=(("uk_k", ("k",)),))
T_SCHEMA = "id long, k string, a int, b int"
B_SCHEMA = "k string, a int, b int, seq long"


def _random_case(rng, n_t=8, n_b=25):
    keys = [f"k{i}" for i in range(12)] + [None]
    t_keys = rng.sample(keys[:-1], n_t)
    t = [(i + 1, k, rng.randint(0, 9), rng.randint(0, 9)) for i, k in enumerate(t_keys)]
    seqs = rng.sample(range(1000), n_b)
    b = [(rng.choice(keys), rng.choice([None, *range(5)]), rng.choice([None, *range(5)]), s) for s in seqs]
    return t, b


def _replay_upsert(t, b, update_cols=("a",)):
    rows = {r[1]: list(r) for r in t}
    extra = []
    next_id = max(r[0] for r in t) + 1
    for k, a, bb, s in sorted(b, key=lambda r: r[3]):
        if k is not None and k in rows:
            if "a" in update_cols:
                rows[k][2] = a
            if "b" in update_cols:
                rows[k][3] = bb
        else:
            row = [next_id, k, a, bb]
            next_id += 1
            if k is None:
                extra.append(row)
            else:
                rows[k] = row
    return sorted(tuple(r) for r in list(rows.values()) + extra)


def _replay_ignore(t, b):
    rows = {r[1]: tuple(r) for r in t}
    extra = []
    next_id = max(r[0] for r in t) + 1
    for k, a, bb, s in sorted(b, key=lambda r: r[3]):
        if k is None:
            extra.append((next_id, k, a, bb)); next_id += 1
        elif k not in rows:
            rows[k] = (next_id, k, a, bb); next_id += 1
    return sorted(list(rows.values()) + extra)


def _replay_replace(t, b):
    rows = {r[1]: (r[1], r[2], r[3]) for r in t}
    extra = []
    for k, a, bb, s in sorted(b, key=lambda r: r[3]):
        if k is None:
            extra.append((k, a, bb))
        else:
            rows[k] = (k, a, bb)
    return sorted(list(rows.values()) + extra, key=str)


@pytest.mark.parametrize("seed", range(6))
def test_upsert_equals_replay(spark, seed):
    t, b = _random_case(random.Random(seed))
    T = spark.createDataFrame(t, T_SCHEMA)
    B = spark.createDataFrame(b, B_SCHEMA)
    new, m = M.upsert(T, B, SPEC, key="k", update_cols=["a"], seq="seq", set_now=())
    assert sorted(map(tuple, new.collect())) == _replay_upsert(t, b)
    new2, _ = M.upsert(T, B, SPEC, key="k", update_cols=["a", "b"], seq="seq", set_now=())
    assert sorted(map(tuple, new2.collect())) == _replay_upsert(t, b, ("a", "b"))
    mm = m.first()
    distinct_new = {r[0] for r in b if r[0] is not None} - {r[1] for r in t}
    assert mm.inserted == len(distinct_new) + sum(1 for r in b if r[0] is None)


@pytest.mark.parametrize("seed", range(6))
def test_insert_ignore_equals_replay(spark, seed):
    t, b = _random_case(random.Random(100 + seed))
    T = spark.createDataFrame(t, T_SCHEMA)
    B = spark.createDataFrame(b, B_SCHEMA)
    new, m, rejected = M.insert_ignore(T, B, SPEC, key="k", seq="seq")
    assert sorted(map(tuple, new.collect())) == _replay_ignore(t, b)
    r = m.first()
    assert r.inserted + r.ignored == len(b)


@pytest.mark.parametrize("seed", range(6))
def test_replace_equals_replay(spark, seed):
    t, b = _random_case(random.Random(200 + seed))
    T = spark.createDataFrame(t, T_SCHEMA)
    B = spark.createDataFrame(b, B_SCHEMA)
    new, _, _ = M.replace(T, B, SPEC, key="k", seq="seq")
    got = new.collect()
    assert sorted([(r.k, r.a, r.b) for r in got], key=str) == _replay_replace(t, b)
    ids = [r.id for r in got]
    assert len(ids) == len(set(ids))
    old_ids = {r[0] for r in t}
    replaced = {r[0] for r in b if r[0] is not None}
    for r in got:
        if r.k in replaced or r.k is None:
            assert r.id > max(old_ids)   # a replaced row gets a NEW id


def test_replace_cascades_children(spark):
    T = spark.createDataFrame([(1, "x", 1, 1), (2, "y", 2, 2)], T_SCHEMA)
    B = spark.createDataFrame([("x", 9, 9, 1)], B_SCHEMA)
    child = spark.createDataFrame([(10, 1), (11, 2), (12, 1)], "cid long, parent long")
    _, _, (new_child,) = M.replace(T, B, SPEC, key="k", seq="seq", children=[(child, "parent")])
    assert sorted(r.cid for r in new_child.collect()) == [11]


def test_insert_defaults_and_ids(spark):
    T = spark.createDataFrame([(5, "a", 1, 1)], T_SCHEMA)
    B = spark.createDataFrame([("z", 3), ("m", 4)], "k string, a int")
    new, m = M.insert(T, B, SPEC, order=["k"])
    assert sorted(map(tuple, new.collect())) == [(5, "a", 1, 1), (6, "m", 4, 7), (7, "z", 3, 7)]
    assert m.first().inserted == 2


def test_update_three_valued_where_and_touch(spark):
    T = spark.createDataFrame([(1, "a", 1, 1), (2, None, 2, 2), (3, "c", 3, 3)], T_SCHEMA)
    new, m = M.update(T, {"a": F.col("a") * 10}, F.col("k") == "a")
    assert sorted(map(tuple, new.collect())) == [(1, "a", 10, 1), (2, None, 2, 2), (3, "c", 3, 3)]
    assert m.first().updated == 1


def test_update_decimal_rounds_half_up_and_case_without_else_is_null(spark):
    df = spark.createDataFrame([(Decimal("0.05"),), (Decimal("10.05"),)], "s decimal(10,2)")
    new, _ = M.update(df, {"s": F.col("s") * F.lit(Decimal("1.10"))})
    assert [r.s for r in new.collect()] == [Decimal("0.06"), Decimal("11.06")]
    r = spark.sql("SELECT CASE WHEN 1 = 2 THEN 'x' END AS v").first()
    assert r.v is None


def test_decimal_overflow_raises(spark):
    df = spark.createDataFrame([(Decimal("99999999.99"),)], "s decimal(10,2)")
    new, _ = M.update(df, {"s": F.col("s") * 2})
    with pytest.raises(Exception):
        new.collect()


def test_update_join_never_multiplies(spark):
    T = spark.createDataFrame([(1, "a", 1, 1), (2, "b", 2, 2)], T_SCHEMA)
    S = spark.createDataFrame([("a",), ("a",), ("a",)], "k string")
    new, m = M.update_join(T, S, "k", "k", {"a": F.col("a") + 100})
    assert sorted(map(tuple, new.collect())) == [(1, "a", 101, 1), (2, "b", 2, 2)]


def test_drain_equals_delete_and_chunks(spark):
    T = spark.range(1, 2501).select(F.col("id"), (F.col("id") % 5).alias("st"), (F.col("id") % 97).alias("age"))
    kept, chunks = M.drain(T, F.col("st") == 0, ["age"], "id", 100)
    plain, _ = M.delete(T, F.col("st") == 0)
    assert sorted(kept.collect()) == sorted(plain.collect())
    c = sorted(chunks.collect())
    assert [r.deleted for r in c] == [100, 100, 100, 100, 100]
    one, _ = M.delete_chunk(T, F.col("st") == 0, ["age"], "id", 100)
    first_chunk_ids = set(T.filter("st = 0").orderBy("age", "id").limit(100).toPandas().id)
    assert set(r.id for r in T.collect()) - set(r.id for r in one.collect()) == first_chunk_ids


def test_soft_delete_active_equals_delete(spark):
    T = spark.range(20).select(F.col("id"), (F.col("id") % 3).alias("g"))
    soft, _ = M.soft_delete(T, F.col("g") == 1, "2024-01-01 00:00:00")
    hard, _ = M.delete(T, F.col("g") == 1)
    assert sorted(M.active(soft).select("id", "g").collect()) == sorted(hard.collect())


def test_upsert_is_idempotent(spark):
    from tests.conftest import SF001
    from tablekit.sources import fixtures as fx
    T = fx.employees(spark, SF001)
    B = fx.orders_batch(spark, SF001)
    once, _ = M.upsert(T, B, EMPLOYEES, "national_id", ["full_name", "base_salary"], "seq", "2024-01-01 00:00:00")
    once = once.cache()
    twice, m = M.upsert(once, B, EMPLOYEES, "national_id", ["full_name", "base_salary"], "seq",
                        "2024-01-01 00:00:00")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert m.first().inserted == 0
    once.unpersist()


def test_update_join_set_from_other(spark):
    from tablekit.operators.quality import ConstraintViolation
    T = spark.createDataFrame([(1, "a", 1, 1), (2, "b", 2, 2), (3, None, 3, 3)], T_SCHEMA)
    S = spark.createDataFrame([("a", 100), ("b", 200), ("z", 9)], "k string, x int")
    new, m = M.update_join(T, S, "k", "k", {}, where=F.col("a") >= 2, from_other={"b": "x"})
    assert sorted(map(tuple, new.collect()), key=str) == sorted([(1, "a", 1, 1), (2, "b", 2, 200), (3, None, 3, 3)], key=str)
    assert m.first().updated == 1
    dup = spark.createDataFrame([("a", 1), ("a", 2)], "k string, x int")
    with pytest.raises(ConstraintViolation):
        M.update_join(T, dup, "k", "k", {}, from_other={"b": "x"})


def test_duplicate_seq_is_resolved_deterministically(spark):
    T = spark.createDataFrame([(1, "a", 1, 1)], T_SCHEMA)
    rows = [("a", 5, 1, 7), ("a", 3, 2, 7), ("b", 9, 9, 7), ("b", 8, 8, 7)]
    results = set()
    for order in (rows, list(reversed(rows))):
        B = spark.createDataFrame(order, B_SCHEMA).repartition(3)
        new, _ = M.upsert(T, B, SPEC, key="k", update_cols=["a"], seq="seq", set_now=())
        results.add(tuple(sorted(map(tuple, new.collect()), key=str)))
    assert len(results) == 1


def test_migration_rerun_inserts_nothing(spark):
    from tests.conftest import SF001
    from tablekit.sources import fixtures as fx
    emp, src = fx.employees(spark, SF001), fx.legacy_import(spark, SF001)
    mapping = {"national_id": F.col("nat_id"), "full_name": F.col("name"),
               "contract_type": F.lit("CONTRACTOR"), "base_salary": F.col("salary"), "birth_date": F.col("dob")}
    new, m, keys = M.insert_select(emp, src, EMPLOYEES, mapping, where=~F.col("is_processed"),
                                   now="2024-01-01 00:00:00", source_key="nat_id")
    assert m.first().inserted == src.filter("NOT is_processed").count() > 0
    marked, _ = M.mark_processed(src, keys, "nat_id")
    _, m2, _ = M.insert_select(new, marked, EMPLOYEES, mapping, where=~F.col("is_processed"),
                               now="2024-01-01 00:00:00", source_key="nat_id")
    assert m2.first().inserted == 0


def test_upsert_strict_checks_other_unique_keys(spark):
    from tablekit.operators.quality import ConstraintViolation
    spec = SPEC.replace(unique=(("uk_k", ("k",)), ("uk_a", ("a",))))
    T = spark.createDataFrame([(1, "x", 1, 1), (2, "y", 2, 2)], T_SCHEMA)
    ok = spark.createDataFrame([("x", 5, 0, 1)], B_SCHEMA)
    new, _ = M.upsert(T, ok, spec, "k", ["a"], "seq", set_now=(), unique_check="strict")
    assert sorted(r.a for r in new.collect()) == [2, 5]
    clash = spark.createDataFrame([("x", 2, 0, 1)], B_SCHEMA)      # a=2 already held by key y
    with pytest.raises(ConstraintViolation):
        M.upsert(T, clash, spec, "k", ["a"], "seq", set_now=(), unique_check="strict")


def test_large_batch_path_equals_replay(spark):
    """The reduced batch is checkpointed once and ids come from the
    range/prefix-sum path, whatever the batch's size."""
    for seed in range(2):
        t, b = _random_case(random.Random(300 + seed))
        T = spark.createDataFrame(t, T_SCHEMA)
        B = spark.createDataFrame(b, B_SCHEMA)
        new, _ = M.upsert(T, B, SPEC, key="k", update_cols=["a"], seq="seq", set_now=())
        assert sorted(map(tuple, new.collect())) == _replay_upsert(t, b)
        new, _, _ = M.insert_ignore(T, B, SPEC, key="k", seq="seq")
        assert sorted(map(tuple, new.collect())) == _replay_ignore(t, b)
        new, _, _ = M.replace(T, B, SPEC, key="k", seq="seq")
        assert sorted([(r.k, r.a, r.b) for r in new.collect()], key=str) == _replay_replace(t, b)


def test_ignore_and_replace_strict_other_unique_keys(spark):
    from tablekit.operators.quality import ConstraintViolation
    spec = SPEC.replace(unique=(("uk_k", ("k",)), ("uk_a", ("a",))))
    T = spark.createDataFrame([(1, "x", 1, 1), (2, "y", 2, 2)], T_SCHEMA)
    clash = spark.createDataFrame([("z", 2, 0, 1)], B_SCHEMA)       # new key z, but a=2 is taken
    with pytest.raises(ConstraintViolation):
        M.insert_ignore(T, clash, spec, "k", "seq", unique_check="strict")
    with pytest.raises(ConstraintViolation):
        M.replace(T, clash, spec, "k", "seq", unique_check="strict")
    fine = spark.createDataFrame([("y", 7, 0, 1)], B_SCHEMA)        # replaces y, a=7 is free
    new, _, _ = M.replace(T, fine, spec, "k", "seq", unique_check="strict")
    assert sorted(r.a for r in new.collect()) == [1, 7]


def test_strict_insert_rejects_rows_keys_and_unknown_columns(spark):
    from tablekit.operators.quality import ConstraintViolation
    from tablekit.sources import fixtures as fx
    from tablekit.spec import EMPLOYEES
    emp = fx.employees(spark, "/root/testdata/sf0.001")
    good = fx.sample_rows(spark, "admin")
    taken = emp.select("national_id").first()[0]
    for bad in (good.withColumn("base_salary", F.lit(-5).cast("decimal(10,2)")),
                good.withColumn("contract_type", F.lit(None).cast("string")),
                good.withColumn("contract_type", F.lit("INTERN")),
                good.withColumn("national_id", F.lit(taken)),
                good.union(good),
                good.withColumnRenamed("full_name", "full_nme")):
        with pytest.raises(ConstraintViolation):
            M.insert(emp, bad, EMPLOYEES, "2024-01-01 00:00:00")
    new, _ = M.insert(emp, good, EMPLOYEES, "2024-01-01 00:00:00")
    assert new.count() == emp.count() + 1


def test_ignore_drops_what_does_not_convert_and_other_duplicates(spark):
    from tablekit.sources import fixtures as fx
    from tablekit.spec import EMPLOYEES
    emp = fx.employees(spark, "/root/testdata/sf0.001")
    name = emp.select("full_name").first()[0]
    good = fx.sample_rows(spark, "bulk").withColumn("seq", F.monotonically_increasing_id())
    wide = good.withColumn("base_salary", F.when(F.col("full_name") == "Engineer A", F.lit("1000000000000.00"))
                           .otherwise(F.col("base_salary").cast("string")).cast("decimal(20,2)"))
    wide = wide.withColumn("full_name", F.when(F.col("full_name") == "Engineer B", F.lit(name)).otherwise(F.col("full_name")))
    new, m, rejected = M.insert_ignore(emp, wide, EMPLOYEES, "national_id", "seq", "2024-01-01 00:00:00")
    assert [r.reasons for r in rejected.collect()] == [["type:base_salary"]]
    assert new.count() == emp.count() + 1 and tuple(m.first()) == (1, 2)


def test_conditions_reach_the_scan(spark):
    import re
    from tablekit.operators import query as Q
    li = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    pushed = lambda df: re.findall(r"PushedFilters: \[([^\]]*)\]", df._jdf.queryExecution().executedPlan().toString())[0]
    kept, _ = M.delete(li, F.col("o_orderkey") < 100)
    assert "Or(GreaterThanOrEqual(o_orderkey,100),IsNull(o_orderkey))" in pushed(kept)
    assert "EqualTo(o_orderstatus,F)" in pushed(Q.oldest(li, F.col("o_orderstatus") == "F", ["o_orderdate"], "o_orderkey", 5))
    assert "GreaterThan(o_orderkey,7)" in pushed(Q.page_after(li, ["o_orderkey"], [7], 5))
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    left, _ = M.purge(ev, "ts", F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'"))
    assert "GreaterThanOrEqual(ts" in pushed(left) and "IsNull(ts)" in pushed(left)
