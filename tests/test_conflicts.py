"""M3-M5 over all unique keys against a row-by-row replay, and strict writers."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablekit.operators import mutate as M
from tablekit.operators.quality import ConstraintViolation
from tablekit.spec import EMPLOYEES, TableSpec, col

SPEC = TableSpec(
    name="t",
    columns=(col("id", "bigint", nullable=False, auto_increment=True), col("k", "string"), col("m", "int"),
             col("p", "string"), col("q", "int"), col("a", "int"), col("b", "int", default=7)),
    primary_key=("id",), unique=(("uk_k", ("k",)), ("uk_m", ("m",)), ("uk_pq", ("p", "q"))))
T_SCHEMA = "id long, k string, m int, p string, q int, a int, b int"
B_SCHEMA = "k string, m int, p string, q int, a int, b int, seq long"
RULES = ("unique:uk_k", "unique:uk_m", "unique:uk_pq")


def key_tokens(r):
    """r: (k, m, p, q, ..)"""
    return {i: v for i, v in enumerate((r[0], r[1], (r[2], r[3]) if None not in (r[2], r[3]) else None)) if v is not None}


def batches(seed, n=500, size=8):
    """Many small universes of keys in one table and one batch: chains, ties on several keys, NULLs."""
    rng = random.Random(seed)

    def row(u, spread):
        return (None if rng.random() < 0.1 else f"u{u}k{rng.randrange(spread)}", None if rng.random() < 0.1 else u * 100 + rng.randrange(spread),
                None if rng.random() < 0.1 else f"u{u}", rng.randrange(spread), rng.choice([None, *range(9)]), rng.randrange(9))
    t, b, taken = [], [], set()
    for u in range(n):
        spread = rng.choice([3, 6, 12])
        for _ in range(rng.randint(0, 6)):
            r = row(u, spread)
            own = set(key_tokens(r).items())
            if not own & taken:
                taken |= own
                t.append((len(t) + 1, *r))
        b += [row(u, spread) for _ in range(rng.randint(1, size))]
    seqs = rng.sample(range(10 * len(b)), len(b))
    return t, [(*r, s) for r, s in zip(b, seqs)]


def replay(t, b, kind, update=()):
    rows = {r[0]: list(r[1:]) for r in t}
    index = [{}, {}, {}]
    for n, r in rows.items():
        for i, v in key_tokens(r).items():
            index[i][v] = n
    new_id, ignored, deleted, updated = len(t), {}, 0, set()
    names = ["k", "m", "p", "q", "a", "b"]
    for *r, s in sorted(b, key=lambda r: r[-1]):
        hits = {i: index[i][v] for i, v in key_tokens(r).items() if v in index[i]}
        if kind == "ignore" and hits:
            ignored[s] = sorted(RULES[i] for i in hits)
            continue
        if kind == "upsert" and hits:
            n = hits[min(hits)]
            old = rows[n]
            changed = [r[names.index(c)] if c in update else old[names.index(c)] for c in names]
            for i, v in key_tokens(changed).items():
                if index[i].get(v, n) != n:
                    raise ConstraintViolation(RULES[i])
            for i, v in key_tokens(old).items():
                del index[i][v]
            for i, v in key_tokens(changed).items():
                index[i][v] = n
            rows[n] = changed
            updated.add(n)
            continue
        if kind == "replace":
            for n in set(hits.values()):
                for i, v in key_tokens(rows[n]).items():
                    del index[i][v]
                del rows[n]
                deleted += n <= len(t)
        new_id += 1
        rows[new_id] = list(r)
        for i, v in key_tokens(r).items():
            index[i][v] = new_id
    return sorted([(n, *r) for n, r in rows.items()], key=str), ignored, deleted, updated


def frames(spark, t, b):
    return spark.createDataFrame(t, T_SCHEMA), spark.createDataFrame(b, B_SCHEMA).repartition(3)


def got(df):
    assert df.columns == [c.split()[0] for c in T_SCHEMA.split(", ")]
    return sorted(map(tuple, df.collect()), key=str)


def test_insert_ignore_equals_replay(spark):
    t, b = batches(1)
    want, ignored, _, _ = replay(t, b, "ignore")
    new, m, rejected = M.insert_ignore(*frames(spark, t, b), SPEC, None, "seq")
    assert got(new) == want
    assert m.first().asDict() == {"inserted": len(want) - len(t), "ignored": len(b) - len(want) + len(t)}
    reasons = {r.seq: r.reasons for r in rejected.collect()}
    assert reasons.keys() == ignored.keys() and all(set(reasons[s]) & set(ignored[s]) for s in reasons)


def test_ignore_named_cases(spark):
    """A row that is itself ignored blocks nobody."""
    t = [(1, "A", None, None, None, 0, 0), (2, "B", None, None, None, 0, 0)]
    b = [("B", 5, None, None, 1, 0, 1), ("C", 5, None, None, 2, 0, 2), ("C", 6, None, None, 3, 0, 3), ("D", 6, None, None, 4, 0, 4)]
    new, _, rejected = M.insert_ignore(*frames(spark, t, b), SPEC, None, "seq")
    assert [(r.id, r.k, r.m) for r in new.orderBy("id").collect()][2:] == [(3, "C", 5), (4, "D", 6)]
    assert {r.seq: r.reasons for r in rejected.collect()} == {1: ["unique:uk_k"], 3: ["unique:uk_k"]}


def test_replace_equals_replay(spark):
    t, b = batches(2)
    want, _, deleted, _ = replay(t, b, "replace")
    new, m, _ = M.replace(*frames(spark, t, b), SPEC, None, "seq")
    assert got(new) == want
    assert m.first().deleted == deleted


@pytest.mark.parametrize("update", [("a",), ("b", "a")])
def test_upsert_equals_replay(spark, update):
    t, b = batches(3)
    want, _, _, updated = replay(t, b, "upsert", update)
    new, m = M.upsert(*frames(spark, t, b), SPEC, None, list(update), "seq", set_now=())
    assert got(new) == want
    assert m.first().asDict() == {"inserted": len(want) - len(t), "updated": len([n for n in updated if n <= len(t)])}


def test_upsert_of_key_columns_equals_replay(spark):
    """Keys move: universes in which no update repeats a key go through, one that does raises."""
    t, b = batches(4, n=700, size=7)
    good_t, good_b, bad = [], [], []
    for u in range(700):
        own_t = [r for r in t if r[1] == f"u{u}" or str(r[1]).startswith(f"u{u}k") or r[3] == f"u{u}" or (r[2] or -1) // 100 == u]
        own_b = [r for r in b if str(r[0]).startswith(f"u{u}k") or r[2] == f"u{u}" or (r[1] or -1) // 100 == u]
        try:
            replay([(i + 1, *r[1:]) for i, r in enumerate(own_t)], own_b, "upsert", ("m", "a"))
            good_t += own_t
            good_b += own_b
        except ConstraintViolation:
            bad.append(([(i + 1, *r[1:]) for i, r in enumerate(own_t)], own_b))
    good_t = [(i + 1, *r[1:]) for i, r in enumerate(good_t)]
    want, *_ = replay(good_t, good_b, "upsert", ("m", "a"))
    new, _ = M.upsert(*frames(spark, good_t, good_b), SPEC, None, ["m", "a"], "seq", set_now=())
    assert len(good_b) > 1000 and len(bad) > 10
    assert got(new) == want
    with pytest.raises(ConstraintViolation):
        M.upsert(*frames(spark, *bad[0]), SPEC, None, ["m", "a"], "seq", set_now=())


def test_upsert_any_key_named_case(spark):
    """Row (c, 'B') updates the row that is named 'B'."""
    t = [(1, "a", 1, None, None, 0, 0), (2, "b", 2, None, None, 0, 0)]
    new, m = M.upsert(*frames(spark, t, [("c", 2, None, None, 9, 9, 1)]), SPEC, None, ["a"], "seq", set_now=())
    assert got(new) == sorted([t[0], (2, "b", 2, None, None, 9, 0)], key=str) and m.first().asDict() == {"inserted": 0, "updated": 1}


def test_one_hot_key_is_one_wave(spark, monkeypatch):
    """A key that a third of the batch repeats is one group, whatever its other columns hold."""
    from tablekit.operators import conflicts
    waves = []
    real = conflicts._refuse_collisions
    monkeypatch.setattr(conflicts, "_refuse_collisions", lambda *a: (waves.append(1), real(*a))[1])
    b = [("hot" if i % 3 else f"x{i}", i, None, None, i, 0, i) for i in range(600)]
    t = [(1, "hot", 9000, None, None, 0, 0)]
    new, _ = M.upsert(*frames(spark, t, b), SPEC, None, ["a", "m"], "seq", set_now=())
    assert got(new) == replay(t, b, "upsert", ("a", "m"))[0] and len(waves) == 1


@pytest.mark.parametrize("rows", [0, 1 << 14])
def test_waves_keep_only_the_holders_they_need(spark, monkeypatch, rows):
    """A long chain beside many settled rows: who holds nothing of a pending row's is dropped, broadcast or shuffled."""
    from tablekit.operators import conflicts
    owners = []
    real = conflicts.materialize

    def kept(df, *a):
        out = real(df, *a)
        if out.columns == ["k", "v", "rid"]:
            owners.append(out.count())
        return out
    monkeypatch.setattr(conflicts, "materialize", kept)
    monkeypatch.setattr(conflicts, "BROADCAST_ROWS", rows, raising=False)
    t = [(i + 1, f"t{i}", i, None, None, 0, 0) for i in range(80)]
    b = [(f"t{i}", None, None, None, i, 5, i) for i in range(80)]
    b += [(f"c{i // 2}", 1000 + (i + 1) // 2, None, None, i, 6, 100 + i) for i in range(5)]
    new, _ = M.upsert(*frames(spark, t, b), SPEC, None, ["a", "b"], "seq", set_now=())
    assert got(new) == replay(t, b, "upsert", ("a", "b"))[0]
    assert len(owners) > 2 and owners[0] == 80 and max(owners[1:]) < 10 and owners[-1] == 0


# ---------------------------------------------------------------- strict writers

EMP = [(1, 10, "A", Decimal("5.00"), "X"), (2, None, "B", Decimal("6.00"), "Y")]
EMP_SPEC = TableSpec("e", tuple(EMPLOYEES.column(c) for c in ("emp_id", "department_id", "national_id", "base_salary", "full_name")),
                     primary_key=("emp_id",), unique=EMPLOYEES.unique, checks=EMPLOYEES.checks, foreign_keys=EMPLOYEES.foreign_keys)
EMP_SCHEMA = "emp_id long, department_id long, national_id string, base_salary decimal(10,2), full_name string"


@pytest.fixture()
def emp(spark):
    return spark.createDataFrame(EMP, EMP_SCHEMA), {"departments": spark.createDataFrame([(10,), (20,)], "id long")}


@pytest.mark.parametrize("row", [(10, "C", -5, "Z"), (10, "C", 5, None), (999, "C", 5, "Z"), (10, "C", 5, "X")])
def test_strict_writers_refuse(spark, emp, row):
    table, parents = emp
    batch = spark.createDataFrame([(row[0], row[1], Decimal(row[2]), row[3], 1)],
                                  "department_id long, national_id string, base_salary decimal(10,2), full_name string, seq long")
    with pytest.raises(ConstraintViolation):
        M.insert(table, batch.drop("seq"), EMP_SPEC, parents=parents)
    with pytest.raises(ConstraintViolation):
        M.upsert(table, batch, EMP_SPEC, "national_id", ["base_salary"], "seq", set_now=(), parents=parents)
    with pytest.raises(ConstraintViolation):
        M.replace(table, batch, EMP_SPEC, "national_id", "seq", parents=parents)


@pytest.mark.parametrize("sets", ["base_salary", "full_name", "emp_id", "national_id", "department_id"])
def test_strict_update_refuses(spark, emp, sets):
    table, parents = emp
    value = {"base_salary": -1, "full_name": None, "emp_id": 1, "national_id": "A", "department_id": 999}[sets]
    for run in (lambda **kw: M.update(table, {sets: F.lit(value)}, "emp_id = 2", EMP_SPEC, **kw),
                lambda **kw: M.update_chunk(table, {sets: F.lit(value)}, "emp_id = 2", ["emp_id"], "emp_id", 5, EMP_SPEC, **kw),
                lambda **kw: M.update_join(table, spark.createDataFrame([("B",)], "x string"), "national_id", "x",
                                           {sets: F.lit(value)}, spec=EMP_SPEC, **kw)):
        with pytest.raises(ConstraintViolation):
            run(parents=parents)
        run(parents=parents, mode="unchecked")


def test_replace_keeps_column_order(spark, emp):
    table, _ = emp
    batch = spark.createDataFrame([("B", Decimal(5), "Z", 1)], "national_id string, base_salary decimal(10,2), full_name string, seq long")
    for key in ("national_id", None):
        new, _, _ = M.replace(table, batch, EMP_SPEC, key, "seq")
        assert new.columns == table.columns
        assert {(r.emp_id, r.national_id, r.full_name) for r in new.collect()} == {(1, "A", "X"), (3, "B", "Z")}


def test_replace_displaces_several_rows(spark, emp):
    table, _ = emp
    child = spark.createDataFrame([("c1", 1), ("c2", 2)], "name string, emp long")
    batch = spark.createDataFrame([("A", Decimal(5), "Y", 1)], "national_id string, base_salary decimal(10,2), full_name string, seq long")
    new, m, (left,) = M.replace(table, batch, EMP_SPEC, None, "seq", children=[(child, "emp")])
    assert [(r.emp_id, r.national_id, r.full_name) for r in new.collect()] == [(3, "A", "Y")]
    assert m.first().asDict() == {"deleted": 2, "inserted": 1} and left.count() == 0 and left.columns == child.columns
