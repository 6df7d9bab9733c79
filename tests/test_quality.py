"""Constraint rules: each seeded bad row is found; strict modes raise."""

import datetime as dt
import json
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablekit.operators import evolve as E
from tablekit.operators import mutate as M
from tablekit.operators import quality as V
from tablekit.spec import EMPLOYEES, TableSpec, col
from tests.conftest import SF001

SCHEMA = ("emp_id long, department_id long, national_id string, full_name string, contract_type string, "
          "base_salary decimal(15,2), status string, birth_date date, created_at timestamp, "
          "updated_at timestamp, metadata string")
D = dt.date(1999, 1, 1)
TS = dt.datetime(2024, 1, 1)


def good(i, **kw):
    row = dict(emp_id=i, department_id=1, national_id=f"{i:014d}", full_name=f"name {i}",
               contract_type="FULL_TIME", base_salary=Decimal("100.00"), status="ACTIVE",
               birth_date=D, created_at=TS, updated_at=TS, metadata='{"k": 1}')
    row.update(kw)
    return row


# one broken rule per row (FIXTURES section 4)
BAD = [
    (good(1, national_id=None), "not_null:national_id"),
    (good(3, base_salary=Decimal("-1")), "check:chk_salary"),
    (good(4, base_salary=Decimal("123456789.00")), "type:base_salary"),
    (good(5, contract_type="INTERN"), "enum:contract_type"),
    (good(6, national_id="1" * 15), "length:national_id"),
    (good(7, full_name="x" * 151), "length:full_name"),
    (good(8, metadata="{bad"), "json:metadata"),
    (good(10, updated_at=dt.datetime(2040, 1, 1)), "range:updated_at"),
]


def _frame(spark, rows):
    cols = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], SCHEMA)


def test_each_bad_row_is_found(spark):
    rows = [r for r, _ in BAD] + [good(20), good(20), good(21, full_name="name 22"), good(22),
                                  good(23, department_id=999)]
    df = _frame(spark, rows)
    deps = spark.createDataFrame([(1,)], "id long")
    v = {(r.rule, r.key) for r in V.check(df, EMPLOYEES, {"departments": deps}).collect()}
    for row, rule in BAD:
        assert (rule, str(row["emp_id"])) in v, rule
    assert ("primary_key", "20") in v
    assert ("unique:uk_email", "name 22") in v
    assert ("fk:fk_employee_department", "23") in v
    clean_keys = {str(i) for i in (20, 21, 22)}
    row_rules = {k for r, k in v if not r.startswith(("primary", "unique", "fk"))}
    assert not (row_rules & clean_keys)


def test_null_passes_check_and_unique(spark):
    df = _frame(spark, [good(1, base_salary=None, full_name=None), good(2, full_name=None)])
    rules = {r.rule for r in V.check(df, EMPLOYEES).collect()}
    assert "check:chk_salary" not in rules          # CHECK fails only on FALSE
    assert "unique:uk_email" not in rules           # NULLs never collide
    assert "not_null:full_name" in rules


def test_enforce_strict_raises_and_ignore_drops(spark):
    df = _frame(spark, [good(1), good(2, contract_type="INTERN")])
    with pytest.raises(V.ConstraintViolation):
        V.enforce(df, EMPLOYEES, "strict")
    clean, rejected = V.enforce(df, EMPLOYEES, "ignore")
    assert [r.emp_id for r in clean.collect()] == [1]
    assert rejected.first().reasons == ["enum:contract_type"]


def test_enum_ordinal_set_domain_lob(spark):
    df = spark.createDataFrame([("PART_TIME",), ("X",)], "c string")
    assert [r.o for r in V.enum_ordinal(df, "c", ("FULL_TIME", "PART_TIME"), "o").collect()] == [2, 0]
    s = col("tags", "string", set_values=("A", "B"))
    spec = EMPLOYEES.replace(columns=(s,), primary_key=(), unique=(), checks=(), foreign_keys=())
    t = spark.createDataFrame([("A,B",), ("A,C",)], "tags string")
    assert [r.rule for r in V.row_violations(t, spec).collect()] == ["set:tags"]
    lob = spark.createDataFrame([("a" * 255,), ("é" * 200,), ("x" * 70000,), (None,)], "t string")
    assert [r.lob_class for r in V.lob_class(lob, "t").collect()] == ["TINYTEXT", "TEXT", "MEDIUMTEXT", None]


def test_fk_actions(spark):
    parent = spark.createDataFrame([(1, "CLOSED"), (2, "OPEN")], "id long, status string")
    child = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "emp_id long, department_id long")
    fk = EMPLOYEES.foreign_keys[0]
    with pytest.raises(V.ConstraintViolation):
        V.delete_parent(parent, child, fk, F.col("status") == "CLOSED", "restrict")
    p, c = V.delete_parent(parent, child, fk, F.col("status") == "CLOSED", "cascade")
    assert sorted(r.emp_id for r in c.collect()) == [11, 12] and p.count() == 1
    _, c = V.delete_parent(parent, child, fk, F.col("status") == "CLOSED", "set_null")
    assert sorted(map(tuple, c.collect()), key=str) == sorted([(10, None), (11, 2), (12, None)], key=str)
    mapping = spark.createDataFrame([(2, 200)], "old long, new long")
    p, c = V.update_parent_key(parent, child, fk, mapping)
    assert sorted(r.id for r in p.collect()) == [1, 200]
    assert sorted(map(tuple, c.collect()), key=str) == sorted([(10, 1), (11, 200), (12, None)], key=str)


def test_evolution_checks_raise(spark):
    from tablekit.sources import fixtures as fx
    emp = fx.employees(spark, SF001)
    with pytest.raises(V.ConstraintViolation):
        E.modify_column(emp, EMPLOYEES, col("full_name", "string", nullable=False, max_len=5))
    with pytest.raises(V.ConstraintViolation):
        E.add_unique(emp, EMPLOYEES, "uk_type", ("contract_type",))
    spec = E.add_unique(emp, EMPLOYEES, "uk_nat2", ("national_id",))
    assert ("uk_nat2", ("national_id",)) in spec.unique
    t, spec = E.add_column(emp, EMPLOYEES, E.PHONE, first=True)
    assert t.columns[0] == "phone_number" and spec.names[0] == "phone_number"
    t, spec = E.drop_column(emp, EMPLOYEES, "full_name")
    assert "full_name" not in t.columns and all("full_name" not in u[1] for u in spec.unique)
    assert E.set_default(EMPLOYEES, "base_salary", Decimal("1000.00")).column("base_salary").default == Decimal("1000.00")


def test_json_field_and_utc(spark):
    df = spark.createDataFrame([('{"k": 5}',), ("{bad",)], "j string")
    assert [r.k for r in V.json_field(df, "j", "$.k", "int", "k").collect()] == [5, None]
    ts = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 12:00:00' AS t")
    assert str(V.to_utc(ts, "t", "America/New_York").first().t) == "2024-01-01 17:00:00"


def test_rename_and_drop_follow_exact_names():
    from tablekit.operators import evolve as E
    from tablekit.spec import EMPLOYEES
    spec = EMPLOYEES.replace(checks=(("c1", "base_salary >= 0"), ("c2", "salary <> 'base_salary' AND `salary` > 0")))
    new = E.rename_in_spec(spec, "base_salary", "pay")
    assert new.checks == (("c1", "pay >= 0"), ("c2", "salary <> 'base_salary' AND `salary` > 0"))
    assert ("idx_department_salary", ("department_id", "pay DESC")) in new.indexes
    assert [c.name for c in new.columns if c.name in ("pay", "base_salary")] == ["pay"]
    assert E.rename_in_spec(spec, "full_name", "n").unique[1] == ("uk_email", ("n",))
    kept = E.drop_column(_Frame(), spec, "salary")[1]
    assert [n for n, _ in kept.checks] == ["c1"]
    assert E.drop_index(E.add_index(spec, "i2", ("full_name",)), "i2") == spec


class _Frame:
    def drop(self, name):
        return self


def test_update_cascade_refuses_ambiguous_maps(spark):
    import pytest
    from tablekit.operators import quality as V
    from tablekit.spec import ForeignKey
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    child = spark.createDataFrame([(10, 1), (11, 2)], "cid long, pid long")
    fk = ForeignKey("f", ("pid",), "p", ("id",))
    for rows in ([(1, 5), (1, 6)], [(1, 2)], [(1, 7), (2, 7)]):
        with pytest.raises(V.ConstraintViolation):
            V.update_parent_key(parent, child, fk, spark.createDataFrame(rows, "old long, new long"))
    p, c = V.update_parent_key(parent, child, fk, spark.createDataFrame([(1, 2), (2, 1)], "old long, new long"))
    assert sorted(r.id for r in p.collect()) == [1, 2, 3] and sorted((r.cid, r.pid) for r in c.collect()) == [(10, 2), (11, 1)]


def test_unique_follows_the_declared_collation(spark):
    names = spark.createDataFrame([(1, "José"), (2, "jose"), (3, "Ana"), (4, None), (5, None)], "id long, name string")
    for kind, want in (("ai_ci", [("unique:uk", "José", 2)]), ("as_cs", []), ("bin", []), (None, [])):
        spec = TableSpec("t", (col("id", "bigint"), col("name", "string", collation=kind)), unique=(("uk", ("name",)),))
        assert [tuple(r) for r in V.check(names, spec).collect()] == want
        held = M.key_violations(names, spark.createDataFrame([(9, "JOSE"), (10, "ANA")], "id long, name string"), spec)
        assert sorted(r.key for r in held.collect()) == (["ANA", "JOSE"] if kind == "ai_ci" else [])


def test_json_paths_equal_a_walk(spark):
    texts = ['{"a": 1, "b": {"c": [1, "x", null, {"d": 2.50}]}}', '{"a": "s", "a.b": true, "b": []}', "[1, [2, [3e300]]]", "7",
             "null", "{bad", "", None, '{"b": {"c": {}}, "a.b": 0}'] * 2

    def kind(v):
        return {dict: "OBJECT", list: "ARRAY", str: "STRING", bool: "BOOLEAN", int: "BIGINT", type(None): "VOID"}.get(
            type(v)) or ("DOUBLE" if abs(v) > 1e100 else "DECIMAL")

    want = Counter()

    def walk(path, v):
        want[path, kind(v)] += 1
        for k, x in v.items() if isinstance(v, dict) else [(None, x) for x in v] if isinstance(v, list) else []:
            walk(path + ("[*]" if k is None else f".{k}" if k.isidentifier() else f"['{k}']"), x)

    for t in texts:
        try:
            walk("$", json.loads(t or ""))
        except ValueError:
            pass
    rows = V.json_paths(spark.createDataFrame([(t,) for t in texts], "j string"), "j").collect()
    assert {(r.path, r.type): r.n for r in rows} == want and len(rows) == len(want)
    assert V.json_paths(spark.createDataFrame([], "j string"), "j").count() == 0
