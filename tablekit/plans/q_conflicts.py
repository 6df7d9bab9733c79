"""Registered queries for conflicts on any unique key (M3-M5) and strict writers.

The oracles walk the batch row by row in a recursive query, or state the end of
such a walk directly.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tablekit.operators import mutate as M
from tablekit.plans.catalog import register
from tablekit.plans.oracle_views import with_views
from tablekit.plans.q_mutate import EMP_SQL_OUT, NOW, NOW_SQL, ntz
from tablekit.plans.q_quality import _CHECK_SQL
from tablekit.sources import fixtures as fx
from tablekit.spec import EMPLOYEES

#: the batch in replay order, with the employees who hold its keys already
_WALKED = """
, b AS (SELECT m.*, ROW_NUMBER() OVER (ORDER BY m.seq) AS rn, e.emp_id AS by_nat, f.emp_id AS by_name
        FROM multi_key_batch m LEFT JOIN employees e ON e.national_id = m.national_id
                               LEFT JOIN employees f ON f.full_name = m.full_name),
  mx AS (SELECT max(emp_id) AS m FROM employees)
"""


def _views() -> str:
    return with_views("employees", "multi_key_batch").replace("WITH", "WITH RECURSIVE", 1) + _WALKED


_TAKES = "(b.by_nat IS NULL AND b.by_name IS NULL AND NOT list_contains(w.nats, b.national_id) AND NOT list_contains(w.names, b.full_name))"


@register("insert_ignore_multi_key", _views() + f"""
, walk(rn, ok, nats, names) AS (
    SELECT CAST(0 AS BIGINT), FALSE, CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[])
    UNION ALL
    SELECT b.rn, {_TAKES}, CASE WHEN {_TAKES} THEN list_append(w.nats, b.national_id) ELSE w.nats END,
           CASE WHEN {_TAKES} THEN list_append(w.names, b.full_name) ELSE w.names END
    FROM walk w JOIN b ON b.rn = w.rn + 1)
SELECT {EMP_SQL_OUT} FROM employees
UNION ALL
SELECT (SELECT m FROM mx) + ROW_NUMBER() OVER (ORDER BY b.rn), NULL, b.national_id, b.full_name, b.contract_type,
       b.base_salary, NULL, b.birth_date, {NOW_SQL}, {NOW_SQL}, NULL
FROM walk w JOIN b ON b.rn = w.rn WHERE w.ok
""", "M4 V14")
def insert_ignore_multi_key(spark, d):
    new, _, _ = M.insert_ignore(fx.employees(spark, d), fx.multi_key_batch(spark, d), EMPLOYEES, None, "seq", NOW)
    return ntz(new)


_HOLDER = """CASE WHEN b.by_nat IS NOT NULL THEN concat('t', b.by_nat)
    WHEN list_position(w.nats, b.national_id) > 0 THEN concat('b', w.ins[list_position(w.nats, b.national_id)])
    WHEN b.by_name IS NOT NULL THEN concat('t', b.by_name)
    WHEN list_position(w.names, b.full_name) > 0 THEN concat('b', w.ins[list_position(w.names, b.full_name)]) END"""


@register("upsert_any_key", _views() + f"""
, walk(rn, target, ins, nats, names) AS (
    SELECT CAST(0 AS BIGINT), CAST('' AS VARCHAR), CAST([] AS BIGINT[]), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[])
    UNION ALL
    SELECT b.rn, coalesce({_HOLDER}, concat('b', b.rn)),
           CASE WHEN {_HOLDER} IS NULL THEN list_append(w.ins, b.rn) ELSE w.ins END,
           CASE WHEN {_HOLDER} IS NULL THEN list_append(w.nats, b.national_id) ELSE w.nats END,
           CASE WHEN {_HOLDER} IS NULL THEN list_append(w.names, b.full_name) ELSE w.names END
    FROM walk w JOIN b ON b.rn = w.rn + 1),
  last AS (SELECT w.target, max(w.rn) AS hi, min(w.rn) AS lo FROM walk w WHERE w.rn > 0 GROUP BY 1)
SELECT e.emp_id, e.department_id, e.national_id, e.full_name, coalesce(h.contract_type, e.contract_type) AS contract_type,
       coalesce(h.base_salary, e.base_salary) AS base_salary, e.status, e.birth_date,
       CAST(e.created_at AS TIMESTAMP) AS created_at,
       CASE WHEN h.rn IS NULL THEN CAST(e.updated_at AS TIMESTAMP) ELSE {NOW_SQL} END AS updated_at, e.metadata
FROM employees e LEFT JOIN last ON last.target = concat('t', e.emp_id) LEFT JOIN b h ON h.rn = last.hi
UNION ALL
SELECT (SELECT m FROM mx) + ROW_NUMBER() OVER (ORDER BY last.lo), NULL, f.national_id, f.full_name, h.contract_type,
       h.base_salary, NULL, f.birth_date, {NOW_SQL}, {NOW_SQL}, NULL
FROM last JOIN b f ON f.rn = last.lo JOIN b h ON h.rn = last.hi WHERE last.target LIKE 'b%'
""", "M3 M16 V15")
def upsert_any_key(spark, d):
    new, _ = M.upsert(fx.employees(spark, d), fx.multi_key_batch(spark, d), EMPLOYEES, None,
                      ["contract_type", "base_salary"], "seq", NOW)
    return ntz(new)


@register("replace_any_key", _views() + f"""
SELECT {EMP_SQL_OUT} FROM employees
WHERE national_id NOT IN (SELECT national_id FROM b) AND full_name NOT IN (SELECT full_name FROM b)
UNION ALL
SELECT (SELECT m FROM mx) + b.rn, NULL, b.national_id, b.full_name, b.contract_type, b.base_salary, NULL, b.birth_date,
       {NOW_SQL}, {NOW_SQL}, NULL
FROM b WHERE NOT EXISTS (SELECT 1 FROM b c WHERE c.rn > b.rn AND (c.national_id = b.national_id OR c.full_name = b.full_name))
""", "M5 V15")
def replace_any_key(spark, d):
    new, _, _ = M.replace(fx.employees(spark, d), fx.multi_key_batch(spark, d), EMPLOYEES, None, "seq", NOW)
    return ntz(new)


@register("insert_strict_violations", _CHECK_SQL.replace("WITH ", with_views("employees") + ", ", 1) + """
SELECT rule, key, n FROM v WHERE rule <> 'primary_key'
UNION ALL SELECT 'primary_key', CAST(emp_id AS VARCHAR), COUNT(*) FROM employee_import WHERE emp_id IS NOT NULL
          GROUP BY emp_id HAVING COUNT(*) > 1
UNION ALL SELECT DISTINCT 'primary_key:held', CAST(emp_id AS VARCHAR), 1 FROM employee_import
          WHERE emp_id IN (SELECT emp_id FROM employees)
UNION ALL SELECT DISTINCT 'unique:uk_national_id:held', national_id, 1 FROM employee_import
          WHERE national_id IN (SELECT national_id FROM employees)
UNION ALL SELECT DISTINCT 'unique:uk_email:held', full_name, 1 FROM employee_import
          WHERE full_name IN (SELECT full_name FROM employees)
""", "V14 M1 M2")
def insert_strict_violations(spark, d):
    """What a strict INSERT of the staging batch is refused for, foreign keys included."""
    return M.insert_violations(fx.employees(spark, d), fx.employee_import(spark, d), EMPLOYEES,
                               {"departments": fx.departments(spark, d)})


@register("update_strict_violations", with_views("employees", "departments") + """
, new AS (SELECT emp_id, status = 'PENDING' AS hit,
                 CASE WHEN status = 'PENDING' THEN department_id + 10 ELSE department_id END AS department_id,
                 CASE WHEN status = 'PENDING' THEN lpad(CAST(emp_id % 700 AS VARCHAR), 14, '0') ELSE national_id END AS national_id,
                 CASE WHEN status = 'PENDING' THEN CAST(base_salary - 5000 AS DECIMAL(10,2)) ELSE base_salary END AS base_salary
          FROM employees)
SELECT 'check:chk_salary' AS rule, CAST(emp_id AS VARCHAR) AS key, CAST(1 AS BIGINT) AS n FROM new WHERE hit AND base_salary < 0
UNION ALL SELECT 'unique:uk_national_id', national_id, COUNT(*) FROM new GROUP BY national_id HAVING COUNT(*) > 1
UNION ALL SELECT 'fk:fk_employee_department', CAST(emp_id AS VARCHAR), 1 FROM new
          WHERE hit AND department_id IS NOT NULL AND department_id NOT IN (SELECT id FROM departments)
""", "V14 M7")
def update_strict_violations(spark, d):
    """What a strict UPDATE of salaries, departments and national ids is refused for."""
    emp, where = fx.employees(spark, d), F.col("status") == "PENDING"
    sets = {"base_salary": F.col("base_salary") - F.lit(Decimal("5000")), "department_id": F.col("department_id") + 10,
            "national_id": F.lpad((F.col("emp_id") % 700).cast("string"), 14, "0")}
    hits, _ = M.update(emp.filter(where), sets)
    new, _ = M.update(emp, sets, where, mode="unchecked")
    return M.update_violations(hits, new, EMPLOYEES, list(sets), {"departments": fx.departments(spark, d)})
