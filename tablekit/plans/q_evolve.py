"""Registered queries for schema evolution (E1-E7); E8 is a catalog rename."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tablekit.operators import evolve as E
from tablekit.operators import mutate as M
from tablekit.operators import quality as V
from tablekit.plans.catalog import register
from tablekit.plans.oracle_views import with_views
from tablekit.plans.q_mutate import NOW, NOW_SQL, ntz
from tablekit.sources import fixtures as fx
from tablekit.sources.tables import scan
from tablekit.spec import EMPLOYEES, ForeignKey, col


@register("evolve_columns", with_views("employees") + """
SELECT e.emp_id, e.department_id, e.national_id, e.full_name, CAST(NULL AS VARCHAR) AS phone_number,
       d.text AS resume_text, e.base_salary, e.status, e.birth_date,
       CAST(e.created_at AS TIMESTAMP) AS created_at, CAST(e.updated_at AS TIMESTAMP) AS updated_at, e.metadata
FROM employees e LEFT JOIN documents d ON d.doc_id = e.emp_id
""", "E2 E3 E4 E5")
def evolve_columns(spark, d):
    emp = fx.employees(spark, d)
    t, spec = E.add_column(emp, EMPLOYEES, E.BIOGRAPHY, after="full_name")
    docs = scan(spark, d, "documents").select(F.col("doc_id").alias("emp_id"), F.col("text").alias("__bio"))
    t = t.join(docs, "emp_id", "left").withColumn("biography", F.col("__bio")).select(*t.columns)
    t, spec = E.add_column(t, spec, E.PHONE, after="full_name")
    t, spec = E.rename_column(t, spec, "biography", E.RESUME.name)
    t, spec = E.modify_columns(t, spec, [col("full_name", "string", nullable=False, max_len=255), E.RESUME])
    t, spec = E.drop_column(t, spec, "contract_type")
    return ntz(t)


@register("evolve_rename_then_check", with_views("employee_import") + """
SELECT 'unique:uidx_national_id' AS rule, CAST(national_id AS VARCHAR) AS key, COUNT(*) AS n
FROM employee_import WHERE national_id IS NOT NULL GROUP BY national_id HAVING COUNT(*) > 1
""", "E4 V4")
def evolve_rename_then_check(spark, d):
    """After CHANGE of a column under a unique key, the spec still checks."""
    key = next(name for name, cols in EMPLOYEES.unique if cols == ("national_id",))
    t, spec = E.rename_column(fx.employee_import(spark, d), EMPLOYEES, "national_id", "citizen_id")
    found = V.check(t, spec).filter(F.col("rule") == f"unique:{key}")
    return found.withColumn("rule", F.lit("unique:uidx_national_id"))


@register("evolve_set_default", with_views("employees", "legacy_import") + f"""
SELECT emp_id, department_id, national_id, full_name, contract_type, base_salary, status, birth_date,
       CAST(created_at AS TIMESTAMP) AS created_at, CAST(updated_at AS TIMESTAMP) AS updated_at, metadata
FROM employees
UNION ALL
SELECT (SELECT max(emp_id) FROM employees) + ROW_NUMBER() OVER (ORDER BY nat_id), NULL, nat_id, name,
       'CONTRACTOR', CAST(1000.00 AS DECIMAL(10,2)), NULL, dob, {NOW_SQL}, {NOW_SQL}, NULL
FROM legacy_import WHERE is_processed = FALSE
""", "E1 V2")
def evolve_set_default(spark, d):
    spec = E.set_default(EMPLOYEES, "base_salary", Decimal("1000.00"))
    new, _, _ = M.insert_select(
        fx.employees(spark, d), fx.legacy_import(spark, d), spec,
        {"national_id": F.col("nat_id"), "full_name": F.col("name"),
         "contract_type": F.lit("CONTRACTOR"), "birth_date": F.col("dob")},
        where=~F.col("is_processed"), now=NOW, order=["national_id"])
    return ntz(new)


@register("add_unique_check", with_views("employees") + """
SELECT 'unique:uidx_salary' AS rule, CAST(base_salary AS VARCHAR) AS key, COUNT(*) AS n
FROM employees WHERE base_salary IS NOT NULL GROUP BY base_salary HAVING COUNT(*) > 1
""", "E6 V4")
def add_unique_check(spark, d):
    return E.unique_violations(fx.employees(spark, d), "uidx_salary", ("base_salary",))


@register("add_fk_check", with_views("employees", "departments") + """
SELECT 'fk:fk_employee_dept_new' AS rule, CAST(emp_id AS VARCHAR) AS key, CAST(1 AS BIGINT) AS n
FROM employees
WHERE department_id IS NOT NULL AND department_id NOT IN (SELECT id FROM departments WHERE status = 'OPEN')
""", "E7 V13")
def add_fk_check(spark, d):
    new_departments = fx.departments(spark, d).filter(F.col("status") == "OPEN")
    spec = E.drop_foreign_key(EMPLOYEES, "fk_employee_department")
    fk = ForeignKey("fk_employee_dept_new", ("department_id",), "new_departments", ("id",),
                    on_delete="restrict", on_update="cascade")
    return E.fk_violations(fx.employees(spark, d), spec, fk, new_departments)
