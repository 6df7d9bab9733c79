"""Registered queries for mutations (M1-M16) and FK actions.

Each returns the NEW version of the whole table (or the chunk plan / metrics),
so the oracle compares complete table states.  ``now`` is fixed so results
repeat; timestamps leave as timestamp_ntz (zone-free) for the comparison.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.operators import mutate as M
from tablekit.operators import quality as V
from tablekit.plans.catalog import register
from tablekit.plans.oracle_views import with_views
from tablekit.sources import fixtures as fx
from tablekit.sources.tables import scan
from tablekit.spec import EMPLOYEES

NOW = "2024-06-01 12:00:00"
NOW_SQL = "TIMESTAMP '2024-06-01 12:00:00'"
EMP_COLS = ["emp_id", "department_id", "national_id", "full_name", "contract_type", "base_salary",
            "status", "birth_date", "created_at", "updated_at", "metadata"]
EMP_SQL_OUT = ("emp_id, department_id, national_id, full_name, contract_type, base_salary, status, "
               "birth_date, CAST(created_at AS TIMESTAMP) AS created_at, "
               "CAST(updated_at AS TIMESTAMP) AS updated_at, metadata")


def ntz(df: DataFrame) -> DataFrame:
    """Zone-aware timestamps out as zone-free wall times (oracle compare)."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c)
                       for c, t in df.dtypes])


# --- M1 / M2 / M6 ---------------------------------------------------------------------

@register("insert_single", with_views("employees") + f"""
SELECT {EMP_SQL_OUT} FROM employees
UNION ALL
SELECT (SELECT max(emp_id) + 1 FROM employees), NULL, '29905051234567', 'System Admin', 'FULL_TIME',
       CAST(8500.00 AS DECIMAL(10,2)), NULL, DATE '1999-05-05', {NOW_SQL}, {NOW_SQL}, NULL
""", "M1 S2 V2 V15")
def insert_single(spark, d):
    new, _ = M.insert(fx.employees(spark, d), fx.sample_rows(spark, "admin"), EMPLOYEES, NOW)
    return ntz(new)


@register("insert_bulk", with_views("employees") + f"""
, b(national_id, full_name, contract_type, base_salary, birth_date) AS (VALUES
    ('29901010000001', 'Engineer A', 'FULL_TIME', 9000.00, DATE '1999-01-01'),
    ('29901010000002', 'Engineer B', 'CONTRACTOR', 7500.00, DATE '1999-01-02'),
    ('29901010000003', 'Engineer C', 'PART_TIME', 4000.00, DATE '1999-01-03'))
SELECT {EMP_SQL_OUT} FROM employees
UNION ALL
SELECT (SELECT max(emp_id) FROM employees) + ROW_NUMBER() OVER (ORDER BY national_id), NULL,
       national_id, full_name, contract_type, CAST(base_salary AS DECIMAL(10,2)), NULL, birth_date,
       {NOW_SQL}, {NOW_SQL}, NULL
FROM b
""", "M2 S3 U2 V2 V15")
def insert_bulk(spark, d):
    new, _ = M.insert(fx.employees(spark, d), fx.sample_rows(spark, "bulk"), EMPLOYEES, NOW,
                      order=["national_id"])
    return ntz(new)


@register("insert_select", with_views("employees", "legacy_import") + f"""
SELECT {EMP_SQL_OUT} FROM employees
UNION ALL
SELECT (SELECT max(emp_id) FROM employees) + ROW_NUMBER() OVER (ORDER BY nat_id), NULL,
       nat_id, name, 'CONTRACTOR', salary, NULL, dob, {NOW_SQL}, {NOW_SQL}, NULL
FROM legacy_import WHERE is_processed = FALSE
""", "M6 P2 P3")
def insert_select(spark, d):
    src = fx.legacy_import(spark, d)
    new, _, _ = M.insert_select(
        fx.employees(spark, d), src, EMPLOYEES,
        {"national_id": F.col("nat_id"), "full_name": F.col("name"),
         "contract_type": F.lit("CONTRACTOR"), "base_salary": F.col("salary"),
         "birth_date": F.col("dob")},
        where=F.col("is_processed") == F.lit(False), now=NOW, order=["national_id"], source_key="nat_id")
    return ntz(new)


@register("insert_select_mark_processed", with_views("legacy_import") + """
SELECT nat_id, name, salary, dob,
       CASE WHEN is_processed THEN TRUE WHEN salary >= 50000 THEN TRUE ELSE FALSE END AS is_processed
FROM legacy_import
""", "M6")
def insert_select_mark_processed(spark, d):
    """M6 followed by marking the migrated source rows processed (D11); rows
    under the salary bound are not migrated and stay as they are."""
    src = fx.legacy_import(spark, d)
    _, _, keys = M.insert_select(
        fx.employees(spark, d), src, EMPLOYEES,
        {"national_id": F.col("nat_id"), "full_name": F.col("name"),
         "contract_type": F.lit("CONTRACTOR"), "base_salary": F.col("salary"),
         "birth_date": F.col("dob")},
        where=(F.col("is_processed") == F.lit(False)) & (F.col("salary") >= 50000), now=NOW, order=["national_id"], source_key="nat_id")
    marked, _ = M.mark_processed(src, keys, "nat_id")
    return marked


# --- M3 / M4 / M5 ---------------------------------------------------------------------

_BATCH_RANKS = """
, ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY national_id ORDER BY seq) AS rn_first,
                    ROW_NUMBER() OVER (PARTITION BY national_id ORDER BY seq DESC) AS rn_last
             FROM orders_batch),
  first AS (SELECT * FROM ranked WHERE rn_first = 1),
  last AS (SELECT * FROM ranked WHERE rn_last = 1),
  mx AS (SELECT max(emp_id) AS m FROM employees)
"""


@register("upsert", with_views("employees", "orders_batch") + _BATCH_RANKS + f"""
SELECT {EMP_SQL_OUT} FROM employees WHERE national_id NOT IN (SELECT national_id FROM last)
UNION ALL
SELECT e.emp_id, e.department_id, e.national_id, l.full_name, e.contract_type, l.base_salary, e.status,
       e.birth_date, CAST(e.created_at AS TIMESTAMP), {NOW_SQL}, e.metadata
FROM employees e JOIN last l ON e.national_id = l.national_id
UNION ALL
SELECT (SELECT m FROM mx) + ROW_NUMBER() OVER (ORDER BY f.seq), NULL, f.national_id, l.full_name,
       f.contract_type, l.base_salary, NULL, f.birth_date, {NOW_SQL}, {NOW_SQL}, NULL
FROM first f JOIN last l ON f.national_id = l.national_id
WHERE f.national_id NOT IN (SELECT national_id FROM employees)
""", "M3 M16 V15")
def upsert(spark, d):
    new, _ = M.upsert(fx.employees(spark, d), fx.orders_batch(spark, d), EMPLOYEES,
                      key="national_id", update_cols=["full_name", "base_salary"], seq="seq", now=NOW)
    return ntz(new)


@register("upsert_metrics", with_views("employees", "orders_batch") + """
, keys AS (SELECT DISTINCT national_id FROM orders_batch)
SELECT CAST(SUM(CASE WHEN e.national_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS inserted,
       CAST(SUM(CASE WHEN e.national_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS updated
FROM keys k LEFT JOIN employees e ON k.national_id = e.national_id
""", "M3")
def upsert_metrics(spark, d):
    _, m = M.upsert(fx.employees(spark, d), fx.orders_batch(spark, d), EMPLOYEES,
                    key="national_id", update_cols=["full_name", "base_salary"], seq="seq", now=NOW)
    return m


@register("insert_ignore", with_views("employees", "orders_batch") + _BATCH_RANKS + f"""
SELECT {EMP_SQL_OUT} FROM employees
UNION ALL
SELECT (SELECT m FROM mx) + ROW_NUMBER() OVER (ORDER BY f.seq), NULL, f.national_id, f.full_name,
       f.contract_type, f.base_salary, NULL, f.birth_date, {NOW_SQL}, {NOW_SQL}, NULL
FROM first f WHERE f.national_id NOT IN (SELECT national_id FROM employees)
""", "M4 V14")
def insert_ignore(spark, d):
    new, _, _ = M.insert_ignore(fx.employees(spark, d), fx.orders_batch(spark, d), EMPLOYEES,
                                key="national_id", seq="seq", now=NOW)
    return ntz(new)


@register("replace", with_views("employees", "orders_batch") + _BATCH_RANKS + f"""
SELECT {EMP_SQL_OUT} FROM employees WHERE national_id NOT IN (SELECT national_id FROM last)
UNION ALL
SELECT (SELECT m FROM mx) + ROW_NUMBER() OVER (ORDER BY l.seq), NULL, l.national_id, l.full_name,
       l.contract_type, l.base_salary, NULL, l.birth_date, {NOW_SQL}, {NOW_SQL}, NULL
FROM last l
""", "M5 V15")
def replace(spark, d):
    new, _, _ = M.replace(fx.employees(spark, d), fx.orders_batch(spark, d), EMPLOYEES,
                          key="national_id", seq="seq", now=NOW)
    return ntz(new)


@register("insert_ignore_import", with_views("employee_import") + """
, broken AS (SELECT *,
    national_id IS NULL AS b1, length(national_id) > 14 AS b2, length(full_name) > 150 AS b3,
    contract_type IS NULL AS b4, contract_type = 'INTERN' AS b5
  FROM employee_import)
SELECT 'not_null:national_id' AS reason, count(*) AS n FROM broken WHERE b1
UNION ALL SELECT 'length:national_id', count(*) FROM broken WHERE b2
UNION ALL SELECT 'length:full_name', count(*) FROM broken WHERE b3
UNION ALL SELECT 'not_null:contract_type', count(*) FROM broken WHERE b4
UNION ALL SELECT 'enum:contract_type', count(*) FROM broken WHERE b5
UNION ALL SELECT 'type:base_salary', count(*) FROM broken WHERE abs(base_salary) >= 99999999.995
""", "M4 V14")
def insert_ignore_import(spark, d):
    """INSERT IGNORE of a batch full of rule breakers: rejected rows by reason."""
    batch = fx.employee_import(spark, d).withColumn("seq", F.monotonically_increasing_id())
    _, _, rejected = M.insert_ignore(fx.employees(spark, d), batch, EMPLOYEES, key="national_id", seq="seq", now=NOW)
    shown = ["not_null:national_id", "length:national_id", "length:full_name", "not_null:contract_type",
             "enum:contract_type", "type:base_salary"]
    counts = rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in shown])).alias("reason"))
    return wanted.join(counts, "reason", "left").select("reason", F.coalesce("n", F.lit(0)).alias("n"))


# --- M7 - M10, M16 ----------------------------------------------------------------------

@register("update_where", with_views("employees") + f"""
SELECT emp_id, department_id, national_id, full_name, contract_type,
       CASE WHEN contract_type = 'FULL_TIME' AND status = 'PENDING'
            THEN CAST(base_salary * 1.10 AS DECIMAL(10,2)) ELSE base_salary END AS base_salary,
       status, birth_date, CAST(created_at AS TIMESTAMP) AS created_at,
       CASE WHEN contract_type = 'FULL_TIME' AND status = 'PENDING' THEN {NOW_SQL}
            ELSE CAST(updated_at AS TIMESTAMP) END AS updated_at, metadata
FROM employees
""", "M7 P9 P12 P13")
def update_where(spark, d):
    new, _ = M.update(fx.employees(spark, d),
                      {"base_salary": F.col("base_salary") * F.lit(Decimal("1.10")),
                       "updated_at": M.now_col(NOW)},
                      (F.col("contract_type") == "FULL_TIME") & (F.col("status") == "PENDING"),
                      EMPLOYEES, NOW)
    return ntz(new)


@register("update_join", with_views("employees", "departments") + f"""
, hit AS (SELECT e.emp_id FROM employees e
          WHERE e.contract_type = 'FULL_TIME'
            AND e.department_id IN (SELECT id FROM departments WHERE department_name = 'NATION_5'))
SELECT emp_id, department_id, national_id, full_name, contract_type,
       CASE WHEN emp_id IN (SELECT emp_id FROM hit) THEN CAST(base_salary + 500.00 AS DECIMAL(10,2))
            ELSE base_salary END AS base_salary,
       status, birth_date, CAST(created_at AS TIMESTAMP) AS created_at,
       CASE WHEN emp_id IN (SELECT emp_id FROM hit) THEN {NOW_SQL}
            ELSE CAST(updated_at AS TIMESTAMP) END AS updated_at, metadata
FROM employees
""", "M8 J7 M16")
def update_join(spark, d):
    new, _ = M.update_join(
        fx.employees(spark, d), fx.departments(spark, d), "department_id", "id",
        {"base_salary": F.col("base_salary") + F.lit(Decimal("500.00"))},
        where=F.col("contract_type") == "FULL_TIME",
        other_where=F.col("department_name") == "NATION_5", spec=EMPLOYEES, now=NOW)
    return ntz(new)


@register("update_join_from_other", with_views("employees", "departments") + f"""
SELECT e.emp_id, e.department_id, e.national_id, e.full_name, e.contract_type, e.base_salary,
       CASE WHEN d.id IS NOT NULL AND e.contract_type = 'PART_TIME' THEN d.department_name ELSE e.status END AS status,
       e.birth_date, CAST(e.created_at AS TIMESTAMP) AS created_at,
       CASE WHEN d.id IS NOT NULL AND e.contract_type = 'PART_TIME'
                 AND d.department_name IS DISTINCT FROM e.status THEN {NOW_SQL}
            ELSE CAST(e.updated_at AS TIMESTAMP) END AS updated_at, e.metadata
FROM employees e LEFT JOIN (SELECT * FROM departments WHERE status = 'OPEN') d ON e.department_id = d.id
""", "M8 M16")
def update_join_from_other(spark, d):
    new, _ = M.update_join(
        fx.employees(spark, d), fx.departments(spark, d), "department_id", "id", {},
        where=F.col("contract_type") == "PART_TIME", other_where=F.col("status") == "OPEN",
        spec=EMPLOYEES, now=NOW, from_other={"status": "department_name"})
    return ntz(new)


_CASE_SQL = """CASE WHEN contract_type = 'FULL_TIME' THEN CAST(base_salary * 1.10 AS DECIMAL(10,2))
                    WHEN contract_type = 'PART_TIME' THEN CAST(base_salary * 1.05 AS DECIMAL(10,2))
                    ELSE base_salary END"""


@register("update_case", with_views("employees") + f"""
SELECT emp_id, department_id, national_id, full_name, contract_type,
       CASE WHEN department_id = 5 THEN {_CASE_SQL} ELSE base_salary END AS base_salary,
       status, birth_date, CAST(created_at AS TIMESTAMP) AS created_at,
       CASE WHEN department_id = 5 AND {_CASE_SQL} IS DISTINCT FROM base_salary THEN {NOW_SQL}
            ELSE CAST(updated_at AS TIMESTAMP) END AS updated_at, metadata
FROM employees
""", "M9 P8 M16")
def update_case(spark, d):
    s, ct = F.col("base_salary"), F.col("contract_type")
    new_salary = (F.when(ct == "FULL_TIME", (s * F.lit(Decimal("1.10"))).cast("decimal(10,2)"))
                  .when(ct == "PART_TIME", (s * F.lit(Decimal("1.05"))).cast("decimal(10,2)"))
                  .otherwise(s))
    new, _ = M.update(fx.employees(spark, d), {"base_salary": new_salary},
                      F.col("department_id") == 5, EMPLOYEES, NOW)
    return ntz(new)


@register("update_chunk", with_views("employees") + f"""
, chunk AS (SELECT emp_id FROM employees WHERE status = 'PENDING' ORDER BY created_at, emp_id LIMIT 100)
SELECT emp_id, department_id, national_id, full_name, contract_type, base_salary,
       CASE WHEN emp_id IN (SELECT emp_id FROM chunk) THEN 'PROCESSED' ELSE status END AS status,
       birth_date, CAST(created_at AS TIMESTAMP) AS created_at,
       CASE WHEN emp_id IN (SELECT emp_id FROM chunk) THEN {NOW_SQL}
            ELSE CAST(updated_at AS TIMESTAMP) END AS updated_at, metadata
FROM employees
""", "M10 O3 M16")
def update_chunk(spark, d):
    new, _ = M.update_chunk(fx.employees(spark, d), {"status": F.lit("PROCESSED")},
                            F.col("status") == "PENDING", ["created_at"], "emp_id", 100, EMPLOYEES, NOW)
    return ntz(new)


# --- M11 - M15 ---------------------------------------------------------------------------

@register("delete_where", with_views("employees") + f"""
SELECT {EMP_SQL_OUT} FROM employees
WHERE NOT COALESCE(department_id = 5 OR base_salary > 9000, FALSE)
""", "M11 P13")
def delete_where(spark, d):
    new, _ = M.delete(fx.employees(spark, d),
                      (F.col("department_id") == 5) | (F.col("base_salary") > 9000))
    return ntz(new)


@register("delete_join", with_views("employees", "departments") + f"""
SELECT {EMP_SQL_OUT} FROM employees e
WHERE NOT EXISTS (SELECT 1 FROM departments d WHERE d.id = e.department_id AND d.status = 'CLOSED_DOWN')
""", "M12 J8")
def delete_join(spark, d):
    new, _ = M.delete_join(fx.employees(spark, d), fx.departments(spark, d), "department_id", "id",
                           F.col("status") == "CLOSED_DOWN")
    return ntz(new)


@register("delete_chunk", with_views("employees") + f"""
, chunk AS (SELECT emp_id FROM employees WHERE status = 'TERMINATED' ORDER BY updated_at, emp_id LIMIT 100)
SELECT {EMP_SQL_OUT} FROM employees WHERE emp_id NOT IN (SELECT emp_id FROM chunk)
""", "M13 O3")
def delete_chunk(spark, d):
    new, _ = M.delete_chunk(fx.employees(spark, d), F.col("status") == "TERMINATED",
                            ["updated_at"], "emp_id", 100)
    return ntz(new)


@register("drain_chunks", with_views("employees") + """
, r AS (SELECT emp_id, ROW_NUMBER() OVER (ORDER BY updated_at, emp_id) AS rn
        FROM employees WHERE status = 'TERMINATED')
SELECT CAST(ceil(rn / 100.0) AS BIGINT) AS chunk, COUNT(*) AS deleted,
       arg_min(emp_id, rn) AS first_key, arg_max(emp_id, rn) AS last_key
FROM r GROUP BY 1
""", "M13")
def drain_chunks(spark, d):
    _, chunks = M.drain(fx.employees(spark, d), F.col("status") == "TERMINATED",
                        ["updated_at"], "emp_id", 100)
    return chunks


@register("soft_delete", with_views("employees") + f"""
SELECT {EMP_SQL_OUT},
       COALESCE(department_id = 5, FALSE) AS is_deleted,
       CASE WHEN department_id = 5 THEN {NOW_SQL} END AS deleted_at
FROM employees
""", "M14")
def soft_delete(spark, d):
    new, _ = M.soft_delete(fx.employees(spark, d), F.col("department_id") == 5, NOW)
    return ntz(new)


@register("soft_delete_active", with_views("employees") + """
SELECT emp_id, full_name FROM employees WHERE NOT COALESCE(department_id = 5, FALSE)
""", "M14")
def soft_delete_active(spark, d):
    new, _ = M.soft_delete(fx.employees(spark, d), F.col("department_id") == 5, NOW)
    return M.active(new).select("emp_id", "full_name")


@register("purge_events", """
SELECT * FROM events WHERE NOT COALESCE(ts < TIMESTAMP '2024-01-15 00:00:00', FALSE)
""", "M15 P4")
def purge_events(spark, d):
    new, _ = M.purge(scan(spark, d, "events"), "ts", F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'"))
    return new


@register("mutation_metrics", with_views("employees") + """
SELECT CAST(SUM(CASE WHEN contract_type = 'FULL_TIME' AND status = 'PENDING' THEN 1 ELSE 0 END) AS BIGINT) AS updated
FROM employees
""", "M7")
def mutation_metrics(spark, d):
    _, m = M.update(fx.employees(spark, d), {"base_salary": F.col("base_salary") * 2},
                    (F.col("contract_type") == "FULL_TIME") & (F.col("status") == "PENDING"))
    return m


# --- F1 - F4: foreign key actions ------------------------------------------------------------

_FK = EMPLOYEES.foreign_keys[0]


@register("fk_set_null", with_views("employees", "departments") + f"""
SELECT emp_id,
       CASE WHEN department_id IN (SELECT id FROM departments WHERE status = 'CLOSED_DOWN') THEN NULL
            ELSE department_id END AS department_id,
       national_id, full_name, contract_type, base_salary, status, birth_date,
       CAST(created_at AS TIMESTAMP) AS created_at, CAST(updated_at AS TIMESTAMP) AS updated_at, metadata
FROM employees
""", "F3")
def fk_set_null(spark, d):
    _, child = V.delete_parent(fx.departments(spark, d), fx.employees(spark, d), _FK,
                               F.col("status") == "CLOSED_DOWN", "set_null")
    return ntz(child)


@register("fk_cascade", with_views("employees", "departments") + f"""
SELECT {EMP_SQL_OUT} FROM employees
WHERE department_id IS NULL
   OR department_id NOT IN (SELECT id FROM departments WHERE status = 'CLOSED_DOWN')
""", "F2")
def fk_cascade(spark, d):
    _, child = V.delete_parent(fx.departments(spark, d), fx.employees(spark, d), _FK,
                               F.col("status") == "CLOSED_DOWN", "cascade")
    return ntz(child)


@register("fk_restrict_blockers", with_views("employees", "departments") + """
SELECT emp_id, department_id FROM employees
WHERE department_id IN (SELECT id FROM departments WHERE status = 'CLOSED_DOWN')
""", "F1")
def fk_restrict_blockers(spark, d):
    return V.delete_blockers(fx.departments(spark, d), fx.employees(spark, d), _FK,
                             F.col("status") == "CLOSED_DOWN").select("emp_id", "department_id")


@register("fk_update_cascade", with_views("employees", "departments") + """
SELECT emp_id, CASE WHEN department_id IN (SELECT id FROM departments WHERE status = 'OPEN')
                    THEN department_id + 100 ELSE department_id END AS department_id, full_name
FROM employees
""", "F4")
def fk_update_cascade(spark, d):
    dep = fx.departments(spark, d)
    mapping = dep.filter(F.col("status") == "OPEN").select(F.col("id").alias("old"),
                                                             (F.col("id") + 100).alias("new"))
    _, child = V.update_parent_key(dep, fx.employees(spark, d), _FK, mapping)
    return child.select("emp_id", "department_id", "full_name")
