"""Registered queries for sinks and DDL (S4-S10, E8), TRUNCATE (S6) and the
savepoint batch (M17).

The sink queries write the whole table into a FRESH folder under the
session's shared ``spark.checkpoint.dir`` and return what reads back, so the
oracle checks the written data, not just the plan.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablekit.operators import mutate as M
from tablekit.operators.batch import Batch
from tablekit.operators.ids import assign_ids, next_id
from tablekit.operators.query import oldest
from tablekit.plans.catalog import register
from tablekit.plans.oracle_views import with_views
from tablekit.plans.q_mutate import EMP_COLS, EMP_SQL_OUT, NOW, NOW_SQL, ntz
from tablekit.sources import fixtures as fx
from tablekit.sources import partitioned as P
from tablekit.sources import sinks as S
from tablekit.sources.fences import fenced_rows, page_by_fence as page_by, write_fenced
from tablekit.sources.tables import scan
from tablekit.spec import EMPLOYEES


@register("truncate", with_views("legacy_import") + f"""
SELECT ROW_NUMBER() OVER (ORDER BY nat_id) AS emp_id, CAST(NULL AS BIGINT) AS department_id, nat_id AS national_id,
       name AS full_name, 'CONTRACTOR' AS contract_type, salary AS base_salary, CAST(NULL AS VARCHAR) AS status,
       dob AS birth_date, {NOW_SQL} AS created_at, {NOW_SQL} AS updated_at, CAST(NULL AS VARCHAR) AS metadata
FROM legacy_import WHERE is_processed = FALSE
""", "S6 S5 M6 V15")
def truncate_employees(spark, d):
    """Truncate a published table, then load it anew: ids start at 1 again."""
    base = S.scratch_dir(spark, "employees")
    S.publish(fx.employees(spark, d), base, 1)
    empty = S.truncate(S.read_latest(spark, base))
    new, _, _ = M.insert_select(
        empty, fx.legacy_import(spark, d), EMPLOYEES,
        {"national_id": F.col("nat_id"), "full_name": F.col("name"), "contract_type": F.lit("CONTRACTOR"),
         "base_salary": F.col("salary"), "birth_date": F.col("dob")},
        where=F.col("is_processed") == F.lit(False), now=NOW, order=["national_id"])
    S.publish(new, base, 2)
    return ntz(S.read_latest(spark, base))


@register("publish_read_latest", with_views("employees") + f"""
SELECT {EMP_SQL_OUT} FROM employees WHERE contract_type = 'FULL_TIME'
""", "S5")
def publish_read_latest(spark, d):
    """Two versions; the reader finds the newest complete one."""
    base = S.scratch_dir(spark, "employees")
    S.publish(fx.employees(spark, d), base, 1)
    S.publish(S.read_latest(spark, base).filter(F.col("contract_type") == "FULL_TIME"), base, 2)
    return ntz(S.read_latest(spark, base))


def _tcl(spark, d, rollback: bool):
    b = Batch(fx.employees(spark, d))
    b.apply(M.insert, fx.sample_rows(spark, "tcl"), EMPLOYEES, NOW)
    b.savepoint("point_alpha")
    b.apply(M.update, {"base_salary": F.col("base_salary") + F.lit(500).cast("decimal(10,2)")},
            F.col("national_id") == "29906061122334", EMPLOYEES, NOW)
    if rollback:
        b.rollback_to("point_alpha")
        b.release("point_alpha")
    return ntz(b.current)


_TCL_SQL = with_views("employees") + f"""
SELECT {EMP_SQL_OUT} FROM employees
UNION ALL
SELECT (SELECT max(emp_id) + 1 FROM employees), NULL, '29906061122334', 'Systems Architect', 'FULL_TIME',
       CAST(__SALARY__ AS DECIMAL(10,2)), NULL, DATE '1999-06-06', {NOW_SQL}, {NOW_SQL}, NULL
"""


@register("tcl_savepoint_rollback", _TCL_SQL.replace("__SALARY__", "9500.00"), "M17 M1 M7")
def tcl_savepoint_rollback(spark, d):
    return _tcl(spark, d, rollback=True)


@register("tcl_update_kept", _TCL_SQL.replace("__SALARY__", "10000.00"), "M17 M1 M7")
def tcl_update_kept(spark, d):
    return _tcl(spark, d, rollback=False)


@register("publish_commit", _TCL_SQL.replace("__SALARY__", "9500.00"), "S5 M17")
def publish_commit(spark, d):
    b = Batch(fx.employees(spark, d))
    b.apply(M.insert, fx.sample_rows(spark, "tcl"), EMPLOYEES, NOW)
    b.savepoint("point_alpha")
    b.apply(M.update, {"base_salary": F.col("base_salary") + F.lit(500).cast("decimal(10,2)")},
            F.col("national_id") == "29906061122334", EMPLOYEES, NOW)
    b.rollback_to("point_alpha")
    path = b.commit(S.scratch_dir(spark, "employees"), 1)
    return ntz(spark.read.parquet(path))


@register("append_by_name", with_views("employees") + f"""
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
""", "S4 U2 S3")
def append_by_name(spark, d):
    emp = fx.employees(spark, d)
    path = S.publish(emp, S.scratch_dir(spark, "employees"), 1)
    batch = M.align(fx.sample_rows(spark, "bulk"), EMPLOYEES, NOW, exclude=("emp_id",))
    batch = assign_ids(batch, ["national_id"], start=next_id(emp, "emp_id"), name="emp_id")
    # columns deliberately in a different order: the sink aligns by name
    S.append(batch.select(*reversed(batch.columns)), path)
    return ntz(spark.read.parquet(path))


@register("insert_counter", with_views("employees") + f"""
, b(national_id, full_name, contract_type, base_salary, birth_date) AS (VALUES
    ('29901010000001', 'Engineer A', 'FULL_TIME', 9000.00, DATE '1999-01-01'),
    ('29901010000002', 'Engineer B', 'CONTRACTOR', 7500.00, DATE '1999-01-02'),
    ('29901010000003', 'Engineer C', 'PART_TIME', 4000.00, DATE '1999-01-03'))
SELECT {EMP_SQL_OUT} FROM employees WHERE emp_id < (SELECT max(emp_id) - 9 FROM employees)
UNION ALL
SELECT (SELECT max(emp_id) FROM employees) + ROW_NUMBER() OVER (ORDER BY national_id), NULL,
       national_id, full_name, contract_type, CAST(base_salary AS DECIMAL(10,2)), NULL, birth_date,
       {NOW_SQL}, {NOW_SQL}, NULL
FROM b
""", "V15 S5 M11 M2")
def insert_counter(spark, d):
    """The last ten rows go, then three come: none gets an id that was in use."""
    base = S.scratch_dir(spark, "employees")
    emp = fx.employees(spark, d)
    S.publish(emp, base, 1, next_ids=S.counted(emp, {"emp_id": 1}))
    last = S.next_ids(spark, base)["emp_id"] - 1
    kept, _ = M.delete(S.read_latest(spark, base), F.col("emp_id") >= last - 9)
    S.publish(kept, base, 2, next_ids=S.counted(kept, S.next_ids(spark, base)))
    new, _ = M.insert(S.read_latest(spark, base), fx.sample_rows(spark, "bulk"), EMPLOYEES, NOW,
                      order=["national_id"], counter=S.next_ids(spark, base)["emp_id"])
    S.publish(new, base, 3, next_ids=S.counted(new, S.next_ids(spark, base)))
    return ntz(S.read_latest(spark, base))


@register("publish_partitions", """
WITH chunk AS (SELECT event_id FROM events WHERE event_type = 'error' ORDER BY ts, event_id LIMIT 300),
     kept AS (SELECT * FROM events WHERE event_id NOT IN (SELECT event_id FROM chunk)
                                     AND CAST(ts AS DATE) <> DATE '2024-01-03')
SELECT event_id, ts, user_id, event_type,
       CASE WHEN event_type = 'view' AND CAST(ts AS DATE) = DATE '2024-01-20' THEN value * 2 ELSE value END AS value,
       props, CAST(ts AS DATE) AS day
FROM kept
""", "S5 M13 M15 M7")
def publish_partitions(spark, d):
    """A chunked delete, a purge of one day and an update of one day, each
    rewriting only the days it touches."""
    import uuid
    base = S.scratch_dir(spark, "events")
    name = f"events_{uuid.uuid4().hex}"
    P.save_partitioned(scan(spark, d, "events").withColumn("day", F.col("ts").cast("date")), name, "day", base)

    def rewrite(hit_rows, change):
        P.rewrite_partitions(spark, name, "day", hit_rows, base, change)

    chunk = oldest(spark.table(name), F.col("event_type") == "error", ["ts"], "event_id", 300)
    rewrite(chunk, lambda rows: M.delete_join(rows, chunk, "event_id", "event_id")[0])
    purged = F.col("day") == F.lit("2024-01-03").cast("date")
    rewrite(spark.table(name).filter(purged), lambda rows: M.delete(rows, purged)[0])
    raised = (F.col("event_type") == "view") & (F.col("day") == F.lit("2024-01-20").cast("date"))
    rewrite(spark.table(name).filter(raised), lambda rows: M.update(rows, {"value": F.col("value") * 2}, raised)[0])
    return spark.table(name)


@register("page_by_fence", with_views("shop_orders") + """
, r AS (SELECT order_id, total_amount, ROW_NUMBER() OVER (ORDER BY total_amount DESC, order_id) AS rn,
               COUNT(*) OVER () AS n FROM shop_orders)
SELECT order_id, total_amount FROM r WHERE rn > n * 9 // 10 AND rn <= n * 9 // 10 + 100
""", "O2 O4 S8")
def page_by_fence(spark, d):
    """The page at nine tenths of the table: one or two of 64 ranges are read."""
    path = S.scratch_dir(spark, "orders")
    order = ["total_amount DESC", "order_id"]
    write_fenced(fx.shop_orders(spark, d).select("order_id", "total_amount"), path, order, ranges=64)
    return page_by(spark, path, order, 100, fenced_rows(spark, path) * 9 // 10)


@register("compact_files", with_views("employees") + f"SELECT {EMP_SQL_OUT} FROM employees", "S7")
def compact_files(spark, d):
    base = S.scratch_dir(spark, "employees")
    fragmented = f"{base}/fragmented"
    fx.employees(spark, d).repartition(4 * spark.sparkContext.defaultParallelism).write.parquet(fragmented)
    S.compact(spark, fragmented, f"{base}/compacted", target_bytes=8 << 20, order=["emp_id"])
    return ntz(spark.read.parquet(f"{base}/compacted"))


@register("clustered_layout", with_views("employees") + f"""
SELECT {EMP_SQL_OUT} FROM employees WHERE department_id = 5 AND base_salary >= 1000
""", "S8 P4 P5")
def clustered_layout(spark, d):
    path = S.scratch_dir(spark, "employees")
    S.write_clustered(fx.employees(spark, d), path,
                      [F.col("department_id"), F.col("base_salary").desc()], "emp_id")
    t = spark.read.parquet(path)
    return ntz(t.filter((F.col("department_id") == 5) & (F.col("base_salary") >= 1000)))


@register("curve_layout", with_views("employees") + f"""
SELECT {EMP_SQL_OUT} FROM employees WHERE base_salary >= 9000
""", "S8 P5")
def curve_layout(spark, d):
    """The composite index's second column alone, over the interleaved layout."""
    path = S.scratch_dir(spark, "employees")
    S.write_curve(fx.employees(spark, d), path, ["base_salary", "department_id"], "emp_id")
    return ntz(spark.read.parquet(path).filter(F.col("base_salary") >= 9000))


@register("ddl_create_insert_rename", with_views("employees") + f"SELECT {EMP_SQL_OUT} FROM employees",
          "S9 S10 E8")
def ddl_create_insert_rename(spark, d):
    import uuid
    from tablekit.operators.evolve import rename_table
    db = f"enterprise_core_db_{uuid.uuid4().hex[:8]}"
    base = S.scratch_dir(spark, db)
    S.create_database(spark, db, location=f"{base}/db")
    name = S.create_table(spark, EMPLOYEES, db, location=f"{base}/enterprise_employees")
    S.insert_by_name(fx.employees(spark, d).select(*reversed(EMP_COLS)), name)
    rename_table(spark, name, f"{db}.core_employees")
    return ntz(spark.table(f"{db}.core_employees"))
