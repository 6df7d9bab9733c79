"""Views that give the driver tables the shape of the HR / sales model.

Each view is a projection (plus dimension joins) over a driver table, so its
size grows with the data and Catalyst still prunes columns and pushes
filters into the parquet scan underneath.
"""

from __future__ import annotations

import datetime as dt
import functools
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.sources.tables import rows, scan


_VIEWS: dict[tuple[str, str], tuple[SparkSession, DataFrame]] = {}


def view(fn):
    """Resolve a fixture view once per session and directory, as a catalog
    view is; the DataFrame stays lazy and is re-planned per action."""
    @functools.wraps(fn)
    def wrapper(spark: SparkSession, d: str) -> DataFrame:
        key = (fn.__name__, d)
        hit = _VIEWS.get(key)
        if hit is not None and hit[0] is spark and spark.sparkContext._jsc is not None:
            return hit[1]
        df = fn(spark, d)
        _VIEWS[key] = (spark, df)
        return df
    return wrapper


def _date(s: str) -> Column:
    return F.lit(dt.date.fromisoformat(s))


CUSTOMER_STATUSES = ("ACTIVE", "INACTIVE")      # the declared domain of customers.status


@view
def customers(spark: SparkSession, d: str) -> DataFrame:
    """customer_id, status, region.  nation/region are fixed-size dimensions."""
    c = scan(spark, d, "customer")
    n = scan(spark, d, "nation")
    r = scan(spark, d, "region")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.when(F.col("c_acctbal") >= 0, "ACTIVE").otherwise("INACTIVE").alias("status"),
            F.col("r_name").alias("region"),
        )
    )


@view
def shop_orders(spark: SparkSession, d: str) -> DataFrame:
    """order_id, customer_id, total_amount DECIMAL(15,2), order_date DATE."""
    o = scan(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("total_amount"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


@view
def departments(spark: SparkSession, d: str) -> DataFrame:
    """id, department_name, status ('CLOSED_DOWN' for region 0)."""
    n = scan(spark, d, "nation")
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("department_name"),
        F.when(F.col("n_regionkey") == 0, "CLOSED_DOWN").otherwise("OPEN").alias("status"),
    )


@view
def employees(spark: SparkSession, d: str) -> DataFrame:
    """The enterprise_employees table (plus `status`), one row per customer."""
    c = scan(spark, d, "customer")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    return c.select(
        (k + 1).alias("emp_id"),
        F.when(k % 10 == 9, F.lit(None).cast("bigint"))
        .otherwise(F.col("c_nationkey").cast("bigint")).alias("department_id"),
        F.lpad(k.cast("string"), 14, "0").alias("national_id"),
        F.col("c_name").alias("full_name"),
        F.when(seg.isin("BUILDING", "MACHINERY"), "FULL_TIME")
        .when(seg.isin("AUTOMOBILE", "HOUSEHOLD"), "PART_TIME")
        .otherwise("CONTRACTOR").alias("contract_type"),
        F.abs(F.col("c_acctbal")).cast("decimal(10,2)").alias("base_salary"),
        F.when(k % 3 == 0, "PENDING").when(k % 3 == 1, "TERMINATED")
        .otherwise("ACTIVE").alias("status"),
        F.date_add(_date("1970-01-01"), (k % 10000).cast("int")).alias("birth_date"),
        F.date_add(_date("2020-01-01"), (k % 1000).cast("int")).cast("timestamp").alias("created_at"),
        F.date_add(_date("2023-01-01"), (k % 700).cast("int")).cast("timestamp").alias("updated_at"),
        F.concat(F.lit('{"k": '), (k % 100).cast("string"), F.lit("}")).alias("metadata"),
    )


@view
def orders_batch(spark: SparkSession, d: str) -> DataFrame:
    """The batch shape over ALL orders (whole-table mutation input).  Keys are
    lpad(2 * customer): about half hit existing employees, half are new, and
    every key repeats once per order of that customer."""
    o = scan(spark, d, "orders")
    return o.select(
        F.lpad((F.col("o_custkey") * 2).cast("string"), 14, "0").alias("national_id"),
        F.concat(F.lit("N"), F.col("o_orderkey").cast("string")).alias("full_name"),
        F.when(F.col("o_orderkey") % 2 == 0, "FULL_TIME").otherwise("PART_TIME").alias("contract_type"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("base_salary"),
        F.col("o_orderdate").cast("date").alias("birth_date"),
        F.col("o_orderkey").alias("seq"),
    )


@view
def multi_key_batch(spark: SparkSession, d: str) -> DataFrame:
    """A batch over ALL customers whose rows meet each other and the employees
    on two unique keys: pairs share a national id, triples a name, in an order
    (``seq``) that has nothing to do with either."""
    c = scan(spark, d, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.lpad((F.floor(k / 2) * 3).cast("string"), 14, "0").alias("national_id"),
        F.concat(F.lit("Customer#"), F.lpad((F.floor(k / 3) * 5).cast("string"), 9, "0")).alias("full_name"),
        F.when(k % 2 == 0, "PART_TIME").otherwise("CONTRACTOR").alias("contract_type"),
        F.abs(F.col("c_acctbal")).cast("decimal(10,2)").alias("base_salary"),
        F.date_add(_date("1980-01-01"), (k % 10000).cast("int")).alias("birth_date"),
        (k * 7919 % 1000003).alias("seq"),
    )


@view
def employee_import(spark: SparkSession, d: str) -> DataFrame:
    """A staging batch of employee rows over ALL orders, with rule breakers
    derived from the data: repeated ids, NULL / 15-char / repeated national
    ids, 151-char names, an 'INTERN' contract, negative and oversized
    salaries, far-future timestamps, broken JSON and orphan departments."""
    o = scan(spark, d, "orders")
    k = F.col("o_orderkey")
    pr = F.col("o_orderpriority")
    ts = F.col("o_orderdate").cast("timestamp")
    return o.select(
        F.when(k % 50 == 1, k - 1).otherwise(k).alias("emp_id"),
        F.when(F.col("o_custkey") % 11 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("o_custkey") % 30).alias("department_id"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
        .when(k % 89 == 0, F.lpad(k.cast("string"), 15, "0"))
        .when(k % 83 == 0, F.lpad(F.col("o_custkey").cast("string"), 14, "0"))
        .otherwise(F.lpad(k.cast("string"), 14, "0")).alias("national_id"),
        F.when(k % 61 == 0, F.repeat(F.lit("x"), 151))
        .otherwise(F.concat(F.lit("Emp "), k.cast("string"))).alias("full_name"),
        F.when(pr == "1-URGENT", "FULL_TIME").when(pr == "2-HIGH", "PART_TIME")
        .when(pr == "3-MEDIUM", "CONTRACTOR").when(pr == "4-NOT SPECIFIED", "INTERN")
        .alias("contract_type"),
        (F.col("o_totalprice").cast("decimal(15,2)")
         * F.when(k % 101 == 0, F.lit(1000)).otherwise(F.lit(1)) - F.lit(100000))
        .cast("decimal(15,2)").alias("base_salary"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("birth_date"),
        ts.alias("created_at"),
        F.when(k % 71 == 0, F.lit("2040-01-01 00:00:00").cast("timestamp")).otherwise(ts).alias("updated_at"),
        F.when(k % 13 == 0, F.lit("{bad"))
        .otherwise(F.concat(F.lit('{"k": '), (k % 100).cast("string"), F.lit("}"))).alias("metadata"),
    )


@view
def legacy_import(spark: SparkSession, d: str) -> DataFrame:
    """legacy_hr_import_table: nat_id, name, salary, dob, is_processed (from orders)."""
    o = scan(spark, d, "orders")
    return o.select(
        F.lpad((F.col("o_orderkey") + 100000000).cast("string"), 14, "0").alias("nat_id"),
        F.concat(F.lit("Legacy "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("salary"),
        F.col("o_orderdate").cast("date").alias("dob"),
        (F.col("o_orderstatus") == "F").alias("is_processed"),
    )


# ---------------------------------------------------------------------------
# Sample rows written in the reference's insert and TCL scripts.
# (national_id, full_name, contract_type, base_salary, birth_date)
# ---------------------------------------------------------------------------
SAMPLE_ADMIN = ("29905051234567", "System Admin", "FULL_TIME", Decimal("8500.00"), dt.date(1999, 5, 5))
SAMPLE_BULK = [
    ("29901010000001", "Engineer A", "FULL_TIME", Decimal("9000.00"), dt.date(1999, 1, 1)),
    ("29901010000002", "Engineer B", "CONTRACTOR", Decimal("7500.00"), dt.date(1999, 1, 2)),
    ("29901010000003", "Engineer C", "PART_TIME", Decimal("4000.00"), dt.date(1999, 1, 3)),
]
# (national_id, full_name, base_salary, birth_date): contract_type is left to its default
SAMPLE_TCL = ("29906061122334", "Systems Architect", Decimal("9500.00"), dt.date(1999, 6, 6))

BATCH_SCHEMA = T.StructType([
    T.StructField("national_id", T.StringType()),
    T.StructField("full_name", T.StringType()),
    T.StructField("contract_type", T.StringType()),
    T.StructField("base_salary", T.DecimalType(10, 2)),
    T.StructField("birth_date", T.DateType()),
])
TCL_SCHEMA = T.StructType([f for f in BATCH_SCHEMA.fields if f.name != "contract_type"])


def sample_rows(spark: SparkSession, which: str = "admin") -> DataFrame:
    if which == "admin":
        return rows(spark, BATCH_SCHEMA, [SAMPLE_ADMIN])
    if which == "bulk":
        return rows(spark, BATCH_SCHEMA, SAMPLE_BULK)
    if which == "tcl":
        return rows(spark, TCL_SCHEMA, [SAMPLE_TCL])
    raise ValueError(which)
