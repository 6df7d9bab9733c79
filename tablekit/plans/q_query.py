"""Registered queries for projections, joins, aggregates, windows, sorts, pages."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tablekit.operators import query as Q
from tablekit.operators.ids import assign_ids
from tablekit.operators.window import rank_within, top_k
from tablekit.plans.catalog import register
from tablekit.plans.flagship import FLAGSHIP_SQL, flagship, high_value_customers
from tablekit.plans.oracle_views import with_views
from tablekit.sources import fixtures as fx
from tablekit.sources.tables import scan

register("flagship", with_views("customers", "shop_orders") + FLAGSHIP_SQL,
         "S1 P1 P3 P4 P5 P10 J1 A1 A2 A4 A7 W1 W7 O1 O2")(flagship)


# --- P: projections, literals, filters, CASE, BETWEEN, DISTINCT -------------------

@register("project_filter", with_views("employees") + """
SELECT emp_id AS id, full_name AS name, 'EMP' AS kind,
       CASE WHEN base_salary >= 5000 THEN 'HIGH' WHEN base_salary >= 1000 THEN 'MID' END AS band,
       CAST(base_salary * 1.10 AS DECIMAL(10,2)) AS raised,
       CAST(base_salary + 500.00 AS DECIMAL(10,2)) AS bonus
FROM employees
WHERE contract_type = 'FULL_TIME' AND base_salary BETWEEN 100 AND 9000 AND department_id IS NOT NULL
""", "P1 P2 P3 P5 P6 P7 P8 P9")
def project_filter(spark, d):
    e = fx.employees(spark, d)
    s = F.col("base_salary")
    return e.filter((F.col("contract_type") == "FULL_TIME") & s.between(100, 9000)
                    & F.col("department_id").isNotNull()).select(
        F.col("emp_id").alias("id"), F.col("full_name").alias("name"), F.lit("EMP").alias("kind"),
        F.when(s >= 5000, "HIGH").when(s >= 1000, "MID").alias("band"),
        (s * F.lit(Decimal("1.10"))).cast("decimal(10,2)").alias("raised"),
        (s + F.lit(Decimal("500.00"))).cast("decimal(10,2)").alias("bonus"))


@register("date_range_filter", with_views("shop_orders") + """
SELECT order_id, customer_id, total_amount, order_date FROM shop_orders
WHERE order_date >= DATE '1999-01-01' AND order_date < DATE '2000-01-01' AND total_amount > 250000.00
""", "P4 P5 P6")
def date_range_filter(spark, d):
    o = fx.shop_orders(spark, d)
    return o.filter((F.col("order_date") >= F.lit(dt.date(1999, 1, 1)))
                    & (F.col("order_date") < F.lit(dt.date(2000, 1, 1)))
                    & (F.col("total_amount") > F.lit(Decimal("250000.00"))))


@register("distinct_projection", with_views("employees") + """
SELECT DISTINCT department_id, contract_type FROM employees
""", "P11")
def distinct_projection(spark, d):
    return fx.employees(spark, d).select("department_id", "contract_type").distinct()


# --- J: joins ----------------------------------------------------------------------

_ORD_AGG_SQL = """
, agg AS (SELECT o.customer_id, CAST(sum(o.total_amount) AS DECIMAL(25,2)) AS total_spent, count(*) AS order_count
          FROM shop_orders o WHERE year(o.order_date) >= 1999 GROUP BY ALL)
"""


def _ord_agg(spark, d):
    o = fx.shop_orders(spark, d).filter(F.col("order_date") >= F.lit(dt.date(1999, 1, 1)))
    return o.groupBy("customer_id").agg(
        F.sum("total_amount").cast("decimal(25,2)").alias("total_spent"),
        F.count("order_id").alias("order_count"))


@register("join_left", with_views("customers", "shop_orders") + _ORD_AGG_SQL + """
SELECT c.customer_id, c.region, a.total_spent, a.order_count
FROM customers c LEFT JOIN agg a ON c.customer_id = a.customer_id
""", "J2")
def join_left(spark, d):
    c = fx.customers(spark, d).select("customer_id", "region")
    return Q.left_join(c, _ord_agg(spark, d), "customer_id")


@register("join_right", with_views("customers", "shop_orders") + _ORD_AGG_SQL + """
SELECT a.customer_id, a.total_spent, a.order_count, c.region
FROM (SELECT * FROM customers WHERE status = 'ACTIVE') c RIGHT JOIN agg a ON c.customer_id = a.customer_id
""", "J3")
def join_right(spark, d):
    c = fx.customers(spark, d).filter(F.col("status") == "ACTIVE").select("customer_id", "region")
    # RIGHT JOIN written as the swapped LEFT join; keep the right table's key
    return Q.right_join(c, _ord_agg(spark, d), "customer_id") \
        .select("customer_id", "total_spent", "order_count", "region")


_FULL_SQL = with_views("employees", "departments") + """
SELECT e.emp_id, e.department_id, d.id AS dept_id, d.department_name
FROM (SELECT * FROM employees WHERE contract_type = 'FULL_TIME') e
FULL OUTER JOIN (SELECT * FROM departments WHERE status = 'OPEN') d ON e.department_id = d.id
"""


def _full_inputs(spark, d):
    e = fx.employees(spark, d).filter(F.col("contract_type") == "FULL_TIME") \
        .select("emp_id", "department_id")
    dep = fx.departments(spark, d).filter(F.col("status") == "OPEN") \
        .select(F.col("id").alias("dept_id"), "department_name")
    return e, dep


@register("join_full", _FULL_SQL, "J4")
def join_full(spark, d):
    e, dep = _full_inputs(spark, d)
    return Q.full_join(e, dep, "department_id", "dept_id").select("emp_id", "department_id", "dept_id", "department_name")


@register("join_full_union", _FULL_SQL, "J5 U1")
def join_full_union(spark, d):
    e, dep = _full_inputs(spark, d)
    return Q.full_via_union(e, dep, "department_id", "dept_id") \
        .select("emp_id", "department_id", "dept_id", "department_name")


@register("join_cross_grid", with_views("customers") + """
, regions AS (SELECT DISTINCT region FROM customers),
  statuses AS (SELECT DISTINCT status FROM customers),
  counts AS (SELECT region, status, COUNT(*) AS n FROM customers GROUP BY region, status)
SELECT g.region, g.status, COALESCE(c.n, 0) AS n_customers
FROM (SELECT * FROM regions CROSS JOIN statuses) g
LEFT JOIN counts c ON g.region = c.region AND g.status = c.status
""", "J6 A1")
def join_cross_grid(spark, d):
    """The dense (region x status) grid over the declared status domain."""
    return Q.grid(fx.customers(spark, d), "region", "status", fx.CUSTOMER_STATUSES, "n_customers")


@register("join_semi", with_views("employees", "departments") + """
SELECT e.emp_id, e.full_name FROM employees e
WHERE EXISTS (SELECT 1 FROM departments d WHERE d.id = e.department_id AND d.department_name = 'NATION_5')
  AND e.contract_type = 'FULL_TIME'
""", "J7")
def join_semi(spark, d):
    e = fx.employees(spark, d).filter(F.col("contract_type") == "FULL_TIME")
    dep = fx.departments(spark, d).filter(F.col("department_name") == "NATION_5") \
        .select(F.col("id").alias("department_id"))
    return Q.semi(e, dep, "department_id").select("emp_id", "full_name")


@register("join_anti", with_views("employees", "departments") + """
SELECT e.emp_id, e.department_id FROM employees e
WHERE NOT EXISTS (SELECT 1 FROM departments d WHERE d.id = e.department_id AND d.status = 'OPEN')
""", "J8")
def join_anti(spark, d):
    e = fx.employees(spark, d)
    dep = fx.departments(spark, d).filter(F.col("status") == "OPEN") \
        .select(F.col("id").alias("department_id"))
    return Q.anti(e, dep, "department_id").select("emp_id", "department_id")


# --- A: aggregates ---------------------------------------------------------------

@register("agg_summary", with_views("customers", "shop_orders") + """
SELECT c.region, COUNT(*) AS n_rows, COUNT(o.total_amount) AS n_values,
       CAST(SUM(o.total_amount) AS DECIMAL(25,2)) AS sum_value,
       CAST(AVG(o.total_amount) AS DECIMAL(19,6)) AS avg_value,
       MIN(o.total_amount) AS min_value, MAX(o.total_amount) AS max_value
FROM customers c LEFT JOIN shop_orders o
  ON c.customer_id = o.customer_id AND o.order_date >= DATE '2001-01-01'
GROUP BY c.region
""", "A1 A2 A3 A4 A5 A6")
def agg_summary(spark, d):
    c = fx.customers(spark, d)
    o = fx.shop_orders(spark, d).filter(F.col("order_date") >= F.lit(dt.date(2001, 1, 1)))
    j = c.join(o, "customer_id", "left")
    return Q.summarize(j, ["region"], "total_amount").select(
        "region", "n_rows", "n_values",
        F.col("sum_value").cast("decimal(25,2)").alias("sum_value"),
        F.col("avg_value").cast("decimal(19,6)").alias("avg_value"),
        "min_value", "max_value")


@register("agg_nulls", with_views("employees") + """
SELECT contract_type, COUNT(*) AS n_rows, COUNT(department_id) AS n_values,
       CAST(SUM(department_id) AS BIGINT) AS sum_value, CAST(AVG(department_id) AS DOUBLE) AS avg_value,
       MIN(department_id) AS min_value, MAX(department_id) AS max_value
FROM employees GROUP BY contract_type
""", "A3 A4 A5 A6")
def agg_nulls(spark, d):
    e = fx.employees(spark, d)
    return Q.summarize(e, ["contract_type"], "department_id")


@register("agg_having", with_views("shop_orders") + """
SELECT * FROM (
  SELECT o.customer_id, CAST(sum(o.total_amount) AS DECIMAL(25,2)) AS total_spent, count(*) AS order_count
  FROM shop_orders o WHERE year(o.order_date) >= 1999 GROUP BY ALL) t
WHERE t.total_spent > 5000
""", "A1 A2 A4 A7 P10")
def agg_having(spark, d):
    h = high_value_customers(fx.shop_orders(spark, d))
    return h.select("customer_id", F.col("total_spent").cast("decimal(25,2)").alias("total_spent"),
                    "order_count")


# --- W: windows ------------------------------------------------------------------

_WINDOW_RANKINGS_SQL = with_views("customers", "shop_orders") + _ORD_AGG_SQL + """
, j AS (SELECT c.region, c.customer_id, a.total_spent FROM customers c JOIN agg a USING (customer_id))
SELECT region, customer_id, total_spent,
  ROW_NUMBER() OVER (PARTITION BY region ORDER BY total_spent DESC, customer_id) AS rn,
  RANK() OVER (PARTITION BY region ORDER BY total_spent DESC) AS rnk,
  DENSE_RANK() OVER (PARTITION BY region ORDER BY total_spent DESC) AS drnk,
  NTILE(4) OVER (PARTITION BY region ORDER BY total_spent DESC, customer_id) AS quartile,
  LAG(customer_id, 1) OVER (PARTITION BY region ORDER BY total_spent DESC, customer_id) AS prev_customer,
  LEAD(customer_id, 1) OVER (PARTITION BY region ORDER BY total_spent DESC, customer_id) AS next_customer
FROM j
"""


@register("window_rankings", _WINDOW_RANKINGS_SQL, "W1 W2 W3 W4 W5 W6")
def window_rankings(spark, d):
    c = fx.customers(spark, d)
    j = c.join(_ord_agg(spark, d), "customer_id").select("region", "customer_id", "total_spent")
    return rank_within(
        j, ["region"], ["total_spent DESC"], ["customer_id"],
        row_number="rn", rank="rnk", dense_rank="drnk", ntile=("quartile", 4),
        lag=[("prev_customer", "customer_id", 1)], lead=[("next_customer", "customer_id", 1)],
    ).select("region", "customer_id", "total_spent", "rn", "rnk", "drnk", "quartile",
             "prev_customer", "next_customer")


@register("window_rankings_split", _WINDOW_RANKINGS_SQL, "W1 W2 W3 W4 W5 W6")
def window_rankings_split(spark, d):
    """The same report with an explicit number of ranges."""
    c = fx.customers(spark, d)
    j = c.join(_ord_agg(spark, d), "customer_id").select("region", "customer_id", "total_spent")
    return rank_within(
        j, ["region"], ["total_spent DESC"], ["customer_id"],
        row_number="rn", rank="rnk", dense_rank="drnk", ntile=("quartile", 4),
        lag=[("prev_customer", "customer_id", 1)], lead=[("next_customer", "customer_id", 1)],
        num_partitions=5,
    ).select("region", "customer_id", "total_spent", "rn", "rnk", "drnk", "quartile",
             "prev_customer", "next_customer")


@register("window_ties", with_views("employees") + """
SELECT emp_id, contract_type, status,
  RANK() OVER (PARTITION BY contract_type ORDER BY status) AS rnk,
  DENSE_RANK() OVER (PARTITION BY contract_type ORDER BY status) AS drnk,
  NTILE(7) OVER (PARTITION BY contract_type ORDER BY status, emp_id) AS bucket
FROM employees
""", "W2 W3 W4")
def window_ties(spark, d):
    e = fx.employees(spark, d).select("emp_id", "contract_type", "status")
    return rank_within(e, ["contract_type"], ["status"], ["emp_id"], rank="rnk",
                       dense_rank="drnk", ntile=("bucket", 7)) \
        .select("emp_id", "contract_type", "status", "rnk", "drnk", "bucket")


@register("window_lag_lead_orders", with_views("shop_orders") + """
SELECT order_id, customer_id, order_date,
  LAG(order_date, 1) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS prev_date,
  LEAD(total_amount, 2) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS next2_amount
FROM shop_orders
""", "W5 W6")
def window_lag_lead_orders(spark, d):
    o = fx.shop_orders(spark, d)
    return rank_within(o, ["customer_id"], ["order_date"], ["order_id"],
                       lag=[("prev_date", "order_date", 1)], lead=[("next2_amount", "total_amount", 2)]) \
        .select("order_id", "customer_id", "order_date", "prev_date", "next2_amount")


@register("top_k_per_region", with_views("customers", "shop_orders") + _ORD_AGG_SQL + """
SELECT * FROM (
  SELECT c.region, c.customer_id, a.total_spent,
    ROW_NUMBER() OVER (PARTITION BY c.region ORDER BY a.total_spent DESC, c.customer_id) AS rank
  FROM customers c JOIN agg a USING (customer_id)) t
WHERE rank <= 3
""", "W8 W7")
def top_k_per_region(spark, d):
    c = fx.customers(spark, d)
    j = c.join(_ord_agg(spark, d), "customer_id").select("region", "customer_id", "total_spent")
    return top_k(j, ["region"], ["total_spent DESC", "customer_id"], 3)


@register("page_deep", with_views("customers", "shop_orders") + _ORD_AGG_SQL + """
, placed AS (
  SELECT c.region, c.customer_id, a.total_spent,
    ROW_NUMBER() OVER (PARTITION BY c.region ORDER BY a.total_spent DESC, c.customer_id) AS rank
  FROM customers c JOIN agg a USING (customer_id))
SELECT * FROM placed ORDER BY region, rank LIMIT 100 OFFSET 500
""", "W8 O2")
def page_deep(spark, d):
    """A page far behind the first: top-k in two stages holds for any depth."""
    c = fx.customers(spark, d)
    j = c.join(_ord_agg(spark, d), "customer_id").select("region", "customer_id", "total_spent")
    ranked = top_k(j, ["region"], ["total_spent DESC", "customer_id"], 5100)
    return Q.page(ranked, ["region", "rank"], 100, 500)


# --- O: sorts and pages ---------------------------------------------------------------

@register("order_multi_key", with_views("employees") + """
SELECT emp_id, department_id, base_salary,
       ROW_NUMBER() OVER (ORDER BY department_id ASC NULLS FIRST, base_salary DESC, emp_id) AS position
FROM employees
""", "O1 V15")
def order_multi_key(spark, d):
    """O1 over the whole table: every row's position in the multi-key order
    (ASC puts NULLs first, DESC last), from the distributed global numbering."""
    e = fx.employees(spark, d).select("emp_id", "department_id", "base_salary")
    return assign_ids(e, ["department_id", "base_salary DESC", "emp_id"], start=1, name="position")


@register("page_offset", with_views("shop_orders") + """
SELECT order_id, total_amount FROM shop_orders
ORDER BY total_amount DESC, order_id LIMIT 100 OFFSET 200
""", "O2")
def page_offset(spark, d):
    o = fx.shop_orders(spark, d).select("order_id", "total_amount")
    return Q.page(o, ["total_amount DESC", "order_id"], 100, 200)


@register("page_wide_rows", """
SELECT doc_id, n_chars, lang, text FROM documents
ORDER BY n_chars DESC, doc_id LIMIT 20 OFFSET 40
""", "O2")
def page_wide_rows(spark, d):
    """O2 over rows with a LOB column: page on (n_chars, doc_id) only, join the
    texts back for the 20 rows of the page."""
    docs = scan(spark, d, "documents").select("doc_id", "n_chars", "lang", "text")
    return Q.page_narrow(docs, ["n_chars DESC", "doc_id"], 20, 40, "doc_id")


@register("page_keyset", with_views("shop_orders") + """
SELECT order_id, total_amount FROM shop_orders
WHERE total_amount < 400000.00 OR (total_amount = 400000.00 AND order_id > 0)
ORDER BY total_amount DESC, order_id LIMIT 100
""", "O4")
def page_keyset(spark, d):
    o = fx.shop_orders(spark, d).select("order_id", "total_amount")
    return Q.page_after(o, ["total_amount DESC", "order_id"], [Decimal("400000.00"), 0], 100)


@register("oldest_chunk", with_views("employees") + """
SELECT emp_id, status, created_at::TIMESTAMP AS created_at FROM employees WHERE status = 'PENDING'
ORDER BY created_at, emp_id LIMIT 100
""", "O3")
def oldest_chunk(spark, d):
    e = fx.employees(spark, d)
    return Q.oldest(e, F.col("status") == "PENDING", ["created_at"], "emp_id", 100) \
        .select("emp_id", "status", F.col("created_at").cast("timestamp_ntz").alias("created_at"))


@register("union_distinct", with_views("customers", "employees") + """
SELECT customer_id AS id FROM customers WHERE status = 'ACTIVE'
UNION SELECT emp_id - 1 AS id FROM employees WHERE contract_type = 'FULL_TIME'
""", "U1")
def union_distinct(spark, d):
    a = fx.customers(spark, d).filter(F.col("status") == "ACTIVE").select(F.col("customer_id").alias("id"))
    b = fx.employees(spark, d).filter(F.col("contract_type") == "FULL_TIME") \
        .select((F.col("emp_id") - 1).alias("id"))
    return Q.union(a, b, distinct=True)


@register("scan_lineitem_agg", """
SELECT l_returnflag, l_linestatus, CAST(SUM(l_quantity) AS DOUBLE) AS sum_qty,
       COUNT(*) AS n_rows, COUNT(DISTINCT l_orderkey) AS n_orders
FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-09-02 00:00:00'
GROUP BY l_returnflag, l_linestatus
""", "S1 A1")
def scan_lineitem_agg(spark, d):
    li = scan(spark, d, "lineitem")
    return li.filter(F.col("l_shipdate") < F.expr("TIMESTAMP_NTZ '1998-09-02 00:00:00'")) \
        .groupBy("l_returnflag", "l_linestatus").agg(
            F.sum("l_quantity").alias("sum_qty"), F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct("l_orderkey").alias("n_orders"))
