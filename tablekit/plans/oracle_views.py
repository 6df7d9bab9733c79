"""SQL text of the fixture views, for the DuckDB oracle side.

Only the driver's own tables are registered in the oracle, so every oracle
query inlines the views it needs as CTEs via :func:`with_views`.
"""

from __future__ import annotations

VIEW_SQL = {
    "customers": """
SELECT c.c_custkey AS customer_id,
       CASE WHEN c.c_acctbal >= 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status,
       r.r_name AS region
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "shop_orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CAST(o_totalprice AS DECIMAL(15,2)) AS total_amount, CAST(o_orderdate AS DATE) AS order_date
FROM orders""",
    "departments": """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS department_name,
       CASE WHEN n_regionkey = 0 THEN 'CLOSED_DOWN' ELSE 'OPEN' END AS status
FROM nation""",
    "employees": """
SELECT c_custkey + 1 AS emp_id,
       CASE WHEN c_custkey % 10 = 9 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS department_id,
       lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS national_id,
       c_name AS full_name,
       CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'FULL_TIME'
            WHEN c_mktsegment IN ('AUTOMOBILE','HOUSEHOLD') THEN 'PART_TIME'
            ELSE 'CONTRACTOR' END AS contract_type,
       CAST(abs(c_acctbal) AS DECIMAL(10,2)) AS base_salary,
       CASE WHEN c_custkey % 3 = 0 THEN 'PENDING' WHEN c_custkey % 3 = 1 THEN 'TERMINATED'
            ELSE 'ACTIVE' END AS status,
       DATE '1970-01-01' + CAST(c_custkey % 10000 AS INT) AS birth_date,
       CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INT) AS TIMESTAMP) AS created_at,
       CAST(DATE '2023-01-01' + CAST(c_custkey % 700 AS INT) AS TIMESTAMP) AS updated_at,
       concat('{"k": ', CAST(c_custkey % 100 AS VARCHAR), '}') AS metadata
FROM customer""",
    "orders_batch": """
SELECT lpad(CAST(o_custkey * 2 AS VARCHAR), 14, '0') AS national_id,
       concat('N', CAST(o_orderkey AS VARCHAR)) AS full_name,
       CASE WHEN o_orderkey % 2 = 0 THEN 'FULL_TIME' ELSE 'PART_TIME' END AS contract_type,
       CAST(o_totalprice AS DECIMAL(10,2)) AS base_salary,
       CAST(o_orderdate AS DATE) AS birth_date,
       o_orderkey AS seq
FROM orders""",
    "multi_key_batch": """
SELECT lpad(CAST(c_custkey // 2 * 3 AS VARCHAR), 14, '0') AS national_id,
       concat('Customer#', lpad(CAST(c_custkey // 3 * 5 AS VARCHAR), 9, '0')) AS full_name,
       CASE WHEN c_custkey % 2 = 0 THEN 'PART_TIME' ELSE 'CONTRACTOR' END AS contract_type,
       CAST(abs(c_acctbal) AS DECIMAL(10,2)) AS base_salary,
       DATE '1980-01-01' + CAST(c_custkey % 10000 AS INT) AS birth_date,
       c_custkey * 7919 % 1000003 AS seq
FROM customer""",
    "employee_import": """
SELECT CASE WHEN o_orderkey % 50 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS emp_id,
       CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_custkey % 30 END AS department_id,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            WHEN o_orderkey % 89 = 0 THEN lpad(CAST(o_orderkey AS VARCHAR), 15, '0')
            WHEN o_orderkey % 83 = 0 THEN lpad(CAST(o_custkey AS VARCHAR), 14, '0')
            ELSE lpad(CAST(o_orderkey AS VARCHAR), 14, '0') END AS national_id,
       CASE WHEN o_orderkey % 61 = 0 THEN repeat('x', 151) ELSE concat('Emp ', CAST(o_orderkey AS VARCHAR)) END AS full_name,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'FULL_TIME' WHEN '2-HIGH' THEN 'PART_TIME'
            WHEN '3-MEDIUM' THEN 'CONTRACTOR' WHEN '4-NOT SPECIFIED' THEN 'INTERN' END AS contract_type,
       CAST(CAST(o_totalprice AS DECIMAL(15,2)) * (CASE WHEN o_orderkey % 101 = 0 THEN 1000 ELSE 1 END) - 100000
            AS DECIMAL(15,2)) AS base_salary,
       o_orderstatus AS status,
       CAST(o_orderdate AS DATE) AS birth_date,
       CAST(o_orderdate AS TIMESTAMP) AS created_at,
       CASE WHEN o_orderkey % 71 = 0 THEN TIMESTAMP '2040-01-01 00:00:00' ELSE CAST(o_orderdate AS TIMESTAMP) END AS updated_at,
       CASE WHEN o_orderkey % 13 = 0 THEN '{bad' ELSE concat('{"k": ', CAST(o_orderkey % 100 AS VARCHAR), '}') END AS metadata
FROM orders""",
    "legacy_import": """
SELECT lpad(CAST(o_orderkey + 100000000 AS VARCHAR), 14, '0') AS nat_id,
       concat('Legacy ', CAST(o_orderkey AS VARCHAR)) AS name,
       CAST(o_totalprice AS DECIMAL(10,2)) AS salary,
       CAST(o_orderdate AS DATE) AS dob,
       (o_orderstatus = 'F') AS is_processed
FROM orders""",
}


def with_views(*names: str) -> str:
    """'WITH a AS (...), b AS (...)' -- continue with ', x AS (...)' or ' SELECT'."""
    parts = [f"{n} AS ({VIEW_SQL[n]}\n)" for n in names]
    return "WITH " + ",\n".join(parts)
