"""Registered queries for constraints and data quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tablekit.operators import quality as V
from tablekit.operators import text as X
from tablekit.operators.fk_graph import delete_cascade
from tablekit.operators.ids import assign_ids
from tablekit.plans.catalog import register
from tablekit.plans.oracle_views import with_views
from tablekit.sources import fixtures as fx
from tablekit.sources.tables import scan
from tablekit.spec import CONTRACT_TYPES, EMPLOYEES, ForeignKey, TableSpec, col

_K = "CAST(emp_id AS VARCHAR)"
_RANGE = ("< TIMESTAMP '1970-01-01 00:00:01'", "> TIMESTAMP '2038-01-19 03:14:07'")
_ROW_RULES = [
    ("not_null:emp_id", "emp_id IS NULL"),
    ("unsigned:emp_id", "emp_id < 0"),
    ("unsigned:department_id", "department_id < 0"),
    ("not_null:national_id", "national_id IS NULL"),
    ("length:national_id", "length(national_id) > 14"),
    ("not_null:full_name", "full_name IS NULL"),
    ("length:full_name", "length(full_name) > 150"),
    ("not_null:contract_type", "contract_type IS NULL"),
    ("enum:contract_type", "contract_type NOT IN ('FULL_TIME','PART_TIME','CONTRACTOR')"),
    ("not_null:base_salary", "base_salary IS NULL"),
    ("type:base_salary", "base_salary IS NOT NULL AND TRY_CAST(base_salary AS DECIMAL(10,2)) IS NULL"),
    ("not_null:birth_date", "birth_date IS NULL"),
    ("range:created_at", f"created_at {_RANGE[0]} OR created_at {_RANGE[1]}"),
    ("range:updated_at", f"updated_at {_RANGE[0]} OR updated_at {_RANGE[1]}"),
    ("json:metadata", "metadata IS NOT NULL AND NOT json_valid(metadata)"),
    ("check:chk_salary", "base_salary < 0"),
]
_ROW_SQL = "\nUNION ALL ".join(
    f"SELECT '{name}' AS rule, {_K} AS key, CAST(1 AS BIGINT) AS n FROM employee_import WHERE {cond}"
    for name, cond in _ROW_RULES)
_CHECK_SQL = with_views("employee_import", "departments") + f"""
, v AS (
{_ROW_SQL}
UNION ALL SELECT 'primary_key', COALESCE({_K}, 'NULL'), COUNT(*) FROM employee_import
          GROUP BY emp_id HAVING COUNT(*) > 1
UNION ALL SELECT 'unique:uk_national_id', national_id, COUNT(*) FROM employee_import
          WHERE national_id IS NOT NULL GROUP BY national_id HAVING COUNT(*) > 1
UNION ALL SELECT 'unique:uk_email', full_name, COUNT(*) FROM employee_import
          WHERE full_name IS NOT NULL GROUP BY full_name HAVING COUNT(*) > 1
UNION ALL SELECT 'fk:fk_employee_department', {_K}, 1 FROM employee_import
          WHERE department_id IS NOT NULL AND department_id NOT IN (SELECT id FROM departments))
"""


def _check(spark, d):
    return V.check(fx.employee_import(spark, d), EMPLOYEES,
                   parents={"departments": fx.departments(spark, d)})


@register("check_constraints", _CHECK_SQL + "SELECT rule, key, n FROM v",
          "V1 V3 V4 V5 V6 V8 V9 V10 V11 V12 V13")
def check_constraints(spark, d):
    return _check(spark, d)


@register("check_summary", _CHECK_SQL + """
SELECT rule, COUNT(*) AS violations, CAST(SUM(n) AS BIGINT) AS rows_involved FROM v GROUP BY rule
""", "V1 V3 V4 V5 V6 V8 V9 V10 V11 V12 V13")
def check_summary(spark, d):
    return _check(spark, d).groupBy("rule").agg(F.count(F.lit(1)).alias("violations"),
                                                 F.sum("n").alias("rows_involved"))


@register("enforce_ignore", with_views("employee_import") + "SELECT emp_id FROM employee_import WHERE NOT ("
          + " OR ".join(f"COALESCE({c}, FALSE)" for _, c in _ROW_RULES) + ")", "V14")
def enforce_ignore(spark, d):
    clean, _ = V.enforce(fx.employee_import(spark, d), EMPLOYEES, mode="ignore")
    return clean.select("emp_id")


@register("enum_ordinal", with_views("employees") + """
SELECT emp_id, contract_type,
       CAST(CASE contract_type WHEN 'FULL_TIME' THEN 1 WHEN 'PART_TIME' THEN 2
                               WHEN 'CONTRACTOR' THEN 3 ELSE 0 END AS BIGINT) AS contract_type_ordinal
FROM employees
""", "V6")
def enum_ordinal(spark, d):
    e = fx.employees(spark, d).select("emp_id", "contract_type")
    return V.enum_ordinal(e, "contract_type", CONTRACT_TYPES)


@register("set_domain", """
, tags AS (SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS tags
           FROM events GROUP BY user_id)
SELECT user_id, tags,
       len(list_filter(string_split(tags, ','), lambda x: x NOT IN ('click', 'view', 'purchase'))) = 0 AS in_domain
FROM tags
""".replace("\n, tags", "WITH tags", 1), "V7")
def set_domain(spark, d):
    tags = _tags(spark, d)
    return tags.withColumn("in_domain", ~V.any_broken(TAGS, tags))


@register("set_domain_check", """
WITH tags AS (SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS tags
              FROM events GROUP BY user_id)
SELECT 'set:tags' AS rule, CAST(user_id AS VARCHAR) AS key, CAST(1 AS BIGINT) AS n
FROM tags WHERE len(list_filter(string_split(tags, ','), lambda x: x NOT IN ('click', 'view', 'purchase'))) > 0
""", "V7")
def set_domain_check(spark, d):
    """The SET rule as ``check`` reports it."""
    return V.check(_tags(spark, d), TAGS)


#: users with the kinds of their events as a SET column
TAGS = TableSpec("user_tags", (col("user_id", "bigint"), col("tags", "string", set_values=("click", "view", "purchase"))),
                 primary_key=("user_id",))


def _tags(spark, d):
    return scan(spark, d, "events").groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("tags"))


@register("json_field", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       props IS NOT NULL AND json_valid(props) AS valid_json
FROM events
""", "V11")
def json_field(spark, d):
    ev = scan(spark, d, "events").select("event_id", "props")
    out = V.json_field(ev, "props", "$.k", "int", "k")
    return out.select("event_id", "k",
                      (F.col("props").isNotNull() & F.try_parse_json("props").isNotNull()).alias("valid_json"))


@register("json_paths", r"""
WITH p AS (SELECT '{"type":"' || event_type || '","user":{"id":' || user_id || ',"tags":["' || event_type || '",' || user_id
                  || ',[]]},"value":' || CASE WHEN value > 20 THEN CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) ELSE 'null' END
                  || ',"props":' || props || '}' AS payload FROM events),
     nodes AS (SELECT regexp_replace(j.fullkey, '\[[0-9]+\]', '[*]', 'g') AS path, j.type AS t
               FROM p, json_tree(p.payload) j)
SELECT path, CASE WHEN t = 'VARCHAR' THEN 'STRING' WHEN t IN ('UBIGINT', 'BIGINT') THEN 'BIGINT'
                  WHEN t = 'DOUBLE' THEN 'DECIMAL' WHEN t = 'NULL' THEN 'VOID' ELSE t END AS type, count(*) AS n
FROM nodes GROUP BY 1, 2
""", "V11")
def json_paths(spark, d):
    """Paths and types of event payloads: objects, arrays, nulls, numbers."""
    c = F.col
    value = F.when(c("value") > 20, c("value").cast("decimal(12,2)").cast("string")).otherwise("null")
    payload = F.concat(F.lit('{"type":"'), c("event_type"), F.lit('","user":{"id":'), c("user_id"), F.lit(',"tags":["'),
                       c("event_type"), F.lit('",'), c("user_id"), F.lit(',[]]},"value":'), value,
                       F.lit(',"props":'), c("props"), F.lit("}"))
    return V.json_paths(scan(spark, d, "events").select(payload.alias("payload")), "payload")


@register("to_utc", """
SELECT event_id, ts, timezone('UTC', timezone('America/New_York', ts)) AS ts_utc FROM events
""", "V12")
def to_utc(spark, d):
    ev = scan(spark, d, "events").select("event_id", "ts")
    return V.to_utc(ev, "ts", "America/New_York", "ts_utc")


@register("lob_class", """
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes,
       CASE WHEN strlen(text) <= 255 THEN 'TINYTEXT' WHEN strlen(text) <= 65535 THEN 'TEXT'
            WHEN strlen(text) <= 16777215 THEN 'MEDIUMTEXT' WHEN strlen(text) <= 4294967295 THEN 'LONGTEXT'
            ELSE 'TOO_LARGE' END AS lob_class
FROM documents
""", "V16")
def lob_class(spark, d):
    docs = scan(spark, d, "documents").select("doc_id", "text")
    return V.lob_class(docs, "text").select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"),
                                            "lob_class")


@register("assign_ids", """
SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) + 1000 AS id FROM orders
""", "V15")
def assign_ids_orders(spark, d):
    o = scan(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return assign_ids(o, ["o_orderdate", "o_orderkey"], start=1001).select("o_orderkey", "id")


@register("assign_ids_split", """
SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) + 1000 AS id FROM orders
""", "V15")
def assign_ids_split(spark, d):
    """V15 forced onto the range-partition + prefix-sum path used beyond the bound."""
    o = scan(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return assign_ids(o, ["o_orderdate", "o_orderkey"], start=1001, num_partitions=7).select("o_orderkey", "id")


@register("unique_ai_ci", r"""
WITH w AS (SELECT DISTINCT lang, unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS word FROM documents)
SELECT 'unique:uk_word' AS rule, lang || '|' || min(word) AS key, count(*) AS n
FROM w WHERE lang IS NOT NULL
GROUP BY lang, replace(strip_accents(lower(word)), 'ß', 'ss') HAVING count(*) > 1
""", "V4 T1")
def unique_ai_ci(spark, d):
    """UNIQUE (lang, word) over the vocabulary, the word declared accent and
    case insensitive."""
    spec = TableSpec("vocabulary", (col("lang", "string"), col("word", "string", collation="ai_ci")),
                     unique=(("uk_word", ("lang", "word")),))
    docs = scan(spark, d, "documents").select("lang", X.tokens("text", lower=False).alias("__t"))
    vocab = X.explode_tokens(docs, "__t", "word").select("lang", "word").distinct()
    return V.check(vocab, spec)


@register("fk_cascade_tree", """
WITH RECURSIVE c AS (SELECT c_custkey, c_nationkey, nullif(c_custkey // 7, 0) AS referrer FROM customer),
gone_n AS (SELECT n_nationkey FROM nation WHERE n_regionkey = 1),
gone_c AS (
  SELECT c_custkey FROM c WHERE c_nationkey IN (SELECT n_nationkey FROM gone_n)
  UNION
  SELECT c.c_custkey FROM c JOIN gone_c g ON c.referrer = g.c_custkey)
SELECT 'region' AS tbl, r_regionkey AS id, CAST(NULL AS BIGINT) AS parent FROM region WHERE r_regionkey <> 1
UNION ALL SELECT 'nation', n_nationkey, n_regionkey FROM nation WHERE n_regionkey <> 1
UNION ALL SELECT 'customer', c_custkey, c_nationkey FROM c WHERE c_custkey NOT IN (SELECT c_custkey FROM gone_c)
UNION ALL SELECT 'orders', o_orderkey,
  CASE WHEN o_custkey IN (SELECT c_custkey FROM gone_c) THEN NULL ELSE o_custkey END FROM orders
""", "F1 F2 F3")
def fk_cascade_tree(spark, d):
    """DELETE of a region: three levels of tables, customers who refer to the
    customer that brought them, orders that keep no customer."""
    def table(name, *refs):
        frame = scan(spark, d, name)
        return frame, TableSpec(name, tuple(col(f.name, f.dataType.simpleString()) for f in frame.schema),
                                primary_key=(frame.columns[0],), foreign_keys=refs)

    customers, spec = table(
        "customer",
        ForeignKey("fk_nation", ("c_nationkey",), "nation", ("n_nationkey",), on_delete="cascade"),
        ForeignKey("fk_referrer", ("referrer",), "customer", ("c_custkey",), on_delete="cascade"))
    customers = customers.withColumn("referrer", F.expr("nullif(c_custkey div 7, 0)"))
    left = delete_cascade({
        "region": table("region"),
        "nation": table("nation", ForeignKey("fk_region", ("n_regionkey",), "region", ("r_regionkey",),
                                             on_delete="cascade")),
        "customer": (customers, spec),
        "orders": table("orders", ForeignKey("fk_customer", ("o_custkey",), "customer", ("c_custkey",),
                                             on_delete="set_null")),
    }, "region", F.col("r_regionkey") == 1)
    shown = {"region": F.lit(None), "nation": F.col("n_regionkey"), "customer": F.col("c_nationkey"),
             "orders": F.col("o_custkey")}
    parts = [left[t].select(F.lit(t).alias("tbl"), F.col(left[t].columns[0]).cast("bigint").alias("id"),
                            parent.cast("bigint").alias("parent")) for t, parent in shown.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
