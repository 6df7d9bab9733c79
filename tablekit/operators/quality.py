"""Constraints and data quality as DataFrame jobs.

``check(T, spec)`` returns a violations frame ``(rule, key, n)``:

* row rules (NOT NULL, CHECK, ENUM, SET, lengths, widths, decimal range,
  JSON, temporal range, LOB size) are evaluated in ONE pass over T: each row
  gets an array of the rules it breaks, which is exploded.  No shuffle.
* key rules (PRIMARY KEY, UNIQUE) are one partial+final aggregate each (column
  pruning makes each read only its key columns), so a
  hot key is combined map-side before the shuffle.
* foreign keys are one anti-join each against the parent's key set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions.exprs import hit, miss
from tablekit.spec import COLLATIONS, ColumnSpec, ForeignKey, TableSpec

VIOLATION_SCHEMA = "rule string, key string, n bigint"


class ConstraintViolation(Exception):
    pass


def key_string(cols: Sequence[str]) -> Column:
    """A printable key: the key columns cast to string, joined by '|'."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def _actual_type(df: DataFrame, name: str) -> T.DataType | None:
    for f in df.schema.fields:
        if f.name == name:
            return f.dataType
    return None


def column_rules(c: ColumnSpec, df: DataFrame) -> list[tuple[str, Column]]:
    """(rule name, violation predicate) for one column; predicates are
    TRUE only when the rule is broken (a NULL never breaks CHECK-like rules)."""
    v = F.col(c.name)
    out: list[tuple[str, Column]] = []
    if not c.nullable:                                            # V1
        out.append((f"not_null:{c.name}", v.isNull()))
    if c.enum is not None:                                        # V6
        out.append((f"enum:{c.name}", v.isNotNull() & ~v.isin(*c.enum)))
    if c.set_values is not None:                                  # V7
        allowed = F.array(*[F.lit(x) for x in c.set_values])
        out.append((f"set:{c.name}", v.isNotNull() & (v != "")    # '' is the empty set
                    & (F.size(F.array_except(F.split(v, ","), allowed)) > 0)))
    limit = c.char_len or c.max_len                               # V8
    if limit is not None:
        out.append((f"length:{c.name}", F.char_length(v) > limit))
    if c.unsigned:                                                # V9
        out.append((f"unsigned:{c.name}", v < 0))
    actual = _actual_type(df, c.name)                             # V9 / V10 width, precision
    if actual is not None and actual.simpleString() != c.dtype.replace(" ", "").lower():
        out.append((f"type:{c.name}",
                    v.isNotNull() & F.expr(f"try_cast(`{c.name}` AS {c.dtype})").isNull()))
    if c.json:                                                    # V11
        out.append((f"json:{c.name}", v.isNotNull() & F.try_parse_json(v).isNull()))
    if c.ts_range is not None:                                    # V12
        lo, hi = (F.lit(t.isoformat(sep=" ")).cast(actual.simpleString() if actual else "timestamp")
                  for t in c.ts_range)
        out.append((f"range:{c.name}", (v < lo) | (v > hi)))
    if c.max_bytes is not None:                                   # V16
        out.append((f"bytes:{c.name}", F.octet_length(v) > c.max_bytes))
    return out


def row_rules(spec: TableSpec, df: DataFrame) -> list[tuple[str, Column]]:
    rules = []
    present = set(df.columns)
    for c in spec.columns:
        if c.name in present:
            rules += column_rules(c, df)
    for name, expr in spec.checks:                                # V5: fails only when FALSE
        rules.append((f"check:{name}", F.expr(expr) == F.lit(False)))
    return [(n, F.coalesce(p, F.lit(False))) for n, p in rules]


def any_broken(spec: TableSpec, df: DataFrame) -> Column:
    """TRUE when the row breaks any row rule: a plain OR, so the whole test
    stays inside whole-stage codegen (no higher-order function)."""
    rules = row_rules(spec, df)
    out = F.lit(False)
    for _, p in rules:
        out = out | p
    return out


def _rule_slots(spec: TableSpec, df: DataFrame) -> Column:
    """Array with the rule name where broken and NULL elsewhere (codegen-friendly)."""
    rules = row_rules(spec, df)
    if not rules:
        return F.array(F.lit(None).cast("string"))
    return F.array(*[F.when(p, F.lit(n)) for n, p in rules])


def broken_rules(spec: TableSpec, df: DataFrame) -> Column:
    """Array<string> of the row rules this row breaks (empty when clean).
    ``array_compact`` is a higher-order function (interpreted), so callers
    apply this only to rows already known to be broken."""
    return F.array_compact(_rule_slots(spec, df))


def row_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    key = key_string(spec.primary_key) if spec.primary_key else F.lit(None).cast("string")
    # explode_outer + NULL filter: a plain explode makes Catalyst add a
    # "non-empty" filter that evaluates every rule a second time, and
    # dropping the NULL slots after the explode avoids array_compact
    return df.select(key.alias("key"), F.explode_outer(_rule_slots(spec, df)).alias("rule")) \
        .filter(F.col("rule").isNotNull()) \
        .select("rule", "key", F.lit(1).cast("bigint").alias("n"))


def compared(df: DataFrame, cols: Sequence[str], collations: Mapping[str, str] | None) -> DataFrame:
    """``df`` with its key columns under the collations declared for them, so
    that grouping, joining and DISTINCT compare them that way."""
    kinds = {c: COLLATIONS[collations[c]] for c in cols if c in (collations or {})}
    return df.withColumns({c: F.collate(F.col(c), k) for c, k in kinds.items()}) if kinds else df


def duplicate_keys(df: DataFrame, cols: Sequence[str], rule: str, skip_nulls: bool = True,
                   collations: Mapping[str, str] | None = None) -> DataFrame:
    """V3/V4: keys held by more than one row (NULL keys never collide in a
    UNIQUE index, so they are skipped unless ``skip_nulls`` is False).  Columns
    with a declared collation compare under it; the key reported is then the
    smallest of the colliding values by code point."""
    src = df
    if skip_nulls:
        cond = F.lit(True)
        for c in cols:
            cond = cond & F.col(c).isNotNull()
        src = df.filter(cond)
    if not any(c in (collations or {}) for c in cols):
        return src.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1) \
            .select(F.lit(rule).alias("rule"), key_string(cols).alias("key"), "n")
    keyed = src.select(*cols, key_string(cols).alias("__key"))
    return compared(keyed, cols, collations).groupBy(*cols) \
        .agg(F.count(F.lit(1)).alias("n"), F.min("__key").alias("key")).filter(F.col("n") > 1) \
        .select(F.lit(rule).alias("rule"), "key", "n")


def orphans(child: DataFrame, parent: DataFrame, fk: ForeignKey, key_cols: Sequence[str]) -> DataFrame:
    """Child rows whose non-NULL FK value has no parent row."""
    cond = F.lit(True)
    for c in fk.cols:
        cond = cond & F.col(c).isNotNull()
    parent_keys = parent.select(*[F.col(p).alias(c) for p, c in zip(fk.parent_cols, fk.cols)]).distinct()
    missing = child.filter(cond).join(parent_keys, list(fk.cols), "left_anti")
    return missing.select(F.lit(f"fk:{fk.name}").alias("rule"),
                          key_string(key_cols or fk.cols).alias("key"),
                          F.lit(1).cast("bigint").alias("n"))


def check(df: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All violations of ``spec`` in ``df`` as (rule, key, n)."""
    parts = [row_violations(df, spec)]
    if spec.primary_key:
        parts.append(duplicate_keys(df, spec.primary_key, "primary_key", skip_nulls=False,
                                    collations=spec.collations))
    for name, cols in spec.unique:
        parts.append(duplicate_keys(df, cols, f"unique:{name}", collations=spec.collations))
    for fk in spec.foreign_keys:
        if parents and fk.parent in parents:
            parts.append(orphans(df, parents[fk.parent], fk, spec.primary_key))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def enforce(batch: DataFrame, spec: TableSpec, mode: str = "strict") -> tuple[DataFrame, DataFrame]:
    """Strict raises on the first broken row rule (one action);
    ``ignore`` drops broken rows and returns them with their reasons."""
    bad = any_broken(spec, batch)
    clean = batch.filter(~bad)
    rejected = batch.filter(bad).withColumn("reasons", broken_rules(spec, batch))
    if mode == "strict":
        bad = rejected.select("reasons").limit(5).collect()
        if bad:
            raise ConstraintViolation(f"rows break constraints: {[r.reasons for r in bad]}")
    elif mode != "ignore":
        raise ValueError(mode)
    return clean, rejected


def require_empty(violations: DataFrame, what: str) -> None:
    sample = violations.limit(5).collect()
    if sample:
        raise ConstraintViolation(f"{what}: {[tuple(r) for r in sample]}")


# --- V6 / V11 / V12 / V16 helpers --------------------------------------------------

def enum_ordinal(df: DataFrame, column: str, members: Sequence[str], name: str | None = None) -> DataFrame:
    """V6: 1-based position of the value in the ENUM list (0 for a non-member)."""
    arr = F.array(*[F.lit(m) for m in members])
    return df.withColumn(name or f"{column}_ordinal", F.array_position(arr, F.col(column)))


def json_field(df: DataFrame, column: str, path: str, dtype: str, name: str) -> DataFrame:
    """Typed extraction of one JSON path (NULL when invalid or absent)."""
    return df.withColumn(name, F.get_json_object(F.col(column), path).cast(dtype))


def json_paths(df: DataFrame, column: str) -> DataFrame:
    """The paths that the JSON texts in ``column`` hold: (path, type, n), a row
    for each path and type.  Array elements share the path ``[*]``, keys that are not
    plain names stand as ``['key']``; numbers are BIGINT, DECIMAL or DOUBLE as Spark's VARIANT reads them; a JSON null is VOID.
    Texts that are NULL or not JSON count nowhere.

    A level is the VARIANT explosion of the one above; each is counted map-side,
    so what is shuffled is a row a task, path and type.  There is a job for each
    level of nesting."""
    level = df.select(F.lit("$").alias("path"), F.try_parse_json(column).alias("v")).filter(F.col("v").isNotNull())
    found = []
    while True:
        kind = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
        level = level.withColumn("type", kind)
        found.append(level.groupBy("path", "type").agg(F.count(F.lit(1)).alias("n")))
        nested = level.filter(F.col("type").isin("OBJECT", "ARRAY")).select("path", "v")
        if nested.isEmpty():
            break
        step = F.when(F.col("key").isNull(), "[*]") \
            .when(F.col("key").rlike("^[A-Za-z_][A-Za-z0-9_]*$"), F.concat(F.lit("."), F.col("key"))) \
            .otherwise(F.concat(F.lit("['"), F.col("key"), F.lit("']")))
        level = nested.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer())
                                   .select("key", F.col("value").alias("child"))) \
            .select(F.concat("path", step).alias("path"), F.col("child").alias("v"))
    return reduce(DataFrame.unionAll, found)


def to_utc(df: DataFrame, column: str, zone: str, name: str | None = None) -> DataFrame:
    """A zone-free local time (DATETIME) in ``zone`` -> UTC wall time.
    Works on TIMESTAMP_NTZ, so the result does not depend on the session zone."""
    return df.withColumn(name or column, F.convert_timezone(
        F.lit(zone), F.lit("UTC"), F.col(column).cast("timestamp_ntz")))


# The TEXT family size limits in bytes.
LOB_LIMITS = (("TINYTEXT", 255), ("TEXT", 65535), ("MEDIUMTEXT", 16777215), ("LONGTEXT", 4294967295))


def lob_class(df: DataFrame, column: str, name: str = "lob_class") -> DataFrame:
    """Smallest TEXT type that holds the value's UTF-8 bytes (NULL for NULL)."""
    size = F.octet_length(F.col(column))
    expr = F.when(size.isNull(), F.lit(None).cast("string"))
    for cls, limit in LOB_LIMITS:
        expr = expr.when(size <= limit, F.lit(cls))
    return df.withColumn(name, expr.otherwise(F.lit("TOO_LARGE")))


# --- F1-F4: foreign key actions ----------------------------------------------------

def _flag_join(child: DataFrame, keys: DataFrame, fk_cols: Sequence[str], flag: str) -> DataFrame:
    k = keys.select(*fk_cols).distinct().withColumn(flag, F.lit(True))
    return child.join(k, list(fk_cols), "left") \
        .withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def delete_blockers(parent: DataFrame, child: DataFrame, fk: ForeignKey, where) -> DataFrame:
    """the child rows that refuse the deletion of the parents hit by ``where``."""
    deleted = parent.filter(hit(where)).select(
        *[F.col(p).alias(c) for p, c in zip(fk.parent_cols, fk.cols)]).distinct()
    return child.join(deleted, list(fk.cols), "left_semi").select(*child.columns)


def delete_parent(parent: DataFrame, child: DataFrame, fk: ForeignKey, where,
                  action: str | None = None) -> tuple[DataFrame, DataFrame]:
    """DELETE parent rows hit by ``where`` and apply the FK action to
    the child table.  Returns (new parent, new child).

    restrict / no_action raise when any child references a deleted parent;
    cascade removes those children; set_null clears their FK columns.
    """
    action = (action or fk.on_delete).lower()
    deleted = parent.filter(hit(where)).select(
        *[F.col(p).alias(c) for p, c in zip(fk.parent_cols, fk.cols)])
    new_parent = parent.filter(miss(where))
    if action in ("restrict", "no_action"):
        require_empty(delete_blockers(parent, child, fk, where).select(*fk.cols),
                      f"{fk.name}: parent rows are still referenced")
        return new_parent, child
    if action == "cascade":
        return new_parent, child.join(deleted.distinct(), list(fk.cols), "left_anti")
    if action == "set_null":
        cols = child.columns
        flagged = _flag_join(child, deleted, fk.cols, "__gone")
        types = dict(child.dtypes)
        out = flagged.select(*[
            F.when(F.col("__gone"), F.lit(None).cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in fk.cols else F.col(c) for c in cols])
        return new_parent, out
    raise ValueError(action)


def update_parent_key(parent: DataFrame, child: DataFrame, fk: ForeignKey,
                      mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ON UPDATE CASCADE for a single-column key.  ``mapping`` holds
    (old, new) key pairs; parent and child keys are rewritten together.
    ``old`` must be unique, and the parents' keys must stay unique."""
    (pc,), (cc,) = fk.parent_cols, fk.cols
    require_empty(duplicate_keys(mapping, ["old"], "old"), f"{fk.name}: a key is mapped twice")
    m = mapping.select(F.col("old").alias("__old"), F.col("new").alias("__new"))
    ptypes, ctypes = dict(parent.dtypes), dict(child.dtypes)
    new_parent = parent.join(m, parent[pc] == m["__old"], "left").select(
        *[F.coalesce(F.col("__new").cast(ptypes[c]), F.col(c)).alias(c) if c == pc else F.col(c)
          for c in parent.columns])
    require_empty(duplicate_keys(new_parent, [pc], pc), f"{fk.name}: two parents would share a key")
    new_child = child.join(m, child[cc] == m["__old"], "left").select(
        *[F.coalesce(F.col("__new").cast(ctypes[c]), F.col(c)).alias(c) if c == cc else F.col(c)
          for c in child.columns])
    return new_parent, new_child
