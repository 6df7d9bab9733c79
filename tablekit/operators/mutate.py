"""Table mutations as DataFrame -> DataFrame steps.

Spark's parquet tables accept no UPDATE / DELETE / MERGE, so every mutation
derives the next version of the table from the current one; a ``publish``
(see ``tablekit.sources.sinks``) writes it once.  Each operator returns
``(new_table, metrics)``; ``metrics`` is a lazy one-row frame of counts
(the reference relies on ``rows_affected``).

Scale notes
* UPDATE / DELETE by condition are projections / filters: no shuffle.
* Joins against another table use a DISTINCT key set of the other side, so
  T is never multiplied, and the planner (AQE) picks broadcast or
  sort-merge from real sizes; a hot FK value is handled by AQE's skew join.
* Upsert / ignore / replace first reduce the batch to one row per key with
  ``min_by`` / ``max_by`` (partial aggregation combines a hot key map-side),
  then join 1:1 with T on the conflict key.
* Chunks are bounded by their size n; the planner broadcasts their keys.
* Writers check their batch first: rows, keys and unknown columns (strict), or
  drop what breaks a rule (IGNORE).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.functions.exprs import any_differs, hit, miss
from tablekit.operators import conflicts
from tablekit.operators.ids import assign_ids, next_id
from tablekit.operators.quality import (
    ConstraintViolation, any_broken, broken_rules, check, compared, duplicate_keys, enforce, key_string, orphans, require_empty)
from tablekit.operators.query import oldest
from tablekit.operators.window import numbered_rows
from tablekit.session import materialize
from tablekit.spec import NOW, ColumnSpec, TableSpec


# --- helpers --------------------------------------------------------------------------

def now_col(now=None) -> Column:
    """The statement time.  Pass it explicitly for repeatable results."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    if isinstance(now, dt.datetime):
        now = now.isoformat(sep=" ")
    return F.lit(str(now)).cast("timestamp")


def default_value(c: ColumnSpec, now=None) -> Column:
    """V2: the declared default (NULL when none is declared)."""
    if c.has_default:
        if c.default is NOW:
            return now_col(now).cast(c.dtype)
        return F.lit(c.default).cast(c.dtype)
    return F.lit(None).cast(c.dtype)


def auto_column(spec: TableSpec) -> str | None:
    for c in spec.columns:
        if c.auto_increment:
            return c.name
    return None


def align(batch: DataFrame, spec: TableSpec, now=None, exclude: Sequence[str] = (),
          extra: Sequence[str] = (), lenient: bool = False) -> DataFrame:
    """Columns by NAME, never by position: present columns are cast to the
    declared type (``lenient``: NULL where that fails), absent ones take their
    defaults.  A column that the table lacks raises, but for the named ``extra``
    ones (such as a ``seq``), which are kept at the end."""
    unknown = [c for c in batch.columns if c not in spec.names and c not in extra]
    if unknown:
        raise ConstraintViolation(f"unknown columns for {spec.name}: {unknown}")
    cols = []
    for c in spec.columns:
        if c.name in exclude:
            continue
        if c.name in batch.columns:
            cast = F.col(c.name).try_cast(c.dtype) if lenient else F.col(c.name).cast(c.dtype)
            cols.append(cast.alias(c.name))
        else:
            cols.append(default_value(c, now).alias(c.name))
    return batch.select(*cols, *[x for x in batch.columns if x in extra])


def _metrics(df: DataFrame, **counts: Column) -> DataFrame:
    return df.agg(*[F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(k)
                    for k, c in counts.items()])


def _count_of(df: DataFrame) -> Column:
    """COUNT(*) of ``df`` as a scalar subquery (to sit beside other counts)."""
    return df.select(F.count(F.lit(1))).scalar()


def _with_ids(new_rows: DataFrame, table: DataFrame, id_col: str | None, order: Sequence[str],
              counter: int | None = None) -> DataFrame:
    if id_col is None:
        return new_rows
    start = next_id(table, id_col)
    return assign_ids(new_rows, order, start=start if counter is None else F.greatest(start, F.lit(counter)), name=id_col)


def _without(spec: TableSpec, column: str | None) -> TableSpec:
    return spec.replace(columns=tuple(c for c in spec.columns if c.name != column))


def check_rows(batch: DataFrame, spec: TableSpec, skip: str | None = None,
               parents: Mapping[str, DataFrame] | None = None) -> None:
    """Strict mode of every writer: raises ConstraintViolation when a row breaks
    a row rule, or a FOREIGN KEY into one of ``parents`` (by table name).
    ``skip``: a column that the table fills in itself (AUTO_INCREMENT)."""
    enforce(batch, _without(spec, skip), "strict")
    for fk in spec.foreign_keys:
        if parents and fk.parent in parents and set(fk.cols) <= set(batch.columns):
            require_empty(orphans(batch, parents[fk.parent], fk, fk.cols), f"{spec.name}: {fk.name}")


def check_batch(table: DataFrame, batch: DataFrame, spec: TableSpec, skip: str | None = None,
                parents: Mapping[str, DataFrame] | None = None) -> None:
    """Strict mode of an INSERT: ``check_rows``, and no PRIMARY or UNIQUE key of
    the batch or the table is repeated."""
    check_rows(batch, spec, skip, parents)
    require_empty(key_violations(table, batch, spec), f"INSERT into {spec.name}")


def key_violations(table: DataFrame, batch: DataFrame, spec: TableSpec) -> DataFrame:
    """(rule, key, n): keys that the batch repeats (n rows), and ``<rule>:held`` for those the table holds already."""
    out = None
    for rule, cols in conflicts.unique_keys(spec, batch.columns):
        own = batch.select(*cols).dropna(subset=list(cols))
        named = own.select(*cols, key_string(cols).alias("key"))
        held = compared(named, cols, spec.collations) \
            .join(compared(table.select(*cols), cols, spec.collations), list(cols), "left_semi") \
            .select("key").distinct().select(
                F.lit(f"{rule}:held").alias("rule"), "key", F.lit(1).cast("bigint").alias("n"))
        for part in (duplicate_keys(own, cols, rule, collations=spec.collations), held):
            out = part if out is None else out.unionByName(part)
    if out is None:
        out = batch.sparkSession.createDataFrame([], "rule string, key string, n bigint")
    return out


def insert_violations(table: DataFrame, batch: DataFrame, spec: TableSpec,
                      parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(rule, key, n): everything for which a strict INSERT of the batch is refused."""
    keys = key_violations(table, batch, spec)
    return check(batch, spec.replace(unique=()), parents) \
        .filter("rule <> 'primary_key'").unionByName(keys)


def _check_other_unique(new: DataFrame, spec: TableSpec, key: str, mode: str | None) -> None:
    """The conflict key decides; with ``mode='strict'`` every OTHER unique key
    is checked on the result (one aggregate each) and a duplicate raises."""
    if mode is None:
        return
    if mode != "strict":
        raise ValueError(mode)
    for name, ucols in spec.unique:
        if tuple(ucols) != (key,):
            require_empty(duplicate_keys(new, ucols, f"unique:{name}", collations=spec.collations),
                          f"result breaks {name}")


# --- M1 / M2 / M6: insert -------------------------------------------------------------

def insert(table: DataFrame, batch: DataFrame, spec: TableSpec, now=None,
           order: Sequence[str] | None = None, mode: str = "strict",
           parents: Mapping[str, DataFrame] | None = None,
           counter: int | None = None) -> tuple[DataFrame, DataFrame]:
    """M1/M2: INSERT (named columns; defaults for the rest; AUTO_INCREMENT
    ids continue after the table's max in ``order`` of the batch, and not below
    ``counter``, the next id of the published table).  In strict
    mode the batch is checked first (``check_batch``); ``mode="unchecked"`` is
    for batches that are known to be clean."""
    id_col = auto_column(spec)
    fills = id_col if id_col and id_col not in batch.columns else None
    b = align(batch, spec, now, exclude=(fills,) if fills else ())
    if mode == "strict":
        check_batch(table, b, spec, fills, parents)
    elif mode != "unchecked":
        raise ValueError(mode)
    if fills:
        order = order or ([spec.unique[0][1][0]] if spec.unique else None)
        b = _with_ids(b, table, id_col, order, counter)
    new = table.unionByName(b.select(*table.columns))
    return new, _metrics(b, inserted=F.lit(True))


def insert_select(table: DataFrame, source: DataFrame, spec: TableSpec,
                  mapping: Mapping[str, Column], where=None, now=None,
                  order: Sequence[str] | None = None,
                  source_key: str | None = None, mode: str = "strict",
                  parents: Mapping[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """M6: INSERT .. SELECT.  Returns (new table, metrics, processed source
    keys) so the caller can mark them processed (the template never does)."""
    picked = source.filter(hit(where))
    batch = picked.select(*[e.alias(c) for c, e in mapping.items()])
    new, m = insert(table, batch, spec, now, order, mode, parents)
    keys = picked.select(source_key) if source_key else None
    return new, m, keys


def mark_processed(source: DataFrame, keys: DataFrame, key: str, flag: str = "is_processed",
                   now=None) -> tuple[DataFrame, DataFrame]:
    """Close the loop of M6: set ``flag`` = TRUE on the source rows whose keys
    were migrated (an UPDATE .. JOIN on the DISTINCT key set), so running
    the migration again inserts nothing twice."""
    return update_join(source, keys, key, key, {flag: F.lit(True)}, touch=False, now=now)


# --- M3 / M4 / M5: conflict handling -----------------------------------------------------

def _seq_order(batch: DataFrame, seq: str) -> Column:
    """Replay order: ``seq``, then a 64-bit hash of the whole row.  ``seq``
    should be unique; if it is not, the row content still decides, so a
    recomputed task (after an executor loss) picks the same row as the first
    attempt.  Identical rows are interchangeable; distinct rows sharing key,
    seq and hash would need a 64-bit collision."""
    return F.struct(F.col(seq), F.xxhash64(*[F.col(c) for c in batch.columns if c != seq]))


def _reduce(batch: DataFrame, key: str, seq: str, cols: Sequence[str], pick: str) -> DataFrame:
    """One row per key: the first (``min_by``) or last (``max_by``) in replay order."""
    fn = F.min_by if pick == "first" else F.max_by
    red = batch.groupBy(key).agg(fn(F.struct(*cols, seq), _seq_order(batch, seq)).alias("__r"))
    return red.select(key, *[F.col(f"__r.{c}").alias(c) for c in cols if c != key],
                      F.col(f"__r.{seq}").alias(seq))


def _matched_keys(table: DataFrame, batch_keys: DataFrame, key: str) -> DataFrame:
    """Batch keys already present in T, found with a semi join whose build
    side is the (reduced) batch key set: when the batch is small AQE
    broadcasts it and T's key column is filtered in place, never shuffled."""
    return table.select(key).join(batch_keys, key, "left_semi")


def upsert(table: DataFrame, batch: DataFrame, spec: TableSpec, key: str | None,
           update_cols: Sequence[str], seq: str, now=None,
           set_now: Sequence[str] = ("updated_at",),
           unique_check: str | None = "strict", mode: str = "strict",
           parents: Mapping[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """M3: INSERT .. ON DUPLICATE KEY UPDATE c = VALUES(c), replayed in ``seq`` order.

    Without a ``key`` a row updates the row that holds its value of ANY unique
    key, the first key in declared order that is held (``conflicts``); an update
    that would repeat a key raises.  With a ``key`` only that one decides, and
    the others are checked on the result.  In strict ``mode`` the batch's rows
    are checked first (``check_rows``).

    With a ``key``: equals row-by-row replay: a key already in T gets the LAST batch value of
    each update column (others keep T's values); a new key is inserted from
    its FIRST batch row, then its update columns take the LAST values.  Rows
    with a NULL key never conflict and are all inserted.  ``set_now``
    columns become ``now`` on every updated row (``updated_at = CURRENT_TIMESTAMP``).

    Plan: ONE aggregate reduces the batch per key (first row by ``min_by``,
    last update values by ``max_by``, combined map-side); T is LEFT-joined to
    that reduced batch (broadcast by AQE when it is small, so T keeps its
    partitioning), and new keys are the reduced batch minus the keys T holds.
    """
    id_col = auto_column(spec)
    cols = table.columns
    b = align(batch, spec, now, exclude=(id_col,) if id_col else (), extra=(seq,))
    if mode == "strict":
        check_rows(b, spec, id_col, parents)
    elif mode != "unchecked":
        raise ValueError(mode)
    ins_cols = [c for c in cols if c != id_col]
    if key is None:
        return _upsert_any_key(table, b, spec, id_col, update_cols, seq, now, set_now)
    b_key, b_null = b.filter(F.col(key).isNotNull()), b.filter(F.col(key).isNull())

    order = _seq_order(b_key, seq)
    red = materialize(b_key.groupBy(key).agg(
        F.min_by(F.struct(*[c for c in ins_cols if c != key], seq), order).alias("__first"),
        F.max_by(F.struct(*update_cols), order).alias("__last")))
    types = dict(table.dtypes)

    upd = red.select(key, "__last", F.lit(True).alias("__in_b"))
    j = table.join(upd, key, "left")
    in_b = F.coalesce(F.col("__in_b"), F.lit(False))

    def kept_value(c: str) -> Column:
        if c in update_cols:
            return F.when(in_b, F.col(f"__last.{c}")).otherwise(F.col(c)).cast(types[c])
        if c in set_now:
            return F.when(in_b, now_col(now).cast(types[c])).otherwise(F.col(c))
        return F.col(c)

    kept = j.select(*[kept_value(c).alias(c) for c in cols])

    fresh = red.join(_matched_keys(table, red.select(key), key), key, "left_anti")

    def new_value(c: str) -> Column:
        if c == key:
            return F.col(key)
        if c in update_cols:
            return F.col(f"__last.{c}").cast(types[c])
        return F.col(f"__first.{c}").cast(types[c])

    fresh = fresh.select(*[new_value(c).alias(c) for c in ins_cols], F.col(f"__first.{seq}").alias(seq))
    fresh = fresh.unionByName(b_null.select(*ins_cols, seq))
    if id_col:
        fresh = _with_ids(fresh, table, id_col, [seq, key])
    new = kept.unionByName(fresh.select(*cols))
    _check_other_unique(new, spec, key, unique_check)
    metrics = _metrics(j, updated=in_b).select(
        _count_of(fresh).alias("inserted"), "updated")
    return new, metrics


def _upsert_any_key(table: DataFrame, b: DataFrame, spec: TableSpec, id_col: str | None, update_cols: Sequence[str],
                    seq: str, now, set_now: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    cols, types = table.columns, dict(table.dtypes)
    (row_key,) = spec.primary_key
    keys = conflicts.unique_keys(spec, b.columns)
    batch = conflicts.numbered_batch(b, seq)
    ops = materialize(conflicts.upserted(table, batch, keys, row_key, update_cols))
    rows = batch.count()
    values = batch.select(F.col(conflicts.ORD).alias("last"), F.struct(*update_cols).alias("__last"))
    upd = ops.filter("old IS NOT NULL").join(conflicts.met(values, rows), "last").select(
        F.col("old").cast(types[row_key]).alias("__k"), "__last", F.lit(True).alias("__in_b"))
    j = table.join(conflicts.met(upd, rows), table[row_key] == F.col("__k"), "left")
    in_b = F.coalesce(F.col("__in_b"), F.lit(False))
    stamps = [c for c in set_now if c in cols and c not in update_cols]
    kept = j.select(*[F.when(in_b, F.col(f"__last.{c}")).otherwise(F.col(c)).cast(types[c]).alias(c) if c in update_cols
                      else F.when(in_b, now_col(now).cast(types[c])).otherwise(F.col(c)).alias(c) if c in stamps
                      else F.col(c) for c in cols])
    fresh = (ops.filter("first IS NOT NULL").join(conflicts.met(batch, rows), F.col("first") == F.col(conflicts.ORD))
             .join(conflicts.met(values, rows), "last", "left")
             .select(conflicts.ORD, *[F.when(F.col("__last").isNotNull(), F.col(f"__last.{c}")).otherwise(F.col(c)).alias(c)
                                      if c in update_cols else F.col(c) for c in b.columns if c != seq]))
    fresh = _with_ids(fresh, table, id_col, [conflicts.ORD]) if id_col else fresh
    metrics = ops.agg(F.coalesce(F.sum(F.col("first").isNotNull().cast("bigint")), F.lit(0)).cast("bigint").alias("inserted"),
                      F.coalesce(F.sum(F.col("old").isNotNull().cast("bigint")), F.lit(0)).cast("bigint").alias("updated"))
    return kept.unionByName(fresh.select(*cols)), metrics


def insert_ignore(table: DataFrame, batch: DataFrame, spec: TableSpec, key: str | None, seq: str,
                  now=None, unique_check: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M4: INSERT IGNORE.  Without a ``key``: a replay in ``seq`` order over ALL
    unique keys (``conflicts``); ``rejected`` then holds the ignored duplicates
    too, with the keys they repeat.  With a ``key``:  Rows that break a row rule, values that do not
    convert to the column's type among them, are dropped with their reasons
    (V14, lenient); of the rest, the first row per unique key is inserted
    unless the key is already in T.  ``key`` comes first, then the other
    unique keys in declared order (with ``unique_check="strict"`` a duplicate
    of those raises instead).  Returns (new table, metrics, rejected)."""
    id_col = auto_column(spec)
    cols = table.columns
    ins_cols = [c for c in cols if c != id_col]
    own = _without(spec, id_col)
    batch = batch.drop(id_col) if id_col in batch.columns else batch
    absent = [c for c in own.columns if c.name not in batch.columns]
    raw = batch.select("*", *[default_value(c, now).alias(c.name) for c in absent])
    clean, rejected = enforce(raw, own, mode="ignore")
    if key is None:
        numbered = conflicts.numbered_batch(clean, seq)
        aligned = align(numbered, spec, now, exclude=(id_col,) if id_col else (), extra=(seq, conflicts.ORD), lenient=True)
        taken, ignored = conflicts.accepted(table, aligned, conflicts.unique_keys(spec, aligned.columns))
        rows = numbered.count()
        fresh = materialize(aligned.join(conflicts.met(taken, rows), conflicts.ORD, "left_semi"))
        fresh = _with_ids(fresh, table, id_col, [conflicts.ORD]) if id_col else fresh
        rejected = rejected.unionByName(numbered.join(conflicts.met(ignored, rows), conflicts.ORD).drop(conflicts.ORD))
        metrics = fresh.agg(F.count(F.lit(1)).alias("inserted")).select(
            "inserted", (_count_of(batch) - F.col("inserted")).alias("ignored"))
        return table.unionByName(fresh.select(*cols)), metrics, rejected
    clean = align(clean, spec, now, exclude=(id_col,) if id_col else (), extra=(seq,), lenient=True)
    fresh = materialize(_reduce(clean.filter(F.col(key).isNotNull()), key, seq, ins_cols, "first"))
    fresh = fresh.join(_matched_keys(table, fresh.select(key), key), key, "left_anti") \
        .unionByName(clean.filter(F.col(key).isNull()).select(*ins_cols, seq))
    for _, other in spec.unique if unique_check is None else ():
        if tuple(other) != (key,) and id_col not in other:
            full = [F.col(c).isNotNull() for c in other]
            whole = full[0]
            for f in full[1:]:
                whole = whole & f
            firsts = fresh.filter(whole).groupBy(*other).agg(
                F.min_by(F.struct(*[c for c in [*ins_cols, seq] if c not in other]), _seq_order(fresh, seq)).alias("__r"))
            firsts = firsts.select(*other, "__r.*").join(table.select(*other), list(other), "left_anti")
            fresh = firsts.select(*ins_cols, seq).unionByName(fresh.filter(~whole).select(*ins_cols, seq))
    fresh = _with_ids(fresh, table, id_col, [seq, key]) if id_col else fresh
    new = table.unionByName(fresh.select(*cols))
    _check_other_unique(new, spec, key, unique_check)
    metrics = fresh.agg(F.count(F.lit(1)).alias("inserted")).select(
        "inserted", (_count_of(batch) - F.col("inserted")).alias("ignored"))
    return new, metrics, rejected


def replace(table: DataFrame, batch: DataFrame, spec: TableSpec, key: str | None, seq: str, now=None,
            children: Sequence[tuple[DataFrame, str]] = (),
            unique_check: str | None = "strict", mode: str = "strict",
            parents: Mapping[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """M5: REPLACE INTO = delete the conflicting rows, insert the new one.

    Without a ``key`` a row displaces every row, of the table or earlier in the
    batch, that holds its value of ANY unique key (``conflicts``), and every row
    of the batch uses up an id.  With a ``key`` only that one decides, and the
    others are checked on the result.  In strict ``mode`` the batch's rows are
    checked first (``check_rows``).

    With a ``key``: the last batch row per key wins; replaced rows get NEW auto-increment
    ids, and columns the batch omits take their defaults (old values are
    lost).  ``children`` are (child table, FK column referencing the id):
    rows pointing at a replaced parent are cascade-deleted (F2).
    """
    id_col = auto_column(spec)
    cols = table.columns
    ins_cols = [c for c in cols if c != id_col]
    b = align(batch, spec, now, exclude=(id_col,) if id_col else (), extra=(seq,))
    if mode == "strict":
        check_rows(b, spec, id_col, parents)
    elif mode != "unchecked":
        raise ValueError(mode)
    if key is None:
        numbered = conflicts.numbered_batch(b, seq)
        kept, gone, fresh = conflicts.replaced(table, numbered, conflicts.unique_keys(spec, b.columns))
        if id_col:
            fresh = fresh.withColumn(id_col, (next_id(table, id_col) + F.col(conflicts.ORD) - 1).cast("bigint"))
        new = kept.select(*cols).unionByName(fresh.select(*cols))
        return new, _replace_metrics(gone, fresh), _without_parents(children, gone, id_col)
    lasts = materialize(_reduce(b.filter(F.col(key).isNotNull()), key, seq, ins_cols, "last"))
    fresh = lasts.unionByName(b.filter(F.col(key).isNull()).select(*ins_cols, seq))
    replaced_keys = lasts.select(key)
    kept = table.join(replaced_keys, key, "left_anti").select(*cols)
    fresh = _with_ids(fresh, table, id_col, [seq, key]) if id_col else fresh
    new = kept.unionByName(fresh.select(*cols))
    _check_other_unique(new, spec, key, unique_check)
    gone = table.join(replaced_keys, key, "left_semi")
    return new, _replace_metrics(gone, fresh), _without_parents(children, gone, id_col)


def _replace_metrics(gone: DataFrame, fresh: DataFrame) -> DataFrame:
    return gone.agg(F.count(F.lit(1)).alias("deleted")).select("deleted", _count_of(fresh).alias("inserted"))


def _without_parents(children: Sequence[tuple[DataFrame, str]], gone: DataFrame, id_col: str) -> list[DataFrame]:
    """F2 on the children of the rows that go, their columns in order."""
    out = []
    for child, fk_col in children:
        dead = gone.select(F.col(id_col).alias(fk_col)).distinct()
        out.append(child.join(dead, fk_col, "left_anti").select(*child.columns))
    return out


# --- M7 - M10, M16: updates --------------------------------------------------------------

def _apply_set(table: DataFrame, hit_col: Column, assignments: Mapping[str, Column],
               spec: TableSpec | None, now, touch: bool, keep: Sequence[str] | None = None) -> DataFrame:
    """Rewrite the SET columns where ``hit_col`` is TRUE; SET expressions read
    the OLD row.  With ``touch``, ON UPDATE columns become ``now`` on rows
    whose SET values actually change (M16)."""
    types = dict(table.dtypes)
    keep = keep or table.columns
    newv = {c: e.cast(types[c]) for c, e in assignments.items()}
    changed = any_differs([(newv[c], F.col(c)) for c in newv])
    out = []
    for c in keep:
        if c in newv:
            out.append(F.when(hit_col, newv[c]).otherwise(F.col(c)).alias(c))
        elif touch and spec is not None and c in spec.names and spec.column(c).on_update_now:
            out.append(F.when(hit_col & changed, now_col(now).cast(types[c])).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return table.select(*out)


def update_violations(hit_rows: DataFrame, new: DataFrame, spec: TableSpec, changed: Sequence[str],
                      parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(rule, key, n): what an UPDATE of the columns ``changed`` breaks.

    ``hit_rows`` are the rows it hits, with their new values: row rules and
    FOREIGN KEYs are theirs alone.  A PRIMARY or UNIQUE key with a changed column
    is checked on the whole ``new`` table.
    """
    assigned = set(changed)
    own = spec.replace(columns=tuple(c for c in spec.columns if c.name in assigned))
    key = key_string(spec.primary_key) if spec.primary_key else F.lit(None).cast("string")
    out = hit_rows.filter(any_broken(own, hit_rows)).select(
        F.explode(broken_rules(own, hit_rows)).alias("rule"), key.alias("key"), F.lit(1).cast("bigint").alias("n"))
    for rule, cols in conflicts.unique_keys(spec, new.columns):
        if assigned & set(cols):
            out = out.unionByName(duplicate_keys(new, cols, rule, skip_nulls=rule != "primary_key",
                                                 collations=spec.collations))
    for fk in spec.foreign_keys:
        if assigned & set(fk.cols) and parents and fk.parent in parents:
            out = out.unionByName(orphans(hit_rows, parents[fk.parent], fk, spec.primary_key))
    return out


def _checked_update(table: DataFrame, hit_col: Column, assignments: Mapping[str, Column], spec: TableSpec | None,
                    now, touch: bool, keep: Sequence[str], mode: str,
                    parents: Mapping[str, DataFrame] | None) -> DataFrame:
    """The updated table; strict mode raises ConstraintViolation when it breaks a rule of ``spec``."""
    new = _apply_set(table, hit_col, assignments, spec, now, touch, keep)
    if mode == "strict" and spec is not None:
        hits = table.filter(hit_col)
        rows = _apply_set(hits, F.lit(True), assignments, spec, now, touch, keep)
        require_empty(update_violations(rows, new, spec, list(assignments), parents), f"UPDATE {spec.name}")
    elif mode not in ("strict", "unchecked"):
        raise ValueError(mode)
    return new


def update(table: DataFrame, assignments: Mapping[str, Column], where=None,
           spec: TableSpec | None = None, now=None, touch: bool = True, mode: str = "strict",
           parents: Mapping[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """M7 / M9: UPDATE T SET .. WHERE .. as one projection (no shuffle).
    Values are cast back to the column type (decimals round half up).  With a
    ``spec``, strict mode checks what it changes first (``update_violations``)."""
    h = hit(where)
    new = _checked_update(table, h, assignments, spec, now, touch, table.columns, mode, parents)
    return new, _metrics(table, updated=h)


def update_join(table: DataFrame, other: DataFrame, table_key: str, other_key: str,
                assignments: Mapping[str, Column], where=None, other_where=None,
                spec: TableSpec | None = None, now=None, touch: bool = True,
                from_other: Mapping[str, str] | None = None, mode: str = "strict",
                parents: Mapping[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """M8: UPDATE T JOIN S ON T.k = S.k SET .. WHERE ..

    When the SET reads T only, S contributes a DISTINCT key set and a match
    flag: T is never multiplied however many S rows share a key.
    ``from_other`` maps T columns to S columns (``SET t.c = s.c``); then S
    must be unique on its key among the rows that qualify (checked with one
    aggregate, raising otherwise), since several matches would make the new
    value ambiguous.  Those S columns enter ``assignments`` as ``__s_<col>``.
    """
    picked = other.filter(hit(other_where))
    s_cols = sorted(set((from_other or {}).values()))
    if s_cols:
        dups = picked.groupBy(other_key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        require_empty(dups, f"UPDATE .. JOIN: {other_key} is not unique in the joined table")
        keys = picked.select(F.col(other_key).alias("__k"), *[F.col(c).alias(f"__s_{c}") for c in s_cols])
    else:
        keys = picked.select(F.col(other_key).alias("__k")).distinct()
    keys = keys.withColumn("__match", F.lit(True))
    j = table.join(keys, table[table_key] == keys["__k"], "left")
    h = F.coalesce(F.col("__match"), F.lit(False)) & hit(where)
    sets = dict(assignments)
    for t_col, s_col in (from_other or {}).items():
        sets[t_col] = F.col(f"__s_{s_col}")
    new = _checked_update(j, h, sets, spec, now, touch, table.columns, mode, parents)
    return new, _metrics(j, updated=h)


def update_chunk(table: DataFrame, assignments: Mapping[str, Column], where, order: Sequence[str],
                 key: str, n: int, spec: TableSpec | None = None, now=None, touch: bool = True, mode: str = "strict",
                 parents: Mapping[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """UPDATE .. WHERE .. ORDER BY .. LIMIT n: the n oldest hit rows.

    The chunk's key set has at most n rows and is joined as a flag; the
    planner broadcasts it when it is small, and T is then not shuffled.
    """
    chunk = oldest(table, where, order, key, n).select(F.col(key).alias("__k")) \
        .withColumn("__match", F.lit(True))
    j = table.join(chunk, table[key] == chunk["__k"], "left")
    h = F.coalesce(F.col("__match"), F.lit(False))
    new = _checked_update(j, h, assignments, spec, now, touch, table.columns, mode, parents)
    return new, _metrics(j, updated=h)


# --- M11 - M15: deletes ----------------------------------------------------------------------

def delete(table: DataFrame, where) -> tuple[DataFrame, DataFrame]:
    """DELETE .. WHERE: keep rows where the condition is not TRUE."""
    return table.filter(miss(where)), _metrics(table, deleted=hit(where))


def delete_join(table: DataFrame, other: DataFrame, table_key: str, other_key: str,
                other_where=None) -> tuple[DataFrame, DataFrame]:
    """DELETE t FROM T t JOIN S s ON .. WHERE (S condition): only T loses rows."""
    keys = other.filter(hit(other_where)).select(F.col(other_key).alias("__k")).distinct()
    kept = table.join(keys, table[table_key] == keys["__k"], "left_anti")
    gone = table.join(keys, table[table_key] == keys["__k"], "left_semi")
    return kept, gone.agg(F.count(F.lit(1)).alias("deleted"))


def delete_chunk(table: DataFrame, where, order: Sequence[str], key: str,
                 n: int) -> tuple[DataFrame, DataFrame]:
    """M13 (one run): DELETE .. WHERE .. ORDER BY .. LIMIT n."""
    chunk = oldest(table, where, order, key, n).select(F.col(key).alias("__k"))
    kept = table.join(chunk, table[key] == chunk["__k"], "left_anti")
    return kept, chunk.agg(F.count(F.lit(1)).alias("deleted"))


def drain(table: DataFrame, where, order: Sequence[str], key: str, n: int) -> tuple[DataFrame, DataFrame]:
    """M13 (loop until no row is hit) in ONE pass, not a driver loop.

    The end state equals a plain DELETE; the chunk plan numbers the hit rows
    in (order, key) order with the distributed row number and groups them
    into chunks of n: (chunk, deleted, first_key, last_key).
    """
    numbered = numbered_rows(table.filter(hit(where)), [], order, [key])
    chunks = numbered.withColumn("chunk", F.ceil(F.col("__rn") / n).cast("bigint")) \
        .groupBy("chunk").agg(F.count(F.lit(1)).alias("deleted"),
                              F.min_by(F.col(key), F.col("__rn")).alias("first_key"),
                              F.max_by(F.col(key), F.col("__rn")).alias("last_key"))
    return table.filter(miss(where)), chunks


def soft_delete(table: DataFrame, where, now=None) -> tuple[DataFrame, DataFrame]:
    """UPDATE .. SET is_deleted = TRUE, deleted_at = now WHERE ..
    (the two columns are added, FALSE / NULL, when the table lacks them)."""
    t = table
    if "is_deleted" not in t.columns:
        t = t.withColumn("is_deleted", F.lit(False))
    if "deleted_at" not in t.columns:
        t = t.withColumn("deleted_at", F.lit(None).cast("timestamp"))
    return update(t, {"is_deleted": F.lit(True), "deleted_at": now_col(now)}, where, touch=False)


def active(table: DataFrame) -> DataFrame:
    """The rows not soft-deleted."""
    return table.filter(~F.col("is_deleted") | F.col("is_deleted").isNull())


def purge(table: DataFrame, ts_col: str, before) -> tuple[DataFrame, DataFrame]:
    """Retention purge, DELETE .. WHERE ts < before.  The complement
    filter is pushed to the parquet scan, and on a date-partitioned table it
    prunes whole partitions."""
    c = F.col(ts_col)
    b = before if isinstance(before, Column) else F.lit(before)
    return delete(table, c < b)


def purge_partitions(spark, path: str, part_col: str, before, out_base: str, version: int) -> str:
    """M15 on a table partitioned by ``part_col`` (a date): the new version
    keeps only partitions with ``part_col >= before``.  The filter is on the
    partition column, so only the kept partition directories are listed and
    read (PartitionFilters); purged partitions are never scanned."""
    from tablekit.sources.sinks import publish
    kept = spark.read.parquet(path).filter(F.col(part_col) >= F.lit(before))
    return publish(kept, out_base, version, partition_by=[part_col])
