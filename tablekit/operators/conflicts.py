"""M3-M5 over ALL unique keys: conflicts of a batch with a table, replayed.

A row holds one token for each key whose columns it fills: (number of the key,
value).  A NULL in a key holds none and conflicts with nothing.  The results
equal a row-by-row replay in ``seq`` order; what differs is how they are found:

* REPLACE always inserts, and a later row removes whoever holds one of its
  tokens.  So a batch row stays if it is the last one on each of its tokens,
  a table row if the batch has none of its tokens.  One aggregate, no rounds.
* INSERT IGNORE advances in waves: a pending row that is the first on each of
  its tokens is accepted, rows that share a token with it go.
* ON DUPLICATE KEY UPDATE: tokens that only one batch row and no table row hold
  can't conflict and are left out; rows with the same tokens left are one group
  (closed form: the first row inserts, the last one's values stand).  What
  touches several keys advances in waves of groups: a group's touched tokens
  are its own and those of the rows that hold them; a group that is first on
  all of them commutes with everything before it, and runs up to the first row
  of another group that touches them.

Frames between waves are written as tables: the planner then knows their sizes,
while size estimates of checkpoints would multiply from wave to wave.

Waves end with the longest chain of conflicts that depend on each other, not
with the size of the batch.  The table is only ever joined by its key columns
with the batch's tokens (broadcast by the planner when they are few); rows
that share no token with the batch pass through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.operators.quality import ConstraintViolation
from tablekit.operators.window import numbered_rows
from tablekit.session import materialize
from tablekit.spec import TableSpec

ORD = "__ord"
BROADCAST_ROWS = 1 << 14              # from so many rows on, a side of a join is shuffled
Key = tuple[str, tuple[str, ...]]


def unique_keys(spec: TableSpec, columns: Sequence[str]) -> list[Key]:
    """(rule, columns) of the PRIMARY KEY and the UNIQUE keys, in declared order, that ``columns`` hold whole."""
    every = [("primary_key", spec.primary_key), *[(f"unique:{n}", tuple(c)) for n, c in spec.unique]]
    return [(rule, cols) for rule, cols in every if cols and set(cols) <= set(columns)]


def key_value(cols: Sequence[str]) -> Column:
    """A key's value as one string, NULL when one of its columns is."""
    parts = [F.col(c).cast("string") for c in cols]
    if len(parts) == 1:
        return parts[0]
    return F.concat(*[x for p in parts for x in (F.char_length(p).cast("string"), F.lit(":"), p)])


def tokens(df: DataFrame, keys: Sequence[Key], *carry: str) -> DataFrame:
    """(carry.., k, v): a row for every key that a row fills."""
    slots = F.array(*[F.struct(F.lit(i).alias("k"), key_value(cols).alias("v")) for i, (_, cols) in enumerate(keys)])
    return df.select(*carry, F.explode(slots).alias("t")).select(*carry, "t.k", "t.v").filter("v IS NOT NULL")


def numbered_batch(batch: DataFrame, seq: str) -> DataFrame:
    """The batch with ``ORD``: 1, 2, .. in replay order (``seq``, then a hash of the row)."""
    hashed = batch.withColumn("__h", F.xxhash64(*[F.col(c) for c in batch.columns if c != seq]))
    return materialize(numbered_rows(hashed, [], [seq], ["__h"], ORD).drop("__h"))


def met(side: DataFrame, rows: int) -> DataFrame:
    """``side`` of a join in a step over ``rows`` rows.

    The planner goes by the size of the files, which are packed: what it would
    broadcast is many times that in the driver, and again in every wave.
    """
    return side.hint("merge") if rows > BROADCAST_ROWS else side


def _held(table: DataFrame, wanted: DataFrame, keys: Sequence[Key], rows: int, *carry: str) -> DataFrame:
    """The table's tokens (carry.., k, v) that ``wanted(k, v)``, of ``rows`` rows at most, names, key by key."""
    out = None
    for i, (_, cols) in enumerate(keys):
        own = table.select(*carry, F.lit(i).alias("k"), key_value(cols).alias("v"))
        hit = own.join(met(wanted.filter(F.col("k") == i).select("v"), rows), "v", "left_semi").select(*carry, "k", "v")
        out = hit if out is None else out.union(hit)
    return out


# ---------------------------------------------------------------- REPLACE

def replaced(table: DataFrame, batch: DataFrame, keys: Sequence[Key]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(table rows that stay, table rows that go, batch rows that stay) after REPLACE of a numbered batch."""
    tok = tokens(batch, keys, ORD)
    last = tok.groupBy("k", "v").agg(F.max(ORD).alias("__last"))
    wanted = materialize(last.select("k", "v"))
    rows = wanted.count()
    beaten = tok.join(met(last, rows), ["k", "v"]).filter(F.col(ORD) < F.col("__last")).select(ORD).distinct()
    stay = table
    for i, (_, cols) in enumerate(keys):
        value = wanted.filter(F.col("k") == i).select(F.col("v").alias("__v"))
        stay = stay.join(met(value, rows), key_value(cols) == F.col("__v"), "left_anti")
    gone = None
    for i, (_, cols) in enumerate(keys):               # a row goes once, by its first key that is hit
        value = wanted.filter(F.col("k") == i).select(F.col("v").alias("__v"))
        hit = table.join(met(value, rows), key_value(cols) == F.col("__v"), "left_semi")
        for j, (_, before) in enumerate(keys[:i]):
            value = wanted.filter(F.col("k") == j).select(F.col("v").alias("__v"))
            hit = hit.join(met(value, rows), key_value(before) == F.col("__v"), "left_anti")
        gone = hit if gone is None else gone.union(hit)
    return stay, gone, batch.join(met(beaten, rows), ORD, "left_anti")


# ---------------------------------------------------------------- INSERT IGNORE

def accepted(table: DataFrame, batch: DataFrame, keys: Sequence[Key]) -> tuple[DataFrame, DataFrame]:
    """(ORD of the rows that INSERT IGNORE inserts, (ORD, reasons) of those it ignores) of a numbered batch."""
    tok = materialize(tokens(batch, keys, ORD))
    names = F.array(*[F.lit(rule) for rule, _ in keys])
    rows = tok.count()
    held = _held(table, tok.select("k", "v").distinct(), keys, rows).distinct()
    lost = tok.join(met(held, rows), ["k", "v"]).select(ORD, "k")
    ignored = [lost]
    taken = [batch.join(met(tok.select(ORD), rows), ORD, "left_anti").select(ORD)]      # no key filled: nothing to conflict with
    pending = materialize(tok.join(met(lost.select(ORD), rows), ORD, "left_anti"))
    while rows := pending.count():
        first = pending.groupBy("k", "v").agg(F.min(ORD).alias("__first"))
        marked = pending.join(met(first, rows), ["k", "v"])
        leads = marked.groupBy(ORD).agg(F.bool_and(F.col(ORD) == F.col("__first")).alias("__leads")).filter("__leads")
        wins = materialize(leads.select(ORD))
        loses = materialize(marked.filter(F.col(ORD) > F.col("__first"))
                                    .join(met(wins.select(F.col(ORD).alias("__first")), rows), "__first", "left_semi").select(ORD, "k"))
        taken.append(wins)
        ignored.append(loses)
        pending = materialize(pending.join(met(wins.union(loses.select(ORD)).distinct(), rows), ORD, "left_anti"))
    reasons = _union(ignored).groupBy(ORD).agg(F.sort_array(F.collect_set(F.get(names, F.col("k")))).alias("reasons"))
    return _union(taken), reasons


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ---------------------------------------------------------------- ON DUPLICATE KEY UPDATE

def _token_sets(tok: DataFrame) -> DataFrame:
    """(ORD, s): each row's tokens as one sorted array."""
    return tok.groupBy(ORD).agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("s"))


def _opened(groups: DataFrame, *carry: str) -> DataFrame:
    return groups.select("s", *carry, F.explode("s").alias("t")).select("s", *carry, "t.k", "t.v")


def _inserted(order: str) -> Column:
    return F.concat(F.lit("b"), F.col(order).cast("string"))


def upserted(table: DataFrame, batch: DataFrame, keys: Sequence[Key], row_key: str,
             update_cols: Sequence[str]) -> DataFrame:
    """What a numbered batch does, a row for each target: (old, first, last, changes).

    ``old`` is the ``row_key`` of the table row it changes, or NULL; then
    ``first`` is the ORD of the batch row that is inserted.  ``last`` is the ORD
    of the row whose update values stand (NULL: an insert that nothing updated);
    ``changes`` counts the updates.
    """
    changed = {i for i, (_, cols) in enumerate(keys) if set(cols) & set(update_cols)}
    tok = materialize(tokens(batch, keys, ORD))
    rows = tok.count()
    wanted = tok.select("k", "v").distinct()
    hit_rows = _held(table, wanted, keys, rows, row_key).select(F.col(row_key).alias("__rid")).distinct()
    mine = table.join(met(hit_rows, rows), table[row_key] == F.col("__rid"), "left_semi")
    # who holds a token: "t" and the key of a table row, or "b" and the ORD of the batch row that was inserted
    owners = materialize(tokens(mine, keys, row_key).join(met(wanted, rows), ["k", "v"], "left_semi")
                         .select("k", "v", F.concat(F.lit("t"), F.col(row_key).cast("string")).alias("rid")))
    shared = tok.groupBy("k", "v").agg(F.count(F.lit(1)).alias("c")).join(
        met(owners.select("k", "v", F.lit(True).alias("held")), rows), ["k", "v"], "left").filter("c > 1 OR held").select("k", "v")
    sets = _token_sets(tok.join(met(shared, rows), ["k", "v"], "left_semi"))
    pending = materialize(sets)
    free = batch.join(met(pending.select(ORD), rows), ORD, "left_anti").select(
        _inserted(ORD).alias("rid"), F.lit(True).alias("inserted"), F.col(ORD).alias("lo"), F.col(ORD).alias("hi"), F.lit(1).cast("long").alias("c"))
    log = [free]
    while rows := pending.count():
        groups = pending.groupBy("s").agg(F.min(ORD).alias("f"))
        own = _opened(groups, "f")
        hits = own.join(met(owners, rows), ["k", "v"])
        touched = own.union(hits.select("s", "f", "rid").distinct().join(met(owners, rows), "rid").select("s", "f", "k", "v")).distinct()
        touched = materialize(touched)
        first = touched.groupBy("k", "v").agg(F.min("f").alias("f1"))
        marked = touched.join(met(first, rows), ["k", "v"])
        second = marked.filter("f > f1").groupBy("k", "v").agg(F.min("f").alias("f2"))
        ready = (marked.join(met(second, rows), ["k", "v"], "left").groupBy("s", "f")
                 .agg(F.bool_and(F.col("f") == F.col("f1")).alias("ok"), F.min("f2").alias("until")).filter("ok").drop("ok"))
        target = hits.groupBy("s").agg(F.min_by("rid", "k").alias("rid"), F.collect_set(F.struct("k", "rid")).alias("who"))
        ready = materialize(ready.join(met(target, rows), "s", "left"))
        _refuse_collisions(ready, changed, keys)
        run = (pending.join(met(ready, rows), "s").filter(F.col("until").isNull() | (F.col(ORD) < F.col("until")))
               .groupBy("s", "f", "rid").agg(F.min(ORD).alias("lo"), F.max(ORD).alias("hi"), F.count(F.lit(1)).alias("c")))
        done = materialize(run.select("s", F.coalesce("rid", _inserted("f")).alias("rid"), F.col("rid").isNull().alias("inserted"),
                                              "lo", "hi", "c"))
        log.append(done.drop("s"))
        # holders after this wave: an updated key column frees the old value and takes the new one
        freed = done.filter(~F.col("inserted")).select("rid", F.explode(F.array(*[F.lit(k) for k in sorted(changed)])
                                                                        if changed else F.array().cast("array<int>")).alias("k"))
        takes = _opened(done, "rid", "inserted").filter(
            F.col("inserted") | F.col("k").isin(sorted(changed) or [-1])).select("k", "v", "rid")
        owners = owners.join(met(freed, rows), ["rid", "k"], "left_anti").select("k", "v", "rid").union(takes).distinct()
        pending = materialize(pending.join(met(done.select("s", "hi"), rows), "s", "left")
                                      .filter(F.col("hi").isNull() | (F.col(ORD) > F.col("hi"))).select(ORD, "s"))
        # rows that hold no token of a pending row are met by nobody any more
        asked = pending.select("s").distinct().select(F.explode("s").alias("t")).select("t.k", "t.v").distinct()
        live = owners.join(met(asked, rows), ["k", "v"], "left_semi").select("rid").distinct()
        owners = materialize(owners.join(met(live, rows), "rid", "left_semi").select("k", "v", "rid"))
    every = _union(log).groupBy("rid").agg(F.bool_or("inserted").alias("inserted"), F.min("lo").alias("lo"),
                                           F.max("hi").alias("hi"), F.sum("c").alias("c"))
    return every.select(
        F.when(F.col("rid").startswith("t"), F.expr("substring(rid, 2)")).alias("old"), F.when(F.col("inserted"), F.col("lo")).alias("first"),
        F.when(~F.col("inserted") | (F.col("hi") > F.col("lo")), F.col("hi")).alias("last"),
        (F.col("c") - F.col("inserted").cast("int")).alias("changes"))


def _refuse_collisions(ready: DataFrame, changed: set[int], keys: Sequence[Key]) -> None:
    """Updating a row to a key value that another row holds breaks that key."""
    if not changed:
        return
    other = ready.filter("rid IS NOT NULL").select("rid", F.explode("who").alias("w")).filter(
        F.col("w.k").isin(sorted(changed)) & (F.col("w.rid") != F.col("rid"))).select("w.k").limit(5).collect()
    if other:
        raise ConstraintViolation(f"an update would repeat a key: {sorted({keys[r.k][0] for r in other})}")
