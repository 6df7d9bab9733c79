"""Window operators (W1-W8) built so that no window group lands in one task.

Spark's ``Window.partitionBy(g)`` sends every row of a group ``g`` to one
task.  With a low-cardinality group (a region) or a hot key that holds a
third of the data, that task holds a third of the data.  So the full-table
rankings here work on a *global range partitioning* instead:

1. range-partition on (group, order, tiebreak) and sort inside partitions:
   a hot group is split across many tasks, in order;
2. ``monotonically_increasing_id`` gives each row (partition id, local position);
   the frame is checkpointed so both uses see the same rows;
3. a per-(partition, group) count table (at most partitions x groups rows)
   gets a prefix sum per group: the offset of each partition inside the group;
   row_number = offset + local position.

``rank_within`` is a scan with carry over the same ranges.  A *piece* is the
part of a group inside one range.  Spark's own window functions number each
piece (a piece never exceeds its range), the frame is checkpointed, and one
small table carries the rest from piece to piece: rows and distinct order
values before the piece, the rank of a tie run that began earlier, and the
last and first ``k`` rows around it.  Only groups that begin some range can
have more than one piece, so that table has at most two rows a range.  The
input is exchanged twice (by range, by piece) and joined to nothing larger.

There is one path for every size: nothing is measured first.

``top_k`` (row_number <= k) works in two stages for any k: first inside
``SALTS`` shares of each group, dealt by a hash of the row, then over the at
most ``SALTS * k`` rows of a group that remain.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.session import reliable_checkpoint

SALTS = 32
_LOC_BITS = 33
_LOC_MASK = (1 << _LOC_BITS) - 1


@dataclass(frozen=True)
class OrderKey:
    name: str
    desc: bool = False

    def sort(self) -> Column:
        c = F.col(self.name)
        return c.desc() if self.desc else c.asc()


def parse_order(order: Sequence[str | OrderKey]) -> list[OrderKey]:
    res = []
    for o in order:
        if isinstance(o, OrderKey):
            res.append(o)
        else:
            parts = o.split()
            res.append(OrderKey(parts[0], len(parts) > 1 and parts[1].upper() == "DESC"))
    return res


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[str | OrderKey], k: int,
          name: str = "rank", kind: str = "row_number") -> DataFrame:
    """Rows whose row_number (or rank / dense_rank) within ``by`` is <= k.

    A row's rank in a share of its group is never above its rank in the whole
    group, so the first stage drops no row of the result; a hot group is read
    by ``SALTS`` tasks, and no task of the second stage gets more than
    ``SALTS * k`` rows of a group (ties apart).
    """
    fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[kind]
    sort = [o.sort() for o in parse_order(order)]
    salt = F.pmod(F.xxhash64(*[F.col(o.name) for o in parse_order(order)]), F.lit(SALTS))
    near = df.withColumn("__salt", salt)
    near = near.withColumn("__r", fn().over(Window.partitionBy(*by, "__salt").orderBy(*sort))) \
        .filter(F.col("__r") <= k).drop("__r", "__salt")
    return near.withColumn(name, fn().over(Window.partitionBy(*by).orderBy(*sort))).filter(F.col(name) <= k) \
        .withColumn(name, F.col(name).cast("bigint"))


def _join_back(big: DataFrame, small: DataFrame, keys: Sequence[str], add: Sequence[str]) -> DataFrame:
    """Left-join ``small`` (unique on ``keys``) into ``big`` null-safely."""
    s = small.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *add)
    cond = F.lit(True)
    for k in keys:
        cond = cond & big[k].eqNullSafe(s[f"__r_{k}"])
    return big.join(s, cond, "left").drop(*[f"__r_{k}" for k in keys])


def _numbered(df: DataFrame, group: Sequence[str], order: list[OrderKey],
              tiebreak: Sequence[str], num_partitions: int | None, size: str | None = None) -> DataFrame:
    """Global row_number per group without a one-task group (steps 1-3); ``size`` names a column for the group's rows."""
    sort = [F.col(g).asc() for g in group] + [o.sort() for o in order] + [F.col(t).asc() for t in tiebreak]
    # without an explicit count AQE may coalesce small ranges; partition ids
    # are read back from the ids themselves, so that stays consistent
    ranged = df.repartitionByRange(num_partitions, *sort) if num_partitions else df.repartitionByRange(*sort)
    tagged = (
        ranged
        .sortWithinPartitions(*sort)
        .withColumn("__mid", F.monotonically_increasing_id())
    )
    tagged = reliable_checkpoint(tagged)
    tagged = tagged.withColumn("__pid", F.shiftright("__mid", _LOC_BITS)) \
                   .withColumn("__loc", F.col("__mid").bitwiseAND(F.lit(_LOC_MASK)))
    per_part = tagged.groupBy("__pid", *group).agg(
        F.min("__loc").alias("__first"), F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(*group).orderBy("__pid") if group else Window.orderBy("__pid")
    per_part = per_part.withColumn(
        "__before",
        F.coalesce(F.sum("__cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    add = ["__first", "__before"]
    if size:
        per_part = per_part.withColumn(size, F.sum("__cnt").over(Window.partitionBy(*group)))
        add.append(size)
    out = _join_back(tagged, per_part, ["__pid", *group], add)
    out = out.withColumn("__rn", F.col("__before") + (F.col("__loc") - F.col("__first")) + 1)
    return out.drop("__mid", "__first", "__before")


def numbered_rows(df: DataFrame, group: Sequence[str], order: Sequence[str | OrderKey],
                  tiebreak: Sequence[str], name: str = "__rn") -> DataFrame:
    """``df`` plus a row_number column ``name`` per group (hot groups split)."""
    out = _numbered(df, list(group), parse_order(order), tiebreak, None)
    return out.withColumnRenamed("__rn", name).drop("__pid", "__loc") if name != "__rn" \
        else out.drop("__pid", "__loc")


def _pieces(df: DataFrame, group: list[str], order: list[OrderKey], tiebreak: Sequence[str],
            num_partitions: int | None, lag: Sequence[tuple[str, str, int]],
            lead: Sequence[tuple[str, str, int]]) -> DataFrame:
    """``df`` with its range (``__pid``) and every window function computed
    inside its piece, checkpointed."""
    by_value = [o.sort() for o in order]
    by_row = by_value + [F.col(t).asc() for t in tiebreak]
    sort = [F.col(g).asc() for g in group] + by_row
    ranged = df.repartitionByRange(num_partitions, *sort) if num_partitions else df.repartitionByRange(*sort)
    # with its tiebreak a row's range depends on the row alone, so a task run
    # again after a lost executor gives the same ranges
    ranged = ranged.withColumn("__pid", F.spark_partition_id())
    piece = Window.partitionBy("__pid", *group)
    rows = piece.orderBy(*by_row)
    values = piece.orderBy(*by_value)
    local = {"__rn": F.row_number().over(rows), "__rank": F.rank().over(values),
             "__dense": F.dense_rank().over(values), "__cnt": F.count(F.lit(1)).over(piece)}
    for i, (_, src, off) in enumerate(lag):
        local[f"__lag{i}"] = F.lag(src, off).over(rows)
    for i, (_, src, off) in enumerate(lead):
        local[f"__lead{i}"] = F.lead(src, off).over(rows)
    return reliable_checkpoint(ranged.withColumns(local))


def _carry(pieces: DataFrame, group: list[str], ocols: list[str], lag_src: list[str],
           lead_src: list[str], reach: int) -> DataFrame:
    """What each piece of a split group takes from the pieces around it: at
    most two rows a range (a range's first group, and that group's piece at
    the end of the range before)."""
    edge = pieces.filter((F.col("__rn") <= reach) | (F.col("__rn") > F.col("__cnt") - reach))
    if group:
        # one row a range: the groups that begin some range (group sorts ascending, NULL first, as MIN does)
        begins = pieces.filter("__rn = 1").groupBy("__pid").agg(F.min(F.struct(*group)).alias("__g")) \
            .select(*[F.col("__g")[g].alias(f"__b_{g}") for g in group]).distinct()
        same = F.lit(True)
        for g in group:
            same = same & edge[g].eqNullSafe(begins[f"__b_{g}"])
        edge = edge.join(F.broadcast(begins), same, "left_semi")

    def ends(cond: Column, srcs: list[str]) -> Column:
        row = F.struct("__rn", *[F.col(c).alias(f"__v{i}") for i, c in enumerate(srcs)])
        return F.sort_array(F.collect_list(F.when(cond, row)))

    value = F.struct(*ocols)
    table = edge.groupBy("__pid", *group).agg(
        F.max("__cnt").alias("__n"), F.max("__rank").alias("__last_rank"), F.max("__dense").alias("__values"),
        F.min_by(value, "__rn").alias("__first"), F.max_by(value, "__rn").alias("__last"),
        ends(F.col("__rn") <= reach, lead_src).alias("__head"),
        ends(F.col("__rn") > F.col("__cnt") - reach, lag_src).alias("__tail"))
    whole = Window.partitionBy(*group)
    w = whole.orderBy("__pid")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    table = table.withColumns({
        "__before": F.coalesce(F.sum("__n").over(before), F.lit(0)),
        "__size": F.sum("__n").over(whole),
        "__goes_on": (F.count(F.lit(1)).over(before) > 0)
        & F.col("__first").eqNullSafe(F.last("__last").over(w.rowsBetween(-1, -1))),
        # a piece has a row at least, so ``reach`` pieces hold ``reach`` rows
        "__past": F.flatten(F.collect_list("__tail").over(w.rowsBetween(-reach, -1))),
        "__next": F.flatten(F.collect_list("__head").over(w.rowsBetween(1, reach)))})
    known = F.when(F.col("__last_rank") > 1, F.col("__before") + F.col("__last_rank")) \
        .when(~F.col("__goes_on"), F.col("__before") + 1)     # rank of the piece's last tie run
    fresh = F.col("__values") - F.col("__goes_on").cast("int")
    return table.withColumn("__known", known).withColumn("__fresh", fresh).withColumns({
        "__run_rank": F.when(F.col("__goes_on"), F.last("__known", ignorenulls=True).over(before)),
        "__dense_before": F.coalesce(F.sum("__fresh").over(before), F.lit(0)) - F.col("__goes_on").cast("int"),
    }).select("__pid", *group, "__before", "__size", "__run_rank", "__dense_before", "__past", "__next")


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[str | OrderKey],
                tiebreak: Sequence[str], *, row_number: str | None = None,
                rank: str | None = None, dense_rank: str | None = None,
                ntile: tuple[str, int] | None = None,
                lag: Sequence[tuple[str, str, int]] = (),
                lead: Sequence[tuple[str, str, int]] = (),
                num_partitions: int | None = None) -> DataFrame:
    """W1-W6 over whole tables, as a scan with carry (see the module).

    ``tiebreak`` must make (group, order, tiebreak) unique; it decides the
    row_number among ties (the reference's ROW_NUMBER has none, D4).
    ``lag``/``lead`` take (output name, source column, offset >= 1).  The
    carried table is broadcast: two rows a range, ``offset`` values each.
    """
    group, order_keys = list(group), parse_order(order)
    ocols = [o.name for o in order_keys]
    reach = max([1, *[off for _, _, off in (*lag, *lead)]])
    pieces = _pieces(df, group, order_keys, tiebreak, num_partitions, lag, lead)
    carry = _carry(pieces, group, ocols, [src for _, src, _ in lag], [src for _, src, _ in lead], reach)
    out = _join_back(pieces, F.broadcast(carry), ["__pid", *group],
                     ["__before", "__size", "__run_rank", "__dense_before", "__past", "__next"])

    at, before = F.col("__rn"), F.coalesce("__before", F.lit(0))
    rn = (before + at).cast("bigint")
    add: dict[str, Column] = {}
    if rank:
        add[rank] = F.when(F.col("__rank") == 1, F.coalesce("__run_rank", before + 1)) \
            .otherwise(before + F.col("__rank")).cast("bigint")
    if dense_rank:
        add[dense_rank] = (F.coalesce("__dense_before", F.lit(0)) + F.col("__dense")).cast("bigint")
    if ntile:
        name, buckets = ntile
        size = F.coalesce("__size", "__cnt")
        q = F.floor(size / buckets)
        r = size % buckets
        big = (q + 1) * r  # rows in the first r (larger) buckets
        add[name] = F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1) \
            .otherwise(F.floor((rn - 1 - big) / F.greatest(q, F.lit(1))) + r + 1).cast("bigint")
    for i, (name, _, off) in enumerate(lag):
        back = F.greatest(F.lit(off) - at + 1, F.lit(1))       # that many rows before the piece
        add[name] = F.when(at > off, F.col(f"__lag{i}")) \
            .otherwise(F.try_element_at("__past", -back)[f"__v{i}"])
    for i, (name, _, off) in enumerate(lead):
        ahead = F.greatest(at + off - F.col("__cnt"), F.lit(1)).cast("int")
        add[name] = F.when(at + off <= F.col("__cnt"), F.col(f"__lead{i}")) \
            .otherwise(F.try_element_at("__next", ahead)[f"__v{i}"])
    if row_number:
        add[row_number] = rn
    return out.select(*[c for c in df.columns if c not in add], *[v.alias(n) for n, v in add.items()])
