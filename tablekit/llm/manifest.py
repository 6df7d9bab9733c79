"""Merkle manifest of a dataset: content-addressed records, proofs by descent.

Leaves (one digest a row) form a binary hash tree for every language; the
trees' subroots form one more tree with the root on top.  Nothing holds a tree
whole: nodes are grouped by their rank into blocks of ``FAN`` consecutive
ones, a block is hashed up level by level inside its row, and the blocks' tops
are the next round's nodes.

Store.  A block is one record, ``digest -> levels``: the address is the digest
of its top node, ``levels[0]`` are its children ``FAN`` ranks wide, the rest
the nodes between.  Equal blocks are one record, so the trees share a DAG.

Proofs.  Requests are ranks.  They descend from the root: in every round a
request's digit (8 bits of the rank) selects a child of the record it stands
at, the unselected node of every level on the way joins its path, and the
child's digest is the next address.  Requests with a common prefix descend as
one row until the last round.  The path, reversed, runs from leaf to root;
folding a leaf with it gives a root to compare.

Edge cases: NULL columns are hashed as ``-``; a NULL language is a tree of its
own, before all others; rows are ordered by (doc_id with NULL first, leaf), so
ties and repeated rows are leaves like any others; a NULL doc_id is never
tampered with; an empty table has no root and gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm.common import checkpointed, crc32_of_id, table
from tablekit.operators.window import _numbered, parse_order

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGIT = 8                             # bits of a rank that select a child of a record
FAN = 1 << DIGIT
TOP = "top"                           # name of the tree over the subroots
TAMPER_MOD = 7


def encoded_field(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """The digest of a row; ``changed`` replaces columns by other values."""
    return F.sha2(F.concat(*[encoded_field(changed.get(c, F.col(c))) for c in FIELDS]), 256)


def tree_name(lang: str = "lang") -> Column:
    """A never-NULL name that sorts as the language does: NULL first, then bytewise."""
    return F.coalesce(F.concat(F.lit("1"), F.col(lang)), F.lit("0"))


# ---------------------------------------------------------------- store

@dataclass(frozen=True)
class Manifest:
    """``records(digest, levels)``, ``trees(tree, n, over, top_rank, subroot)``, ``leaves`` with their ranks, and the root."""
    records: DataFrame
    trees: DataFrame
    leaves: DataFrame
    root: str | None
    n_trees: int


def _height(n: str) -> str:
    """Levels of a block in a tree (of ``n`` nodes at this round): all but the top round's are full."""
    steps = " ".join(f"WHEN {n} > {1 << k} THEN {k + 1}" for k in range(DIGIT - 1, 0, -1))
    return f"CASE {steps} WHEN {n} > 1 THEN 1 ELSE 0 END"


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, n, rank, digest) of trees with n > 1 -> their blocks, hashed up level by level."""
    out = nodes.filter("n > 1").groupBy("tree", "n", F.expr(f"rank >> {DIGIT}").alias("rank")).agg(
        F.expr("transform(array_sort(collect_list(struct(rank, digest))), x -> x.digest)").alias("l0"))
    out = out.withColumn("h", F.expr(_height("n")))
    for k in range(1, DIGIT + 1):                      # an odd last node is hashed alone
        out = out.withColumn(f"l{k}", F.expr(
            f"CASE WHEN h >= {k} THEN transform(sequence(0, (size(l{k - 1}) - 1) DIV 2), "
            f"i -> sha2(concat(l{k - 1}[2 * i], coalesce(get(l{k - 1}, CAST(2 * i + 1 AS INT)), '')), 256)) "
            f"ELSE l{k - 1} END"))
    levels = "array(" + ", ".join(f"l{k}" for k in range(DIGIT)) + ")"
    return out.select("tree", F.expr(f"(n + {FAN - 1}) DIV {FAN}").alias("n"), "rank",
                      F.expr(f"l{DIGIT}[0]").alias("digest"), F.expr(f"slice({levels}, 1, h)").alias("levels"))


def _grown(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Hash trees over their leaves: (records of every round, (tree, subroot))."""
    records, tops = [], nodes.filter("n = 1").select("tree", F.col("digest").alias("subroot"))
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        blocks = checkpointed(_blocks(nodes))
        records.append(blocks.select("digest", "levels"))
        nodes = blocks.select("tree", "n", "rank", "digest")
        tops = tops.union(nodes.filter("n = 1").select("tree", F.col("digest").alias("subroot")))
        most = -(-most // FAN)
    return records, tops


def _ranked(df: DataFrame, by: list[str], tie: list[str]) -> DataFrame:
    """``rank`` from 0 within a tree, and ``n``, the tree's size."""
    # rows that are equal in all of this are the same leaf; their place in the input keeps a crowd of them splittable
    out = _numbered(df.withColumn("__at", F.monotonically_increasing_id()), ["tree"], parse_order(by), [*tie, "__at"], None, size="n")
    return out.withColumn("rank", F.col("__rn") - 1).drop("__at", "__rn", "__pid", "__loc")


def build_manifest(leaves: DataFrame) -> Manifest:
    """A manifest over ``leaves(tree string, doc_id, leaf, ..)``: further columns stay beside the ranks."""
    ranked = checkpointed(_ranked(leaves, ["doc_id"], ["leaf"]))
    records, tops = _grown(ranked.select("tree", "n", "rank", F.col("leaf").alias("digest")))
    sizes = ranked.filter("rank = 0").select("tree", "n")
    tops = checkpointed(tops.join(sizes, "tree").select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "n", "subroot"))
    over = checkpointed(_ranked(tops.drop("n"), ["of"], []))
    n_trees = over.count()
    more, top = _grown(over.select("tree", "n", "rank", F.col("subroot").alias("digest")))
    trees = (over.select(F.col("of").alias("tree"), F.col("tree").alias("over"), F.col("rank").alias("top_rank"), "subroot")
             .join(tops.select(F.col("of").alias("tree"), "n"), "tree"))
    store = None
    for r in records + more:
        store = r if store is None else store.union(r)
    if store is None:
        store = leaves.sparkSession.createDataFrame([], "digest string, levels array<array<string>>")
    root = top.first()
    return Manifest(checkpointed(store.groupBy("digest").agg(F.first("levels").alias("levels"))), checkpointed(trees),
                    ranked, root.subroot if root else None, n_trees)


# ---------------------------------------------------------------- proofs

def _rounds(n: str) -> str:
    """How many records a request passes in a tree of ``n`` leaves."""
    return f"CASE WHEN {n} <= 1 THEN 0 ELSE CAST(ceil((length(bin({n} - 1))) / {DIGIT}D) AS INT) END"


#: the path of child ``j`` through a record's levels, top down: side and digest of the unselected node, ``=`` where there is none
_STEPS = """transform(sequence(size(levels) - 1, 0, -1), k -> CASE WHEN (shiftright(j, k) & 1) = 1
    THEN concat('L', get(levels[k], CAST(shiftright(j, k) - 1 AS INT)))
    ELSE coalesce(concat('R', get(levels[k], CAST(shiftright(j, k) + 1 AS INT))), '=') END)"""


def _descended(at: DataFrame, records: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (tree, prefix, digest, path) one round down: to the children that ``wanted`` (keys and digit ``j``) selects."""
    return (wanted.join(at, keys).join(records, "digest")
            .withColumn("path", F.expr(f"concat(path, {_STEPS})"))
            .withColumn("digest", F.expr("levels[0][CAST(j AS INT)]")).drop("levels"))


def _rounds_down(starts: DataFrame, requests: DataFrame, records: DataFrame, rounds: int) -> DataFrame:
    """Requests (tree, rank, left, ..) with the ``path`` to their leaf; starts(tree, left, digest, path) are the trees' tops.

    ``left`` is the number of records between a tree's top and its leaves.
    """
    frontier = starts.filter("left = 0").select("tree", "digest", "path")
    done = requests.filter("left = 0").join(frontier.select("tree", "path"), "tree")
    at = None
    for r in range(rounds - 1, -1, -1):
        fresh = starts.filter(F.col("left") == r + 1).select("tree", F.lit(0).cast("long").alias("prefix"), "digest", "path")
        at = fresh if at is None else at.union(fresh)
        if r:                                          # requests of one prefix go down together
            digit = F.expr(f"(rank >> {r * DIGIT}) & {FAN - 1}").alias("j")
            wanted = (requests.filter(F.col("left") > r)
                      .select("tree", F.expr(f"rank >> {(r + 1) * DIGIT}").alias("prefix"), digit).distinct())
            at = checkpointed(_descended(at, records, wanted, ["tree", "prefix"])
                              .select("tree", F.expr(f"(prefix << {DIGIT}) | j").alias("prefix"), "digest", "path"))
        else:
            wanted = requests.filter("left > 0").withColumn("prefix", F.expr(f"rank >> {DIGIT}")) \
                .withColumn("j", F.expr(f"rank & {FAN - 1}"))
            # first the record to its place, so that a request meets the record of its 256 ranks only
            here = at.join(records, "digest").drop("digest")
            last = (wanted.join(here, ["tree", "prefix"]).withColumn("path", F.expr(f"concat(path, {_STEPS})"))
                    .drop("levels", "prefix", "j"))
            done = done.unionByName(last)
    return done


def proofs(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests(tree, rank, ..)`` with ``path``: from the leaf to the root, one entry a level.

    An entry is ``L`` or ``R`` and the other node's digest (it stands left or
    right), or ``=`` where a last node is hashed alone.
    """
    most = manifest.trees.agg(F.max("n")).first()[0] or 0
    sized = manifest.trees.withColumn("left", F.expr(_rounds("n")))
    top_rounds, rounds = _count_rounds(manifest.n_trees), _count_rounds(most)
    # ``over`` is a column read back, not a literal: a join on literals alone would be a product
    tops = sized.select(F.col("over").alias("tree"), F.col("top_rank").alias("rank"), F.lit(top_rounds).alias("left"),
                        F.col("tree").alias("of"), F.col("left").alias("own"), "subroot")
    start = manifest.records.sparkSession.createDataFrame(
        [(TOP, top_rounds, manifest.root, [])], "tree string, left int, digest string, path array<string>")
    starts = checkpointed(_rounds_down(start, tops, manifest.records, top_rounds)
                          .select(F.col("of").alias("tree"), F.col("own").alias("left"), F.col("subroot").alias("digest"), "path"))
    asked = requests.join(sized.select("tree", "left"), "tree")
    return _rounds_down(starts, asked, manifest.records, rounds).drop("left").withColumn("path", F.reverse("path"))


def _count_rounds(n: int) -> int:
    return 0 if n <= 1 else -(-(n - 1).bit_length() // DIGIT)


def folded(leaf: str, path: str = "path") -> Column:
    """The root that a leaf and its path lead to."""
    return F.expr(f"""aggregate({path}, {leaf}, (a, p) -> sha2(CASE left(p, 1)
        WHEN 'L' THEN concat(substring(p, 2), a) WHEN 'R' THEN concat(a, substring(p, 2)) ELSE a END, 256))""")


def proof_digest(path: str = "path") -> Column:
    """One digest over the siblings of a path, in order."""
    return F.expr(f"sha2(array_join(transform(filter({path}, p -> p <> '='), p -> substring(p, 2)), ''), 256)")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' leaves, proofs and verdicts, some of them tampered with."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce((F.col("doc_id").isNotNull()) & (crc32_of_id() % TAMPER_MOD == 0), F.lit(False))
    shown = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    leaves = docs.select(tree_name().alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                         leaf_digest().alias("leaf"), leaf_digest(n_chars=shown).alias("shown"))
    m = build_manifest(leaves)
    if m.root is None:
        return spark.createDataFrame([], OP12_SCHEMA)
    subroots = m.trees.select("tree", "subroot")
    out = (proofs(m, m.leaves).join(subroots, "tree").withColumn("root", F.lit(m.root))
           .withColumn("proof_sha256", proof_digest()).withColumn("folded_root", folded("shown")))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


OP12_SCHEMA = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
               "verified boolean")

#: levels of a tree are rows (lvl, tree, pos, digest); a proof is folded along its rows
OP12_SQL = """
WITH RECURSIVE bits(v, i, c) AS (
  SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
  UNION ALL
  SELECT v, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE i < 8),
crc_table AS (SELECT list(c ORDER BY v) AS t FROM bits WHERE i = 8),
enc AS (
  SELECT doc_id, lang, n_chars,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR) END AS e1,
    CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END AS e2,
    CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS e3,
    CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR) END AS e4,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS e5,
    CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || CAST(n_chars + 1 AS VARCHAR) END AS e4t,
    doc_id IS NOT NULL AND xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: xor(a >> 8, t[CAST(xor(a, b) & 255 AS INT) + 1])), 4294967295) % 7 = 0 AS tamper
  FROM documents, crc_table),
leafs AS (
  SELECT doc_id, lang, sha256(e1 || e2 || e3 || e4 || e5) AS leaf,
         sha256(e1 || e2 || e3 || (CASE WHEN tamper THEN e4t ELSE e4 END) || e5) AS shown FROM enc),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n,
         coalesce('1' || lang, '0') AS tree FROM leafs),
nodes(lvl, tree, pos, n, digest) AS (
  SELECT 0, tree, CAST(pos AS BIGINT), CAST(n AS BIGINT), leaf FROM ranked
  UNION ALL
  SELECT lvl + 1, tree, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lvl, tree, n, pos // 2),
subs AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops(lvl, pos, n, digest) AS (
  SELECT 0, CAST(pos AS BIGINT), CAST(n AS BIGINT), subroot FROM subs
  UNION ALL
  SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY lvl, n, pos // 2),
root AS (SELECT digest AS root FROM tops WHERE n = 1),
steps AS (
  SELECT r.tree, r.pos AS leaf_pos, x.lvl AS step, x.pos % 2 = 0 AS left_of, x.digest
  FROM ranked r JOIN nodes x ON x.tree = r.tree AND x.n > 1 AND x.pos = xor(r.pos >> x.lvl, 1)
  UNION ALL
  SELECT r.tree, r.pos, 1000 + t.lvl, t.pos % 2 = 0, t.digest
  FROM ranked r JOIN subs s ON s.tree = r.tree JOIN tops t ON t.n > 1 AND t.pos = xor(s.pos >> t.lvl, 1)),
proof AS (SELECT tree, leaf_pos, sha256(string_agg(digest, '' ORDER BY step)) AS proof FROM steps GROUP BY 1, 2),
ways AS (
  SELECT r.tree, r.pos AS leaf_pos, x.lvl AS step FROM ranked r
  JOIN (SELECT DISTINCT tree, lvl FROM nodes WHERE n > 1) x ON x.tree = r.tree
  UNION ALL
  SELECT r.tree, r.pos, 1000 + t.lvl FROM ranked r JOIN (SELECT DISTINCT lvl FROM tops WHERE n > 1) t ON TRUE),
way AS (
  SELECT w.tree, w.leaf_pos, row_number() OVER (PARTITION BY w.tree, w.leaf_pos ORDER BY w.step) AS k, s.left_of, s.digest
  FROM ways w LEFT JOIN steps s USING (tree, leaf_pos, step)),
fold(tree, leaf_pos, k, digest) AS (
  SELECT tree, CAST(pos AS BIGINT), CAST(0 AS BIGINT), shown FROM ranked
  UNION ALL
  SELECT f.tree, f.leaf_pos, f.k + 1, sha256(CASE WHEN w.digest IS NULL THEN f.digest
         WHEN w.left_of THEN w.digest || f.digest ELSE f.digest || w.digest END)
  FROM fold f JOIN way w ON w.tree = f.tree AND w.leaf_pos = f.leaf_pos AND w.k = f.k + 1),
ended AS (SELECT tree, leaf_pos, arg_max(digest, k) AS folded_root FROM fold GROUP BY 1, 2)
SELECT r.doc_id, r.leaf, s.subroot, root.root, coalesce(p.proof, sha256('')) AS proof_sha256, e.folded_root,
       e.folded_root = root.root AS verified
FROM ranked r JOIN subs s ON s.tree = r.tree JOIN ended e ON e.tree = r.tree AND e.leaf_pos = r.pos
     LEFT JOIN proof p ON p.tree = r.tree AND p.leaf_pos = r.pos, root
"""
