"""Merkle manifest of a dataset, levels kept as concatenated strings.

A row is a leaf: the sha256 of its fields. Per partition (``lang``) the leaves,
in ascending order of ids, are the bottom of a tree: while several nodes remain,
every two consecutive ones (a last one alone) become the sha256 of their hex
digests. The partitions' subroots, in order of the partition's name, are the
bottom of one more tree, whose top is the root.

Leaves are numbered in sorted ranges (``fmspark.functions.ordered``) and dealt
to aligned blocks of ``2 ** LEVELS`` consecutive ones. A block keeps each of its
levels as one string of 64-character digests: the parents are the hashes of the
128-character substrings, and node ``i``'s sibling is the substring that flanks
it, so a whole proof segment is cut out by arithmetic. Blocks' tops are the
leaves of the next tier of blocks, until a partition has one block. A tier has
``2 ** LEVELS`` times fewer rows than the one below; a partition with any share
of the rows is as many blocks as it needs, and a block has a fixed size.

Going down again, a block hands its own path (the siblings above it) to its
nodes. A path is a list with one item a level: ``L`` or ``R``, the side on which
the sibling stands, and its digest; ``-`` where the node was alone.

All of it is built-in SQL functions.

Cases: a null field is ``-``. Rows with null ids come first in their partition;
rows of equal id are ordered by their digests, and equal rows stand one after
the other. Null is a partition of its own, the first. An empty table has no
rows and no root. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fmspark.functions.ordered import numbered

from .common import documents, saved, small

LEVELS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*values: Column) -> Column:
    """The sha256 (lowercase hex) of fields: each ``-`` if null, else its UTF-8
    byte count, ``:`` and the value."""
    def field(v: Column) -> Column:
        s = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


@dataclass(frozen=True)
class Tree:
    """Written tables. ``leaves``: the input with ``grp`` and ``idx`` (0-based in
    its group). ``tiers``: per tier the blocks ``grp, c`` (nodes of the group in
    this tier) ``, block, size, levels``. ``tops``: ``grp, digest``."""

    leaves: DataFrame
    tiers: list[DataFrame]
    tops: DataFrame


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` (grp, c, idx, digest) as blocks with all levels, the last one
    the block's top."""
    wide = 1 << levels
    grouped = (nodes.groupBy("grp", "c", F.expr(f"idx div {wide}").alias("block"))
               .agg(F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("m")))
    # a group with one block ends where one node remains; other blocks go through all levels
    depth = f"CASE WHEN c > {wide} THEN {levels} ELSE CAST(ceil(log2(c)) AS INT) END"
    up = ("concat(acc, array(array_join(transform(sequence(0, (length(element_at(acc, -1)) - 1) div 128), "
          "i -> sha2(substring(element_at(acc, -1), 128 * i + 1, 128), 256)), '')))")
    steps = ", ".join(str(k) for k in range(levels))
    return saved(grouped.select("grp", "c", "block", F.size("m").alias("size"), F.expr(
        f"aggregate(slice(array({steps}), 1, {depth}), array(array_join(m.digest, '')), (acc, k) -> {up})").alias("levels")), "blocks")


def build(leaves: DataFrame, grp: str, order: list[Column], *, levels: int = LEVELS) -> Tree:
    """The trees of ``leaves`` (with a column ``digest``), one a value of ``grp``,
    numbered in ``order``. ``leaves`` has no columns ``idx``, ``c``."""
    wide = 1 << levels
    placed = saved(numbered(leaves, order, by=[grp], out_col="idx").withColumnRenamed(grp, "grp"), "leaves")
    counts = saved(placed.groupBy(F.col("grp").alias("g")).agg(F.count(F.lit(1)).alias("c")), "counts")
    nodes = (placed.select("grp", "idx", "digest").join(small(counts, 64), F.col("grp").eqNullSafe(F.col("g")))
             .select("grp", "c", "idx", "digest"))
    tiers, tops = [], None
    while True:
        blocks = _blocks(nodes, levels)
        tiers.append(blocks)
        top = blocks.select("grp", "c", F.col("block").alias("idx"), F.element_at("levels", -1).alias("digest"))
        done = top.where(F.col("c") <= wide).select("grp", "digest")
        tops = done if tops is None else tops.unionByName(done)
        nodes = top.where(F.col("c") > wide).withColumn("c", F.expr(f"(c + {wide - 1}) div {wide}"))
        if nodes.isEmpty():
            return Tree(placed, tiers, saved(tops, "tops"))


def paths(tree: Tree, above: DataFrame, *, levels: int = LEVELS) -> DataFrame:
    """``grp, idx, path, root`` of every leaf. ``above``: ``grp, path, root`` of
    the groups' tops."""
    wide = 1 << levels
    segment = ("transform(slice(levels, 1, size(levels) - 1), (s, j) -> concat("
               "CASE WHEN substring(s, 64 * (shiftright(i, j) ^ 1) + 1, 64) = '' THEN '-' WHEN shiftright(i, j) % 2 = 1 THEN 'L' ELSE 'R' END, "
               "substring(s, 64 * (shiftright(i, j) ^ 1) + 1, 64)))")
    each = F.inline(F.expr(f"transform(sequence(0, size - 1), i -> struct(block * {wide} + i AS idx, concat({segment}, path) AS path))"))
    known = None
    for t in range(len(tree.tiers) - 1, -1, -1):
        blocks = tree.tiers[t]
        ends = above.select(F.col("grp").alias("g"), F.lit(0).cast("long").alias("b"), "path", "root")
        last = blocks.where(F.col("c") <= wide).join(small(ends, 256), F.col("grp").eqNullSafe(F.col("g")))
        parts = [last]
        if known is not None:  # the nodes of the tier above are this tier's blocks
            up = known.select(F.col("grp").alias("g"), F.col("idx").alias("b"), "path", "root")
            parts.append(blocks.where(F.col("c") > wide).join(up, F.col("grp").eqNullSafe(F.col("g")) & (F.col("block") == F.col("b"))))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        known = rows.select("grp", "root", each)
        if t:
            known = saved(known, "paths")
    return known


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    def step(acc: Column, x: Column) -> Column:
        other = F.substring(x, 2, 64)
        return F.sha2(F.when(F.startswith(x, F.lit("L")), F.concat(other, acc)).when(F.startswith(x, F.lit("R")), F.concat(acc, other)).otherwise(acc), 256)
    return F.aggregate(path, leaf, step)


def proof(path: Column) -> Column:
    """The sha256 of a path's digests, bottom up."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.substring(x, 2, 64)), ""), 256)


def manifest(docs: DataFrame, *, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", part_col: str = "lang",
             extra: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """One row a document: ``doc_id, grp`` (its partition) ``, leaf, subroot,
    root, path`` and the ``extra`` columns, which are carried along."""
    extra = extra or {}
    leaves = saved(docs.select(F.col(id_col).alias("_id"), F.col(part_col).alias("_grp"), digest(*[F.col(f) for f in fields]).alias("digest"),
                               *[c.alias(f"_x_{n}") for n, c in extra.items()]), "digests")
    spread = F.monotonically_increasing_id()  # equal rows do not share a range
    tree = build(leaves.withColumn("_row", spread), "_grp", [F.col("_id").asc_nulls_first(), F.col("digest"), F.col("_row")], levels=levels)
    over = build(tree.tops.select(F.lit(0).alias("_all"), F.col("grp").alias("_name"), "digest"), "_all", [F.col("_name").asc_nulls_first()], levels=levels)
    root = over.tops.select("grp", F.array().cast("array<string>").alias("path"), F.col("digest").alias("root"))
    of_part = paths(over, root, levels=levels).join(over.leaves.select("idx", F.col("_name"), F.col("digest").alias("subroot")), "idx")
    of_part = saved(of_part.select(F.col("_name").alias("grp"), "path", F.struct("subroot", "root").alias("root")), "above")
    leaf = tree.leaves.select(F.col("grp").alias("g"), F.col("idx").alias("i"), "_id", "digest", *[f"_x_{n}" for n in extra])
    rows = paths(tree, of_part, levels=levels).join(leaf, F.col("grp").eqNullSafe(F.col("g")) & (F.col("idx") == F.col("i")))
    return rows.select(F.col("_id").alias("doc_id"), "grp", F.col("digest").alias("leaf"), "root.subroot", "root.root", "path",
                       *[F.col(f"_x_{n}").alias(n) for n in extra])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    wrong = digest(*[more if f == "n_chars" else F.col(f) for f in FIELDS])
    rows = manifest(documents(spark, sf_dir), extra={"tampered": F.when(hit & F.col("n_chars").isNotNull(), wrong)})
    out = rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
                      fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = """
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, lang, n_chars, source, text,
    list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda k: 0::UBIGINT)),
        lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)) AS crc
  FROM documents),
f AS MATERIALIZED (
  SELECT doc_id, lang, n_chars IS NOT NULL AND xor(crc, 4294967295::UBIGINT) % 7 = 0 AS hit,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS mid,
    strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) AS wrong,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM d),
leaf AS MATERIALIZED (
  SELECT doc_id, lang, sha256(head || mid || tail) AS leaf,
    CASE WHEN hit THEN sha256(head || wrong || tail) ELSE sha256(head || mid || tail) END AS start,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS c
  FROM f),
tree AS (
  SELECT lang, 0 AS lev, c, idx, leaf AS h FROM leaf
  UNION ALL
  SELECT lang, lev + 1, (c + 1) // 2, idx // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM tree WHERE c > 1
  GROUP BY lang, lev, c, idx // 2),
sub AS MATERIALIZED (
  SELECT lang, h AS subroot, lev AS depth, row_number() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS idx, count(*) OVER () AS c
  FROM tree WHERE c = 1),
over_ AS (
  SELECT 0 AS lev, c, idx, subroot AS h FROM sub
  UNION ALL
  SELECT lev + 1, (c + 1) // 2, idx // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM over_ WHERE c > 1
  GROUP BY lev, c, idx // 2),
root AS (SELECT h AS root FROM over_ WHERE c = 1),
steps AS MATERIALIZED (
  SELECT l.lang, l.idx, t.lev AS step, (l.idx >> t.lev) % 2 AS side, s.h
  FROM leaf l JOIN (SELECT DISTINCT lang, lev FROM tree WHERE c > 1) t ON t.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM l.lang AND s.lev = t.lev AND s.idx = xor(l.idx >> t.lev, 1)
  UNION ALL
  SELECT l.lang, l.idx, u.depth + t.lev, (u.idx >> t.lev) % 2, s.h
  FROM leaf l JOIN sub u ON u.lang IS NOT DISTINCT FROM l.lang JOIN (SELECT DISTINCT lev FROM over_ WHERE c > 1) t ON TRUE
  LEFT JOIN over_ s ON s.lev = t.lev AND s.idx = xor(u.idx >> t.lev, 1)),
fold AS (
  SELECT lang, idx, 0 AS step, start AS h FROM leaf
  UNION ALL
  SELECT f.lang, f.idx, f.step + 1, sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.side = 1 THEN s.h || f.h ELSE f.h || s.h END)
  FROM fold f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.idx = f.idx AND s.step = f.step),
proofs AS (SELECT lang, idx, sha256(coalesce(string_agg(h, '' ORDER BY step), '')) AS p, max(step) + 1 AS n FROM steps GROUP BY lang, idx)
SELECT l.doc_id, l.leaf, u.subroot, r.root, coalesce(p.p, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = r.root AS verified
FROM leaf l JOIN sub u ON u.lang IS NOT DISTINCT FROM l.lang JOIN root r ON TRUE
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.idx = l.idx
JOIN fold f ON f.lang IS NOT DISTINCT FROM l.lang AND f.idx = l.idx AND f.step = coalesce(p.n, 0)
"""
