"""Shards of bounded size by extendible hashing.

Rows are placed by the bits of a hash of their id. A directory node is a prefix
of those bits; a node that holds more bytes than the limit splits on the next
bit, others stay whole, so shards are the shallowest prefixes that fit. The sums
of all prefixes down to a depth come from one aggregate over a histogram, and
only the rows of nodes that are still too large look at deeper bits.

Rows with one id have the same hash; bits 64 to 127 come from a second hash of
the row's own number, so that an id with a third of all rows splits as well. A
single row larger than the limit is a shard of its own, marked ``oversized``.

Cases: a null id is an id like others. A null or empty text has ``row_bytes``
overhead only. An empty table gives no rows. Further columns are untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fmspark.functions.ordered import numbered

from .common import documents, saved, small

LIMIT = 16 * 1024 * 1024
ROW_BYTES = 32
STEP = 8


def _prefix(bits: Column, depth: Column) -> Column:
    """The first ``depth`` (0 to 63) bits of a 64-bit hash as a number."""
    shift = (F.lit(63) - depth).cast("int")
    return F.call_function("shiftrightunsigned", F.call_function("shiftrightunsigned", bits, F.lit(1)), shift)


def _split(rows: DataFrame, bits: str, limit: int, first: int, most: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Leaf tables (node, depth, prefix, bytes, n) of rows (node, bits, size)
    by their first ``most`` bits, and the nodes that did not fit."""
    leaves, base, step = [], 0, first
    while True:
        depth = min(most, base + step)
        hist = saved(rows.groupBy("node", _prefix(F.col(bits), F.lit(depth)).alias("p"))
                     .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "histogram")
        up = F.explode(F.sequence(F.lit(base), F.lit(depth)))
        nodes = saved(hist.select("node", "p", "bytes", "n", up.alias("depth"))
                      .withColumn("prefix", F.expr(f"shiftright(p, cast({depth} - depth as int))"))
                      .groupBy("node", "depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")), "nodes")
        full = nodes.where((F.col("bytes") > limit) & (F.col("n") > 1))
        parents = full.select("node", (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
        fits = nodes.where(~((F.col("bytes") > limit) & (F.col("n") > 1))).withColumn("up", F.expr("shiftright(prefix, 1)"))
        top = fits.where(F.col("depth") == base) if base == 0 else None
        below = fits.where(F.col("depth") > base).join(parents, ["node", "depth", "up"], "left_semi")
        leaf = below if top is None else below.unionByName(top)
        leaves.append(leaf.select("node", "depth", "prefix", "bytes", "n"))
        left = saved(full.where(F.col("depth") == depth).select("node", "prefix"), "left")
        if left.isEmpty() or depth == most:
            return leaves, left
        p = _prefix(F.col(bits), F.lit(depth))
        rows = rows.withColumn("prefix", p).join(small(left, 64), ["node", "prefix"], "left_semi").drop("prefix")
        base, step = depth, STEP


def shard(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT,
          row_bytes: int = ROW_BYTES) -> DataFrame:
    """A written table ``_id, size, shard`` (bits of the prefix, as text),
    ``depth, shard_bytes, shard_rows, oversized``."""
    rows = saved(docs.select(F.col(id_col).alias("_id"), (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + row_bytes)
                             .cast("long").alias("size"), F.xxhash64(F.col(id_col)).alias("h1"), F.xxhash64(F.col(text_col)).alias("text")), "rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    first = max(1, min(24, math.ceil(math.log2(max(1.0, total / limit))) + 3))
    leaves, left = _split(rows.select(F.lit(0).cast("long").alias("node"), "h1", "size"), "h1", limit, first, 63)
    out = [_assign(rows, leaves, "h1", F.lit(0).cast("long"), "")]
    if left is not None and not left.isEmpty():  # many rows with one hash: on to their own bits
        node = _prefix(F.col("h1"), F.lit(63))
        deep = rows.withColumn("node", node).join(small(left.select(F.col("prefix").alias("node")), 32), "node", "left_semi")
        # told apart by text, equal rows by a number: the same shards in any order of the rows
        deep = numbered(deep.withColumn("row", F.monotonically_increasing_id()), [F.col("row")], by=["node", "text"], out_col="nth")
        deep = saved(deep.withColumn("h2", F.xxhash64(F.lit(1), "text", "nth")).drop("row", "nth"), "deep")
        more, _ = _split(deep.select("node", "h2", "size"), "h2", limit, STEP, 63)
        out.append(_assign(deep.drop("node"), more, "h2", node, "h1"))
    result = out[0]
    for x in out[1:]:
        result = result.unionByName(x)
    return result.withColumn("oversized", F.col("shard_bytes") > limit)


def _assign(rows: DataFrame, leaves: list[DataFrame], bits: str, node: Column, above: str) -> DataFrame:
    """Rows joined with their leaf through a directory of the depths in use."""
    every = leaves[0]
    for x in leaves[1:]:
        every = every.unionByName(x)
    every = saved(every, "leaves")
    depths = sorted(r["depth"] for r in every.select("depth").distinct().collect())  # 64 at most
    if not depths:
        depths = [0]
    tries = F.explode(F.array(*[F.lit(d) for d in depths]))
    side = every.select(F.col("node"), F.col("depth"), F.col("prefix"), F.col("bytes").alias("shard_bytes"), F.col("n").alias("shard_rows"))
    placed = (rows.withColumn("node", node).withColumn("depth", tries).withColumn("prefix", _prefix(F.col(bits), F.col("depth")))
              .join(small(side, 64), ["node", "depth", "prefix"]))
    name = F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), "0")
    name = F.when(F.col("depth") == 0, F.lit("")).otherwise(name)
    if above:
        name = F.concat(F.lpad(F.conv(F.col("node").cast("string"), 10, 2), 63, "0"), F.lit("."), name)
    return placed.select("_id", "size", name.alias("shard"), F.col("depth").cast("int"), "shard_bytes", "shard_rows")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir)).withColumnRenamed("_id", "doc_id")
