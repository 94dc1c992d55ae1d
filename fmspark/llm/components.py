"""Connected components of an edge table, as DataFrame aggregates and joins.

Hook and jump: every root that has smaller neighbours hooks itself to the
smallest of them, hooks are followed to their end by doubling, and edges are
renamed by the roots of their ends, until no edge is left between roots. A star
or a tree whose parents are smaller takes one round. A node with a third of all
edges is one group of a partial minimum and one key of a join of two written
tables, which AQE splits; it is never a list. Every step is written to the
shared folder; the driver sees counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _flat(hooks: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) of hooks (node, root) with smaller roots, each followed to
    its end."""
    for _ in range(max_rounds):
        up = hooks.select(F.col("node").alias("root"), F.col("root").alias("up"))
        nxt = saved(hooks.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"),
                                                          F.col("up").isNotNull().alias("moved")), "hooks")
        hooks = nxt.select("node", "root")
        if nxt.where("moved").isEmpty():
            return hooks
    raise RuntimeError("hooks did not settle")


def renamed(pairs: DataFrame, roots: DataFrame, *cols: str) -> DataFrame:
    """``pairs`` with the columns replaced by the root of their node."""
    for c in cols:
        r = roots.select(F.col("node").alias(c), F.col("root").alias("_r"))
        pairs = pairs.join(r, c, "left").withColumn(c, F.coalesce("_r", c)).drop("_r")
    return pairs


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``edges`` (u, v), any orderable type -> (node, root): ``root`` is the
    smallest node of the component, itself not listed. Nodes without an edge do
    not appear. Loops and repeated edges have no effect."""
    edges = saved(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    total = None
    for _ in range(max_rounds):
        hooks = _flat(saved(edges.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root")), "hooks"))
        total = hooks if total is None else saved(renamed(total, hooks, "root").unionByName(hooks), "roots")
        moved = renamed(edges, hooks, "u", "v").where("u <> v")
        edges = saved(moved.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
        if edges.isEmpty():
            return total
    raise RuntimeError("components did not settle")
