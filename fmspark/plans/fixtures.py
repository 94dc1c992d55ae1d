"""Inputs derived from the test tables (see FIXTURES.md).

* ``feature_rows``  the raw feature table: one row per order
* ``sparse_rows``   equal-width sparse rows with explicit zeros, threshold 5:
                    idx 1-5 continuous, 6-10 segment, 11-35 nation, 36-40 priority
* ``latent``        ``(idx, v array<double>)`` from ``embeddings``
* ``fm_model``      bias, linear and latent tables for scoring
* ``field_of``      ``(idx, field)``
* ``ffm_model``     ``(idx, field, v)``
* ``scores``        ``(y, s)`` with many ties

Every fixture is a lazy DataFrame over the parquet tables, so its work grows
with the tables. The one-hot expansion of ``sparse_rows`` needs the category
lists; they are collected with a size bound (as a StringIndexer fit would),
never by a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fmspark.functions.sparse import pair
from fmspark.session import collect_bounded, materialize

# Fixed values of the fixture layout (FIXTURES.md): the threshold between
# continuous and one-hot indices, the latent rank, the FM bias and the FFM
# factor width per field.
THRESHOLD = 5
K = 8
FM_BIAS = 0.1
FFM_K = 4
N_FIELDS = 8
MAX_CATEGORIES = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customers: what the categories are read from."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey)


def _prio() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # partial aggregation per order before the join: one row per order leaves the map side
    q = (table(spark, sf_dir, "lineitem")
         .groupBy("l_orderkey")
         .agg(F.sum("l_quantity").alias("qty"),
              F.sum(F.when(F.col("l_discount") == 0, 1).otherwise(0)).alias("nd")))
    prio = _prio()
    d = F.col("o_orderdate")
    return (_orders(spark, sf_dir)
            .join(q, F.col("l_orderkey") == F.col("o_orderkey"), "left")
            .select(
                F.col("o_orderkey").cast("string").alias("order_id"),
                F.concat(F.lit("SN"), F.col("o_orderkey").cast("string")).alias("order_sn"),
                F.col("o_custkey").alias("user_id"),
                (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("string").alias("dt"),
                F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("target"),
                ((F.col("c_nationkey") + prio) % 2).alias("target_planted"),
                F.col("o_totalprice").alias("f_price"),
                F.col("c_acctbal").alias("f_bal"),
                F.col("qty").cast("double").alias("f_qty"),
                F.col("nd").cast("double").alias("f_zero_disc"),
                F.col("c_mktsegment").alias("f_seg"),
                F.col("c_nationkey").alias("f_nation"),
                prio.alias("f_prio"),
                F.when(F.col("o_totalprice") > 250000, 1).otherwise(0).alias("f_flag")))


def categories(df: DataFrame, *cols: str) -> dict[str, list]:
    """Sorted distinct non-null values of categorical columns, all in one job
    (the columns are stacked to ``(column, value)`` and de-duplicated with a
    partial + final aggregation), size-checked before the collect."""
    stacked = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])))
    rows = collect_bounded(stacked.where(F.col("v").isNotNull()).distinct(), MAX_CATEGORIES, "categories")
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {c: [] for c in cols}
    for r in rows:
        v = r["v"]
        out[r["c"]].append(int(v) if types[r["c"]].typeName() in ("integer", "long", "short", "byte") else v)
    return {c: sorted(vs) for c, vs in out.items()}


def one_hot_pairs(value: Column, cats: list, first_idx: Column | int) -> list[Column]:
    """Explicit one-hot pairs (zeros included) for a categorical value."""
    out = []
    for i, cat in enumerate(cats):
        idx = first_idx(cat, i) if callable(first_idx) else first_idx + i
        out.append(pair(F.lit(idx), F.when(value == F.lit(cat), F.lit(1.0)).otherwise(F.lit(0.0))))
    return out


def sparse_rows(spark: SparkSession, sf_dir: str, label: str = "target", written: bool = False) -> DataFrame:
    """``row_id bigint, order_id string, label int, features array<struct<idx,val>>``.
    ``label="target_planted"`` gives the planted-interaction label. ``written``: the joined
    rows are written, for rows that are read several times."""
    fr = feature_rows(spark, sf_dir)
    if written:
        fr = materialize(fr.select("order_id", label, *[c for c in fr.columns if c.startswith("f_")]), "feature-rows")
    # the join with the line items adds no category
    cats = categories(_orders(spark, sf_dir).select(F.col("c_mktsegment").alias("f_seg"), F.col("c_nationkey").alias("f_nation"), _prio().alias("f_prio")),
                      "f_seg", "f_nation", "f_prio")
    segs, nations, prios = cats["f_seg"], cats["f_nation"], cats["f_prio"]
    feats = [
        pair(F.lit(1), F.col("f_price") / F.lit(500000)),
        pair(F.lit(2), F.col("f_bal")),
        pair(F.lit(3), F.coalesce(F.col("f_qty"), F.lit(0.0))),
        pair(F.lit(4), F.coalesce(F.col("f_zero_disc"), F.lit(0.0))),
        pair(F.lit(5), F.col("f_flag")),
    ]
    feats += one_hot_pairs(F.col("f_seg"), segs, THRESHOLD + 1)
    feats += one_hot_pairs(F.col("f_nation"), nations, lambda n, i: 11 + n)
    feats += one_hot_pairs(F.col("f_prio"), prios, lambda p, i: 35 + p)
    return fr.select(F.col("order_id").cast("long").alias("row_id"), "order_id",
                     F.col(label).alias("label"), F.array(*feats).alias("features"))


def sparse_long(rows: DataFrame) -> DataFrame:
    """Long form ``(order_id, label, idx, val)`` of sparse rows."""
    return rows.select("order_id", "label", F.inline("features"))


def latent(spark: SparkSession, sf_dir: str, k: int = K) -> DataFrame:
    """``idx int, v array<double>``: the first k elements, cast to double
    before any arithmetic."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("idx"),
        F.transform(F.slice("embedding", 1, k), lambda x: x.cast("double")).alias("v"))


def fm_model(spark: SparkSession, sf_dir: str, k: int = K):
    """``(bias, linear, latent)`` with bias 0.1, ``w = embedding[9]``,
    ``v = embedding[1..8]`` (one-based)."""
    e = table(spark, sf_dir, "embeddings")
    linear = e.select(F.col("vec_id").cast("int").alias("idx"),
                      F.element_at("embedding", k + 1).cast("double").alias("w"))
    return FM_BIAS, linear, latent(spark, sf_dir, k)


def field_expr(idx: Column) -> Column:
    """Field of an index in the fixture layout: 1-5 own field, 6-10 -> 6,
    11-35 -> 7, 36-40 -> 8."""
    return (F.when(idx <= 5, idx).when(idx <= 10, F.lit(6)).when(idx <= 35, F.lit(7))
            .otherwise(F.lit(8))).cast("int")


def field_of(rows: DataFrame) -> DataFrame:
    """``(idx, field)`` for the indices that occur in the rows."""
    idx = rows.select(F.explode("features").alias("p")).select(F.col("p.idx").alias("idx")).distinct()
    return idx.select("idx", field_expr(F.col("idx")).alias("field"))


def field_table(indexed: DataFrame) -> DataFrame:
    """``(idx, field)`` for the indices of a model table (``idx`` column)."""
    return indexed.select(F.col("idx").cast("int").alias("idx")).distinct() \
        .select("idx", field_expr(F.col("idx")).alias("field"))


def ffm_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(idx int, field int, v array<double>)``: the factor of idx toward
    field f is ``slice(embedding, 1 + 4*(f-1), 4)``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").cast("int").alias("idx"),
        F.inline(F.transform(F.sequence(F.lit(1), F.lit(N_FIELDS)), lambda f: F.struct(
            f.cast("int").alias("field"),
            F.transform(F.slice("embedding", F.lit(1) + F.lit(FFM_K) * (f - 1), FFM_K),
                        lambda x: x.cast("double")).alias("v")))))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(y int, s double)``: status F against the rounded price (many ties)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y"),
                    F.round(F.col("o_totalprice") / 1000).alias("s"))
