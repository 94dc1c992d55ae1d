"""Index map, hash split, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fmspark import defaults as DF
from fmspark.functions.ordered import dense_positions

BUCKETS = 10_000


def feature_map(rows: DataFrame, features: str = "features",
                parts: int | None = None) -> tuple[DataFrame, int]:
    """Distinct feature indices of all rows, ascending -> ``0..n-1``.

    ``((idx int, pos int), n)``. The distinct runs as a partial + final hash
    aggregation; the numbering runs in value ranges (functions.ordered), so no
    task holds the whole index set. The map is written once, then read."""
    idx = rows.select(F.explode_outer(features).alias("_p")).select(F.col("_p.idx").alias("idx"))
    return dense_positions(idx, "idx", "pos", parts)


def hash_unit(key, seed: int | None = None) -> Column:
    """Stable uniform bucket ``0..9999`` of a key: the first 32 bits of
    ``md5(key)`` (``md5(seed:key)`` when seeded) modulo 10,000. Independent of
    partitioning and of recomputation, and equal in any engine with md5."""
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    if seed is not None:
        k = F.concat(F.lit(f"{seed}:"), k)
    return F.pmod(F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint"), F.lit(BUCKETS))


def with_part(df: DataFrame, key: str, ratio: float = DF.TRAIN_RATIO, seed: int | None = None,
              col: str = "part") -> DataFrame:
    """Tag rows ``train`` / ``test``. Disjoint and total by construction."""
    cut = int(round(ratio * BUCKETS))
    return df.withColumn(col, F.when(hash_unit(key, seed) < F.lit(cut), F.lit("train")).otherwise(F.lit("test")))


def split(df: DataFrame, key: str, ratio: float = DF.TRAIN_RATIO, seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` as two complementary filters of the same input."""
    cut = int(round(ratio * BUCKETS))
    u = hash_unit(key, seed)
    return df.where(u < F.lit(cut)), df.where(u >= F.lit(cut))


def split_counts(df: DataFrame, key: str, ratio: float = DF.TRAIN_RATIO, seed: int | None = None) -> DataFrame:
    """Rows per part."""
    return with_part(df, key, ratio, seed).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def row_col_count(df: DataFrame) -> DataFrame:
    """Row count and column count of a table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))
