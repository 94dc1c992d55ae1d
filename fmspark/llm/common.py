"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fmspark.session import materialize, maybe_broadcast, ship  # noqa: F401

# What one broadcast may hold; larger sides go through a shuffle join.
SMALL_SIDE_BYTES = 16 * 1024 * 1024


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back:
    evaluated once, and kept when executors are lost."""
    return materialize(df, name)


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if a bounded count proves it small enough."""
    return maybe_broadcast(df, row_bytes, SMALL_SIDE_BYTES)[0]


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: Column) -> Column:
    """16-byte content key: two texts share it only if they are equal."""
    return F.unhex(F.md5(text))


def n_words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
