"""Table reads.

Filters are plain column predicates, so Catalyst turns them into partition
pruning (``dt`` as a partition column) or pushed parquet filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fmspark import defaults as DF
from fmspark.operators.rows import numeric_frame
from fmspark.session import collect_bounded


def _table(spark_or_df, table: str | None) -> DataFrame:
    if isinstance(spark_or_df, DataFrame):
        return spark_or_df
    return spark_or_df.table(table)


def read_range(src, from_dt: str, to_dt: str, table: str | None = None, dt: str = "dt") -> DataFrame:
    """A1: all columns with ``dt`` between two ``yyyyMMdd`` strings, inclusive.
    ``src`` is a session (then ``table`` is read from the catalog) or a
    DataFrame."""
    return _table(src, table).where(F.col(dt).between(F.lit(str(from_dt)), F.lit(str(to_dt))))


def read_day(src, day: str, table: str | None = None, dt: str = "dt") -> DataFrame:
    """A2: a single day."""
    return _table(src, table).where(F.col(dt) == F.lit(str(day)))


def shape(df: DataFrame) -> tuple[int, int]:
    """A1's report: (rows, columns)."""
    return df.count(), len(df.columns)


def transform_spec(meta: DataFrame, model: str, max_index: int = DF.MAX_SPEC_INDEX) -> dict:
    """``{fieldname: transform}`` for one model from a metadata table
    ``(fieldname, transform, modelname, indexnum)``. The table is read by the
    caller (``spark.read.jdbc`` with the caller's options, or any table); the
    spec is configuration, so it is collected (bounded by ``max_index``)."""
    rows = collect_bounded(meta.where((F.col("modelname") == F.lit(model)) & (F.col("indexnum") <= F.lit(max_index)))
                           .select("fieldname", "transform"), max_index + 1, "transform spec")
    return {r["fieldname"]: r["transform"] for r in rows}


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict) -> DataFrame:
    """A6 source for users with a database; options come from the caller."""
    return spark.read.jdbc(url=url, table=table, properties=properties)


def read_csv_numeric(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV -> numeric columns, nulls filled with 0 (distributed
    read; the reference used pandas on the driver)."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return numeric_frame(df)
