"""Load the latent table, training the model when it does not exist."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_latent(spark: SparkSession, path: str,
                fit: Callable[[], DataFrame] | None = None) -> tuple[DataFrame, int]:
    """``(latent(idx, v), k)``. When ``path`` does not exist and ``fit`` is
    given, ``fit()`` produces the table, which is written to ``path`` first."""
    try:
        lat = spark.read.parquet(path)
    except AnalysisException as e:
        # any other error is a table that is there: it must not be overwritten
        if fit is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        fit().write.mode("overwrite").parquet(path)
        lat = spark.read.parquet(path)
    k = lat.select(F.max(F.size("v"))).first()[0] or 0
    return lat, int(k)
