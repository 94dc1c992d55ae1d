"""Numbering and running sums over sorted rows, one way at every size.

A window with ``orderBy`` and no ``partitionBy`` moves every row into one task.
Here rows are sorted into value ranges (one a shuffle partition), written with
the number of their range and their place in it, and the ranges' totals, one
row a range, become offsets. The written table fixes the ranges, so a task that
runs again sees the same ones.

Order of values: null first, then ascending, NaN after every number and equal
to itself (as ``ORDER BY`` has it).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fmspark.session import materialize, maybe_broadcast

# monotonically_increasing_id keeps a row's place in its partition in its low bits
PLACE_BITS = 33


def in_ranges(df: DataFrame, order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """``df`` sorted into ``parts`` value ranges and written, with ``_range`` and
    ``_nth`` (a row's 0-based place in its range). ``parts``: the session's
    shuffle partitions unless given. Equal keys share a range: where one may
    have a large share of the rows, end ``order`` with a column that tells
    them apart."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
           .withColumn("_range", F.spark_partition_id())
           .withColumn("_nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))))
    return materialize(out, "ranges")


def numbered(df: DataFrame, order: Sequence[Column], *, by: Sequence[str] = (), out_col: str = "pos",
             parts: int | None = None) -> DataFrame:
    """``df`` with ``out_col``: a row's 0-based number, in ``order``, among the
    rows that agree in ``by`` (null agrees with null). A group may have any share
    of the rows: it spans as many ranges as it needs."""
    rows = in_ranges(df, [F.col(b).asc_nulls_first() for b in by] + list(order), parts)
    # at most one row a range and group
    sizes = rows.groupBy("_range", *by).agg(F.min("_nth").alias("_lo"), F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_range").alias("_r"), *[F.col(b).alias(f"_b{i}") for i, b in enumerate(by)],
                           (F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_lo")).alias("_off"))
    offsets = maybe_broadcast(materialize(offsets, "offsets"), 64)[0]
    same = F.col("_range") == F.col("_r")
    for i, b in enumerate(by):
        same &= F.col(b).eqNullSafe(F.col(f"_b{i}"))
    return rows.join(offsets, same).select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_nth") + F.col("_off")).alias(out_col))


def exclusive_prefix_sum(df: DataFrame, order_col: str | Sequence[str], value_col: str, out_col: str, parts: int | None = None) -> DataFrame:
    """``out_col`` = sum of ``value_col`` (null: 0) over the rows whose
    ``order_col`` (one column, or several in order) is smaller. It must be
    distinct (aggregate ties first)."""
    cols = [order_col] if isinstance(order_col, str) else list(order_col)
    order = [F.col(c).asc_nulls_first() for c in cols]
    rows = in_ranges(df, order, parts)
    sums = rows.groupBy("_range").agg(F.sum(value_col).alias("t"))
    kind = sums.schema["t"].dataType
    totals = sums.orderBy("_range").collect()  # one row a range
    zero = 0.0 if isinstance(kind, (T.DoubleType, T.FloatType)) else 0
    each = [r["t"] if r["t"] is not None else zero for r in totals]
    offsets = df.sparkSession.createDataFrame(
        list(zip([r["_range"] for r in totals], [zero, *accumulate(each)])),
        T.StructType([T.StructField("_range", T.IntegerType()), T.StructField("_off", kind)]))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(F.broadcast(offsets), "_range")
    return (out.withColumn(out_col, F.col("_off") + F.coalesce(F.sum(value_col).over(within), F.lit(zero).cast(kind)))
            .drop("_range", "_nth", "_off"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], buckets: Sequence[int], parts: int | None = None) -> list[list[float]]:
    """For each column the values of rank ``ceil(i n / b)``, ``0 < i < b``, of its
    ``n`` values (null and NaN left out), ``b`` its number of buckets. Different
    values are counted, then counted up in sorted ranges, all columns in one go;
    only the values asked for reach the driver."""
    spark = df.sparkSession
    each = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])))
    counts = each.where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    run = materialize(exclusive_prefix_sum(counts, ["c", "v"], "n", "before", parts), "value-counts")
    sizes = {r["c"]: (r["lo"], r["n"]) for r in run.groupBy("c").agg(F.min("before").alias("lo"), F.sum("n").alias("n")).collect()}  # one row a column
    wanted = [(i, sizes[i][0] + -(-k * sizes[i][1] // b)) for i, b in enumerate(buckets) if i in sizes for k in range(1, b)]
    out: list[list[float]] = [[] for _ in cols]
    if not wanted:
        return out
    ranks = spark.createDataFrame(sorted(set(wanted)), "c int, r long").groupBy("c").agg(F.collect_list("r").alias("ranks")).withColumnRenamed("c", "_c")
    near = run.join(F.broadcast(ranks), F.col("c") == F.col("_c")).where(F.exists("ranks", lambda r: (r > F.col("before")) & (r <= F.col("before") + F.col("n"))))
    at = {}
    for r in near.select("c", "v", "before", "n").collect():  # at most one row a bucket
        at.setdefault(r["c"], []).append((r["before"], r["before"] + r["n"], r["v"]))
    for c, rank in wanted:
        out[c].append(next(v for lo, hi, v in at[c] if lo < rank <= hi))
    return out


def dense_positions(values: DataFrame, col: str, out_col: str = "pos", parts: int | None = None) -> tuple[DataFrame, int]:
    """Distinct values of ``col`` (null left out) numbered ``0..n-1`` in
    ascending order; returns ``(table, n)``."""
    d = values.select(col).where(F.col(col).isNotNull()).distinct()
    out = materialize(numbered(d, [F.col(col)], out_col=out_col, parts=parts).withColumn(out_col, F.col(out_col).cast("int")), "positions")
    return out, out.count()
