"""Projections and filters over sparse rows and wide tables.

All of these are single ``select``s of built-in expressions (narrow, no
shuffle), except re-indexing, which joins the pairs to the index map.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fmspark.functions import inrow as B
from fmspark.functions import sparse as S
from fmspark.session import maybe_broadcast

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(dt) -> bool:
    return isinstance(dt, NUMERIC)


def _head_only(df: DataFrame, key: str, cols: list[str], pos: str, item: str) -> DataFrame:
    """Carried columns on a row's first exploded position only, so that wide
    ones are neither copied per feature nor grouped on."""
    head = F.coalesce(F.col(pos), F.lit(0)) == 0
    return df.select(key, *[F.when(head, F.col(c)).alias(c) for c in cols], pos, item)


def _regroup(df: DataFrame, key: str, cols: list[str], agg) -> DataFrame:
    """Per-row regroup after an explode of rows with a unique key."""
    return df.groupBy(key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols], agg)


def reindex(rows: DataFrame, feature_map: DataFrame, *, key: str = "row_id", features: str = "features",
            on_unknown: str = "error", clustered: bool = False,
            max_broadcast_bytes: int | None = None, map_rows: int | None = None, once: bool = False, keep_zero: bool = True) -> DataFrame:
    """``idx -> pos`` through the index map ``(idx, pos)``, pair order kept.
    An optional column ``s`` in the map divides the values (scaling in the
    same pass).

    A map that fits a broadcast is looked up inside the row (``_in_row``). One
    that does not is joined to the exploded pairs, as are rows that share a key,
    which become one row, and input that is ``clustered`` by key. Unknown indices
    raise (``on_unknown='error'``, the reference's KeyError) or are dropped.

    The result is written, unless it is read ``once``: then only the keys are read
    first, for those that several rows share, and rows are looked up as they are read.
    Without ``keep_zero`` pairs whose value is then 0 or null are left out (B2).
    """
    if on_unknown not in ("error", "drop"):
        raise ValueError("on_unknown must be 'error' or 'drop'")
    scaled = "s" in feature_map.columns  # optional per-index divisor (a fitted max-abs scale)
    fm = feature_map.select(F.col("idx").cast("int").alias("_midx"), F.col("pos").cast("int").alias("_mpos"),
                            (F.col("s").cast("double") if scaled else F.lit(1.0)).alias("_ms"))
    fm, is_b = maybe_broadcast(fm, row_bytes=24, max_bytes=max_broadcast_bytes, known_rows=map_rows)
    if is_b and not clustered:
        table = B.by_index(fm.where(F.col("_mpos").isNotNull()), "_midx")
        if table is not None and 0 not in pc.unique(table["_ms"]).to_pylist():
            found = lambda df: _in_row(df, table, key, features, on_unknown == "error", keep_zero)
            merged = lambda df: _reindex_joined(df, fm, is_b, key, features, on_unknown, clustered, keep_zero)
            if once:
                return B.one_row_a_key_read(found, [key], rows, merged)
            return B.one_row_a_key(found(rows), [key], rows, merged, "reindexed")
    return _reindex_joined(rows, fm, is_b, key, features, on_unknown, clustered, keep_zero)


def _in_row(rows: DataFrame, table: pa.Table, key: str, features: str, strict: bool, keep_zero: bool) -> DataFrame:
    """``reindex`` of every row for itself. ``table``: ``_midx, _mpos, _ms`` by index."""
    known, pos, scale = table["_midx"].to_numpy(), table["_mpos"].to_numpy(), table["_ms"].combine_chunks()
    cols = [c for c in rows.columns if c not in (key, features)]

    def look_up(b: pa.RecordBatch) -> dict:
        n, row, items = B.flat(b.column(features))
        idx = pc.struct_field(items, "idx")
        at, found = B.find(known, pc.fill_null(idx, 0).to_numpy(zero_copy_only=False))
        found &= pc.is_valid(idx).to_numpy(zero_copy_only=False)
        val = pc.struct_field(items, "val").cast(pa.float64())
        if not found.all():
            lost = ~found & pc.is_valid(items).to_numpy(zero_copy_only=False)
            if strict and lost.any():
                raise ValueError(f"feature index not in the index map: {idx[int(lost.argmax())]}")
            at, val, n = at[found], val.filter(pa.array(found)), np.bincount(row[found], minlength=len(n))
        val = pc.divide(val, scale.take(pa.array(at)))
        if not keep_zero:
            some = pc.fill_null(val, 0.0).to_numpy(zero_copy_only=False) != 0.0
            row = np.repeat(np.arange(len(n)), n)
            at, val, n = at[some], val.filter(pa.array(some)), np.bincount(row[some], minlength=len(n))
        new = pa.StructArray.from_arrays([pa.array(pos[at], pa.int32()), val], names=["idx", "val"])
        return {c: b.column(c) for c in (key, *cols)} | {features: B.lists(n, new)}

    schema = T.StructType([rows.schema[c] for c in (key, *cols)] + [T.StructField(features, S.PAIRS)])
    return B.by_batch(rows, schema, look_up)


def _reindex_joined(rows: DataFrame, fm: DataFrame, is_b: bool, key: str, features: str, on_unknown: str, clustered: bool, keep_zero: bool) -> DataFrame:
    """``reindex`` by exploded pairs. The input is hash-partitioned on the row key
    before the explode where the map is broadcast, so that the regroup needs no
    second exchange."""
    base = rows if clustered or not is_b else rows.repartition(key)
    cols = [c for c in base.columns if c not in (key, features)]
    ex = _head_only(base.select(key, *cols, F.posexplode_outer(features).alias("_p", "_f")), key, cols, "_p", "_f")
    j = ex.join(fm, F.col("_f.idx") == F.col("_midx"), "left")
    newidx = F.col("_mpos")
    if on_unknown == "error":
        newidx = F.when(F.col("_f").isNotNull() & F.col("_mpos").isNull(),
                        F.raise_error(F.concat(F.lit("feature index not in the index map: "),
                                               F.col("_f.idx").cast("string")))).otherwise(F.col("_mpos"))
    item = F.when(F.col("_f").isNotNull() & newidx.isNotNull(),
                  F.struct(F.col("_p").alias("p"), S.pair(newidx, F.col("_f.val") / F.col("_ms")).alias("q")))
    g = _regroup(j, key, cols, F.collect_list(item).alias("_items"))
    pairs = F.transform(F.array_sort("_items"), lambda x: x["q"])
    return g.select(key, *cols, (pairs if keep_zero else S.drop_zero(pairs)).alias(features))


def to_fm(rows: DataFrame, *, is_prd: bool = False, reindex_map: DataFrame | None = None,
          keep_zero: bool = False, key: str = "row_id", label: str = "label",
          features: str = "features", map_rows: int | None = None) -> DataFrame:
    """One pass of relabel (train only), zero drop and optional re-index."""
    out = rows
    if not is_prd:
        out = out.withColumn(label, S.relabel_pm1(label))
    if not keep_zero:
        out = out.withColumn(features, S.drop_zero(features))
    if reindex_map is not None:
        out = reindex(out, reindex_map, key=key, features=features, map_rows=map_rows)
    return out


def table_to_sparse(df: DataFrame, *, label: str = "target", exclude: tuple[str, ...] = (),
                    keep: tuple[str, ...] = (), keep_zero: bool = False) -> DataFrame:
    """label = ``label``; X = every other numeric column in sorted name
    order, zero-based indices; nulls count as zero; zeros dropped."""
    xcols = sorted(c for c, t in ((f.name, f.dataType) for f in df.schema.fields)
                   if c != label and c not in exclude and c not in keep and is_numeric(t))
    arr = F.array(*[S.pair(F.lit(i), F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
                    for i, c in enumerate(xcols)])
    if not keep_zero:
        arr = S.drop_zero(arr)
    return df.select(*keep, F.col(label).cast("double").alias("label"), arr.alias("features"))


def to_libsvm_line(df: DataFrame, label: str, cols: list[str], *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Wide row -> ``label 1:v1 2:v2 ...`` (column i -> index i, one-based,
    zeros kept). Vector columns are expanded in place first."""
    parts = []
    for c in cols:
        t = df.schema[c].dataType
        if t.typeName() == "vector":
            from pyspark.ml.functions import vector_to_array
            parts.append(vector_to_array(F.col(c)))
        elif isinstance(t, T.ArrayType):
            parts.append(F.col(c).cast("array<double>"))
        else:
            parts.append(F.array(F.col(c).cast("double")))
    vals = F.concat(*parts) if len(parts) > 1 else parts[0]
    line = F.concat_ws(" ", S.line_head(label), S.format_pairs(S.numbered(vals, 1)))
    return df.select(*keep, line.alias("line"))


def to_dense(rows: DataFrame, *, label: str = "label", features: str = "features",
             keep: tuple[str, ...] = ()) -> DataFrame:
    """B7 + B1c: ``(label, array<double>)``, index ignored, label ``2*l-1``."""
    return rows.select(*keep, S.relabel_linear(label).alias("target"), S.values(features).alias("feature"))


def to_ffm(rows: DataFrame, field_map: DataFrame, *, key: str = "row_id", label: str = "label",
           features: str = "features", keep: tuple[str, ...] = (), keep_zero: bool = False,
           clustered: bool = False, map_rows: int | None = None, other_field: int | None = None) -> DataFrame:
    """``label field:feature:value`` text. The field of each index comes
    from ``field_map(idx, field)``, a table as small as the feature space; a
    feature that the map lacks is in ``other_field``, or raises."""
    fm = field_map.select(F.col("idx").cast("int").alias("_fidx"), F.col("field").cast("int").alias("_fld"))
    fm, is_b = maybe_broadcast(fm, row_bytes=16, known_rows=map_rows)
    base = rows if keep_zero else rows.withColumn(features, S.drop_zero(features))
    if not clustered and is_b:
        base = base.repartition(key)
    cols = [c for c in dict.fromkeys([label, *keep]) if c != key]
    ex = _head_only(base.select(key, *cols, F.posexplode_outer(features).alias("_p", "_f")), key, cols, "_p", "_f")
    j = ex.join(fm, F.col("_f.idx") == F.col("_fidx"), "left")
    tok = F.when(F.col("_f").isNotNull(), F.struct(F.col("_p").alias("p"), F.concat(
        S.field_of("_fld", "_f.idx", other_field).cast("string"), F.lit(":"), F.col("_f.idx").cast("string"),
        F.lit(":"), S.fmt_num(F.col("_f.val"))).alias("t")))
    g = _regroup(j, key, cols, F.collect_list(tok).alias("_t"))
    line = F.concat_ws(" ", S.line_head(label),
                       F.array_join(F.transform(F.array_sort("_t"), lambda x: x["t"]), " "))
    return g.select(*(keep or (key,)), line.alias("line"))


def drop_ids(df: DataFrame, ids: tuple[str, ...] = ("order_sn", "dt", "user_id"), *,
             key: str = "order_id", target: str = "target") -> tuple[DataFrame, DataFrame]:
    """Drop identifier columns; train keeps ``target`` without the key,
    prd keeps the key without ``target``."""
    base = df.drop(*ids)
    return base.drop(key), base.drop(target)


def cast_fill(df: DataFrame, cols: list[str], *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast to double, null and NaN -> 0, in one ``select`` for all
    columns (no chain of ``withColumn``)."""
    def f(c):
        x = F.col(c).cast("double")
        return F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0)).alias(c)
    others = [c for c in df.columns if c not in cols and c not in keep]
    return df.select(*keep, *others, *[f(c) for c in cols])


def numeric_frame(df: DataFrame) -> DataFrame:
    """A7 (the intention of it): keep the numeric columns, null and NaN -> 0,
    whatever the other rows hold; string columns are dropped."""
    num = [f for f in df.schema.fields if is_numeric(f.dataType)]

    def filled(f):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.nanvl(c, F.lit(0).cast(f.dataType))
        return F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name)

    return df.select(*[filled(f) for f in num])
