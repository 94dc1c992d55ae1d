"""Replace or extend each row's active one-hot features with their
latent vectors.

Plan (F1)::

    rows --(hash repartition on key, skipped when already clustered)-->
         sorted by key --Arrow batches: look the latents up inside the row-->
         rows that share a key (adjacent now, mostly there are none) become one

The exchange carries the rows with their pairs as two plain arrays (indices,
values), a third of the bytes of an array of structs and far better compressed;
the expanded k-wide values are never shuffled, sorted or grouped. Exploding the
pairs and grouping them again held every row's pairs, carried columns and
vectors in a sort, which spilled. Input bucketed or partitioned by the key
(``clustered=True``) runs with no shuffle at all.

The latent table is taken to the tasks only when a bounded count proves it fits
the broadcast budget. One that holds an index twice, rows whose columns Arrow
does not hold as they are, and, unless ``in_row`` is set, rows that leave their
features behind go by exploded pairs, a broadcast join and a regroup. Where the table is too large, indices are counted, the rows of the few hot ones
(at most ``HOT_PER_PARTITION`` a shuffle partition) are broadcast, and the table
is joined once for all others; pairs of hot indices are spread over the join's
partitions by row. That path shuffles for the join and again for the regroup,
and skips the upfront repartition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fmspark.functions import inrow as B
from fmspark.functions import sparse as S
from fmspark.session import materialize, maybe_broadcast

NUMBERINGS = ("offset", "zero")


HOT_PER_PARTITION = 4


def hot_indices(active: DataFrame, idx: str = "idx") -> DataFrame:
    """``_hidx``: the indices that hold more than a quarter of a shuffle partition's
    share of all (row, index) pairs, at most ``HOT_PER_PARTITION`` a partition."""
    parts = int(active.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    freq = materialize(active.groupBy(F.col(idx).alias("_hidx")).agg(F.count(F.lit(1)).alias("_n")), "index-counts")
    total = freq.agg(F.sum("_n")).first()[0] or 0
    return freq.where(F.col("_n") * F.lit(HOT_PER_PARTITION * parts) > F.lit(total)).select("_hidx")


def _with_latents(ex: DataFrame, latent: DataFrame, broadcast: DataFrame | None, key: str) -> DataFrame:
    """Exploded rows (``_aidx``) with ``_v``, their index's latent vector. Where the
    latent table is too large to broadcast it is joined as it is, but for the rows
    of hot indices: those few are broadcast, and the pairs that use them get keys
    of their own in the large join, spread by row."""
    if broadcast is not None:
        return ex.join(broadcast, ex["_aidx"] == broadcast["_lidx"], "left")
    hot = hot_indices(ex.where(F.col("_aidx").isNotNull()), "_aidx")
    some = latent.join(F.broadcast(hot), F.col("_lidx") == F.col("_hidx"), "left_semi").select(F.col("_lidx").alias("_hidx"), F.col("_v").alias("_hv"))
    ex = ex.join(F.broadcast(some), F.col("_aidx") == F.col("_hidx"), "left")
    own = -F.lit(1) - F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)).cast("int")  # no index is negative
    ex = ex.withColumn("_jidx", F.when(F.col("_hv").isNotNull() | F.col("_aidx").isNull(), own).otherwise(F.col("_aidx")))
    return ex.join(latent, F.col("_jidx") == F.col("_lidx"), "left").withColumn("_v", F.coalesce("_hv", "_v"))


def _comparable(t: T.DataType) -> bool:
    """Types whose values Arrow finds equal where Spark does."""
    return isinstance(t, (T.IntegralType, T.StringType, T.DateType))


def _plain(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _plain(t.elementType)
    if isinstance(t, T.StructType):
        return all(_plain(f.dataType) for f in t.fields)
    return _comparable(t) or isinstance(t, (T.BooleanType, T.FractionalType, T.TimestampType, T.BinaryType))


def _in_row(rows: DataFrame, table: pa.Table, vector: T.DataType, threshold: int, key: str, features: str, carry_features: bool,
            clustered: bool, strict: bool, unique: bool, form: tuple[bool, str, bool] | None) -> DataFrame:
    """``embed_values`` of every row for itself. ``table``: ``_lidx, _v`` by index.
    ``form`` (append, numbering, dense): ``_out`` as ``assemble`` makes it instead of
    ``_raw`` and ``emb``."""
    carried = [c for c in rows.columns if c not in (key, features)]
    # what is neither raw nor embedded stays behind, unless the features are carried
    kept = F.col(features) if carry_features else F.filter(features, lambda p: (p["idx"] <= F.lit(threshold)) | ((p["idx"] > F.lit(threshold)) & (p["val"] == F.lit(1.0))))
    if unique:  # nothing is moved: leaving pairs behind would cost more than it saves
        kept = F.col(features)
    base = rows.select(key, *carried, kept.alias("_pairs")).select(key, *carried, F.col("_pairs")["idx"].alias("_fi"), F.col("_pairs")["val"].alias("_fx"))
    if not clustered and not unique:
        base = base.repartition(key)
    known, latents = table["_lidx"].to_numpy(), table["_v"].combine_chunks()
    whole = pc.is_valid(latents).to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(latents), 0).to_numpy(zero_copy_only=False)

    def look_up(b: pa.RecordBatch, first: np.ndarray) -> dict:
        n, row, idx = B.flat(b.column("_fi"))
        x, there = pc.list_flatten(b.column("_fx")), pc.is_valid(idx).to_numpy(zero_copy_only=False)
        i = pc.fill_null(idx, 0).to_numpy(zero_copy_only=False)
        pairs = pa.StructArray.from_arrays([idx, x], names=["idx", "val"])
        out = {c: b.column(c) for c in (key, *carried)}
        if carry_features:
            out[features] = B.lists(n, pairs, b.column("_fi").is_null())
        raw = there & (i <= threshold)
        if form is None:
            out["_raw"] = B.lists(np.bincount(row[raw], minlength=len(n)), pairs.filter(pa.array(raw)))
        else:
            kept_raw = row[raw], idx.filter(pa.array(raw)), x.filter(pa.array(raw))
        on = there & (i > threshold) & (pc.fill_null(x, 0.0).to_numpy(zero_copy_only=False) == 1.0)
        i, row = i[on], row[on]
        at, found = B.find(known, i)
        found[found] = whole[at[found]]
        if strict and not found.all():
            raise ValueError(f"no latent vector for feature index {i[int((~found).argmax())]}")
        rows_of = len(n)
        if len(first) < len(n):  # rows of one key: their vectors by place, then by value, the first of all else
            place = np.arange(len(row)) - np.searchsorted(row, row)
            group = np.searchsorted(first, row, side="right") - 1
            order = np.lexsort((_ranks(latents, at, found), place, group))
            at, found, row, rows_of = at[order], found[order], group[order], len(first)
            out = {c: a.take(pa.array(_first_valid(a, first))) for c, a in out.items()}
        at, row = at[found], row[found]
        lengths = np.bincount(row, weights=sizes[at], minlength=rows_of).astype(np.int64)
        emb = pc.list_flatten(latents.take(pa.array(at)))
        if form is not None:
            return out | {"_out": _assembled(*kept_raw, np.repeat(np.arange(rows_of), lengths), emb, rows_of, threshold, *form)}
        out["emb"] = B.lists(lengths, emb)
        return out

    fields = [T.StructField(key, rows.schema[key].dataType)] + [T.StructField(c, rows.schema[c].dataType) for c in rows.columns if c != key and (carry_features or c != features)]
    made = [T.StructField("_raw", S.PAIRS), T.StructField("emb", vector)] if form is None else [T.StructField("_out", vector if form[2] else S.PAIRS)]
    schema = T.StructType([*fields, *made])
    if unique:
        return B.by_batch(base, schema, lambda b: look_up(b, np.arange(b.num_rows)))
    return B.by_key(base.sortWithinPartitions(key), schema, key, look_up)


def _assembled(raw_row: np.ndarray, raw_idx: pa.Array, raw: pa.Array, row: np.ndarray, emb: pa.Array, n: int, threshold: int,
               append: bool, numbering: str, dense: bool) -> pa.ListArray:
    """``assemble`` of ``n`` rows from their raw pairs and embedded values, each with
    its row (ascending)."""
    if not append:
        raw_row, raw_idx, raw = raw_row[:0], raw_idx.slice(0, 0), raw.slice(0, 0)
    counts, raws = np.bincount(row, minlength=n), np.bincount(raw_row, minlength=n)
    place = np.arange(len(row)) - (np.cumsum(counts) - counts)[row]
    start = np.cumsum(counts + raws) - counts - raws
    raw_place = np.arange(len(raw_row)) - (np.cumsum(raws) - raws)[raw_row]
    order = np.empty(len(row) + len(raw_row), np.int64)
    order[start[raw_row] + raw_place] = np.arange(len(raw_row))
    order[start[row] + raws[row] + place] = np.arange(len(row)) + len(raw_row)
    order = pa.array(order)
    vals = pa.concat_arrays([raw, emb]).take(order)
    if dense:
        return B.lists(counts + raws, vals)
    if numbering == "zero":
        raw_idx, place = pa.array(raw_place, pa.int32()), raws[row] + place
    else:
        place = threshold + 1 + place
    idx = pa.concat_arrays([raw_idx, pa.array(place, pa.int32())]).take(order)
    return B.lists(counts + raws, pa.StructArray.from_arrays([idx, vals], names=["idx", "val"]))


def _ranks(latents: pa.Array, at: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The rank of each item's vector among those at hand, null and then NaN-last order as Spark's."""
    used, back = np.unique(np.where(found, at, 0), return_inverse=True)
    if not len(latents):
        return np.zeros(len(at), np.int64)
    value = lambda x: (0, 0.0) if x is None else (2, 0.0) if x != x else (1, x)
    vectors = [[value(x) for x in v or ()] for v in latents.take(pa.array(used)).to_pylist()]
    ranks = np.empty(len(used), np.int64)
    ranks[sorted(range(len(used)), key=vectors.__getitem__)] = np.arange(len(used))
    return ranks[back.reshape(-1)]


def _first_valid(column: pa.Array, first: np.ndarray) -> np.ndarray:
    """Of each run of rows (from ``first`` on) the first that is not null, if any."""
    if not column.null_count:
        return first
    valid = np.flatnonzero(pc.is_valid(column).to_numpy(zero_copy_only=False))
    group, at = np.unique(np.searchsorted(first, valid, side="right") - 1, return_index=True)
    out = first.copy()
    out[group] = valid[at]
    return out


def embed_values(rows: DataFrame, latent: DataFrame, threshold: int, *, key: str = "row_id",
                 features: str = "features", clustered: bool = False, k_hint: int = 8,
                 on_unknown: str = "error",
                 max_broadcast_bytes: int | None = None, carry_features: bool = True, in_row: bool | None = None,
                 unique: bool = False, form: tuple[bool, str, bool] | None = None) -> DataFrame:
    """Core of F1: every input column plus ``_raw`` (continuous pairs, idx <=
    threshold), ``_act`` (active one-hot pairs) and ``emb`` (the latent
    vectors of ``_act`` concatenated in feature order). ``key`` must be unique
    per row. ``in_row``: latents are looked up inside the row, by default where
    the features are carried, which a regroup would hold. ``unique``: the caller
    knows that no two rows share a key, so those looked up inside the row neither
    move nor are sorted; with ``form`` (append, numbering, dense) they may come with
    ``_out``, put together at once, instead of the parts."""
    if on_unknown not in ("error", "drop"):
        raise ValueError("on_unknown must be 'error' or 'drop'")
    lat = latent.select(F.col("idx").cast("int").alias("_lidx"), F.col("v").alias("_v"))
    # the width of a vector as it is, not as the caller guesses it
    k = latent.select(F.size("v").alias("k")).limit(1).collect()
    side, is_small = maybe_broadcast(lat, row_bytes=16 + 8 * max(1, k[0][0] if k else 1, k_hint), max_bytes=max_broadcast_bytes)
    if (carry_features if in_row is None else in_row) and is_small and _comparable(rows.schema[key].dataType) and all(_plain(f.dataType) for f in rows.schema.fields) \
            and rows.schema[features].dataType.simpleString() == S.PAIRS.simpleString() and _plain(lat.schema["_v"].dataType):
        table = B.by_index(lat, "_lidx")
        if table is not None:
            return _in_row(rows, table, lat.schema["_v"].dataType, threshold, key, features, carry_features, clustered, on_unknown == "error", unique,
                           form if unique and not carry_features and lat.schema["_v"].dataType == T.ArrayType(T.DoubleType()) else None)
    # a null feature array embeds as empty: the guard sits on the derived raw
    # part (posexplode_outer already handles a null active part), so the
    # feature expression is not referenced more often than before
    base = rows.withColumn("_raw", F.coalesce(S.continuous(features, threshold), F.array().cast(S.PAIRS))) \
               .withColumn("_act", S.active(features, threshold))
    if not carry_features:
        base = base.drop(features)
    if not clustered and is_small:
        # broadcast path: partition the compact rows once; everything after
        # keeps the key partitioning. (The shuffle-join path partitions by
        # index for the join and by key for the regroup instead.)
        base = base.repartition(key)
    cols = [c for c in base.columns if c not in (key, "_act")]
    ex = base.select(key, *cols, F.posexplode_outer("_act").alias("_pos", "_ap"))
    # wide carried columns ride on a row's first exploded position only: they are
    # neither copied per active feature nor grouped on
    head = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    ex = ex.select(key, *[F.when(head, F.col(c)).alias(c) for c in cols], "_pos", F.col("_ap.idx").alias("_aidx"))
    j = _with_latents(ex, lat, side if is_small else None, key)
    v = F.col("_v")
    if on_unknown == "error":
        v = F.when(F.col("_pos").isNotNull() & F.col("_v").isNull(),
                   F.raise_error(F.concat(F.lit("no latent vector for feature index "),
                                          F.col("_aidx").cast("string")))).otherwise(F.col("_v"))
    item = F.when(F.col("_pos").isNotNull() & v.isNotNull(), F.struct(F.col("_pos").alias("p"), v.alias("v")))
    agg = j.groupBy(key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols],
                             F.collect_list(item).alias("_items"))
    emb = F.flatten(F.transform(F.array_sort("_items"), lambda x: x["v"]))
    return agg.select(key, *cols, emb.alias("emb")).drop("_items")


def assemble(df: DataFrame, threshold: int, *, features: str = "features", append: bool = True,
             numbering: str = "offset", dense: bool = False, keep_onehot: bool = False) -> Column:
    """The output row as pairs, or as plain values when ``dense``.

    * ``append``      raw continuous pairs first, then the embedding (F2); else
                      the embedding only (F3)
    * ``keep_onehot`` raw part is every input pair (the README's form)
    * ``numbering``   ``offset``: raw pairs keep their index, embedded values
                      get ``threshold+1 ...`` (F4); ``zero``: all renumbered
                      ``0..n-1`` (F5)
    """
    if numbering not in NUMBERINGS:
        raise ValueError(f"numbering must be one of {NUMBERINGS}")
    raw = F.coalesce(F.col(features), F.array().cast(S.PAIRS)) if keep_onehot else F.col("_raw")
    emb = F.col("emb")
    if dense:  # F6
        return F.concat(S.values(raw), emb) if append else emb
    if numbering == "offset":
        e = S.numbered(emb, threshold + 1)
        return F.concat(raw, e) if append else e
    allv = F.concat(S.values(raw), emb) if append else emb
    return S.numbered(allv, 0)


def embed(rows: DataFrame, latent: DataFrame, threshold: int, *, key: str = "row_id",
          features: str = "features", keep: tuple[str, ...] = (), append: bool = True,
          numbering: str = "offset", dense: bool = False, keep_onehot: bool = False,
          clustered: bool = False, k_hint: int = 8, on_unknown: str = "error",
          max_broadcast_bytes: int | None = None, in_row: bool | None = None, unique: bool = False) -> DataFrame:
    """F1-F6 in one call: ``key, *keep, out`` where ``out`` is
    ``array<struct<idx,val>>`` (or ``array<double>`` when ``dense``)."""
    if numbering not in NUMBERINGS:
        raise ValueError(f"numbering must be one of {NUMBERINGS}")
    sel = rows.select(key, *[c for c in keep if c != key], features)
    ev = embed_values(sel, latent, threshold, key=key, features=features, clustered=clustered,
                      k_hint=k_hint, on_unknown=on_unknown, max_broadcast_bytes=max_broadcast_bytes,
                      carry_features=keep_onehot, in_row=in_row, unique=unique, form=(append, numbering, dense))
    out = F.col("_out") if "_out" in ev.columns else assemble(ev, threshold, features=features, append=append, numbering=numbering,
                                                              dense=dense, keep_onehot=keep_onehot)
    return ev.select(key, *[c for c in keep if c != key], out.alias("out"))


def width_report(rows: DataFrame, threshold: int, latent: DataFrame, *, key: str = "row_id", features: str = "features",
                 append: bool = True, strict: bool = False, **how) -> DataFrame:
    """distinct widths of the raw, embedded and total parts of the embedded
    rows, their maxima and the row count, in one aggregation over the output of
    the embedding. ``strict`` raises on ragged rows, be it for features that are
    not there or for latent vectors of different lengths."""
    ev = embed_values(rows.select(key, features), latent, threshold, key=key, features=features, carry_features=False, **how)
    total = assemble(ev, threshold, features=features, append=append, dense=True)
    w = ev.select(F.size(total).alias("total_w"), F.size("emb").alias("emb_w"))
    raw = F.col("total_w") - F.col("emb_w")
    rep = w.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(raw).alias("raw_widths"), F.count_distinct("emb_w").alias("emb_widths"),
                F.count_distinct("total_w").alias("total_widths"), F.max(raw).alias("max_raw"), F.max("emb_w").alias("max_emb"),
                F.max("total_w").alias("max_total"))
    if strict:
        r = rep.first()
        if r["emb_widths"] > 1 or r["raw_widths"] > 1 or r["total_widths"] > 1:
            raise ValueError(f"rows differ in width: {r.asDict()}")
    return rep


def observed(df: DataFrame, col: str = "out", name: str = "widths") -> tuple[DataFrame, Observation]:
    """``df`` with an observation that the job which writes it fills: ``n_rows,
    min_width, max_width`` of ``col``."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.min(F.size(col)).alias("min_width"), F.max(F.size(col)).alias("max_width")), seen


def check_widths(seen: Observation, strict: bool = False) -> dict:
    """What ``observed`` saw, after the write; raises on ragged rows if ``strict``."""
    got = seen.get
    if strict and got["min_width"] != got["max_width"]:
        raise ValueError(f"rows differ in width: {got}")
    return got


def attach_target(prd: DataFrame, train: DataFrame, *, key: str = "order_id",
                  label: str = "label", target: str = "target") -> DataFrame:
    """F8: give prediction rows the label of the training row with the same
    key (a left key join; the reference zips by line number). The training
    side is reduced to one label per key first, so the join cannot fan out."""
    t = train.groupBy(key).agg(F.max(label).alias(target))
    return prd.join(t, key, "left")


def embed_sets(train: DataFrame, prd: DataFrame, latent: DataFrame, threshold: int, **kw) -> DataFrame:
    """both sets through one embedding job, tagged by a ``set`` column.
    ``key`` must be unique across the union (the caller's row id)."""
    u = train.withColumn("set", F.lit("train")).unionByName(
        prd.withColumn("set", F.lit("prd")), allowMissingColumns=True)
    keep = tuple(kw.pop("keep", ())) + ("set",)
    return embed(u, latent, threshold, keep=keep, **kw)
