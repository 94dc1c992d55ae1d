"""Alternating least squares for a 2-way FM (squared loss on +-1
labels), one field at a time.

Coordinate descent updates one parameter ``t`` with
``t* = sum (e + t h) h / (sum h^2 + reg)`` where ``e`` is the row residual
and ``h = d y_hat / d t`` (``x_i`` for ``w_i``,
``x_i (q_f - v_if x_i)`` for ``v_if``, with ``q_f = sum_j v_jf x_j``).
Two features of one one-hot field never occur in the same row, so their
updates do not interact: one ``groupBy(idx)`` updates the whole field for
one factor, and equals the sequential sweep over that field's features.

Two layouts. ``fit_als`` keeps one row a training row and recomputes its score
from the parameters in every pass. ``fit_als_joined`` is for parameters that do
not fit a broadcast: the exploded pairs, the residual table (one row per training
row) and the parameter table (one row per feature) are written as parquet in
the session's checkpoint folder after every step (``session.materialize``):
each update reads the residual table twice (for the sums, then to apply
them), so without a cut the plan would double per step. Only per-feature
sums (one row per feature and partition after map-side partial aggregation)
and per-row deltas move between steps; the parameter and delta tables are
broadcast (size-checked or bounded by the feature count of one field).
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fmspark import defaults as DF
from fmspark.functions import inrow as B
from fmspark.functions import sparse as S
from fmspark.functions.random import normal
from fmspark.operators.fm_train import BIAS, NO_INDEX, Arrays, arrays_of, items_of
from fmspark.session import broadcast_budget, collect_bounded, ensure_checkpoint_dir, materialize, maybe_broadcast


def _residuals(b: pa.RecordBatch, arrays: Arrays) -> tuple:
    """Of a batch of rows (y, features): row number, index, value and items of the
    features, row sums and residuals (0 for a row without a label)."""
    n, row, idx, x, items = items_of(b.column("features"))
    q, yhat = arrays.score(row, idx, x, n)
    y = b.column("y")
    e = pc.fill_null(y, 0.0).to_numpy(zero_copy_only=False) - yhat
    return row, idx, x, items, q, np.where(pc.is_valid(y).to_numpy(zero_copy_only=False), e, 0.0)


def als_sums(rows: DataFrame, params: DataFrame, k: int, width: int, field: int, factor: int | None, *, key: str = "row_id") -> DataFrame:
    """``idx, num, den`` of one coordinate update of a field: of its weights, or of
    its factors number ``factor``; the new value is ``num / (den + reg)``. ``rows``:
    (key, y, features with ``idx, val, fld``), ``params``: (idx, w, v), bias at
    ``BIAS``. A row scores itself, so neither residuals nor row sums are stored,
    and only ``num`` and ``den`` leave it, added up over a batch of rows."""
    arrays = arrays_of(params, k, width)
    own = None
    if factor is not None:
        # h = x (q - v x) needs the index's own factor, which is the same for all its rows
        v = params.where("idx >= 0").select(F.col("idx").cast("long").alias("i"), F.get("v", F.lit(factor)).alias("v"))
        zero = F.lit(0.0)
        t = v.groupBy("i").agg(F.count("v").alias("c"), F.coalesce(F.sum("v"), zero).alias("v"), F.coalesce(F.sum(F.col("v") * F.col("v")), zero).alias("vv")).orderBy("i").toArrow()
        own = [t[c].to_numpy() for c in ("i", "c", "v", "vv")]

    def share(b: pa.RecordBatch) -> dict:
        row, idx, x, items, q, e = _residuals(b, arrays)
        here = B.field(items, "fld", NO_INDEX) == field
        if own is not None:
            at, known = B.find(own[0], idx)
            here &= known
            c, v, vv = (o[at[here]] for o in own[1:])
        row, idx, x = row[here], idx[here], x[here]
        found, place = B.distinct(idx)
        if own is None:
            eh, den = e[row] * x, x * x
        else:
            r = q[row, factor]
            eh, den = e[row] * x * (c * r - v * x), x * x * (c * r * r - 2 * v * x * r + vv * x * x)
        none = np.zeros(len(found), bool)  # a null factor has null sums
        if own is not None:
            none[place] = c == 0
        return {"idx": found, "eh": pa.array(B.totals(place, eh, len(found)), mask=none), "den": pa.array(B.totals(place, den, len(found)), mask=none)}

    sums = B.by_batch(rows.select("y", "features"), "idx long, eh double, den double", share).groupBy(F.col("idx").cast("int").alias("idx")).agg(F.sum("eh").alias("eh"), F.sum("den").alias("den"))
    old = F.col("w") if factor is None else F.get("v", F.lit(factor))
    p = params.select(F.col("idx").alias("_i"), "w", "v")
    return sums.join(p, F.col("idx") == F.col("_i")).select("idx", (F.col("eh") + old * F.col("den")).alias("num"), "den")


def field_updates(rows: DataFrame, params: DataFrame, k: int, width: int, field: int, r1: float, r2: float) -> DataFrame:
    """``idx, w, v``: a field's parameters after the updates of its weights and of
    its factors 0 to ``k - 1``, one after the other, in one pass over the rows.

    Where a row holds one feature of the field at most, its score is linear in that
    feature's parameters ``t``, with the inputs ``z = x (1, q - v x)`` free of them.
    So ``A = sum z z'`` and ``b = sum z (e + z t)``, summed over the rows of an
    index, hold all that its updates need: update ``f`` is
    ``(b_f - sum_{g != f} A_fg t_g) / (A_ff + reg)``. Rows without a label have no
    residual, but count in the denominator, as in ``als_sums``: ``d = sum z^2`` of
    them."""
    arrays = arrays_of(params, k, width)
    m = k + 1
    names = [f"a{f}_{g}" for f in range(m) for g in range(f + 1)] + [f"b{f}" for f in range(m)] + [f"d{f}" for f in range(m)]

    def share(b: pa.RecordBatch) -> dict:
        row, idx, x, items, q, e = _residuals(b, arrays)
        here = B.field(items, "fld", NO_INDEX) == field
        row, idx, x = row[here], idx[here], x[here]
        found, place = B.distinct(idx)
        t = np.column_stack([arrays.w[idx], arrays.v[idx]])
        z = x[:, None] * np.column_stack([np.ones(len(x)), q[row] - t[:, 1:] * x[:, None]])
        r = e[row] + (z * t).sum(axis=1)
        has = pc.is_valid(b.column("y")).to_numpy(zero_copy_only=False)[row].astype(float)
        sums = [B.totals(place, has * z[:, f] * z[:, g], len(found)) for f in range(m) for g in range(f + 1)]
        sums += [B.totals(place, has * z[:, f] * r, len(found)) for f in range(m)] + [B.totals(place, (1 - has) * z[:, f] * z[:, f], len(found)) for f in range(m)]
        return {"idx": found} | dict(zip(names, sums))

    def solve(b: pa.RecordBatch) -> dict:
        c = {n: b.column(n).to_numpy(zero_copy_only=False) for n in names}
        idx = b.column("idx").to_numpy(zero_copy_only=False)
        t = np.column_stack([arrays.w[idx], arrays.v[idx]])
        for f in range(m):
            num = c[f"b{f}"] - sum((c[f"a{max(f, g)}_{min(f, g)}"] * t[:, g] for g in range(m) if g != f), np.zeros(len(idx))) + c[f"d{f}"] * t[:, f]
            den = c[f"a{f}_{f}"] + c[f"d{f}"] + (r1 if f == 0 else r2)
            t[:, f] = np.divide(num, den, out=np.zeros(len(idx)), where=den != 0)
        return {"idx": pa.array(idx, pa.int32()), "w": t[:, 0], "v": B.lists(np.full(len(idx), k), pa.array(t[:, 1:].reshape(-1)))}

    sums = B.by_batch(rows.select("y", "features"), "idx long, " + ", ".join(f"{n} double" for n in names), share).groupBy("idx").agg(*[F.sum(n).alias(n) for n in names])
    return B.by_batch(sums, "idx int, w double, v array<double>", solve)


def _replaced(factor: int) -> Column:
    """``v`` with ``_t``, where there is one, as its value number ``factor``."""
    return F.transform("v", lambda x, i: F.when(i == factor, F.coalesce(F.col("_t"), x)).otherwise(x))


def with_fields(rows: DataFrame, field_map: DataFrame, *, key: str = "row_id", label: str = "label", features: str = "features") -> DataFrame:
    """``key, y`` (-1 or 1) ``, features`` with the field of each: one row a
    training row, written once. A feature that the field map lacks raises. A field
    map that fits a broadcast is looked up inside the row; a larger one is joined to
    the exploded pairs, as are rows that share key and label, which become one."""
    fmap = field_map.select(F.col("idx").cast("int").alias("idx"), F.col("field").cast("int").alias("fld"))
    fmap_b, small = maybe_broadcast(fmap, row_bytes=16)
    y = F.when(F.col(label).cast("double") == 0, F.lit(-1.0)).otherwise(F.signum(F.col(label).cast("double")))
    base = rows.select(key, y.alias("y"), S.drop_zero(features).alias("features"))
    table = B.by_index(fmap, "idx") if small else None
    if table is None:
        return materialize(_fields_joined(base, fmap_b, key), "als-rows")
    known, fld = table["idx"].to_numpy(), table["fld"].combine_chunks()

    def look_up(b: pa.RecordBatch) -> dict:
        n, row, items = B.flat(b.column("features"))
        idx = pc.struct_field(items, "idx")
        there = pc.is_valid(idx).to_numpy(zero_copy_only=False)
        n, idx, val = np.bincount(row[there], minlength=len(n)), idx.drop_null().to_numpy(zero_copy_only=False), pc.struct_field(items, "val").cast(pa.float64()).filter(pa.array(there))
        at, found = B.find(known, idx)
        own = fld.take(pa.array(at, mask=~found))
        if own.null_count:
            raise ValueError(f"feature without a field in the field map: {idx[pc.index(pc.is_null(own), True).as_py()]}")
        return {c: b.column(c) for c in (key, "y")} | {"features": B.lists(n, pa.StructArray.from_arrays([pa.array(idx, pa.int32()), val, own], names=["idx", "val", "fld"]))}

    schema = T.StructType([base.schema[key], base.schema["y"], T.StructField("features", T.ArrayType(T._parse_datatype_string("idx int, val double, fld int")))])
    return B.one_row_a_key(B.by_batch(base, schema, look_up), [key, "y"], base, lambda df: _fields_joined(df, fmap_b, key), "als-rows")


def _fields_joined(base: DataFrame, fmap: DataFrame, key: str) -> DataFrame:
    ex = base.select(key, "y", F.posexplode_outer("features").alias("_n", "_p")).select(key, "y", "_n", "_p.idx", F.col("_p.val").alias("val"))
    ex = ex.join(fmap, "idx", "left").withColumn("fld", S.field_of("fld", "idx"))
    item = F.when(F.col("idx").isNotNull(), F.struct("_n", "idx", F.col("val").cast("double").alias("val"), "fld"))
    out = ex.groupBy(key, "y").agg(F.array_sort(F.collect_list(item)).alias("l"))  # of one row
    return out.select(key, "y", F.transform("l", lambda p: F.struct(p["idx"].alias("idx"), p["val"].alias("val"), p["fld"].alias("fld"))).alias("features"))


def fit_als(rows: DataFrame, field_map: DataFrame, k: int = DF.FM_DIM, *, sweeps: int = 3,
            init_std: float = DF.FM_INIT_STDEV,
            reg: tuple[float, float, float] = (DF.FM_R0_REG, DF.FM_R1_REG, DF.FM_R2_REG), seed: int = 0, key: str = "row_id",
            label: str = "label", features: str = "features", partitions: int | None = None,
            log=None):
    """Returns ``(bias, linear(idx, w), latent(idx, v), history)`` where
    history is the training RMSE after each sweep. Labels in {0,1} are mapped
    to {-1,1}. A feature that the field map lacks raises: put into one field,
    several of them could stand in one row.

    Rows are written once, a row a training row, and never again: all updates of a
    field are one pass (``field_updates``) that scores rows from the parameters
    (arrays proven to fit a broadcast) and adds up the numbers they need of an
    index; only the parameters, a row an index, are written between fields. Where a
    row holds several features of a field, each update is a pass of its own
    (``als_sums``). Parameters beyond the broadcast budget are joined instead
    (``fit_als_joined``)."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    top = field_map.agg(F.max("idx")).first()[0]
    width = int(top if top is not None else 0) + 1
    if 8 * width * (k + 2) > broadcast_budget(spark):
        return fit_als_joined(rows, field_map, k, sweeps=sweeps, init_std=init_std, reg=reg, seed=seed, key=key, label=label, features=features,
                              partitions=partitions, log=log)
    r0, r1, r2 = reg
    data = with_fields(rows, field_map, key=key, label=label, features=features)
    n_rows = data.count()
    used = materialize(data.select(F.explode("features").alias("p")).select("p.idx", "p.fld").distinct(), "als-used")
    fields = sorted(r[0] for r in collect_bounded(used.select("fld").distinct(), 100_000, "fields"))
    init = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: F.lit(float(init_std)) * normal(F.col("idx"), f, seed))
    bias_row = spark.range(1).select(F.lit(BIAS).alias("idx"), F.lit(0.0).alias("w"), F.array_repeat(F.lit(0.0), k).alias("v"))
    params = materialize(used.select("idx", F.lit(0.0).alias("w"), init.alias("v")).unionByName(bias_row), "als-params")

    def residual_sums(power: int) -> float:
        arrays = arrays_of(params, k, width)
        each = B.by_batch(data.select("y", "features"), "s double", lambda b: {"s": [float((_residuals(b, arrays)[-1] ** power).sum())]})
        return each.agg(F.sum("s")).first()[0] or 0.0

    # two features of a field in one row, or an index of two fields: no blocks
    single = not data.where(F.size(F.array_distinct(F.transform("features", lambda p: p["fld"]))) < F.size("features")).limit(1).count()
    single = single and used.count() == used.select("idx").distinct().count()

    w0, history = 0.0, []
    for _ in range(sweeps):
        w0 = (residual_sums(1) + n_rows * w0) / (n_rows + r0) if n_rows + r0 else 0.0
        params = materialize(params.withColumn("w", F.when(F.col("idx") == BIAS, F.lit(w0)).otherwise(F.col("w"))), "als-params")
        for fld in fields:
            if single:
                new = field_updates(data, params, k, width, fld, float(r1), float(r2)).select(F.col("idx").alias("_i"), F.col("w").alias("_w"), F.col("v").alias("_v"))
                j = params.join(new, F.col("idx") == F.col("_i"), "left")
                params = materialize(j.select("idx", F.coalesce("_w", "w").alias("w"), F.coalesce("_v", "v").alias("v")), "als-params")
                for f in (None, *range(k)) if log else ():
                    log(f"field {fld} {'linear' if f is None else f'factor {f}'}")
                continue
            for f in (None, *range(k)):
                s = als_sums(data, params, k, width, fld, f, key=key)
                new = F.try_divide(F.col("num"), F.col("den") + F.lit(float(r1 if f is None else r2)))
                s = s.select(F.col("idx").alias("_i"), F.coalesce(new, F.lit(0.0)).alias("_t"))
                j = params.join(s, F.col("idx") == F.col("_i"), "left")
                if f is None:
                    j = j.withColumn("w", F.coalesce("_t", "w"))
                else:
                    j = j.withColumn("v", _replaced(f))
                params = materialize(j.select("idx", "w", "v"), "als-params")
                if log:
                    log(f"field {fld} {'linear' if f is None else f'factor {f}'}")
        history.append(math.sqrt(residual_sums(2) / max(1, n_rows)))
    own = params.where(F.col("idx") != BIAS)
    return w0, own.select("idx", "w"), own.select("idx", "v"), history


def fit_als_joined(rows: DataFrame, field_map: DataFrame, k: int = DF.FM_DIM, *, sweeps: int = 3,
            init_std: float = DF.FM_INIT_STDEV,
            reg: tuple[float, float, float] = (DF.FM_R0_REG, DF.FM_R1_REG, DF.FM_R2_REG), seed: int = 0, key: str = "row_id",
            label: str = "label", features: str = "features", partitions: int | None = None,
            log=None):
    """As ``fit_als``, with parameters of any number: pairs, residuals and row sums
    are tables that are joined by row key and written after each update."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    n_part = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r0, r1, r2 = reg
    fmap = field_map.select(F.col("idx").cast("int").alias("idx"), F.col("field").cast("int").alias("fld"))
    fmap_b, _ = maybe_broadcast(fmap, row_bytes=16)
    yv = F.when(F.col(label).cast("double") == 0, F.lit(-1.0)).otherwise(F.signum(F.col(label).cast("double")))
    run = uuid.uuid4().hex
    ex = materialize(rows.select(key, yv.alias("y"), F.explode_outer(S.drop_zero(features)).alias("_p"))
                     .select(key, "y", F.col("_p.idx").alias("idx"), F.col("_p.val").alias("x"))
                     .join(fmap_b, "idx", "left").withColumn("fld", S.field_of("fld", "idx"))
                     .repartition(n_part, key), "pairs", run)
    fields = sorted(r[0] for r in collect_bounded(ex.select("fld").where("fld is not null").distinct(),
                                                  100_000, "fields"))
    params = materialize(ex.where("idx is not null").select("idx", "fld").distinct()
                         .select("idx", "fld", F.lit(0.0).alias("w"),
                                 F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                                             lambda f: F.lit(init_std) * normal(F.col("idx"), f, seed)).alias("v")),
                         "params", run)
    w0 = 0.0
    # features per field (one number per field): proves the per-field
    # parameter and delta tables small enough to broadcast, or not
    per_field = {r["fld"]: r["count"] for r in params.groupBy("fld").count().collect()}

    def bc(df, fld):
        return maybe_broadcast(df, row_bytes=24 + 8 * k, known_rows=per_field.get(fld, 0))[0]

    def residuals(ex_, params_, w0_):
        pb, _ = maybe_broadcast(params_.select("idx", "w", "v"), row_bytes=24 + 8 * k)
        j = ex_.join(pb, "idx", "left")
        x = F.coalesce(F.col("x"), F.lit(0.0))
        aggs = [F.first("y").alias("y"),
                F.sum(F.coalesce(F.col("w") * x, F.lit(0.0))).alias("lin"),
                F.sum(F.coalesce(x * x * F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e), F.lit(0.0))).alias("sq")]
        aggs += [F.sum(F.coalesce(F.element_at("v", f + 1) * x, F.lit(0.0))).alias(f"q{f}") for f in range(k)]
        g = j.groupBy(key).agg(*aggs)
        q = F.array(*[F.col(f"q{f}") for f in range(k)])
        pair = sum((F.col(f"q{f}") * F.col(f"q{f}") for f in range(k)), F.lit(0.0)) - F.col("sq")
        yhat = F.lit(w0_) + F.col("lin") + F.lit(0.5) * pair
        return g.select(key, "y", (F.col("y") - yhat).alias("e"), q.alias("q"))

    res = materialize(residuals(ex, params, w0), "res", run)
    n_rows = res.count()
    history = []
    for _ in range(sweeps):
        # global bias
        se = res.agg(F.sum("e")).first()[0] or 0.0
        new_w0 = (se + n_rows * w0) / (n_rows + r0)
        res = materialize(res.withColumn("e", F.col("e") - F.lit(new_w0 - w0)), "res", run)
        w0 = new_w0
        for fld in fields:
            exf = ex.where(F.col("fld") == F.lit(fld)).select(key, "idx", "x")
            pf = params.where(F.col("fld") == F.lit(fld))
            # linear weights of the field
            j = exf.join(res.select(key, "e"), key).join(bc(pf.select("idx", "w"), fld), "idx")
            upd = materialize(j.groupBy("idx").agg(F.sum((F.col("e") + F.col("w") * F.col("x")) * F.col("x")).alias("num"),
                                        F.sum(F.col("x") * F.col("x")).alias("den"))
                   .join(bc(pf.select("idx", "w"), fld), "idx")
                   .select("idx", (F.col("num") / (F.col("den") + F.lit(r1)) - F.col("w")).alias("d")),
                              "upd", run)
            de = exf.join(bc(upd, fld), "idx").groupBy(key).agg(F.sum(-F.col("d") * F.col("x")).alias("de"))
            res = materialize(res.join(de, key, "left")
                              .select(key, "y", (F.col("e") + F.coalesce("de", F.lit(0.0))).alias("e"), "q"),
                              "res", run)
            params = materialize(params.join(bc(upd, fld), "idx", "left")
                                 .select("idx", "fld", (F.col("w") + F.coalesce("d", F.lit(0.0))).alias("w"), "v"),
                                 "params", run)
            pf = params.where(F.col("fld") == F.lit(fld))
            if log:
                log(f"field {fld} linear")
            # factors of the field, one after the other
            for f in range(k):
                vf = F.element_at("v", f + 1)
                qf = F.element_at("q", f + 1)
                j = exf.join(res.select(key, "e", "q"), key).join(bc(pf.select("idx", "v"), fld), "idx")
                h = F.col("x") * (qf - vf * F.col("x"))
                upd = materialize(j.select("idx", vf.alias("vf"), F.col("e"), h.alias("h"))
                       .groupBy("idx").agg(F.sum((F.col("e") + F.col("vf") * F.col("h")) * F.col("h")).alias("num"),
                                           F.sum(F.col("h") * F.col("h")).alias("den"), F.first("vf").alias("vf"))
                       .select("idx", (F.col("num") / (F.col("den") + F.lit(r2)) - F.col("vf")).alias("d")),
                                  "upd", run)
                jj = exf.join(res.select(key, "q"), key).join(bc(pf.select("idx", "v"), fld), "idx") \
                    .join(bc(upd, fld), "idx")
                hh = F.col("x") * (F.element_at("q", f + 1) - F.element_at("v", f + 1) * F.col("x"))
                dd = jj.groupBy(key).agg(F.sum(-F.col("d") * hh).alias("de"),
                                         F.sum(F.col("d") * F.col("x")).alias("dq"))
                res = materialize(res.join(dd, key, "left")
                       .select(key, "y", (F.col("e") + F.coalesce("de", F.lit(0.0))).alias("e"),
                               F.transform("q", lambda qv, i: F.when(i == F.lit(f), qv + F.coalesce(
                                   F.col("dq"), F.lit(0.0))).otherwise(qv)).alias("q")),
                                  "res", run)
                params = materialize(params.join(bc(upd, fld), "idx", "left")
                          .select("idx", "fld", "w", F.transform("v", lambda vv, i: F.when(
                              i == F.lit(f), vv + F.coalesce(F.col("d"), F.lit(0.0))).otherwise(vv)).alias("v")),
                                     "params", run)
                pf = params.where(F.col("fld") == F.lit(fld))
                if log:
                    log(f"field {fld} factor {f}")
        history.append(math.sqrt((res.agg(F.sum(F.col("e") * F.col("e"))).first()[0] or 0.0) / max(1, n_rows)))
    linear = params.select("idx", "w")
    latent = params.select("idx", "v")
    return w0, linear, latent, history
