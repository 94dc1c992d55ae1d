"""Field-aware factorization machines.

Scoring (E8), ``phi = sum_{i<j} <w_{i,f_j}, w_{j,f_i}> x_i x_j``, is computed
at the level of fields instead of feature pairs. With
``S[a][b] = sum_{i in field a} w_{i,b} x_i``:

* pairs across fields a < b contribute ``<S[a][b], S[b][a]>``
* pairs inside field a contribute ``(|S[a][a]|^2 - sum_{i in a} |w_{i,a}|^2 x_i^2) / 2``

A row's ``S`` is added up inside the row, in a batch of rows with numpy, where the
model fits a broadcast; otherwise a row costs one aggregation over (row, unordered
field pair) with plain sums and one sum per row. No pair of features is
materialised.

Training (E7) is mini-batch AdaGrad with the same decomposition for the
gradient, summed per ``(idx, field)`` by ``groupBy`` and kept as a table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fmspark import defaults as DF
from fmspark.functions import inrow as B
from fmspark.functions import sparse as S
from fmspark.session import broadcast_budget, maybe_broadcast

NO_INDEX = -(1 << 62)


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, e: s + e)


def ffm_score(rows: DataFrame, model: DataFrame, field_map: DataFrame, k: int, *, key: str = "row_id",
              features: str = "features", keep: tuple[str, ...] = (), clustered: bool = False,
              normalize: bool = False, other_field: int | None = None) -> DataFrame:
    """``key, *keep, y, p`` (``p = sigmoid(y)``). Rows without any known
    feature score 0. A model feature that the field map lacks is in
    ``other_field``, or raises.

    A model whose table of all indices and fields fits a broadcast scores inside the
    row (``FieldModel``). Otherwise, for rows that share key and ``keep``, which are
    one row, and for ``clustered`` input: (hash repartition on the key) -> explode ->
    join of the model rows ``(idx, own field a, target field b, v)`` -> one hash
    aggregation per ``(key, lo = least(a, b), hi = greatest(a, b))`` with
    separate sums for the ``a < b``, ``a > b`` and ``a = b`` sides (so
    ``S[lo][hi]``, ``S[hi][lo]`` and ``S[a][a]`` come out of the same group) ->
    the pair term per group -> one hash aggregation per key. Both
    aggregations reuse the key partitioning; only plain sums are kept (no
    per-row lists)."""
    fm = field_map.select(F.col("idx").cast("int").alias("_fidx"), F.col("field").cast("int").alias("_a"))
    mm = model.select(F.col("idx").cast("int").alias("_midx"), F.col("field").cast("int").alias("_b"),
                      F.col("v").alias("_v"))
    m = mm.join(fm, F.col("_midx") == F.col("_fidx"), "left") \
        .select("_midx", S.field_of("_a", "_midx", other_field).alias("_a"), "_b", "_v")
    cols = [c for c in keep if c != key]
    base = rows.select(key, *cols, S.drop_zero(features).alias("_f"))
    if normalize:
        nrm = F.sqrt(F.aggregate("_f", F.lit(0.0), lambda s, p: s + p["val"] * p["val"]))
        base = base.withColumn("_f", F.transform("_f", lambda p: S.pair(
            p["idx"], F.when(nrm > 0, p["val"] / nrm).otherwise(p["val"]))))
    got = None if clustered else field_model(m, k)
    if got is None:
        return _score_joined(base, m, k, key, cols, clustered)
    return B.one_row_a_key(_score_in_row(base, got, key, cols), [key, *cols], base, lambda df: _score_joined(df, m, k, key, cols, clustered), "ffm-scores")


@dataclass
class FieldModel:
    """``v[i, b]``: the factor of the index ``idx[i]`` (ascending), of the field ``own[i]``
    (a place in ``fields``), toward field ``b``; 0 where the model has none.
    ``s[i]``: the squared length of its factor toward its own field."""

    idx: np.ndarray
    own: np.ndarray
    fields: np.ndarray
    v: np.ndarray
    there: np.ndarray
    s: np.ndarray

    def parts(self, n: int, row: np.ndarray, idx: np.ndarray, x: np.ndarray):
        """Rows in runs whose field sums are at most 16 MB: their first and last
        number, and of their known features row (from 0), place, value."""
        at, found = B.find(self.idx, idx)
        row, at, x = row[found], at[found], x[found]
        f, k = self.v.shape[1:]
        step = max(1, (1 << 21) // max(1, f * f * k))
        for lo in range(0, n, step):
            hi = min(n, lo + step)
            a, b = np.searchsorted(row, (lo, hi))
            yield lo, hi, row[a:b] - lo, at[a:b], x[a:b]

    def sums(self, n: int, row: np.ndarray, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        """``S[row, a, b]``, the sum of ``v x`` over the row's features of field ``a``."""
        f, k = self.v.shape[1:]
        out = np.zeros((n * f, f, k))
        group = row * f + self.own[at]
        order = np.argsort(group, kind="stable")
        group = group[order]
        first = np.flatnonzero(np.diff(group, prepend=-1))
        if len(first):
            out[group[first]] = np.add.reduceat(self.v[at[order]] * x[order][:, None, None], first)
        return out.reshape(n, f, f, k)

    def score(self, s: np.ndarray, row: np.ndarray, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return 0.5 * (np.einsum("nabk,nbak->n", s, s) - B.totals(row, self.s[at] * x * x, len(s)))


def field_model(m: DataFrame, k: int) -> FieldModel | None:
    """``m``: (_midx, _a, _b, _v), several rows of an index and field add up. None
    where the whole table would not fit a broadcast, or an index has two fields."""
    m, small = maybe_broadcast(m, row_bytes=24 + 8 * k)
    if not small:
        return None
    t = m.where(F.col("_midx").isNotNull() & F.col("_a").isNotNull() & F.col("_b").isNotNull()).toArrow()
    idx, a, b = (t[c].to_numpy() for c in ("_midx", "_a", "_b"))
    known, at = np.unique(idx, return_inverse=True)
    fields = np.unique(np.concatenate([a, b]))
    if 8 * len(known) * len(fields) * k > broadcast_budget(m.sparkSession) or len(np.unique(np.stack([idx, a]), axis=1).T) != len(known):
        return None
    own = np.zeros(len(known), np.int64)
    own[at] = np.searchsorted(fields, a)
    vec, whole = B.vectors(t["_v"], k)
    v, s, there = np.zeros((len(known), len(fields), k)), np.zeros(len(known)), np.zeros((len(known), len(fields)), bool)
    to = np.searchsorted(fields, b)
    np.add.at(v, (at, to), vec)
    np.add.at(s, at, np.where((a == b) & whole, (vec * vec).sum(axis=1), 0.0))
    there[at, to] = True
    return FieldModel(known, own, fields, v, there, s)


def _score_in_row(base: DataFrame, model: FieldModel, key: str, cols: list[str]) -> DataFrame:
    def score(b: pa.RecordBatch) -> dict:
        n, row, items = B.flat(b.column("_f"))
        y = [np.zeros(0)]
        for lo, hi, r, at, x in model.parts(len(n), row, B.field(items, "idx", NO_INDEX), B.field(items, "val", 0.0)):
            y.append(model.score(model.sums(hi - lo, r, at, x), r, at, x))
        y = np.concatenate(y)
        return {c: b.column(c) for c in (key, *cols)} | {"y": y, "p": 1.0 / (1.0 + np.exp(-y))}

    schema = T.StructType([base.schema[c] for c in (key, *cols)] + [T.StructField(c, T.DoubleType()) for c in ("y", "p")])
    return B.by_batch(base, schema, score)


def _score_joined(base: DataFrame, m: DataFrame, k: int, key: str, cols: list[str], clustered: bool) -> DataFrame:
    m, _ = maybe_broadcast(m, row_bytes=24 + 8 * k)
    if not clustered:
        base = base.repartition(key)
    ex = base.select(key, *cols, F.explode_outer("_f").alias("_p"))
    j = ex.join(m, F.col("_p.idx") == F.col("_midx"), "left")
    x = F.col("_p.val")
    a, b = F.col("_a"), F.col("_b")

    def side(cond, d):
        return F.sum(F.when(cond, F.element_at("_v", d + 1) * x).otherwise(F.lit(0.0)))
    aggs = [side(a < b, d).alias(f"_l{d}") for d in range(k)]
    aggs += [side(a > b, d).alias(f"_h{d}") for d in range(k)]
    aggs += [side(a == b, d).alias(f"_z{d}") for d in range(k)]
    aggs.append(F.sum(F.when(a == b, x * x * F.aggregate("_v", F.lit(0.0), lambda s, e: s + e * e))
                      .otherwise(F.lit(0.0))).alias("_q"))
    g = j.groupBy(key, *cols, F.least(a, b).alias("_lo"), F.greatest(a, b).alias("_hi")).agg(*aggs)
    cross = sum((F.col(f"_l{d}") * F.col(f"_h{d}") for d in range(k)), F.lit(0.0))
    inner = F.lit(0.5) * (sum((F.col(f"_z{d}") * F.col(f"_z{d}") for d in range(k)), F.lit(0.0)) - F.col("_q"))
    term = F.when(F.col("_lo") < F.col("_hi"), cross).when(F.col("_lo") == F.col("_hi"), inner)
    y = g.groupBy(key, *cols).agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("y"))
    return y.withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("y"))))


# ---------------------------------------------------------------- training
def fit_ffm(rows: DataFrame, field_map: DataFrame, k: int = DF.FFM_K, *, epochs: int = DF.FFM_ITERATIONS,
            eta: float = DF.FFM_ETA, lam: float = DF.FFM_LAMBDA, normalize: bool = DF.FFM_INSTANCE_NORM,
            valid: DataFrame | None = None, n_batches: int = 4,
            seed: int = 0, key: str = "row_id", label: str = "label", features: str = "features",
            log=None, other_field: int | None = None):
    """FFM with logistic loss, mini-batch AdaGrad, early stop on the
    validation log-loss. Returns ``(model(idx, field, v), history)``. A feature
    that the field map lacks is in ``other_field``, or raises.

    Per mini-batch (rows whose key hashes to the batch), ``row_gradients``
    sums the gradient per ``(idx, b)`` (a batch of rows first), and AdaGrad updates
    the model table; a model that does not fit a broadcast, or rows that share a
    key, take ``ffm_gradients`` over exploded pairs. The model and the rows or pairs
    are written as parquet in the checkpoint folder (``session.materialize``)."""
    import math
    import uuid

    from fmspark.functions.random import unit
    from fmspark.session import collect_bounded, materialize

    run = uuid.uuid4().hex
    fm = field_map.select(F.col("idx").cast("int").alias("idx"), F.col("field").cast("int").alias("a"))
    fm_b, _ = maybe_broadcast(fm, row_bytes=16)
    yv = F.when(F.col(label).cast("double") > 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    base = rows.select(key, yv.alias("y"), S.drop_zero(features).alias("_f"))
    if normalize:
        nrm = F.sqrt(F.aggregate("_f", F.lit(0.0), lambda s, p: s + p["val"] * p["val"]))
        base = base.withColumn("_f", F.transform("_f", lambda p: S.pair(
            p["idx"], F.when(nrm > 0, p["val"] / nrm).otherwise(p["val"]))))
    base = materialize(base.withColumn("batch", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(n_batches)).cast("int")), "ffm_rows", run, ("batch",))
    if valid is not None:
        valid = materialize(valid.select(key, label, features), "ffm_valid", run)
    found = (base.select(F.explode("_f").alias("_p")).select(F.col("_p.idx").alias("idx")).distinct()
             .join(fm_b, "idx", "left").withColumn("a", S.field_of("a", "idx", other_field)))
    found = materialize(found.where("idx is not null"), "ffm_indices", run)
    # the model holds all pairs of an index and a field
    fields = sorted(r[0] for r in collect_bounded(found.select("a").distinct(), 100_000, "fields"))
    cells = found.count() * len(fields)
    in_row = (cells * (24 + 8 * k) <= broadcast_budget(rows.sparkSession) and found.count() == found.select("idx").distinct().count()
              and B.repeated(base, [key]) is None)
    ex = None if in_row else materialize(base.select(key, "y", F.explode("_f").alias("_p"))
                     .select(key, "y", F.col("_p.idx").alias("idx"), F.col("_p.val").alias("x"))
                     .join(fm_b, "idx", "left").withColumn("a", S.field_of("a", "idx", other_field))
                     .withColumn("batch", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(n_batches))),
                     "ffm_pairs", run)
    coef = 1.0 / math.sqrt(k)
    model = materialize(
        found.select("idx").distinct()
        .select("idx", F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"))
        .select("idx", "field",
                F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                            lambda d: F.lit(coef) * unit(F.col("idx"), F.col("field"), d, F.lit(seed))).alias("v"),
                F.array_repeat(F.lit(1.0), k).alias("acc")),
        "ffm_model", run)

    def val_loss(m):
        sc = ffm_score(valid, m.select("idx", "field", "v"), field_map, k, key=key, keep=(label,),
                       normalize=normalize, other_field=other_field)
        p = F.least(F.greatest("p", F.lit(1e-15)), F.lit(1 - 1e-15))
        y = (F.col(label).cast("double") > 0).cast("double")
        return sc.agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p)))).first()[0]

    history, best, best_loss = [], model, float("inf")
    for epoch in range(epochs):
        for b in range(n_batches):
            if in_row:
                m = model.join(found, "idx").select(F.col("idx").alias("_midx"), F.col("a").alias("_a"), F.col("field").alias("_b"), F.col("v").alias("_v"))
                grads = row_gradients(base.where(F.col("batch") == F.lit(b)), field_model(m, k), k, lam=lam)
            else:
                exb = ex.where(F.col("batch") == F.lit(b)).select(key, "y", "idx", "x", "a")
                mb, _ = maybe_broadcast(model.select("idx", F.col("field").alias("fb"), "v"), row_bytes=24 + 8 * k)
                grads = ffm_gradients(exb, mb, k, key=key, lam=lam)
            gcol = F.array(*[F.coalesce(F.col(f"_g{d}"), F.lit(0.0)) for d in range(k)])
            upd = model.join(grads, (model["idx"] == grads["gi"]) & (model["field"] == grads["tb"]), "left") \
                .select("idx", "field", "v", "acc", gcol.alias("grad"))
            acc = F.zip_with("acc", "grad", lambda a, c: a + c * c)
            model = materialize(upd.select("idx", "field", acc.alias("acc_n"), "v", "grad").select(
                "idx", "field",
                F.zip_with(F.arrays_zip("v", "grad"), "acc_n",
                           lambda vg, s: vg["v"] - F.lit(eta) * vg["grad"] / F.sqrt(s)).alias("v"),
                F.col("acc_n").alias("acc")), "ffm_model", run)
        if valid is not None:
            loss = val_loss(model)
            history.append(loss)
            if log:
                log(f"epoch {epoch} valid log-loss {loss:.6f}")
            if loss < best_loss:
                best, best_loss = model, loss
            else:
                break
        else:
            best = model
    return best.select("idx", "field", "v"), history


def row_gradients(rows: DataFrame, model: FieldModel, k: int, *, lam: float = 0.0) -> DataFrame:
    """As ``ffm_gradients``, for rows (y, _f: pairs) with keys of their own that score
    themselves: only the sums an index and field leave a batch."""
    fields = model.fields

    def share(b: pa.RecordBatch) -> dict:
        n, row, items = B.flat(b.column("_f"))
        y = b.column("y").to_numpy(zero_copy_only=False)
        g = np.zeros_like(model.v)
        used = np.zeros(len(model.idx), bool)
        for lo, hi, r, at, x in model.parts(len(n), row, B.field(items, "idx", NO_INDEX), B.field(items, "val", 0.0)):
            s = model.sums(hi - lo, r, at, x)
            kappa = -y[lo:hi] / (1.0 + np.exp(y[lo:hi] * model.score(s, r, at, x)))
            # of each feature: x kappa (S[b][a] - [a = b] v x) + lam v
            mirror = s[r, :, model.own[at], :]
            mirror[np.arange(len(at)), model.own[at]] -= model.v[at, model.own[at]] * x[:, None]
            one = mirror * (kappa[r] * x)[:, None, None] + lam * model.v[at]
            order = np.argsort(at, kind="stable")
            first = np.flatnonzero(np.diff(at[order], prepend=-1))
            if len(first):
                g[at[order][first]] += np.add.reduceat(one[order], first)
                used[at] = True
        i, f = np.nonzero(model.there & used[:, None])
        return {"gi": model.idx[i].astype(np.int64), "tb": fields[f].astype(np.int64)} | {f"_g{d}": g[i, f, d] for d in range(k)}

    each = B.by_batch(rows.select("y", "_f"), "gi long, tb long, " + ", ".join(f"_g{d} double" for d in range(k)), share)
    return each.groupBy(F.col("gi").cast("int").alias("gi"), F.col("tb").cast("int").alias("tb")).agg(*[F.sum(f"_g{d}").alias(f"_g{d}") for d in range(k)])


def ffm_gradients(pairs: DataFrame, model: DataFrame, k: int, *, key: str = "row_id",
                  lam: float = 0.0, clustered: bool = False) -> DataFrame:
    """Gradient of the summed logistic loss of a set of rows, per model
    entry: ``(gi, tb, _g0.._g{k-1})`` for ``w_{gi, tb}``.

    ``pairs``: ``(key, y in {-1,1}, idx, x, a)`` (a = field of idx);
    ``model``: ``(idx, fb, v)`` (broadcast-ready). One aggregation per
    ``(key, lo, hi)`` gives ``S[lo][hi]``, ``S[hi][lo]`` and ``S[a][a]``; one
    per key gives ``phi`` and ``kappa = -y / (1 + exp(y phi))``; each
    ``(feature, target field)`` then reads its mirror vector from its group:
    ``g = kappa x (S[b][a] - [a = b] w_{i,a} x) + lam w_{i,b}``."""
    base = pairs if clustered else pairs.repartition(key)
    j = base.join(model, "idx").withColumn("_lo", F.least("a", "fb")).withColumn("_hi", F.greatest("a", "fb"))
    x, a, fb = F.col("x"), F.col("a"), F.col("fb")

    def side(cond, d):
        return F.sum(F.when(cond, F.element_at("v", d + 1) * x).otherwise(F.lit(0.0)))
    grp = j.groupBy(key, "_lo", "_hi").agg(
        F.array(*[side(a < fb, d) for d in range(k)]).alias("_l"),
        F.array(*[side(a > fb, d) for d in range(k)]).alias("_h"),
        F.array(*[side(a == fb, d) for d in range(k)]).alias("_z"),
        F.sum(F.when(a == fb, x * x * F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e))
              .otherwise(F.lit(0.0))).alias("_q"),
        F.first("y").alias("y"))
    term = F.when(F.col("_lo") < F.col("_hi"), _dot(F.col("_l"), F.col("_h"))) \
        .when(F.col("_lo") == F.col("_hi"), F.lit(0.5) * (_dot(F.col("_z"), F.col("_z")) - F.col("_q")))
    kap = grp.groupBy(key).agg(F.sum(term).alias("_phi"), F.first("y").alias("_y")) \
        .select(key, (-F.col("_y") / (F.lit(1.0) + F.exp(F.col("_y") * F.col("_phi")))).alias("_kappa"))
    g = (j.join(grp.select(key, "_lo", "_hi", "_l", "_h", "_z"), [key, "_lo", "_hi"])
         .join(kap, key)
         .select(F.col("idx").alias("gi"), F.col("fb").alias("tb"),
                 F.zip_with(
                     F.when(a < fb, F.col("_h")).when(a > fb, F.col("_l"))
                      .otherwise(F.zip_with("_z", "v", lambda z, v: z - v * x)),
                     "v", lambda m, v: F.col("_kappa") * x * m + F.lit(lam) * v).alias("_gv")))
    return g.groupBy("gi", "tb").agg(*[F.sum(F.element_at("_gv", d + 1)).alias(f"_g{d}") for d in range(k)])
