"""E1, E1a, E1b, E1d, E5: factorization machines trained on tables.

Parameters and optimiser state are one table, a row a feature (``idx`` -1 is the
bias). A step is one job: every training row scores itself, its features send
their share of the gradient to their index, one aggregation adds it up, and the
join with the state table writes the next state.

Scoring inside the row: with ``q_f = sum_i v_if x_i`` the score is
``w0 + sum_i w_i x_i + 1/2 sum_f (q_f^2 - sum_i v_if^2 x_i^2)``, and for a row
with loss derivative ``g`` the gradient of ``w_i`` is ``g x_i`` and that of
``v_if`` is ``g x_i q_f - v_if g x_i^2``. So an index needs ``k + 2`` sums over
its rows, whatever their number; a batch of rows adds them up with numpy, and what
crosses the network is those sums, one row an index and task. Parameters reach
the tasks as arrays, proven to fit a broadcast; beyond that they are joined by
index (``_by_join``), with the same result.

Training rows are written once, and where parameters fit a broadcast once more in
blocks of packed arrays, which the steps read.

Methods of ``fit``:

* ``sgd``    gradient steps over mini-batches, a batch a folder of the written rows
* ``adamW``  Adam with decoupled decay, by default over all rows a step
* ``sgda``   as ``sgd``, and after every step the strengths of regularisation move
             against the gradient of the validation loss: a step
             ``theta' = theta - eta (grad + r theta)`` has
             ``d theta' / d r = - eta theta``, so ``dL/dr`` is the validation
             gradient at ``theta'`` times ``- eta theta``, summed over a group

Strengths are columns of the state (``r0`` on the bias, ``r1`` on weights, ``r2``
on factors), filled from a table (idx, grp) with one strength a group where one
is given. Labels in {0, 1}, or -1 for 0.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

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
from fmspark.session import broadcast_budget, materialize

BIAS = -1
NO_INDEX = -(1 << 62)
BETA1, BETA2, ADAM_EPS = 0.9, 0.999, 1e-8
SGD_MINI_BATCH = 0.1


# ---------------------------------------------------------------- scoring in the row
@dataclass
class Arrays:
    """Parameters by index: bias, weights, factors (a row an index) and their
    squared lengths. What is null or missing is 0."""

    w0: float
    w: np.ndarray
    v: np.ndarray
    s: np.ndarray

    def score(self, row: np.ndarray, idx: np.ndarray, val: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Row sums ``q`` (a column a factor) and scores of ``n`` rows, whose
        items are (row, index, value)."""
        known = (idx >= 0) & (idx < len(self.w))
        if not known.all():
            row, idx, val = row[known], idx[known], val[known]
        q = np.stack([B.totals(row, np.take(self.v[:, f], idx) * val, n) for f in range(self.v.shape[1])]).T if self.v.shape[1] else np.zeros((n, 0))
        return q, self.w0 + B.totals(row, self.w[idx] * val, n) + 0.5 * ((q * q).sum(axis=1) - B.totals(row, self.s[idx] * val * val, n))


def arrays_of(params: DataFrame, k: int, width: int) -> Arrays:
    """``params``: (idx, w, v), bias at ``BIAS``. Their size is proven to fit a
    broadcast (``scored``)."""
    used = params.where((F.col("idx") == BIAS) | ((F.col("idx") >= 0) & (F.col("idx") < width)))
    t = used.select(F.col("idx").cast("long").alias("idx"), F.col("w").cast("double").alias("w"), F.col("v").cast("array<double>").alias("v")).toArrow()
    idx, w = t["idx"].to_numpy(), pc.fill_null(t["w"], 0.0).to_numpy()
    v, whole = B.vectors(t["v"], k)
    s = np.where(whole, (v * v).sum(axis=1), 0.0)
    bias, none = w[idx == BIAS], np.setdiff1d(np.arange(width), idx)
    idx, w, v, s = (np.concatenate([x[idx >= 0], np.zeros((len(none), *x.shape[1:]), x.dtype)]) for x in (idx, w, v, s))
    idx[len(idx) - len(none):] = none
    order = np.lexsort((*v.T[::-1], w, idx))
    return Arrays(float(bias.min()) if len(bias) else 0.0, w[order], v[order], s[order])


def items_of(column) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Number of rows, and of every feature: its row, index (``NO_INDEX`` for a
    null one), value, and itself."""
    n, row, items = B.flat(column)
    return len(n), row, B.field(items, "idx", NO_INDEX), B.field(items, "val", 0.0), items


def in_row(rows: DataFrame, arrays: Arrays, k: int, features: str) -> DataFrame:
    """``rows`` with ``_yhat``."""
    names = rows.columns

    def score(b: pa.RecordBatch) -> dict:
        n, row, idx, val, _ = items_of(b.column(features))
        return {c: b.column(c) for c in names} | {"_yhat": arrays.score(row, idx, val, n)[1]}

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields] + [T.StructField("_yhat", T.DoubleType())])
    return B.by_batch(rows, schema, score)


def _by_join(rows: DataFrame, params: DataFrame, k: int, key: str, features: str) -> DataFrame:
    """As ``in_row`` where the parameters do not fit a broadcast: two joins by
    key and one by index."""
    bias = params.where(F.col("idx") == BIAS).agg(F.max("w")).first()[0] or 0.0
    rows = rows.withColumn("_f", F.coalesce(F.col(features), F.array().cast(rows.schema[features].dataType)))
    p = params.where(F.col("idx") >= 0).select("idx", "w", "v")
    ex = rows.select(key, F.explode("_f").alias("_p")).select(key, F.col("_p.idx").alias("idx"), F.col("_p.val").alias("x")).join(p, "idx")
    sums = ex.groupBy(key).agg(
        F.sum(F.col("w") * F.col("x")).alias("_lin"), F.sum(F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e) * F.col("x") * F.col("x")).alias("_sq"),
        *[F.sum(F.get("v", F.lit(n)) * F.col("x")).alias(f"_q{n}") for n in range(k)])
    q = F.array(*[F.coalesce(F.col(f"_q{n}"), F.lit(0.0)) for n in range(k)])
    j = rows.join(sums.withColumnRenamed(key, "_key"), F.col(key) == F.col("_key"), "left").withColumn("_q", q)
    pair = F.aggregate("_q", F.lit(0.0), lambda a, e: a + e * e) - F.coalesce("_sq", F.lit(0.0))
    return (j.withColumn("_yhat", F.lit(bias) + F.coalesce("_lin", F.lit(0.0)) + F.lit(0.5) * pair)
            .drop("_key", "_lin", "_sq", *[f"_q{n}" for n in range(k)]))


def fits(rows: DataFrame, k: int, width: int) -> bool:
    """Whether parameters of this many indices and factors may be broadcast."""
    return 8 * width * (k + 2) <= broadcast_budget(rows.sparkSession)


def scored(rows: DataFrame, params: DataFrame, k: int, width: int, *, key: str = "row_id", features: str = "features") -> DataFrame:
    """``rows`` with ``_yhat``."""
    if fits(rows, k, width):
        return in_row(rows, arrays_of(params, k, width), k, features)
    return _by_join(rows, params, k, key, features)


def target(label: Column) -> Column:
    """Labels in {0, 1} or {-1, 1} as 0.0 and 1.0."""
    return F.when(label.cast("double") > 0, 1.0).otherwise(0.0)


BLOCK = 512  # items of a block
BLOCKS_AT_ONCE = 256


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows (label, features, batch) as every step reads them: many to a block of
    packed arrays, which are neither taken apart nor converted on their way to numpy.
    The rows of a block are of one batch and have about ``BLOCK`` items, or are one row
    with more. Null indices, which have no parameter, are left out."""
    def block(b: pa.RecordBatch) -> dict:
        n, row, idx, x, _ = items_of(b.column("features"))
        some = idx != NO_INDEX
        row, idx, x = row[some], idx[some], x[some]
        batch = b.column("batch").to_numpy()
        order = np.argsort(batch, kind="stable")
        at = np.empty(n, np.int64)
        at[order] = np.arange(n)
        items = np.argsort(at[row], kind="stable")
        batch, counts = batch[order], np.bincount(at[row], minlength=n)
        new = np.concatenate([[True], (batch[1:] != batch[:-1])])
        ends = np.cumsum(counts)
        part = np.cumsum(np.maximum(counts, 1)) // BLOCK
        last = np.append(np.flatnonzero((part[1:] != part[:-1]) | new[1:]), n - 1)
        return {"batch": pa.array(batch[last], pa.int32()), "y": B.packed(b.column("label").to_numpy(zero_copy_only=False)[order], last + 1),
                "n": B.packed(counts.astype(np.int32), last + 1), "idx": B.packed(idx[items].astype(np.int32), ends[last]),
                "x": B.packed(x[items], ends[last])}

    return B.by_batch(rows.select("label", "features", "batch"), "batch int, y binary, n binary, idx binary, x binary", block)


def _block_shares(blocks: DataFrame, arrays: Arrays, names: Sequence[str]) -> DataFrame:
    """As ``_shares`` over the rows of blocks."""
    def share(b: pa.RecordBatch) -> dict:
        n = B.unpacked(b.column("n"), np.int32)
        return _share(arrays, names, len(n), np.repeat(np.arange(len(n)), n), B.unpacked(b.column("idx"), np.int32).astype(np.int64),
                      B.unpacked(b.column("x"), np.float64), B.unpacked(b.column("y"), np.float64))

    return _as_shares(blocks, names, share, BLOCKS_AT_ONCE)


def _share(arrays: Arrays, names: Sequence[str], n: int, row: np.ndarray, idx: np.ndarray, x: np.ndarray, y: np.ndarray) -> dict:
    """The sums of ``fm_gradients`` over ``n`` rows with labels ``y``, whose items are
    (row, index, value)."""
    q, yhat = arrays.score(row, idx, x, n)
    g = 1.0 / (1.0 + np.exp(-yhat)) - y
    loss = np.maximum(yhat, 0.0) - y * yhat + np.log1p(np.exp(-np.abs(yhat)))
    found, at = B.distinct(idx)
    gx, m = g[row] * x, len(found)
    sums = [B.totals(at, gx, m), B.totals(at, gx * x, m), np.zeros(m, np.int64), np.zeros(m)]
    sums += [B.totals(at, gx * np.take(q[:, f], row), m) for f in range(q.shape[1])]
    bias = [g.sum(), g.sum(), n, loss.sum(), *[(g * q[:, f]).sum() for f in range(q.shape[1])]]
    found = np.append(found, BIAS)
    return {"idx": pa.array(found, mask=found == NO_INDEX)} | {c: np.append(a, e) for c, a, e in zip(names, sums, bias)}


def _as_shares(df: DataFrame, names: Sequence[str], share: Callable[[pa.RecordBatch], dict], at_once: int = 1 << 30) -> DataFrame:
    schema = "idx long, " + ", ".join(f"{c} {'long' if c == '_n' else 'double'}" for c in names)
    return B.by_batch(df, schema, share, at_once).withColumn("idx", F.col("idx").cast("int"))


def _shares(rows: DataFrame, arrays: Arrays, names: Sequence[str]) -> DataFrame:
    """The sums of ``fm_gradients`` over the rows (``_y, _f``) of a batch: a row an
    index and batch. The number of rows and their loss are the bias's alone."""
    def share(b: pa.RecordBatch) -> dict:
        n, row, idx, x, _ = items_of(b.column("_f"))
        return _share(arrays, names, n, row, idx, x, b.column("_y").to_numpy(zero_copy_only=False))

    return _as_shares(rows, names, share)


def _names(k: int) -> list[str]:
    return ["gw", "_b", "_n", "_loss", *[f"_a{n}" for n in range(k)]]


def fm_gradients(rows: DataFrame, params: DataFrame, k: int, *, width: int | None = None, key: str = "row_id", label: str = "label",
                 features: str = "features") -> DataFrame:
    """The gradient of the summed logistic loss: ``idx, gw, gv, n, loss`` for
    every index of the rows and for ``BIAS`` (whose ``gw`` is the bias's, ``n`` the
    rows and ``loss`` their loss; null elsewhere). ``params``: (idx, w, v); what it
    lacks is 0."""
    if width is None:
        width = (params.agg(F.max("idx")).first()[0] or 0) + 1
    names = _names(k)
    if fits(rows, k, width):
        each = _shares(rows.select(target(F.col(label)).alias("_y"), F.col(features).alias("_f")), arrays_of(params, k, width), names)
    else:
        r = _by_join(rows, params, k, key, features)
        y = target(F.col(label))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_yhat")))
        loss = F.greatest(F.col("_yhat"), F.lit(0.0)) - y * F.col("_yhat") + F.log1p(F.exp(-F.abs("_yhat")))
        r = r.select((p - y).alias("_g"), loss.alias("_loss"), "_q", "_f")
        one = F.array(F.struct(F.lit(BIAS).alias("idx"), F.lit(1.0).alias("val")))
        r = r.select("_g", "_loss", "_q", F.explode(F.concat(F.transform("_f", lambda x: F.struct(x["idx"].cast("int").alias("idx"), x["val"].cast("double").alias("val"))), one)).alias("_p"))
        gx = F.col("_g") * F.col("_p.val")
        each = r.select(F.col("_p.idx").alias("idx"), gx.alias("gw"), (gx * F.col("_p.val")).alias("_b"), F.lit(1).cast("long").alias("_n"), "_loss",
                        *[(gx * F.get("_q", F.lit(n))).alias(f"_a{n}") for n in range(k)])
    return _summed(each, params, k)


def _summed(each: DataFrame, params: DataFrame, k: int) -> DataFrame:
    """``fm_gradients`` of the shares of its rows."""
    sums = each.groupBy("idx").agg(*[F.sum(c).alias(c) for c in _names(k)])
    j = sums.join(params.select(F.col("idx").alias("_i"), F.col("v").alias("_pv")), F.col("idx") == F.col("_i"), "left")
    gv = F.array(*[F.col(f"_a{n}") - F.coalesce(F.get("_pv", F.lit(n)), F.lit(0.0)) * F.col("_b") for n in range(k)])
    bias = F.col("idx") == BIAS
    return j.select("idx", "gw", F.when(~bias, gv).alias("gv"), F.when(bias, F.col("_n")).alias("n"), F.when(bias, F.col("_loss")).alias("loss"))


# ---------------------------------------------------------------- training
@dataclass
class Fitted:
    """``state``: the written state table; ``history``: mean loss of the rows of
    each step, before it; ``strengths``: (step, grp, r1, r2) of ``sgda``."""

    state: DataFrame
    k: int
    history: list[float]
    strengths: list[tuple]

    @property
    def bias(self) -> float:
        return float(self.state.where(F.col("idx") == BIAS).select("w").first()[0])

    @property
    def linear(self) -> DataFrame:
        return self.state.where(F.col("idx") >= 0).select("idx", "w")

    @property
    def latent(self) -> DataFrame:
        return self.state.where(F.col("idx") >= 0).select("idx", "v")


def initial_state(spark, width: int, k: int, init_std: float, reg: tuple[float, float, float], groups: DataFrame | None,
                  seed: int) -> DataFrame:
    """Weights 0, factors normal with ``init_std``, by hashes of index, factor and
    seed. ``groups``: (idx, grp [, r1, r2]), null strengths are the general ones."""
    idx = spark.range(width).select(F.col("id").cast("int").alias("idx"))
    if groups is None:
        groups = idx.select("idx", F.lit(0).alias("grp"))
    strengths = [F.coalesce(F.col(c) if c in groups.columns else F.lit(None).cast("double"), F.lit(float(r))).alias(c) for c, r in (("r1", reg[1]), ("r2", reg[2]))]
    g = idx.join(groups.select(F.col("idx").cast("int").alias("idx"), F.col("grp").cast("int").alias("grp"), *[c for c in ("r1", "r2") if c in groups.columns]), "idx", "left")
    g = g.select("idx", F.coalesce("grp", F.lit(0)).alias("grp"), *[s if n in groups.columns else F.lit(float(r)).alias(n) for n, s, r in zip(("r1", "r2"), strengths, reg[1:])])
    v = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: F.lit(float(init_std)) * normal(F.col("idx"), f, seed))
    zeros = F.array_repeat(F.lit(0.0), k)
    one = idx.limit(1).select(F.lit(BIAS).alias("idx"), F.lit(BIAS).alias("grp"), F.lit(float(reg[0])).alias("r1"), F.lit(0.0).alias("r2"), zeros.alias("v"))
    s = g.select("idx", "grp", "r1", "r2", v.alias("v")).unionByName(one)
    return s.select("*", F.lit(0.0).alias("w"), F.lit(0.0).alias("mw"), F.lit(0.0).alias("sw"), zeros.alias("mv"), zeros.alias("sv"))


def _step(state: DataFrame, grads: DataFrame, k: int, rate: float, adam: int, fit_bias: bool, fit_linear: bool) -> DataFrame:
    """The next state. ``adam``: number of the Adam step, 0 for a plain step."""
    n = grads.where(F.col("idx") == BIAS).agg(F.lit(1).alias("_one"), F.coalesce(F.max("n"), F.lit(0)).alias("_rows"))
    g = grads.select(F.col("idx").alias("_i"), "gw", "gv", "loss")
    state = state.drop("pw", "pv", "loss", "rows")
    j = state.join(g, F.col("idx") == F.col("_i"), "left").withColumn("_b", F.lit(1)).join(F.broadcast(n), F.col("_b") == F.col("_one"))
    moves = F.when(F.col("idx") == BIAS, F.lit(fit_bias)).otherwise(F.lit(fit_linear))
    rows = F.greatest(F.col("_rows"), F.lit(1))
    gw = F.coalesce("gw", F.lit(0.0)) / rows
    gv = F.transform(F.coalesce("gv", F.array_repeat(F.lit(0.0), k)), lambda x: x / rows)
    if not adam:
        w = F.col("w") - F.lit(rate) * (gw + F.col("r1") * F.col("w"))
        v = F.zip_with("v", gv, lambda a, b: a - F.lit(rate) * (b + F.col("r2") * a))
        mw, sw, mv, sv = (F.col(c) for c in ("mw", "sw", "mv", "sv"))
    else:
        c1, c2 = 1 - BETA1 ** adam, 1 - BETA2 ** adam
        first, second = (lambda m, x: BETA1 * m + (1 - BETA1) * x), (lambda s, x: BETA2 * s + (1 - BETA2) * x * x)
        move = lambda m, s: F.lit(rate) * (m / c1) / (F.sqrt(s / c2) + ADAM_EPS)
        mw, sw = first(F.col("mw"), gw), second(F.col("sw"), gw)
        mv, sv = F.zip_with("mv", gv, first), F.zip_with("sv", gv, second)
        w = F.col("w") * (1 - F.lit(rate) * F.col("r1")) - move(mw, sw)
        pair = F.zip_with(mv, sv, lambda m, s: move(m, s))
        v = F.zip_with("v", pair, lambda a, d: a * (1 - F.lit(rate) * F.col("r2")) - d)
    is_bias = F.col("idx") == BIAS
    return j.select("idx", "grp", "r1", "r2", F.when(moves, w).otherwise(F.col("w")).alias("w"), F.when(is_bias, F.col("v")).otherwise(v).alias("v"),
                    mw.alias("mw"), sw.alias("sw"), mv.alias("mv"), sv.alias("sv"), F.col("w").alias("pw"), F.col("v").alias("pv"),
                    F.when(is_bias, F.col("loss")).alias("loss"), F.when(is_bias, F.col("_rows")).alias("rows"))


def _adapted(state: DataFrame, grads: DataFrame, k: int, rate: float, reg_rate: float) -> DataFrame:
    """``state`` with strengths moved against the validation gradient ``grads`` at
    its parameters; ``pw, pv`` are the parameters before the step."""
    n = grads.where(F.col("idx") == BIAS).agg(F.lit(1).alias("_one"), F.coalesce(F.max("n"), F.lit(0)).alias("_m"))
    g = grads.select(F.col("idx").alias("_i"), "gw", "gv")
    j = state.join(g, F.col("idx") == F.col("_i"), "left").withColumn("_b", F.lit(1)).join(F.broadcast(n), F.col("_b") == F.col("_one"))
    m = F.greatest(F.col("_m"), F.lit(1))
    dw = -F.lit(rate) * F.coalesce("gw", F.lit(0.0)) / m * F.col("pw")
    dv = F.aggregate(F.zip_with(F.coalesce("gv", F.array_repeat(F.lit(0.0), k)), F.col("pv"), lambda a, b: a * b), F.lit(0.0), lambda a, e: a + e)
    per = j.groupBy(F.col("grp").alias("_grp")).agg(F.sum(dw).alias("_d1"), F.sum(-F.lit(rate) * dv / m).alias("_d2"))  # one row a group
    j = state.join(per, F.col("grp") == F.col("_grp"))
    r1 = F.greatest(F.lit(0.0), F.col("r1") - F.lit(reg_rate) * F.col("_d1"))
    r2 = F.greatest(F.lit(0.0), F.col("r2") - F.lit(reg_rate) * F.col("_d2"))
    return j.withColumns({"r1": r1, "r2": r2}).drop("_grp", "_d1", "_d2")


def fit(rows: DataFrame, width: int, *, method: str = DF.FM_SPARK_METHOD, dim_k: int = DF.FM_DIM, iter_num: int = DF.FM_NUM_ITER,
        init_stdev: float = DF.FM_INIT_STDEV, learn_rate: float = DF.FM_LEARN_RATE, reg: float | Sequence[float] = 0.0,
        groups: DataFrame | None = None, valid: DataFrame | None = None, reg_rate: float | None = None, fit_bias: bool = True,
        fit_linear: bool = True, seed: int = 0, mini_batch_fraction: float | None = None, key: str = "row_id", label: str = "label",
        features: str = "features", snapshots: Sequence[int] = ()) -> Fitted | tuple[Fitted, dict[int, Fitted]]:
    """Train on ``rows`` (key, label, features with indices 0 to ``width - 1``).

    ``reg``: one strength or (r0, r1, r2). ``groups``: (idx, grp [, r1, r2]).
    ``valid``: rows that ``sgda`` adapts the strengths on. ``snapshots``: numbers
    of steps; then the models after them are returned as well. A row of any
    features scores; an index outside ``0..width-1`` raises. Rows are put into
    mini-batches by a hash of their key, so reruns agree."""
    if method not in ("sgd", "sgda", "adamW"):
        raise ValueError(f"unknown method {method!r}: sgd, sgda or adamW (als: fmspark.operators.als; mcmc has no Spark counterpart)")
    if method == "sgda" and valid is None:
        raise ValueError("sgda needs validation rows")
    strengths = tuple(float(x) for x in (reg if isinstance(reg, (tuple, list)) else (reg, reg, reg)))
    spark = rows.sparkSession
    share = mini_batch_fraction or (1.0 if method == "adamW" else SGD_MINI_BATCH)
    n_batches = max(1, round(1 / share))

    def prepared(df: DataFrame, name: str, batches: int) -> DataFrame:
        out_of = F.exists(features, lambda p: (p["idx"] < 0) | (p["idx"] >= width))
        checked = F.when(F.coalesce(out_of, F.lit(False)), F.raise_error(F.lit(f"feature index outside 0..{width - 1}"))).otherwise(F.col(features))
        # a value of 0 adds 0 to every sum of a step, so the written rows, read at every step, go without
        out = df.select(F.col(key).alias("key"), target(F.col(label)).alias("label"), S.drop_zero(checked).alias("features"),
                        F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(batches)).cast("int").alias("batch"))
        out = materialize(out, name, partition_by=("batch",))
        return materialize(_blocks(out), f"{name}-blocks", partition_by=("batch",)) if in_blocks else out

    def gradients(of: DataFrame, it: int) -> DataFrame:
        part = of.where(F.col("batch") == (it - 1) % n_batches)
        if in_blocks:
            return _summed(_block_shares(part.drop("batch"), arrays_of(state, dim_k, width), _names(dim_k)), state, dim_k)
        return fm_gradients(part, state, dim_k, width=width, key="key")

    in_blocks = fits(rows, dim_k, width)
    train = prepared(rows, "fm-rows", n_batches)
    held = prepared(valid, "fm-valid", n_batches) if method == "sgda" else None
    files = 1 + width * dim_k // 500_000  # of the state table

    def kept_state(df: DataFrame) -> DataFrame:
        return materialize(df.coalesce(files), "fm-state")

    state = kept_state(initial_state(spark, width, dim_k, init_stdev, strengths, groups, seed))
    history, adapted, kept = [], [], {}
    for it in range(1, iter_num + 1):
        # written: the step reads it twice, for the rows' number and for the sums
        grads = materialize(gradients(train, it), "fm-grads")
        state = kept_state(_step(state, grads, dim_k, learn_rate, it if method == "adamW" else 0, fit_bias, fit_linear))
        if method == "sgda":
            vg = materialize(gradients(held, it), "fm-grads")
            state = kept_state(_adapted(state, vg, dim_k, learn_rate, reg_rate if reg_rate is not None else learn_rate))
            adapted += [(it, r.grp, r.r1, r.r2) for r in state.groupBy("grp").agg(F.min("r1").alias("r1"), F.min("r2").alias("r2")).orderBy("grp").limit(1000).collect()]
        b = state.where(F.col("idx") == BIAS).select("loss", "rows").first()
        history.append((b.loss or 0.0) / max(1, b.rows or 0))
        if it in snapshots:
            kept[it] = Fitted(state, dim_k, list(history), list(adapted))
    model = Fitted(state, dim_k, history, adapted)
    return (model, kept) if snapshots else model


def predictions(rows: DataFrame, model: Fitted, width: int, *, key: str = "row_id", features: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """``key, *keep, y`` (score) ``, p`` (probability)."""
    s = scored(rows, model.state.select("idx", "w", "v"), model.k, width, key=key, features=features)
    return s.select(key, *keep, F.col("_yhat").alias("y"), (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_yhat")))).alias("p"))


def grid(rows: DataFrame, valid: DataFrame, width: int, ks: Sequence[int] = (4, 8), iters: Sequence[int] = (50, 100), *, key: str = "row_id",
         label: str = "label", features: str = "features", **how) -> tuple[DataFrame, Fitted | None]:
    """E5: one training run a ``k``, read off at each number of steps in ``iters``,
    ranked by AUC on ``valid``; strictly better wins, so the first wins ties.
    Returns a table (k, iters, auc, log_loss) in grid order and the best model."""
    from .fm import auc, log_loss
    out, best, top = [], None, 0.0
    for k in ks:
        _, models = fit(rows, width, dim_k=k, iter_num=max(iters), snapshots=tuple(iters), key=key, label=label, features=features, **how)
        for n in iters:
            p = materialize(predictions(valid, models[n], width, key=key, features=features, keep=(label,))
                            .select(target(F.col(label)).cast("int").alias("y"), "p"), "grid")
            a, ll = auc(p, "y", "p").first()[0], log_loss(p).first()[0]
            out.append((k, n, a, ll))
            if a is not None and a > top:
                best, top = models[n], a
    return rows.sparkSession.createDataFrame(out, "k int, iters int, auc double, log_loss double"), best
