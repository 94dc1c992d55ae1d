"""The end-to-end flows, each a chain of DataFrame jobs.

``prepare``  text -> parsed rows (parquet) + index map (parquet)
``train``    rows -> FM model -> ``bias / linear / latent`` keyed by the
             original feature index (the reference looked latents up through
             the index map although training had not been re-indexed)
``run``      prepare -> train -> embed -> text / table sinks
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fmspark import defaults as DF
from fmspark.functions import sparse as S
from fmspark.operators import als as ALS
from fmspark.operators import embed as E
from fmspark.operators import fm as M
from fmspark.operators import fm_train as FT
from fmspark.operators import rows as R
from fmspark.operators import split as D
from fmspark.sinks import writers as W
from fmspark.session import materialize, maybe_broadcast
from fmspark.sources import libsvm as L


@dataclass
class Config:
    train_path: str
    prd_path: str | None
    out_dir: str
    threshold: int = DF.THRESHOLD
    method: str = DF.FM_SPARK_METHOD
    dim_k: int = DF.FM_DIM
    iter_num: int = DF.FM_NUM_ITER
    init_stdev: float = DF.FM_INIT_STDEV
    learn_rate: float = DF.FM_LEARN_RATE
    reg: float | tuple[float, float, float] = (DF.FM_R0_REG, DF.FM_R1_REG, DF.FM_R2_REG)
    seed: int = 0
    train_ratio: float = DF.TRAIN_RATIO
    append: bool = DF.IS_APPEND
    numbering: str = "offset"
    dense: bool = False
    scale: bool = False
    table: str | None = None  # tables `<table>_latent` and `<table>_embedded` are written where it is set
    field_map: DataFrame | None = None  # (idx, field), for method als
    groups: DataFrame | None = None  # (idx, grp [, r1, r2]), strengths of regularisation a group
    extra: dict = field(default_factory=dict)  # further arguments of the trainer


def prepare(spark: SparkSession, train_path: str, prd_path: str | None, out_dir: str) -> dict:
    """Parse both sets, build the index map over all rows of both, and
    persist everything as parquet (this also fixes the row ids for later
    jobs). Returns the written DataFrames and the feature count."""
    train = L.read_libsvm(spark, train_path)
    W.write_parquet(train, os.path.join(out_dir, "train_rows"))
    train = spark.read.parquet(os.path.join(out_dir, "train_rows"))
    feats = train.select("features")
    prd = None
    if prd_path:
        prd = L.read_libsvm(spark, prd_path, is_prd=True)
        W.write_parquet(prd, os.path.join(out_dir, "prd_rows"))
        prd = spark.read.parquet(os.path.join(out_dir, "prd_rows"))
        feats = feats.unionByName(prd.select("features"))
    fmap, n = D.feature_map(feats)
    W.write_parquet(fmap, os.path.join(out_dir, "feature_map"))
    return {"train": train, "prd": prd, "feature_map": spark.read.parquet(os.path.join(out_dir, "feature_map")),
            "n_features": n}


METHODS = ("sgd", "sgda", "adamW", "als")


def train(rows: DataFrame, fmap: DataFrame, n_features: int, *, label: str = "label", key: str = "row_id",
          method: str = DF.FM_SPARK_METHOD, scale: bool = False, dim_k: int = DF.FM_DIM, iter_num: int = DF.FM_NUM_ITER,
          init_stdev: float = DF.FM_INIT_STDEV, learn_rate: float = DF.FM_LEARN_RATE,
          reg: float | tuple[float, float, float] = (DF.FM_R0_REG, DF.FM_R1_REG, DF.FM_R2_REG), seed: int = 0,
          valid: DataFrame | None = None, field_map: DataFrame | None = None, groups: DataFrame | None = None,
          **more) -> tuple[float, DataFrame, DataFrame, FT.Fitted]:
    """Fit on re-indexed rows (positions ``0..n-1``), then key the linear
    weights and latents by the original index. Labels must be {0, 1} or {-1, 1}.

    ``method``: ``sgd``, ``sgda`` (on ``valid``), ``adamW`` or ``als`` (with
    ``field_map``; ``iter_num`` sweeps); ``mcmc`` raises. ``field_map`` and
    ``groups`` are keyed by the original index. The model's ``history`` is the
    objective before each step (als: the root mean square error after it).

    ``scale=True`` divides every feature by its largest absolute value (C12)
    in the same re-index pass and folds the divisor back into the returned
    tables (``w / s``, ``v / s``), so they score unscaled rows; one-hot
    features have ``s = 1`` and keep their latents as learned."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}: {', '.join(METHODS)} (mcmc has no Spark counterpart)")
    if scale:
        fmap = fmap.join(M.max_abs_scale(rows), "idx", "left") \
            .select("idx", "pos", F.coalesce("s", F.lit(1.0)).alias("s"))
    fmap = materialize(fmap, "feature-map")

    def positions(df: DataFrame) -> DataFrame:
        return R.reindex(df.select(key, label, "features"), fmap, key=key, map_rows=n_features, once=method != "als",
                         keep_zero=method == "als")

    def keyed(table: DataFrame | None) -> DataFrame | None:
        return None if table is None else table.join(fmap.select("idx", "pos"), "idx").drop("idx").withColumnRenamed("pos", "idx")

    if method == "als":
        if field_map is None:
            raise ValueError("als needs a field map")
        strengths = tuple(reg) if isinstance(reg, (tuple, list)) else (reg, reg, reg)
        bias, lin_pos, lat_pos, history = ALS.fit_als(positions(rows), keyed(field_map), dim_k, sweeps=iter_num, init_std=init_stdev,
                                                      reg=strengths, seed=seed, key=key, label=label, **more)
        state = lin_pos.join(lat_pos, "idx").unionByName(rows.sparkSession.createDataFrame([(FT.BIAS, float(bias), [0.0] * dim_k)], "idx int, w double, v array<double>"))
        model = FT.Fitted(materialize(state, "als-state"), dim_k, history, [])
    else:
        model = FT.fit(positions(rows), n_features, method=method, dim_k=dim_k, iter_num=iter_num, init_stdev=init_stdev, learn_rate=learn_rate,
                       reg=reg, seed=seed, key=key, label=label, valid=None if valid is None else positions(valid), groups=keyed(groups), **more)
    back_cols = [F.col("idx"), F.col("pos"), F.col("s") if scale else F.lit(1.0).alias("s")]
    back, _ = maybe_broadcast(fmap.select(*back_cols), row_bytes=24, known_rows=n_features)
    lin_pos, lat_pos = model.linear, model.latent
    linear = lin_pos.join(back, lin_pos.idx == back.pos).select(back.idx, (F.col("w") / F.col("s")).alias("w"))
    latent = lat_pos.join(back, lat_pos.idx == back.pos).select(
        back.idx, F.transform("v", lambda x: x / F.col("s")).alias("v"))
    return model.bias, linear, latent, model


def run(spark: SparkSession, cfg: Config) -> dict:
    """prepare -> train -> held-out predictions and metrics -> embed both
    sets -> gzip text, and tables where ``cfg.table`` is set.

    Written under ``cfg.out_dir``: ``bias``, ``linear``, ``latent`` (the model),
    ``objective`` (step, value), ``predictions`` (row_id, label, y, p of the held-out
    rows), ``metrics`` (auc, log_loss, accuracy), ``embedded_train`` and
    ``embedded_prd`` (text). Tables: ``<table>_latent`` (idx, dim1..dimk) and
    ``<table>_embedded`` (order_id, target, f0..fN, part), of which a run replaces
    the parts ``train`` and ``prd`` that it writes."""
    p = prepare(spark, cfg.train_path, cfg.prd_path, cfg.out_dir)
    path = lambda name: os.path.join(cfg.out_dir, name)
    rows = p["train"].withColumn("label", F.when(F.col("label") > 0, 1.0).otherwise(0.0))
    fit_rows, held = D.split(rows, "row_id", cfg.train_ratio, seed=cfg.seed)
    how = dict(cfg.extra)
    if cfg.method == "sgda" and "valid" not in how:
        fit_rows, how["valid"] = D.split(fit_rows, "row_id", cfg.train_ratio, seed=cfg.seed + 1)
    bias, linear, latent, model = train(fit_rows, p["feature_map"], p["n_features"], method=cfg.method,
                                        dim_k=cfg.dim_k, iter_num=cfg.iter_num, init_stdev=cfg.init_stdev,
                                        learn_rate=cfg.learn_rate, reg=cfg.reg, seed=cfg.seed,
                                        scale=cfg.scale, field_map=cfg.field_map, groups=cfg.groups, **how)
    W.write_parquet(spark.createDataFrame([(float(bias),)], "w0 double"), path("bias"))
    W.write_parquet(linear, path("linear"))
    W.write_parquet(latent, path("latent"))
    W.write_parquet(spark.createDataFrame(list(enumerate(map(float, model.history), 1)), "step int, value double"), path("objective"))
    linear, latent = spark.read.parquet(path("linear")), spark.read.parquet(path("latent"))
    scored = M.fm_score(held, bias, M.model_table(linear, latent), cfg.dim_k, keep=("label",))
    W.write_parquet(scored.select("row_id", "label", "y", "p"), path("predictions"))
    scored = spark.read.parquet(path("predictions"))
    found = [M.auc(scored, "label", "p").first()[0], M.log_loss(scored, "label", "p").first()[0], M.accuracy(scored, "label", "p").first()[0]]
    W.write_parquet(spark.createDataFrame([tuple(found)], "auc double, log_loss double, accuracy double"), path("metrics"))
    out = {"bias": bias, "metrics": dict(zip(("auc", "log_loss", "accuracy"), found)), "latent": path("latent"), "predictions": path("predictions")}
    kw = dict(append=cfg.append, numbering=cfg.numbering, dense=cfg.dense, k_hint=cfg.dim_k, in_row=True, unique=True)  # prepare gave every row its own id
    sets = {"train": p["train"].withColumn("order_id", F.col("row_id").cast("string"))}
    if p["prd"] is not None:
        sets["prd"] = p["prd"].withColumn("label", F.lit(None).cast("double"))
    widths = {}
    for name, df in sets.items():
        emb = E.embed(df, latent, cfg.threshold, keep=("order_id", "label"), **kw)
        if cfg.table:  # read for the text, the width and the table
            emb = materialize(emb, f"embedded-{name}")
        W.write_text(W.embedded_lines(emb, key="label" if name == "train" else "order_id", dense=cfg.dense), path(f"embedded_{name}"))
        out[name] = path(f"embedded_{name}")
        if cfg.table:
            widths[name] = emb.agg(F.max(F.size("out"))).first()[0] or 0
            W.embedded_parts(emb.withColumnRenamed("label", "target"), f"{cfg.table}_embedded", max(widths.values()), name, dense=cfg.dense)
    if cfg.table:
        W.latent_to_table(latent, f"{cfg.table}_latent", cfg.dim_k)
    return out


def onehot_rows(rows: DataFrame, threshold: int) -> DataFrame:
    """Only the one-hot part of sparse rows (the embedding candidates)."""
    return rows.withColumn("features", F.filter("features", lambda p: p["idx"] > F.lit(threshold)))


def nonzero(rows: DataFrame) -> DataFrame:
    return rows.withColumn("features", S.drop_zero("features"))
