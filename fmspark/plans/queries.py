"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory. Results are flat scalar columns (arrays are
exploded to ``(key, pos, ...)``) so that they can be compared value by value
with the SQL oracles in ``oracle_sql.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fmspark.functions import sparse as S
from fmspark.operators import embed as E
from fmspark.operators import rows as R
from fmspark.operators import split as D
from fmspark.plans import fixtures as fx
from fmspark.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# The outer explode plus a null filter gives the same rows as a plain
# explode, without the inferred ``size(array) > 0`` filter that Catalyst
# would push below the projection (evaluating the array expression twice).
def _pairs_long(df: DataFrame, keys: tuple[str, ...], col: str = "out") -> DataFrame:
    return df.select(*keys, F.posexplode_outer(col).alias("pos", "_q")).where(F.col("pos").isNotNull()) \
        .select(*keys, "pos", F.col("_q.idx").alias("idx"), F.col("_q.val").alias("val"))


def _values_long(df: DataFrame, keys: tuple[str, ...], col: str = "out") -> DataFrame:
    return df.select(*keys, F.posexplode_outer(col).alias("pos", "val")).where(F.col("pos").isNotNull())


def _embed(spark, sf, **kw) -> DataFrame:
    rows = fx.sparse_rows(spark, sf)
    return E.embed(rows, fx.latent(spark, sf), fx.THRESHOLD, keep=("order_id",), k_hint=fx.K, **kw)


# ---------------------------------------------------------------- embedding
@query
def embed_append(spark, sf):
    """F1+F2+F4 (flagship): raw continuous pairs, then the latent vectors of
    the active one-hot features numbered from threshold+1."""
    return _pairs_long(_embed(spark, sf), ("order_id",))


@query
def embed_only(spark, sf):
    """embedding only."""
    return _pairs_long(_embed(spark, sf, append=False), ("order_id",))


@query
def embed_zero_numbering(spark, sf):
    """everything renumbered 0..n-1."""
    return _pairs_long(_embed(spark, sf, numbering="zero"), ("order_id",))


@query
def embed_dense(spark, sf):
    """values only."""
    return _values_long(_embed(spark, sf, dense=True), ("order_id",))


@query
def embed_readme_form(spark, sf):
    """F2 with every input value kept (the README's worked form), dense."""
    return _values_long(_embed(spark, sf, dense=True, keep_onehot=True), ("order_id",))


@query
def embed_width_check(spark, sf):
    """width report of the embedded rows."""
    return E.width_report(fx.sparse_rows(spark, sf), fx.THRESHOLD, fx.latent(spark, sf))


@query
def embed_target_join(spark, sf):
    """F8: prd rows get the label of the training row with the same key."""
    rows = fx.sparse_rows(spark, sf)
    train, _ = D.split(rows, "order_id", 0.8)
    prd = E.attach_target(rows.drop("label"), train, key="order_id")
    out = E.embed(prd, fx.latent(spark, sf), fx.THRESHOLD, keep=("order_id", "target"), dense=True)
    return _values_long(out, ("order_id", "target"))


@query
def embed_union_sets(spark, sf):
    """train and test sets through one embedding job."""
    rows = fx.sparse_rows(spark, sf)
    train, test = D.split(rows, "order_id", 0.8)
    out = E.embed_sets(train, test.drop("label"), fx.latent(spark, sf), fx.THRESHOLD, keep=("order_id",))
    out = out.withColumn("set", F.when(F.col("set") == "prd", F.lit("test")).otherwise(F.col("set")))
    return _pairs_long(out, ("order_id", "set"))


@query
def latent_table(spark, sf):
    """G1 layout: ``idx, dim1..dimk`` (doubles, keyed)."""
    from fmspark.sinks.writers import latent_columns
    return latent_columns(fx.latent(spark, sf), fx.K)


# ---------------------------------------------------------------- rows
@query
def relabel_pm1(spark, sf):
    return fx.feature_rows(spark, sf).select("order_id", S.relabel_pm1("target").alias("label"))


@query
def relabel_zero_only(spark, sf):
    return fx.feature_rows(spark, sf).select("order_id", S.relabel_zero_only("target").alias("label"))


@query
def drop_zero(spark, sf):
    rows = fx.sparse_rows(spark, sf).select("order_id", S.drop_zero("features").alias("out"))
    return _pairs_long(rows, ("order_id",))


@query
def feature_map(spark, sf):
    rows = fx.sparse_rows(spark, sf).select(S.drop_zero("features").alias("features"))
    return D.feature_map(rows)[0]


def _fmap_rows(spark, sf):
    rows = fx.sparse_rows(spark, sf)
    nz = rows.withColumn("features", S.drop_zero("features"))
    fmap, n = D.feature_map(nz)
    return rows, fmap, n


@query
def reindex(spark, sf):
    rows, fmap, n = _fmap_rows(spark, sf)
    nz = rows.withColumn("features", S.drop_zero("features"))
    out = R.reindex(nz, fmap, key="row_id", map_rows=n)
    return out.select("order_id", F.posexplode("features").alias("p", "_q")) \
        .select("order_id", "p", F.col("_q.idx").alias("idx"), F.col("_q.val").alias("val"))


@query
def to_fm(spark, sf):
    rows, fmap, n = _fmap_rows(spark, sf)
    out = R.to_fm(rows, reindex_map=fmap, map_rows=n)
    return out.select("order_id", "label", F.posexplode("features").alias("p", "_q")) \
        .select("order_id", "label", "p", F.col("_q.idx").alias("idx"), F.col("_q.val").alias("val"))


@query
def table_to_sparse(spark, sf):
    fr = fx.feature_rows(spark, sf)
    sp = R.table_to_sparse(fr, label="target", exclude=("user_id",), keep=("order_id",))
    return sp.select("order_id", "label", F.inline("features"))


@query
def to_libsvm_text(spark, sf):
    fr = fx.feature_rows(spark, sf).select(
        "order_id", "target", "f_flag", "f_nation", "f_prio",
        F.coalesce("f_zero_disc", F.lit(0.0)).alias("f_zero_disc"), F.coalesce("f_qty", F.lit(0.0)).alias("f_qty"))
    return R.to_libsvm_line(fr, "target", ["f_flag", "f_nation", "f_prio", "f_zero_disc", "f_qty"],
                            keep=("order_id",))


@query
def to_dense(spark, sf):
    d = R.to_dense(fx.sparse_rows(spark, sf), keep=("order_id",))
    return d.select("order_id", "target", F.posexplode("feature").alias("pos", "val"))


@query
def to_ffm_text(spark, sf):
    rows = fx.sparse_rows(spark, sf)
    onehot = rows.withColumn("features", F.filter("features", lambda p: p["idx"] > F.lit(fx.THRESHOLD)))
    return R.to_ffm(onehot, fx.field_table(fx.latent(spark, sf)), key="row_id", keep=("order_id",))


@query
def dt_range_scan(spark, sf):
    from fmspark.sources.tables import read_range
    return read_range(fx.feature_rows(spark, sf), "19960101", "19961231") \
        .select("order_id", "dt", "target", "f_price")


@query
def dt_day_scan(spark, sf):
    from fmspark.sources.tables import read_day
    return read_day(fx.feature_rows(spark, sf), "19960315").select("order_id", "dt", "target", "f_price")


@query
def numeric_fill(spark, sf):
    return R.numeric_frame(fx.feature_rows(spark, sf))


@query
def cast_fill(spark, sf):
    fr = fx.feature_rows(spark, sf).select("order_id", "f_qty", "f_zero_disc", "f_nation", "f_prio")
    return R.cast_fill(fr, ["f_qty", "f_zero_disc", "f_nation", "f_prio"], keep=("order_id",))


@query
def drop_ids(spark, sf):
    train, _ = R.drop_ids(fx.feature_rows(spark, sf))
    return train


@query
def drop_ids_prd(spark, sf):
    """B11, prediction half: the order id stays, targets and other ids go."""
    return R.drop_ids(fx.feature_rows(spark, sf))[1]


# ---------------------------------------------------------------- index / split
@query
def split_counts(spark, sf):
    return D.split_counts(fx.feature_rows(spark, sf).select("order_id"), "order_id", 0.8)


@query
def split_half(spark, sf):
    return D.with_part(fx.feature_rows(spark, sf).select("order_id"), "order_id", 0.5, seed=0)


@query
def row_col_count(spark, sf):
    return D.row_col_count(fx.feature_rows(spark, sf))


# ---------------------------------------------------------------- FM / FFM scoring and metrics
@query
def fm_score(spark, sf):
    """Relational FM scoring with a fixed model (bias 0.1, w = embedding[9],
    v = embedding[1..8]); features max-abs scaled per index (C12)."""
    from fmspark.operators import fm as M
    rows = fx.sparse_rows(spark, sf)
    bias, linear, latent = fx.fm_model(spark, sf)
    model = M.model_table(linear, latent, M.max_abs_scale(rows))
    sc = M.fm_score(rows, bias, model, fx.K, keep=("order_id",))
    return sc.select("order_id", F.round("y", 6).alias("y"), F.round("p", 6).alias("p"))


def _prob_scores(spark, sf):
    sc = fx.scores(spark, sf)
    top = sc.agg(F.max("s")).first()[0]
    return sc.withColumn("p", (F.col("s") + F.lit(0.5)) / F.lit(float(top) + 1.0))


@query
def auc(spark, sf):
    """ROC AUC with ties."""
    from fmspark.operators import fm as M
    return M.auc(fx.scores(spark, sf), "y", "s").select(F.round("auc", 9).alias("auc"))


@query
def log_loss(spark, sf):
    """Log-loss of the scores scaled into (0, 1)."""
    from fmspark.operators import fm as M
    return M.log_loss(_prob_scores(spark, sf), "y", "p").select(F.round("log_loss", 6).alias("log_loss"))


@query
def accuracy(spark, sf):
    """Accuracy at threshold 0.5."""
    from fmspark.operators import fm as M
    return M.accuracy(_prob_scores(spark, sf), "y", "p").select(F.round("accuracy", 6).alias("accuracy"))


@query
def ffm_score(spark, sf):
    """FFM scoring of the active one-hot features, without instance norm."""
    from fmspark.operators import ffm as FF
    rows = fx.sparse_rows(spark, sf)
    act = rows.withColumn("features", S.active("features", fx.THRESHOLD))
    sc = FF.ffm_score(act, fx.ffm_model(spark, sf), fx.field_table(fx.latent(spark, sf)), fx.FFM_K,
                      keep=("order_id",))
    return sc.select("order_id", F.round("y", 6).alias("y"), F.round("p", 6).alias("p"))


# ---------------------------------------------------------------- feature transforms
FIXTURE_SPEC = {"f_price": "standardnormalize", "f_bal": "discretize(20)", "f_qty": "bucket(min,10,100,max);onehot()",
                "f_zero_disc": "discretize(20)", "f_seg": "onehot", "f_nation": "onehot", "f_prio": "onehot",
                "f_flag": "Untransform", "order_dummy": None}


def _vec_long(df: DataFrame, keys: tuple[str, ...], vec: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return df.select(*keys, F.posexplode(vector_to_array(vec)).alias("pos", "val"))


def _fr(spark, sf, *cols):
    return fx.feature_rows(spark, sf).select("order_id", *cols)


@query
def bucketize(spark, sf):
    """Explicit splits on f_qty (min, 10, 100, max); null stays null."""
    from fmspark.operators import transforms as T
    out = T.bucketizer(_fr(spark, sf, "f_qty"), "f_qty", "f_qty_bucket", [float("-inf"), 10.0, 100.0, float("inf")])
    return out.select("order_id", "f_qty_bucket")


@query
def discretize(spark, sf):
    """C4: 20 quantile buckets of f_bal (exact quantiles: relativeError 0)."""
    from fmspark.operators import transforms as T
    out = T.discretizer(_fr(spark, sf, "f_bal"), "f_bal", "f_bal_bucket", 20, relative_error=0.0)
    return out.select("order_id", "f_bal_bucket")


@query
def onehot(spark, sf):
    """String index by frequency, one-hot without dropping the last."""
    from pyspark.ml.functions import vector_to_array
    from fmspark.operators import transforms as T
    out = T.onehot(_fr(spark, sf, "f_seg"), "f_seg", "f_seg_vec")
    arr = vector_to_array("f_seg_vec")
    return out.select("order_id", F.size(arr).alias("vec_size"),
                      (F.array_position(arr, 1.0) - 1).cast("int").alias("hot_index"))


@query
def standardize(spark, sf):
    """(x - mean) / sample std."""
    from fmspark.operators import transforms as T
    out = T.standard_scaler(_fr(spark, sf, "f_price"), "f_price", "f_price_std")
    return out.select("order_id", F.round("f_price_std", 6).alias("f_price_std"))


@query
def binarize(spark, sf):
    """X > 0."""
    from fmspark.operators import transforms as T
    d = fx.feature_rows(spark, sf).select("order_id", F.coalesce("f_zero_disc", F.lit(0.0)).alias("x"))
    return T.binarizer(d, "x", "x_bin").select("order_id", "x_bin")


@query
def string_index(spark, sf):
    """Index by descending frequency, ties alphabetical."""
    from fmspark.operators import transforms as T
    out, _ = T.string_indexer(_fr(spark, sf, "f_seg"), "f_seg", "f_seg_idx")
    return out.select("order_id", "f_seg_idx")


@query
def index_to_string(spark, sf):
    """Back from index to label with the indexer's labels."""
    from fmspark.operators import transforms as T
    out, m = T.string_indexer(_fr(spark, sf, "f_seg"), "f_seg", "f_seg_idx")
    return T.index_to_string(out, "f_seg_idx", "f_seg_back", m.labels).select("order_id", "f_seg_back")


@query
def normalize_l2(spark, sf):
    """L2 normalisation of the embedding vectors."""
    from pyspark.ml.functions import array_to_vector
    from fmspark.operators import transforms as T
    e = fx.table(spark, sf, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    out = T.normalizer(e, "v", "v_norm")
    return _vec_long(out, ("vec_id",), "v_norm").withColumn("val", F.round("val", 6))


@query
def min_max(spark, sf):
    """C11: rescale f_bal to [0, 1]."""
    from fmspark.operators import transforms as T
    out = T.min_max_scaler(_fr(spark, sf, "f_bal"), "f_bal", "f_bal_mm")
    return out.select("order_id", F.round("f_bal_mm", 6).alias("f_bal_mm"))


@query
def max_abs(spark, sf):
    """f_bal / max |f_bal|."""
    from fmspark.operators import transforms as T
    out = T.max_abs_scaler(_fr(spark, sf, "f_bal"), "f_bal", "f_bal_ma")
    return out.select("order_id", F.round("f_bal_ma", 6).alias("f_bal_ma"))


@query
def assemble(spark, sf):
    """Vector of (f_price, f_bal, f_qty with nulls as 0)."""
    from fmspark.operators import transforms as T
    d = fx.feature_rows(spark, sf).select("order_id", "f_price", "f_bal",
                                          F.coalesce("f_qty", F.lit(0.0)).alias("f_qty"))
    out = T.vector_assembler(d, ["f_price", "f_bal", "f_qty"], "vec", drop=True)
    return _vec_long(out, ("order_id",), "vec")


@query
def copy_column(spark, sf):
    """C14: untransform = copy under a new name."""
    from fmspark.operators import transforms as T
    return T.untransform(_fr(spark, sf, "f_flag"), "f_flag", "f_flag_copy").select("order_id", "f_flag_copy")


@query
def vector_index(spark, sf):
    """Slots with <= 20 distinct values become category indices."""
    from fmspark.operators import transforms as T
    d = T.vector_assembler(_fr(spark, sf, "f_prio", "f_nation", "f_flag"), ["f_prio", "f_nation", "f_flag"], "vec")
    out, _ = T.vector_indexer(d, "vec", "vec_idx", 20)
    return _vec_long(out, ("order_id",), "vec_idx")


@query
def vector_slice(spark, sf):
    """Slots 0 and 2 of (f_price, f_bal, f_flag)."""
    from fmspark.operators import transforms as T
    d = T.vector_assembler(_fr(spark, sf, "f_price", "f_bal", "f_flag"), ["f_price", "f_bal", "f_flag"], "vec")
    return _vec_long(T.vector_slicer(d, "vec", "vec_sl", [0, 2]), ("order_id",), "vec_sl")


@query
def r_formula(spark, sf):
    """C17 (rows-only): target ~ f_seg + f_price."""
    from fmspark.operators import transforms as T
    out = T.r_formula(_fr(spark, sf, "target", "f_seg", "f_price"), "target ~ f_seg + f_price")
    return _vec_long(out, ("order_id", "label"), "features")


@query
def chisq_top(spark, sf):
    """C18 (rows-only): the 2 categorical features most dependent on target."""
    from fmspark.operators import transforms as T
    d = T.vector_assembler(_fr(spark, sf, "target", "f_nation", "f_prio", "f_flag"),
                           ["f_nation", "f_prio", "f_flag"], "vec")
    _, sel = T.chisq_selector(d.withColumn("label", F.col("target").cast("double")), 2, "vec", "sel", "label")
    return spark.range(len(sel)).select(F.col("id").cast("int").alias("rank"),
                                        F.element_at(F.array(*[F.lit(i) for i in sel]),
                                                     F.col("id").cast("int") + 1).alias("feature"))


@query
def transform_spec(spark, sf):
    """C1 + C2 (rows-only): the fixture spec over the feature table as one
    multi-column pipeline; vectors reported as their active slot."""
    from pyspark.ml.functions import vector_to_array
    from fmspark.operators import transforms as T
    fr = fx.feature_rows(spark, sf).withColumn("order_dummy", F.lit(1))
    out, _ = T.transform_pipeline(fr, FIXTURE_SPEC)
    vec_cols = [c for c in ("f_qty", "f_seg", "f_nation", "f_prio")]
    return out.select("order_id", "f_price", "f_bal", "f_zero_disc", "f_flag",
                      *[(F.array_position(vector_to_array(c), 1.0) - 1).cast("int").alias(c) for c in vec_cols])


# ---------------------------------------------------------------- training steps with a fixed model
def _scaled_rows(spark, sf):
    """All features of the sparse rows, max-abs scaled, indices as they are."""
    from fmspark.operators import fm as M
    rows = fx.sparse_rows(spark, sf)
    # written: re-indexing counts the map, then reads it
    scale = materialize(M.max_abs_scale(rows).select("idx", F.col("idx").alias("pos"), "s"), "scale")
    return R.reindex(rows.select("row_id", "order_id", "label", "features"), scale, key="row_id", once=True)


def _fixed_params(spark, sf):
    bias, linear, latent = fx.fm_model(spark, sf)
    one = spark.range(1).select(F.lit(-1).alias("idx"), F.lit(bias).alias("w"), F.array_repeat(F.lit(0.0), fx.K).alias("v"))
    return linear.join(latent, "idx").select("idx", "w", "v").unionByName(one)


@query
def fm_gradients(spark, sf):
    """The gradient of the summed logistic loss at a fixed model, an index
    a row group: ``d`` 0 is the weight (or the bias, idx -1), 1 to 8 the factors."""
    from fmspark.operators import fm_train as FT
    g = FT.fm_gradients(_scaled_rows(spark, sf), _fixed_params(spark, sf), fx.K)
    each = F.posexplode(F.concat(F.array("gw"), F.coalesce("gv", F.array().cast("array<double>")))).alias("d", "g")
    return g.select("idx", each).select("idx", "d", F.round("g", 6).alias("g"))


@query
def als_step(spark, sf):
    """The two sums of the coordinate updates of one field (nation): of its
    weights (``factor`` -1) and of its first factor, at a fixed model."""
    from fmspark.operators import als as A
    data = A.with_fields(_scaled_rows(spark, sf), fx.field_table(fx.latent(spark, sf)))
    params = _fixed_params(spark, sf)
    width = params.agg(F.max("idx")).first()[0] + 1
    parts = [A.als_sums(data, params, fx.K, width, 7, f).select(F.lit(-1 if f is None else f).alias("factor"), "idx", F.round("num", 6).alias("num"),
                                                                 F.round("den", 6).alias("den")) for f in (None, 0)]
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------- text and table flows
def _scratch(spark, name: str) -> str:
    import uuid
    from fmspark.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/fmspark-{name}-{uuid.uuid4().hex}"


@query
def split_text_rows(spark, sf):
    """A3 + D2: text rows with ids made of their content, split by them; many lines
    are equal, and the split is the same for any files."""
    from fmspark.sinks import writers as W
    from fmspark.sources.libsvm import read_libsvm
    path = _scratch(spark, "lines")
    W.write_text(to_libsvm_text(spark, sf).select(F.col("line").alias("value")), path)
    return D.with_part(read_libsvm(spark, path).select("row_id", "label"), "row_id", 0.8)


@query
def libsvm_round_trip(spark, sf):
    """A4 + A5 + G6: prediction rows -> gzip text -> rows, all features."""
    from fmspark.sinks import writers as W
    from fmspark.sources.libsvm import read_libsvm
    path = _scratch(spark, "prd")
    W.write_text(W.prd_lines(fx.sparse_rows(spark, sf)), path)
    back = read_libsvm(spark, path, is_prd=True)
    return back.select("order_id", F.inline("features")).select("order_id", "idx", F.round("val", 6).alias("val"))


@query
def labels_only(spark, sf):
    """A10: the labels of a text file, as counts (equal lines are rows of their own)."""
    from fmspark.sinks import writers as W
    from fmspark.sources.libsvm import read_labels
    path = _scratch(spark, "labels")
    W.write_text(to_libsvm_text(spark, sf).select(F.col("line").alias("value")), path)
    return read_labels(spark, path).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("ids"))


@query
def embedded_table(spark, sf):
    """G3/G4 + F8: embedded train and prediction rows with target in a partitioned
    table ``order_id, target, f0..f28, part``; written twice, a run replaces its
    own partition. Every value is reported."""
    from fmspark.sinks import writers as W
    rows, lat, path = fx.sparse_rows(spark, sf), fx.latent(spark, sf), _scratch(spark, "embedded")
    train, _ = D.split(rows, "order_id", 0.8)
    sets = {"train": train.withColumnRenamed("label", "target"), "prd": E.attach_target(rows.drop("label"), train, key="order_id")}
    width = 5 + 3 * fx.K
    for part in ("train", "prd", "train"):
        emb = E.embed(sets[part], lat, fx.THRESHOLD, keep=("order_id", "target"), dense=True)
        W.write_parts(W.flatten_embedded(emb, width).withColumn("part", F.lit(part)), path, "part")
    back = spark.read.parquet(path)
    return back.select("part", "order_id", "target", F.posexplode(F.array(*[f"f{i}" for i in range(width)])).alias("pos", "val"))


# ---------------------------------------------------------------- FM training (rows-only checks)
def _planted(spark, sf):
    """One-hot part of the sparse rows with the planted two-way label,
    split by the stable hash of the order id. The rows are written: every fit and
    score reads them, none joins the tables anew."""
    from fmspark.plans.pipeline import nonzero, onehot_rows
    from fmspark.session import materialize
    rows = materialize(nonzero(onehot_rows(fx.sparse_rows(spark, sf, label="target_planted"), fx.THRESHOLD)), "planted")
    fmap, n = D.feature_map(rows)
    tr, te = D.split(rows, "order_id", 0.8)
    return tr, te, fmap, n


def _fit_report(spark, sf, method, k=4, iters=100, step=0.1, extra=None, rows=None):
    from fmspark.operators import fm as M
    from fmspark.plans.pipeline import train
    tr, te, fmap, n = rows or _planted(spark, sf)
    bias, linear, latent, _ = train(tr, fmap, n, method=method, dim_k=k, iter_num=iters, learn_rate=step,
                                    init_stdev=0.1, seed=7, **({"reg": 0.0} | (extra or {})))
    model = M.model_table(linear, latent)
    sc = M.fm_score(te, bias, model, k, keep=("label",))
    a = M.auc(sc, "label", "p")
    ll = M.log_loss(sc, "label", "p")
    return a.join(ll).select(F.lit(method).alias("method"), F.lit(k).alias("k"), F.lit(iters).alias("iters"),
                             F.round("auc", 6).alias("auc"), F.round("log_loss", 6).alias("log_loss"))


@query
def fm_fit_adamw(spark, sf):
    """E1/E6 (rows-only): AdamW on the planted label; held-out AUC and log-loss
    from relational scoring of the learned tables."""
    return _fit_report(spark, sf, "adamW", iters=40, step=0.2)


@query
def fm_fit_sgd(spark, sf):
    """E1a (rows-only): gradient steps over mini-batches."""
    return _fit_report(spark, sf, "sgd", iters=50, step=4.0)


@query
def fm_fit_sgda(spark, sf):
    """E1b (rows-only): gradient steps with strengths of regularisation adapted on
    a validation split."""
    _, te, _, _ = planted = _planted(spark, sf)
    tr, va = D.split(planted[0], "order_id", 0.8, seed=1)
    return _fit_report(spark, sf, "sgda", iters=30, step=4.0, extra={"valid": va, "reg": 0.01, "reg_rate": 0.01}, rows=(tr, te, *planted[2:]))


@query
def fm_grid(spark, sf):
    """E5 (rows-only): k x iterations grid, AUC on a validation split; one training
    run a k."""
    from fmspark.operators import fm_train as FT
    tr, te, fmap, n = _planted(spark, sf)
    fit, val = (R.reindex(df, fmap, map_rows=n) for df in D.split(tr, "order_id", 0.8, seed=1))
    table, _ = FT.grid(fit, val, n, ks=(2, 4), iters=(20, 40), learn_rate=0.2, init_stdev=0.1, seed=7)
    return table.select("k", "iters", F.round("auc", 6).alias("auc"), F.round("log_loss", 6).alias("log_loss"))


@query
def fm_fit_als(spark, sf):
    """E1c (rows-only): field-blocked ALS on the planted label; held-out AUC."""
    from fmspark.operators import fm as M
    from fmspark.operators.als import fit_als
    tr, te, _, _ = _planted(spark, sf)
    bias, linear, latent, hist = fit_als(tr, fx.field_table(fx.latent(spark, sf)), 4, sweeps=2,
                                         init_std=0.1, reg=(0.0, 0.1, 0.1), seed=7)
    sc = M.fm_score(te, bias, M.model_table(linear, latent), 4, keep=("label",))
    return M.auc(sc, "label", "y").select(F.lit("als").alias("method"), F.lit(4).alias("k"),
                                           F.lit(len(hist)).alias("sweeps"), F.round("auc", 6).alias("auc"),
                                           F.lit(round(hist[-1], 6)).alias("train_rmse"))


@query
def ffm_fit(spark, sf):
    """E7 (rows-only): FFM by mini-batch AdaGrad on the planted label, early
    stop on a validation split; held-out AUC and log-loss."""
    from fmspark.operators import ffm as FF
    from fmspark.operators import fm as M
    tr, te, _, _ = _planted(spark, sf)
    fit, val = D.split(tr, "order_id", 0.8, seed=1)
    fmap = fx.field_table(fx.latent(spark, sf))
    model, hist = FF.fit_ffm(fit, fmap, 4, epochs=6, eta=0.2, lam=2e-5, valid=val, n_batches=2, seed=7)
    sc = FF.ffm_score(te, model, fmap, 4, keep=("label",), normalize=True)
    return M.auc(sc, "label", "p").join(M.log_loss(sc, "label", "p")).select(
        F.lit("ffm").alias("method"), F.lit(len(hist)).alias("epochs"),
        F.round("auc", 6).alias("auc"), F.round("log_loss", 6).alias("log_loss"))


@query
def pipeline_end_to_end(spark, sf):
    """F10 (rows-only): fixture rows -> libsvm text (train and prd) ->
    prepare (parse, index map) -> FM training -> embedding of both sets ->
    gzip text; the embedded train lines read back. Scratch output goes to the
    session's checkpoint folder (shared on a cluster)."""
    import uuid
    from fmspark.plans.pipeline import Config, run
    from fmspark.session import ensure_checkpoint_dir
    from fmspark.sinks import writers as W
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fmspark-e2e-{uuid.uuid4().hex}"
    rows = fx.sparse_rows(spark, sf, label="target_planted", written=True)
    W.write_text(W.fm_lines(rows.withColumn("label", F.col("label").cast("double"))), f"{base}/train_txt")
    W.write_text(W.prd_lines(rows), f"{base}/prd_txt")
    out = run(spark, Config(train_path=f"{base}/train_txt", prd_path=f"{base}/prd_txt", out_dir=f"{base}/out",
                            threshold=fx.THRESHOLD, dim_k=4, iter_num=20, reg=0.0, scale=True))
    lines = spark.read.text(out["prd"])
    t = S.tokens("value")
    return lines.select(t[0].alias("order_id"), (F.size(t) - 1).alias("n_values"))


@query
def chisq_stats(spark, sf):
    """C18 statistics: chi-square of each categorical feature against target."""
    from pyspark.ml.stat import ChiSquareTest
    from fmspark.operators import transforms as T
    d = T.vector_assembler(_fr(spark, sf, "target", "f_nation", "f_prio", "f_flag"),
                           ["f_nation", "f_prio", "f_flag"], "vec")
    res = ChiSquareTest.test(d.withColumn("label", F.col("target").cast("double")), "vec", "label", flatten=True)
    return res.select(F.col("featureIndex").cast("int").alias("feature"),
                      F.col("degreesOfFreedom").cast("int").alias("dof"),
                      F.round("statistic", 6).alias("statistic"))


@query
def transform_spec_exact(spark, sf):
    """C1 + C2 with exact quantiles (relativeError 0), so that SQL can check
    the whole multi-column pipeline: vectors reported as their active slot,
    the standardised price rounded to 6 places."""
    from pyspark.ml.functions import vector_to_array
    from fmspark.operators import transforms as T
    fr = fx.feature_rows(spark, sf).withColumn("order_dummy", F.lit(1))
    out, _ = T.transform_pipeline(fr, FIXTURE_SPEC, relative_error=0.0)
    vec_cols = ["f_qty", "f_seg", "f_nation", "f_prio"]
    return out.select("order_id", F.round("f_price", 6).alias("f_price"), "f_bal", "f_zero_disc", "f_flag",
                      *[(F.array_position(vector_to_array(c), 1.0) - 1).cast("int").alias(c) for c in vec_cols])
