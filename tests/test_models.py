"""FM scoring, metrics, training (E), FFM (E7/E8) and ALS."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inputs import SF_SMALL
from fmspark.operators import ffm as FF
from fmspark.operators import fm as M
from fmspark.operators.als import fit_als

PAIRS = "row_id long, label int, features array<struct<idx:int,val:double>>"


def random_rows(n=60, fields=((0, 1, 2), (3, 4), (5, 6, 7, 8)), seed=3):
    rnd = random.Random(seed)
    rows = []
    for r in range(n):
        feats = sorted((rnd.choice(f), 1.0) for f in fields)
        rows.append((r, rnd.randint(0, 1), feats))
    field_of = {i: fi for fi, f in enumerate(fields) for i in f}
    return rows, field_of


def np_fm(w0, w, V, feats):
    y = w0 + sum(w[i] * x for i, x in feats)
    for a in range(len(feats)):
        for b in range(a + 1, len(feats)):
            (i, xi), (j, xj) = feats[a], feats[b]
            y += float(np.dot(V[i], V[j])) * xi * xj
    return y


def test_fm_score_equals_pairwise_definition(spark):
    rows, _ = random_rows()
    rnd = np.random.default_rng(0)
    w, V = rnd.normal(size=9), rnd.normal(size=(9, 3))
    lin = spark.createDataFrame([(i, float(w[i])) for i in range(9)], "idx int, w double")
    lat = spark.createDataFrame([(i, [float(x) for x in V[i]]) for i in range(9)], "idx int, v array<double>")
    df = spark.createDataFrame(rows, PAIRS)
    got = {r["row_id"]: r["y"] for r in M.fm_score(df, 0.3, M.model_table(lin, lat), 3).collect()}
    for rid, _, feats in rows:
        assert got[rid] == pytest.approx(np_fm(0.3, w, V, feats), abs=1e-9)


def test_ffm_score_equals_pairwise_definition(spark):
    rows, field_of = random_rows()
    rnd = np.random.default_rng(1)
    W = rnd.normal(size=(9, 3, 2))  # feature x target field x k
    model = spark.createDataFrame([(i, f, [float(x) for x in W[i, f]]) for i in range(9) for f in range(3)],
                                  "idx int, field int, v array<double>")
    fmap = spark.createDataFrame(list(field_of.items()), "idx int, field int")
    df = spark.createDataFrame(rows, PAIRS)
    got = {r["row_id"]: r["y"] for r in FF.ffm_score(df, model, fmap, 2).collect()}
    for rid, _, feats in rows:
        y = 0.0
        for a in range(len(feats)):
            for b in range(a + 1, len(feats)):
                (i, xi), (j, xj) = feats[a], feats[b]
                y += float(np.dot(W[i, field_of[j]], W[j, field_of[i]])) * xi * xj
        assert got[rid] == pytest.approx(y, abs=1e-9)


def test_ffm_same_field_pairs(spark):
    # two features of one field in a row (not one-hot): the inner-field term
    W = {(0, 0): [1.0, 2.0], (1, 0): [3.0, -1.0]}
    model = spark.createDataFrame([(i, f, v) for (i, f), v in W.items()], "idx int, field int, v array<double>")
    fmap = spark.createDataFrame([(0, 0), (1, 0)], "idx int, field int")
    df = spark.createDataFrame([(0, 1, [(0, 2.0), (1, 0.5)]), (1, 0, [])], PAIRS)
    got = {r["row_id"]: r["y"] for r in FF.ffm_score(df, model, fmap, 2).collect()}
    assert got[0] == pytest.approx((1 * 3 + 2 * -1) * 2.0 * 0.5)
    assert got[1] == 0.0


def test_auc_matches_evaluator_with_ties(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from fmspark.plans import fixtures as fx
    sc = fx.scores(spark, SF_SMALL)
    ours = M.auc(sc, "y", "s").first()[0]
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    theirs = ev.evaluate(sc.select(F.col("y").cast("double").alias("y"), "s"))
    assert ours == pytest.approx(theirs, abs=1e-12)


@pytest.mark.parametrize("parts", [1, 4, 60])
def test_auc_does_not_depend_on_ranges(spark, parts):
    df = spark.range(0, 3000).select((F.col("id") % 2).alias("y"), (F.col("id") * 37 % 1009).cast("double").alias("s"))
    assert M.auc(df, "y", "s", parts).first()[0] == pytest.approx(M.auc(df, "y", "s", 9).first()[0], abs=1e-15)


@pytest.mark.parametrize("parts", [1, 2, 30])
def test_auc_null_nan_and_one_class(spark, parts):
    nan = float("nan")
    rows = [(1, 0.9), (0, 0.9), (0, 0.1), (1, nan), (0, nan), (1, None), (None, 0.5), (1, 0.4)]
    df = spark.createDataFrame(rows, "y int, s double")
    used = [(y, 1e9 if s != s else s) for y, s in rows if y is not None and s is not None]
    pairs = [(p, n) for y, p in used if y for z, n in used if not z]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    assert M.auc(df, "y", "s", parts).first()[0] == pytest.approx(want)
    assert M.auc(df.where("y = 1"), "y", "s", parts).first()[0] is None
    assert M.auc(df.limit(0), "y", "s", parts).first()[0] is None


def test_log_loss_and_accuracy(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.4)], "y int, p double")
    ll = M.log_loss(df).first()[0]
    assert ll == pytest.approx(-(math.log(0.9) + math.log(0.8) + math.log(0.4)) / 3)
    assert M.accuracy(df).first()[0] == pytest.approx(2 / 3)


def test_fit_argument_checks(spark):
    with pytest.raises(ValueError, match="mcmc"):
        M.fm_fit(None, method="mcmc")
    with pytest.raises(ValueError, match="single regularisation"):
        M.fm_fit(None, reg=(0.1, 0.2, 0.1))


def test_relational_score_equals_model_transform(spark):
    from pyspark.ml.functions import vector_to_array
    rows, _ = random_rows(n=80)
    df = spark.createDataFrame(rows, PAIRS)
    vec = M.to_vectors(df, 9, keep=("row_id",))
    model = M.fm_fit(vec, dim_k=3, iter_num=5, learn_rate=0.1, init_stdev=0.1, seed=1)
    bias, lin, lat = M.model_tables(spark, model)
    ours = {r["row_id"]: r["y"] for r in M.fm_score(df, bias, M.model_table(lin, lat), 3).collect()}
    theirs = {r["row_id"]: r["raw"] for r in model.transform(vec).select(
        "row_id", vector_to_array("rawPrediction")[1].alias("raw")).collect()}
    for k, v in theirs.items():
        assert ours[k] == pytest.approx(v, abs=1e-9)


def test_fm_learns_planted_interaction(spark):
    from fmspark.plans.queries import QUERIES
    r = QUERIES["fm_fit_adamw"](spark, "/root/testdata/sf0.01").first()
    assert r["auc"] > 0.95


def np_als(rows, field_of, k, sweeps, V0, reg):
    """Sequential coordinate descent (one parameter at a time, feature by
    feature) for squared loss; the reference for the field-blocked version."""
    n = max(field_of) + 1
    w0, w, V = 0.0, np.zeros(n), V0.copy()
    X = [dict(f) for _, _, f in rows]
    y = np.array([1.0 if lab else -1.0 for _, lab, _ in rows])

    def pred(x):
        return np_fm(w0, w, V, sorted(x.items()))
    r0, r1, r2 = reg
    for _ in range(sweeps):
        e = np.array([y[t] - pred(X[t]) for t in range(len(rows))])
        w0 = (e.sum() + len(rows) * w0) / (len(rows) + r0)
        for fld in sorted(set(field_of.values())):
            for i in sorted(j for j, f in field_of.items() if f == fld):
                e = np.array([y[t] - pred(X[t]) for t in range(len(rows))])
                h = np.array([X[t].get(i, 0.0) for t in range(len(rows))])
                w[i] = ((e + w[i] * h) * h).sum() / ((h * h).sum() + r1)
            for f in range(k):
                for i in sorted(j for j, g in field_of.items() if g == fld):
                    e = np.array([y[t] - pred(X[t]) for t in range(len(rows))])
                    h = np.array([X[t].get(i, 0.0) * (sum(V[j, f] * x for j, x in X[t].items()) - V[i, f] * X[t].get(i, 0.0))
                                  for t in range(len(rows))])
                    V[i, f] = ((e + V[i, f] * h) * h).sum() / ((h * h).sum() + r2)
    return w0, w, V


def test_field_blocked_als_equals_sequential(spark):
    from fmspark.functions.random import normal
    rows, field_of = random_rows(n=40)
    df = spark.createDataFrame(rows, PAIRS)
    fmap = spark.createDataFrame(list(field_of.items()), "idx int, field int")
    k, seed, std = 2, 5, 0.3
    init = spark.range(9).select(F.col("id").cast("int").alias("idx"), F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)), lambda f: F.lit(std) * normal(F.col("id").cast("int"), f, seed)).alias("v"))
    V0 = np.array([r["v"] for r in sorted(init.collect(), key=lambda r: r["idx"])])
    reg = (0.0, 0.5, 0.5)
    b, lin, lat, hist = fit_als(df, fmap, k, sweeps=1, init_std=std, reg=reg, seed=seed)
    w0, w, V = np_als(rows, field_of, k, 1, V0, reg)
    assert b == pytest.approx(w0, abs=1e-9)
    for r in lin.collect():
        assert r["w"] == pytest.approx(w[r["idx"]], abs=1e-9)
    for r in lat.collect():
        assert r["v"] == pytest.approx(list(V[r["idx"]]), abs=1e-9)


def test_ffm_learns_planted_interaction(spark):
    from fmspark.plans.queries import QUERIES
    r = QUERIES["ffm_fit"](spark, "/root/testdata/sf0.01").first()
    assert r["auc"] > 0.95


def test_als_query_learns_planted_interaction(spark):
    from fmspark.plans.queries import QUERIES
    r = QUERIES["fm_fit_als"](spark, "/root/testdata/sf0.01").first()
    assert r["auc"] > 0.95


def test_sparse_and_dense_vectors_agree(spark):
    rows, _ = random_rows(n=20)
    df = spark.createDataFrame(rows, PAIRS)
    dense = {r["row_id"]: r["features"].toArray().tolist() for r in M.to_vectors(df, 9, keep=("row_id",)).collect()}
    old = M.DENSE_MAX_WIDTH
    M.DENSE_MAX_WIDTH = 4
    try:
        sp = M.to_vectors(df, 9, keep=("row_id",)).collect()
    finally:
        M.DENSE_MAX_WIDTH = old
    assert all(type(r["features"]).__name__ == "SparseVector" for r in sp)
    assert {r["row_id"]: r["features"].toArray().tolist() for r in sp} == dense


def test_model_save_and_latent_load(spark, scratch):
    import os
    from fmspark.sources.latent import load_latent
    rows, _ = random_rows(n=40)
    df = spark.createDataFrame(rows, PAIRS)
    vec = M.to_vectors(df, 9)
    model = M.fm_fit(vec, dim_k=3, iter_num=3, seed=1)
    M.save_model(model, os.path.join(scratch, "model"))
    from pyspark.ml.classification import FMClassificationModel
    assert FMClassificationModel.load(os.path.join(scratch, "model")).factors.numCols == 3
    calls = []

    def fit():
        calls.append(1)
        return M.model_tables(spark, model)[2]
    lat, k = load_latent(spark, os.path.join(scratch, "latent"), fit)
    lat2, k2 = load_latent(spark, os.path.join(scratch, "latent"), fit)
    assert k == k2 == 3 and lat.count() == lat2.count() == 9 and calls == [1]


def test_fm_beats_linear_model_on_interaction(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array
    from fmspark.plans.queries import _planted
    tr, te, fmap, n = _planted(spark, "/root/testdata/sf0.01")
    from fmspark.operators.rows import reindex
    vtr = M.to_vectors(reindex(tr, fmap, map_rows=n), n)
    vte = M.to_vectors(reindex(te, fmap, map_rows=n), n)
    lr = LogisticRegression(maxIter=50).fit(vtr)
    pr = lr.transform(vte).select(F.col("label").cast("int").alias("y"), vector_to_array("probability")[1].alias("s"))
    lr_auc = M.auc(pr).first()[0]
    fm = M.fm_fit(vtr, dim_k=4, iter_num=100, learn_rate=0.1, init_stdev=0.1, seed=7)
    pf = fm.transform(vte).select(F.col("label").cast("int").alias("y"), vector_to_array("probability")[1].alias("s"))
    fm_auc = M.auc(pf).first()[0]
    assert fm_auc > 0.95 and fm_auc - lr_auc > 0.2, (fm_auc, lr_auc)


def test_ffm_gradient_matches_numpy(spark):
    rnd = np.random.default_rng(4)
    field_of = {0: 0, 1: 0, 2: 1, 3: 1, 4: 2}
    W = rnd.normal(size=(5, 3, 2))
    rows = []
    for r in range(12):
        feats = sorted(rnd.choice(5, size=rnd.integers(1, 5), replace=False).tolist())
        rows.append((r, 1.0 if r % 3 else -1.0, [(int(i), float(rnd.normal())) for i in feats]))
    lam = 0.01
    G = np.zeros_like(W)
    for _, y, feats in rows:
        phi = 0.0
        for p in range(len(feats)):
            for q in range(p + 1, len(feats)):
                (i, xi), (j, xj) = feats[p], feats[q]
                phi += W[i, field_of[j]] @ W[j, field_of[i]] * xi * xj
        kappa = -y / (1 + np.exp(y * phi))
        for p, (i, xi) in enumerate(feats):
            for b in range(3):
                d = np.zeros(2)
                for q, (j, xj) in enumerate(feats):
                    if q != p and field_of[j] == b:
                        d += W[j, field_of[i]] * xi * xj
                G[i, b] += kappa * d + lam * W[i, b]
    pairs = spark.createDataFrame([(r, y, i, x, field_of[i]) for r, y, f in rows for i, x in f],
                                  "row_id long, y double, idx int, x double, a int")
    model = spark.createDataFrame([(i, b, [float(v) for v in W[i, b]]) for i in range(5) for b in range(3)],
                                  "idx int, fb int, v array<double>")
    got = {(r["gi"], r["tb"]): [r["_g0"], r["_g1"]] for r in FF.ffm_gradients(pairs, model, 2, lam=lam).collect()}
    for i in range(5):
        for b in range(3):
            if (i, b) in got:
                assert got[(i, b)] == pytest.approx(list(G[i, b]), abs=1e-9)
            else:
                assert np.allclose(G[i, b], 0)


def test_sgda_picks_regularisation_on_validation(spark):
    rows, _ = random_rows(n=120)
    df = spark.createDataFrame(rows, PAIRS)
    from fmspark.operators.split import split
    tr, va = split(df, "row_id", 0.7)
    m, reg, table = M.fit_sgda(M.to_vectors(tr, 9), M.to_vectors(va, 9), regs=(0.0, 0.5), dim_k=2, iter_num=5, seed=1)
    assert reg in (0.0, 0.5) and len(table) == 2
    assert dict(table)[reg] == max(a for _, a in table)


@pytest.mark.parametrize("method", ["adamW", "sgd", "sgda", "als"])
def test_scaled_training_folds_back_exactly(spark, method):
    from fmspark.operators import fm_train as FT
    from fmspark.operators import rows as R
    from fmspark.operators.split import feature_map, split
    from fmspark.plans.pipeline import train
    rnd = random.Random(9)
    rows = [(r, rnd.randint(0, 1), [(1, rnd.uniform(-5e3, 5e3)), (2, rnd.uniform(0, 3)), (3 + rnd.randint(0, 2), 1.0)])
            for r in range(60)]
    df = spark.createDataFrame(rows, PAIRS)
    fmap, n = feature_map(df)
    how = {"sgda": {"valid": split(df, "row_id", 0.5)[1]},
           "als": {"field_map": spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, 2), (5, 2)], "idx int, field int")}}.get(method, {})
    bias, lin, lat, model = train(df, fmap, n, method=method, dim_k=2, iter_num=2, seed=3, scale=True, reg=0.01, **how)
    assert len(model.history) == 2
    ours = {r["row_id"]: r["y"] for r in M.fm_score(df, bias, M.model_table(lin, lat), 2).collect()}
    smap = fmap.join(M.max_abs_scale(df), "idx").select("idx", "pos", "s")
    theirs = {r["row_id"]: r["y"] for r in FT.predictions(R.reindex(df, smap, map_rows=n), model, n).collect()}
    assert ours.keys() == theirs.keys()
    for k, v in theirs.items():
        assert ours[k] == pytest.approx(v, rel=1e-9, abs=1e-9)
    with pytest.raises(ValueError):
        train(df, fmap, n, method="mcmc")


def test_als_layouts_agree(spark):
    from fmspark.operators.als import fit_als_joined
    rows, field_of = random_rows(n=40)
    df = spark.createDataFrame(rows, PAIRS)
    fmap = spark.createDataFrame(list(field_of.items()), "idx int, field int")
    how = dict(sweeps=1, init_std=0.3, reg=(0.1, 0.5, 0.5), seed=5)
    b, lin, lat, hist = fit_als(df, fmap, 1, **how)
    b2, lin2, lat2, hist2 = fit_als_joined(df, fmap, 1, **how)
    assert b == pytest.approx(b2) and hist == pytest.approx(hist2)
    assert {r.idx: round(r.w, 9) for r in lin.collect()} == {r.idx: round(r.w, 9) for r in lin2.collect()}
    assert {r.idx: round(r.v[0], 9) for r in lat.collect()} == {r.idx: round(r.v[0], 9) for r in lat2.collect()}


def test_feature_without_a_field(spark):
    from fmspark.operators.rows import to_ffm
    df = spark.createDataFrame([(r, r % 2, [(0, 1.0), (1, 2.0), (2 + r % 2, 0.5)]) for r in range(8)] + [(8, 1, [])], PAIRS)
    model = spark.createDataFrame([(i, f, [0.1 * (i + 1), 0.2 * (f + 1)]) for i in range(4) for f in (0, 1, 9)],
                                  "idx int, field int, v array<double>")
    part = spark.createDataFrame([(0, 0), (1, 1), (2, None)], "idx int, field int")  # 2 and 3 have none
    full = spark.createDataFrame([(0, 0), (1, 1), (2, 9), (3, 9)], "idx int, field int")
    calls = [lambda m, **o: FF.ffm_score(df, model, m, 2, **o),
             lambda m, **o: FF.fit_ffm(df, m, 2, epochs=1, n_batches=2, valid=df, **o)[0],
             lambda m, **o: to_ffm(df, m, **o)]
    for call in calls:
        got, want = (sorted(map(str, call(*a, **o).collect())) for a, o in (((part,), {"other_field": 9}), ((full,), {})))
        assert got == want
        with pytest.raises(Exception, match="without a field"):
            call(part).collect()
    with pytest.raises(Exception, match="without a field"):
        fit_als(df, part, 2, sweeps=1)
    fit_als(df, full, 2, sweeps=1)
