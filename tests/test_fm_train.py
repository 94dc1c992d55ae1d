"""The relational trainer against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fmspark.operators import fm as M
from fmspark.operators import fm_train as T

ROWS = "row_id long, label double, features array<struct<idx:int,val:double>>"


def data(n=60, width=7, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for r in range(n):
        idx = sorted(rng.choice(width, rng.integers(0, width), replace=False).tolist())
        rows.append((r, float(rng.integers(0, 2)), [(int(i), float(rng.normal())) for i in idx]))
    rows[3] = (3, -1.0, None)
    return rows


def dense(rows, width):
    x = np.zeros((len(rows), width))
    for r, (_, _, f) in enumerate(rows):
        for i, v in f or []:
            x[r, i] += v
    return x, np.array([1.0 if y > 0 else 0.0 for _, y, _ in rows])


def gradient(x, y, w0, w, v):
    q = x @ v
    yhat = w0 + x @ w + 0.5 * (q ** 2 - (x ** 2) @ (v ** 2)).sum(axis=1)
    g = 1 / (1 + np.exp(-yhat)) - y
    loss = np.logaddexp(0, yhat) - y * yhat
    gv = x.T @ (g[:, None] * q) - v * ((x ** 2).T @ g)[:, None]
    return g.sum(), x.T @ g, gv, loss.sum()


def params(spark, w0, w, v):
    return spark.createDataFrame([(-1, float(w0), [0.0] * v.shape[1])] + [(i, float(a), b.tolist()) for i, (a, b) in enumerate(zip(w, v))],
                                 "idx int, w double, v array<double>")


@pytest.mark.parametrize("budget", [None, "1"])
def test_gradients_equal_numpy_on_both_plans(spark, budget):
    width, k = 7, 3
    rng = np.random.default_rng(2)
    w0, w, v = 0.3, rng.normal(size=width), rng.normal(size=(width, k))
    rows = data(width=width)
    df = spark.createDataFrame(rows, ROWS)
    spark.conf.set("fmspark.broadcast.maxBytes", budget or str(1 << 28))
    try:
        got = {r.idx: r for r in T.fm_gradients(df, params(spark, w0, w, v), k).collect()}
    finally:
        spark.conf.unset("fmspark.broadcast.maxBytes")
    x, y = dense(rows, width)
    g0, gw, gv, loss = gradient(x, y, w0, w, v)
    assert got[-1].gw == pytest.approx(g0) and got[-1].loss == pytest.approx(loss) and got[-1].n == len(rows)
    for i in range(width):
        assert got[i].gw == pytest.approx(gw[i]) and got[i].gv == pytest.approx(gv[i].tolist())


def start(spark, width, k, seed, std=0.1):
    s = T.initial_state(spark, width, k, std, (0, 0, 0), None, seed)
    return np.array([r.v for r in s.where("idx >= 0").orderBy("idx").collect()])


def fold(spark, rows, seed, batches):
    got = spark.createDataFrame(rows, ROWS).select("row_id", F.pmod(F.xxhash64(F.col("row_id").cast("string"), F.lit(seed)), F.lit(batches)).alias("b")).collect()
    return {r.row_id: r.b for r in got}


@pytest.mark.parametrize("method", ["sgd", "adamW", "sgda"])
def test_training_equals_numpy(spark, method):
    width, k, seed, rate, reg, steps = 7, 2, 5, 0.3, (0.01, 0.02, 0.05), 5
    rows, valid = data(width=width), [(r + 1000, y, f) for r, y, f in data(40, width, 9)]
    df, vf = spark.createDataFrame(rows, ROWS), spark.createDataFrame(valid, ROWS)
    how = dict(mini_batch_fraction=0.5) if method != "adamW" else {}
    model = T.fit(df, width, method=method, dim_k=k, iter_num=steps, learn_rate=rate, reg=reg, seed=seed, init_stdev=0.1,
                  valid=vf if method == "sgda" else None, reg_rate=0.5, **how)
    n_batches = 1 if method == "adamW" else 2
    x, y = dense(rows, width)
    xv, yv = dense(valid, width)
    b, bv = fold(spark, rows, seed, n_batches), fold(spark, valid, seed, n_batches)
    b, bv = np.array([b[r[0]] for r in rows]), np.array([bv[r[0]] for r in valid])
    w0, w, v = 0.0, np.zeros(width), start(spark, width, k, seed)
    r0, r1, r2 = reg
    m, s = [0.0, np.zeros(width), np.zeros((width, k))], [0.0, np.zeros(width), np.zeros((width, k))]
    history = []
    for it in range(1, steps + 1):
        pick = b == (it - 1) % n_batches
        g0, gw, gv, loss = gradient(x[pick], y[pick], w0, w, v)
        n = pick.sum()
        history.append(loss / n)
        old = w0, w, v
        if method == "adamW":
            new = []
            for j, (t, g, r) in enumerate(((w0, g0 / n, r0), (w, gw / n, r1), (v, gv / n, r2))):
                m[j] = 0.9 * m[j] + 0.1 * g
                s[j] = 0.999 * s[j] + 0.001 * g ** 2
                new.append(t * (1 - rate * r) - rate * (m[j] / (1 - 0.9 ** it)) / (np.sqrt(s[j] / (1 - 0.999 ** it)) + 1e-8))
            w0, w, v = new
        else:
            w0, w, v = w0 - rate * (g0 / n + r0 * w0), w - rate * (gw / n + r1 * w), v - rate * (gv / n + r2 * v)
        if method == "sgda":
            pick = bv == (it - 1) % n_batches
            g0, gw, gv, _ = gradient(xv[pick], yv[pick], w0, w, v)
            n = pick.sum()
            r0 = max(0.0, r0 - 0.5 * -rate * g0 / n * old[0])
            r1 = max(0.0, r1 - 0.5 * -rate * (gw / n * old[1]).sum())
            r2 = max(0.0, r2 - 0.5 * -rate * (gv / n * old[2]).sum())
    assert model.history == pytest.approx(history)
    assert model.bias == pytest.approx(w0)
    assert [r.w for r in model.linear.orderBy("idx").collect()] == pytest.approx(w.tolist())
    assert np.array([r.v for r in model.latent.orderBy("idx").collect()]) == pytest.approx(v)
    if method == "sgda":
        assert {g: (a, c) for it, g, a, c in model.strengths if it == steps}[0] == pytest.approx((r1, r2))


def test_strengths_of_groups_and_switched_off_parts(spark):
    rows = data()
    df = spark.createDataFrame(rows, ROWS)
    groups = spark.createDataFrame([(0, 1, 2.0, 2.0), (1, 1, 2.0, 2.0), (2, 2, None, None)], "idx int, grp int, r1 double, r2 double")
    m = T.fit(df, 7, method="adamW", dim_k=2, iter_num=2, reg=(0.0, 0.1, 0.2), groups=groups, fit_bias=False, fit_linear=False)
    got = {r.idx: (r.grp, r.r1, r.r2) for r in m.state.collect()}
    assert got[0] == got[1] == (1, 2.0, 2.0) and got[2] == (2, 0.1, 0.2) and got[5] == (0, 0.1, 0.2)
    assert m.bias == 0.0 and all(r.w == 0.0 for r in m.linear.collect())
    with pytest.raises(ValueError):
        T.fit(df, 7, method="sgda")
    with pytest.raises(Exception, match="outside"):
        T.fit(df, 3, method="sgd", iter_num=1)


def test_planted_interaction_and_predictions(spark):
    """A label that only the product of two one-hot features tells."""
    rng = np.random.default_rng(3)
    rows = []
    for r in range(600):
        a, b = int(rng.integers(0, 4)), int(rng.integers(0, 4))
        rows.append((r, float((a + b) % 2), [(a, 1.0), (4 + b, 1.0)]))
    df = spark.createDataFrame(rows, ROWS)
    train, test = df.where("row_id % 3 > 0"), df.where("row_id % 3 = 0")
    table, best = T.grid(train, test, 8, ks=(2,), iters=(5, 40), learn_rate=0.2, seed=2)
    got = {r.iters: r.auc for r in table.collect()}
    assert set(got) == {5, 40} and got[40] > 0.95
    p = T.predictions(test, best, 8, keep=("label",))
    again = M.fm_score(test, best.bias, M.model_table(best.linear, best.latent), 2)
    both = p.join(again.select("row_id", F.col("y").alias("y2")), "row_id").collect()
    assert len(both) == 200 and all(math.isclose(r.y, r.y2, abs_tol=1e-9) for r in both)


def test_empty_rows(spark):
    m = T.fit(spark.createDataFrame([], ROWS), 3, method="adamW", dim_k=2, iter_num=1)
    assert m.history == [0.0] and m.linear.count() == 3
