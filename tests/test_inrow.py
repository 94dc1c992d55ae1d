"""Whole rows in Arrow batches: plans without exploded pairs, results as by joins."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fmspark.operators import als as A
from fmspark.operators import fm_train as T
from fmspark.operators import rows as R

ROWS = "row_id long, label int, features array<struct<idx:int,val:double>>"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sparse(spark, n=50, width=9):
    rng = np.random.default_rng(3)
    return spark.createDataFrame([(r, int(rng.integers(0, 2)), [(int(i), float(rng.normal())) for i in sorted(rng.choice(width, 4, replace=False))]) for r in range(n)], ROWS)


def params(spark, width, k):
    rng = np.random.default_rng(4)
    return spark.createDataFrame([(-1, 0.2, [0.0] * k)] + [(i, float(rng.normal()), rng.normal(size=k).tolist()) for i in range(width)], "idx int, w double, v array<double>")


def test_gradients_carry_no_parameters_and_explode_no_pairs(spark):
    """One row of arrays joined to every row copied 160 KB a row at 2000 indices."""
    p = plan(T.fm_gradients(sparse(spark), params(spark, 9, 2), 2))
    assert "Generate" not in p and "_one" not in p and p.count("MapInArrow") == 1


def test_gradients_of_odd_rows(spark):
    """Null features, indices and values count for nothing but the bias."""
    df = spark.createDataFrame([(1, 1, None), (2, 0, [(None, 1.0), (2, None), (99, 1.0)]), (3, 1, [])], ROWS)
    got = {r.idx: r for r in T.fm_gradients(df, params(spark, 9, 2), 2).collect()}
    p = 1 / (1 + np.exp(-0.2))
    assert got[-1].n == 3 and got[-1].gw == pytest.approx(3 * p - 2) and got[2].gw == 0.0
    assert got[None].gw == got[99].gw == pytest.approx(p)


def test_reindex_without_a_shuffle(spark):
    df = spark.createDataFrame([(1, 0, [(5, 2.0), (7, 3.0)]), (2, 1, None), (3, 1, [(7, None)])], ROWS)
    fmap = spark.createDataFrame([(5, 0, 2.0), (7, 1, 1.0)], "idx int, pos int, s double")
    out = R.reindex(df, fmap)
    assert "Generate" not in plan(out) and "Exchange" not in plan(out)
    assert {r.row_id: [tuple(f) for f in r.features] for r in out.collect()} == {1: [(0, 1.0), (1, 3.0)], 2: [], 3: [(1, None)]}
    few = fmap.where("idx = 7")
    assert {r.row_id: [tuple(f) for f in r.features] for r in R.reindex(df, few, on_unknown="drop").collect()} == {1: [(1, 3.0)], 2: [], 3: [(1, None)]}
    with pytest.raises(Exception, match="not in the index map: 5"):
        R.reindex(df, few).collect()


def test_reindex_merges_rows_of_one_key(spark):
    """A key, null as well, that several rows have is one row, pairs in order of place."""
    df = spark.createDataFrame([(1, 0, [(5, 2.0), (7, 3.0)]), (1, 0, [(7, 4.0)]), (None, 1, [(5, 1.0)]), (None, 1, [(7, 1.0)]), (2, 1, [(5, 6.0)])], ROWS)
    fmap = spark.createDataFrame([(5, 0), (7, 1)], "idx int, pos int")
    got = {r.row_id: (r.label, [tuple(f) for f in r.features]) for r in R.reindex(df, fmap).collect()}
    assert got == {1: (0, [(0, 2.0), (1, 4.0), (1, 3.0)]), None: (1, [(0, 1.0), (1, 1.0)]), 2: (1, [(0, 6.0)])}


def one_hot(spark):
    rng = np.random.default_rng(5)
    rows = [(r, int(rng.integers(0, 2)), [(0, float(rng.normal())), (int(1 + rng.integers(0, 3)), 1.0), (int(4 + rng.integers(0, 2)), float(rng.normal()))]) for r in range(60)]
    rows += [(90, None, [(1, 2.0), (4, 0.5)]), (91, None, [(2, 1.0)])]  # no label
    return spark.createDataFrame(rows, ROWS), spark.createDataFrame([(0, 0), (1, 1), (2, 1), (3, 1), (4, 2), (5, 2)], "idx int, field int")


def test_a_field_in_one_pass_equals_its_updates_one_by_one(spark):
    df, fmap = one_hot(spark)
    data, now = A.with_fields(df, fmap), params(spark, 6, 3)
    block = {r.idx: [r.w, *r.v] for r in A.field_updates(data, now, 3, 6, 1, 0.1, 0.5).collect()}
    state = {r.idx: [r.w, *r.v] for r in now.collect()}
    for f in (None, 0, 1, 2):
        p = spark.createDataFrame([(i, x[0], x[1:]) for i, x in state.items()], "idx int, w double, v array<double>")
        for r in A.als_sums(data, p, 3, 6, 1, f).collect():
            state[r.idx][0 if f is None else f + 1] = r.num / (r.den + (0.1 if f is None else 0.5))
    assert set(block) == {1, 2, 3}
    for i, x in block.items():
        assert x == pytest.approx(state[i], rel=1e-9)


def test_fit_als_takes_one_pass_a_field(spark, monkeypatch):
    """A pass a weight and factor made k + 1 times as many jobs."""
    df, fmap = one_hot(spark)
    df = df.where("label is not null")
    how = dict(sweeps=1, init_std=0.3, reg=(0.1, 0.5, 0.5), seed=5)
    want = A.fit_als_joined(df, fmap, 2, **how)
    monkeypatch.setattr(A, "als_sums", lambda *a, **b: pytest.fail("a pass for one update"))
    got = A.fit_als(df, fmap, 2, **how)
    assert got[0] == pytest.approx(want[0]) and got[3] == pytest.approx(want[3])
    for a, b, c in ((got[1], want[1], "w"), (got[2], want[2], "v")):
        assert {r.idx: r[c] for r in a.collect()} == {r.idx: pytest.approx(r[c]) for r in b.collect()}


def test_rows_with_fields_without_a_shuffle(spark):
    df, fmap = one_hot(spark)
    assert "Exchange" not in plan(A.with_fields(df, fmap))
    two = spark.createDataFrame([(1, 1, [(0, 2.0), (4, 1.0)]), (1, 1, [(0, 0.0), (1, 3.0)]), (2, 0, None)], ROWS)
    got = {r.row_id: (r.y, [tuple(f) for f in r.features]) for r in A.with_fields(two, fmap).collect()}
    assert got == {1: (1.0, [(0, 2.0, 0), (1, 3.0, 1), (4, 1.0, 2)]), 2: (-1.0, [])}


def test_ffm_score_without_pairs(spark):
    """Rows score themselves; rows of one key are one row, as by joins."""
    from fmspark.operators import ffm as FF
    rng = np.random.default_rng(6)
    df = sparse(spark).unionByName(spark.createDataFrame([(1, 1, [(0, 0.5), (8, 2.0)]), (70, 0, None), (None, 1, [(3, 1.0)])], ROWS))
    model = spark.createDataFrame([(i, f, rng.normal(size=3).tolist()) for i in range(8) for f in (0, 1, 2) if (i, f) != (4, 1)], "idx int, field int, v array<double>")
    fmap = spark.createDataFrame([(i, i % 3) for i in range(8)], "idx int, field int")
    got = FF.ffm_score(df.where("row_id > 1"), model, fmap, 3)
    assert "Generate" not in plan(got) and "Exchange" not in plan(got)
    a, b = ({r.row_id: r.y for r in FF.ffm_score(df, model, fmap, 3, normalize=True, clustered=c).collect()} for c in (False, True))
    assert a.keys() == b.keys() and len(a) == 52
    for i, y in a.items():
        assert y == pytest.approx(b[i], abs=1e-12)


def test_ffm_gradient_of_rows_equals_that_of_pairs(spark):
    from fmspark.operators import ffm as FF
    rng = np.random.default_rng(7)
    rows = sparse(spark).select("row_id", F.when(F.col("label") > 0, 1.0).otherwise(-1.0).alias("y"), F.col("features").alias("_f"))
    model = spark.createDataFrame([(i, f, rng.normal(size=2).tolist()) for i in range(9) for f in (0, 1, 2)], "idx int, fb int, v array<double>")
    own = F.col("_midx") % 3
    m = FF.field_model(model.select(F.col("idx").alias("_midx"), F.col("fb").alias("_b"), F.col("v").alias("_v")).withColumn("_a", own.cast("int")), 2)
    each = FF.row_gradients(rows, m, 2, lam=0.1)
    assert "Generate" not in plan(each)
    pairs = rows.select("row_id", "y", F.inline("_f")).select("row_id", "y", "idx", F.col("val").alias("x"), (F.col("idx") % 3).alias("a"))
    got, want = ({(r.gi, r.tb): (r._g0, r._g1) for r in g.collect()} for g in (each, FF.ffm_gradients(pairs, model, 2, lam=0.1)))
    assert got.keys() == want.keys()
    for c, g in want.items():
        assert got[c] == pytest.approx(g, abs=1e-9)


def test_a_step_reads_its_rows_once(spark, monkeypatch):
    """The step used the gradients twice, and each use made them anew."""
    names, real = [], T.materialize
    monkeypatch.setattr(T, "materialize", lambda df, name, *a, **b: names.append((name, plan(df).count("MapInArrow"))) or real(df, name, *a, **b))
    T.fit(sparse(spark), 9, method="adamW", dim_k=2, iter_num=2, seed=1)
    assert [n for n in names if n[0] == "fm-grads"] == [("fm-grads", 1)] * 2
    assert all(n == 0 for name, n in names if name == "fm-state")
