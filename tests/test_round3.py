"""Rows that are read once are not written; training rows without zeros; embedding in
one pass over compact rows; text of many pairs."""

import pytest
from pyspark.sql import functions as F

from fmspark.functions import inrow as B
from fmspark.operators import fm_train as T
from fmspark.operators import rows as R
from inputs import SF_SMALL

ROWS = "row_id long, label int, features array<struct<idx:int,val:double>>"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gradients_write_no_rows_and_scale_once(spark, monkeypatch):
    """The re-indexed rows were written, and the scale's pass over all rows ran twice."""
    from fmspark.operators import fm as M
    from fmspark.plans import queries as Q
    names, scales = [], []
    for m in (B, Q):
        real = m.materialize
        monkeypatch.setattr(m, "materialize", lambda df, name, *a, _real=real, **b: names.append(name) or _real(df, name, *a, **b))
    real_scale = M.max_abs_scale
    monkeypatch.setattr(M, "max_abs_scale", lambda *a, **b: scales.append(1) or real_scale(*a, **b))
    out = Q.fm_gradients(spark, SF_SMALL)
    assert sorted(names) == ["repeated-keys", "scale"] and len(scales) == 1
    assert out.where("idx = -1").count() == 1


def test_reindex_read_once_merges_rows_of_one_key(spark):
    df = spark.createDataFrame([(1, 0, [(5, 2.0), (7, 3.0)]), (1, 0, [(7, 4.0)]), (None, 1, [(5, 1.0)]), (None, 1, [(7, 1.0)]), (2, 1, [(5, 6.0)]), (3, 1, None)], ROWS)
    fmap = spark.createDataFrame([(5, 0), (7, 1)], "idx int, pos int")
    got, want = ({r.row_id: (r.label, [tuple(f) for f in r.features]) for r in R.reindex(df, fmap, once=o).collect()} for o in (True, False))
    assert got == want and len(got) == 4
    alone = R.reindex(df.where("row_id > 1"), fmap, once=True)
    assert "parquet" not in plan(alone).lower() and {r.row_id for r in alone.collect()} == {2, 3}


def test_training_rows_hold_no_zeros(spark, monkeypatch):
    """Zeros were read and multiplied at every step; the model is the same without them,
    and an index out of range raises whatever its value."""
    df = spark.createDataFrame([(r, r % 2, [(0, 0.5 * r), (1, 0.0), (2, float(r % 3)), (3, None)]) for r in range(20)], ROWS)
    seen, real = {}, T.materialize
    monkeypatch.setattr(T, "materialize", lambda d, name, *a, **b: seen.setdefault(name, real(d, name, *a, **b)) if name == "fm-rows" else real(d, name, *a, **b))
    model = T.fit(df, 4, method="adamW", dim_k=2, iter_num=3, seed=1)
    written = [p.val for r in seen["fm-rows"].collect() for p in r.features]
    assert written and all(v for v in written)
    again = T.fit(df.withColumn("features", F.filter("features", lambda p: F.coalesce(p["val"], F.lit(0.0)) != 0)), 4, method="adamW", dim_k=2, iter_num=3, seed=1)
    assert {r.idx: (r.w, r.v) for r in model.state.collect()} == {r.idx: (r.w, r.v) for r in again.state.collect()}
    with pytest.raises(Exception, match="feature index outside"):
        T.fit(spark.createDataFrame([(1, 0, [(9, 0.0)])], ROWS), 4, iter_num=1)


PAIRS = "row_id long, order_id string, label int, features array<struct<idx:int,val:double>>"


def embedded(df, lat, **how):
    from fmspark.operators.embed import embed
    return sorted(map(repr, embed(df, lat, 2, keep=("order_id", "label"), dense=True, **how).collect()))


def test_embedding_groups_no_exploded_pairs(spark):
    """Pairs, carried features and vectors of every row went through a sort, which spilled."""
    from fmspark.operators.embed import embed
    from fmspark.plans import fixtures as fx
    out = embed(fx.sparse_rows(spark, SF_SMALL), fx.latent(spark, SF_SMALL), fx.THRESHOLD, keep=("order_id",), dense=True, keep_onehot=True)
    p = plan(out)
    assert "Generate" not in p and "collect_list" not in p and p.count("hashpartitioning(row_id") == 1
    exchange = next(line for line in p.split("\n") if "hashpartitioning(row_id" in line)
    shuffled = p[p.index(exchange):].split("\n")[1]
    assert "struct" not in shuffled and "named_struct" not in shuffled


def test_embedding_of_odd_rows_equals_the_joined_one(spark):
    """Null features, indices, values, keys and keys of several rows: as by joins."""
    lat = spark.createDataFrame([(3, [0.5, 2.0]), (4, [-1.0, 0.0]), (6, [9.0]), (7, [])], "idx int, v array<double>")
    one = spark.createDataFrame([(1, "a", 1, [(1, 2.0), (3, 1.0), (4, 0.0), (6, 1.0)]), (2, "b", None, None), (3, None, 0, []),
                                 (4, "d", 0, [(1, None), (None, 1.0), (4, None), (7, 1.0)])], PAIRS)
    several = spark.createDataFrame([(5, None, 1, [(2, 0.5), (4, 1.0), (3, 1.0)]), (5, "e", 1, [(2, 0.5), (3, 1.0), (4, 1.0), (6, 1.0)]),
                                     (None, "n", 1, [(1, 1.0), (3, 1.0)]), (None, "n", 1, [(1, 1.0), (6, 1.0)])], PAIRS)
    for n in (1, 5):
        df = one.unionByName(several).repartition(n)
        assert embedded(df, lat, in_row=True) == embedded(df, lat, max_broadcast_bytes=1)
        assert embedded(one.repartition(n), lat, keep_onehot=True) == embedded(one, lat, keep_onehot=True, max_broadcast_bytes=1)


def test_rows_of_a_key_come_together_over_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.createDataFrame([(k, str(k), 0, [(1, 0.5), (3, 1.0)]) for k in (1, 2, 2, 2, 2, 2, 2, 2, 3, 3, 4)], PAIRS)
        lat = spark.createDataFrame([(3, [7.0])], "idx int, v array<double>")
        from fmspark.operators.embed import embed
        got = {r.row_id: r.out for r in embed(df, lat, 2, dense=True, in_row=True).collect()}
        assert got == {1: [0.5, 7.0], 2: [0.5] + [7.0] * 7, 3: [0.5, 7.0, 7.0], 4: [0.5, 7.0]}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_prediction_lines_leave_the_features_compiled(spark):
    """The one-hot array was built inside the lambda function's argument, interpreted."""
    from fmspark.plans import fixtures as fx
    from fmspark.sinks import writers as W
    p = plan(W.prd_lines(fx.sparse_rows(spark, SF_SMALL)))
    line = next(x for x in p.split("\n") if "concat_ws" in x)
    assert "CASE WHEN (f_seg" not in line and p.count("CASE WHEN (f_seg") == 5
    df = spark.createDataFrame([(1, "a", 0, [(1, 0.0), (2, 1.0), (3, -0.0), (4, 2.0), (5, 0.25), (6, float("nan")), (7, None)]), (2, "b", 0, None)], PAIRS)
    assert [r.value for r in W.prd_lines(df).collect()] == ["a 1:0 2:1 3:0 4:2 5:0.25 6:NaN", "b"]
