"""Property tests: text round trip, split, zero drop."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fmspark.functions import sparse as S
from fmspark.operators import split as D
from fmspark.sinks import writers as W
from fmspark.sources import libsvm as L

PAIRS = "row_id long, label double, features array<struct<idx:int,val:double>>"

values = st.one_of(st.integers(-1000, 1000).map(float),
                   st.floats(allow_nan=False, allow_infinity=False, min_value=-1e12, max_value=1e12),
                   st.sampled_from([0.0, 1.0, 0.5, 1e-7, -2.5e-9, 123456.789]))
row = st.tuples(st.sampled_from([0.0, 1.0]),
                st.lists(st.tuples(st.integers(0, 5000), values), max_size=12, unique_by=lambda p: p[0]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=20))
def test_text_round_trip_is_identity(spark, tmp_path_factory, rows):
    data = [(i, lab, [(int(a), float(b)) for a, b in feats]) for i, (lab, feats) in enumerate(rows)]
    df = spark.createDataFrame(data, PAIRS)
    path = os.path.join(str(tmp_path_factory.mktemp("rt")), "t")
    W.write_text(W.fm_lines(df), path)
    back = L.read_libsvm(spark, path)
    want = sorted((lab, tuple(f)) for _, lab, f in data)
    got = sorted((r["label"], tuple((p["idx"], p["val"]) for p in r["features"])) for r in back.collect())
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(min_size=1, max_size=12), min_size=1, max_size=60, unique=True),
       st.floats(min_value=0.0, max_value=1.0), st.integers(0, 5))
def test_split_is_disjoint_and_total(spark, keys, ratio, seed):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    tr, te = D.split(df, "k", ratio, seed=seed)
    a, b = {r[0] for r in tr.collect()}, {r[0] for r in te.collect()}
    assert not (a & b) and (a | b) == set(keys)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=10))
def test_drop_zero_idempotent_and_keeps_nonzero(spark, rows):
    data = [(i, lab, [(int(a), float(b)) for a, b in feats]) for i, (lab, feats) in enumerate(rows)]
    df = spark.createDataFrame(data, PAIRS)
    once = df.select("row_id", S.drop_zero("features").alias("f"))
    twice = once.select("row_id", S.drop_zero("f").alias("f"))
    got = {r["row_id"]: [(p["idx"], p["val"]) for p in r["f"]] for r in once.collect()}
    assert got == {r["row_id"]: [(p["idx"], p["val"]) for p in r["f"]] for r in twice.collect()}
    assert got == {i: [(a, b) for a, b in f if b != 0] for i, _, f in data}
