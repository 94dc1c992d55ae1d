"""Feature transforms."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from inputs import SF_SMALL
from fmspark.operators import transforms as T
from fmspark.plans import fixtures as fx


def test_parse_sample_spec():
    spec = {"age": "discretize(20)", "sex": "onehot", "wait_pay": "bucket(min,10,100,max);onehot()",
            "flag": "Untransform", "x": "untransform", "p": "standardnormalize", "gone": None}
    ch = {c[0].field: c for c in T.parse_transform(spec)}
    assert ch["age"] == [T.Op("discretizer", "age", 20)]
    assert ch["sex"] == [T.Op("onehot", "sex")]
    assert ch["wait_pay"] == [T.Op("bucketizer", "wait_pay", [float("-inf"), 10.0, 100.0, float("inf")]),
                              T.Op("onehot", "wait_pay")]
    assert ch["flag"][0].kind == ch["x"][0].kind == "untransform"
    assert ch["gone"][0].kind == "delete"
    assert T.count_kinds(T.parse_transform(spec))["onehot"] == 2


def test_parse_unknown_raises():
    with pytest.raises(ValueError, match="unknown transform"):
        T.parse_transform({"a": "log1p"})


def test_apply_columns_length_mismatch(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    with pytest.raises(ValueError):
        T.apply_columns(df, T.untransform, ["a", "b"], ["c"])
    out = T.apply_columns(df, T.untransform, ["a", "b"], ["c", "d"])
    assert out.first()["d"] == 2.0


def test_chisq_selector_on_sample_frame(spark):
    df = spark.createDataFrame([
        (7, Vectors.dense([0.0, 0.0, 18.0, 1.0]), 1.0),
        (8, Vectors.dense([0.0, 1.0, 12.0, 0.0]), 0.0),
        (9, Vectors.dense([1.0, 0.0, 15.0, 0.1]), 0.0)], ["id", "features", "clicked"])
    _, sel = T.chisq_selector(df, 1, "features", "selected", "clicked")
    assert sel == [2]


def test_r_formula_on_sample_frame(spark):
    df = spark.createDataFrame([(7, "US", 18, 1.0), (8, "CA", 12, 0.0), (9, "NZ", 15, 0.0)],
                               ["id", "country", "hour", "clicked"])
    out = T.r_formula(df, "clicked ~ country + hour")
    assert out.where("id = 7").first()["features"].toArray().tolist() == [0.0, 0.0, 18.0]


def test_pipeline_whole_spec(spark):
    fr = fx.feature_rows(spark, SF_SMALL).withColumn("order_dummy", F.lit(1))
    from fmspark.plans.queries import FIXTURE_SPEC
    out, model = T.transform_pipeline(fr, FIXTURE_SPEC)
    assert "order_dummy" not in out.columns
    assert out.count() == fr.count()
    # the five kinds ran as multi-column stages, not one fit per column
    kinds = [type(s).__name__ for s in model.stages]
    assert kinds.count("QuantileDiscretizerModel") + kinds.count("Bucketizer") <= 3
    r = out.select(F.avg("f_price").alias("m")).first()
    assert abs(r["m"]) < 1e-9
    # bucket -> onehot chain: 3 buckets (min,10,100,max), no category dropped
    from pyspark.ml.functions import vector_to_array
    assert set(x[0] for x in out.select(F.size(vector_to_array("f_qty"))).distinct().collect()) <= {2, 3}


def test_onehot_keeps_last_category_and_encoder_is_fitted(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "s string")
    out = T.onehot(df, "s", "v")
    sizes = {r["v"].size for r in out.collect()}
    assert sizes == {2}


def test_bucketizer_edges(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (100.0,), (None,)], "x double")
    out = [r["b"] for r in T.bucketizer(df, "x", "b", [0.0, 10.0, 100.0]).collect()]
    assert out == [0.0, 1.0, 1.0, None]


def test_discretizer_collapses_duplicate_cuts(spark):
    df = spark.createDataFrame([(0.0,)] * 90 + [(float(i),) for i in range(1, 11)], "x double")
    out = T.discretizer(df, "x", "b", 20, relative_error=0.0)
    assert out.select("b").distinct().count() < 20


def test_fitted_spec_reused_on_another_set(spark):
    from fmspark.operators.split import split
    from fmspark.plans.queries import FIXTURE_SPEC
    fr = fx.feature_rows(spark, SF_SMALL).withColumn("order_dummy", F.lit(1))
    tr, te = split(fr, "order_id", 0.8)
    spec = dict(FIXTURE_SPEC)
    fitted = T.fit_spec(tr, spec, handle_invalid="keep")
    a = fitted.transform(te)
    b, _ = T.transform_pipeline(tr, spec, handle_invalid="keep")
    assert a.columns == b.columns and a.count() == te.count()
    # the whole training set through the fitted spec equals the direct result
    c = fitted.transform(tr)
    assert sorted(map(tuple, c.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("parts", [1, 5])
def test_exact_quantiles_by_ranks(spark, parts):
    import math

    from fmspark.functions.ordered import exact_quantiles
    rows = [(float(i * 7 % 50), None if i % 4 else float(i), 3.0, float("nan")) for i in range(203)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = exact_quantiles(df, ["a", "b", "c", "d"], [10, 4, 3, 5], parts)
    for k, (col, n) in enumerate(zip(zip(*rows), (10, 4, 3, 5))):
        vals = sorted(v for v in col if v is not None and not math.isnan(v))
        assert got[k] == ([vals[-(-i * len(vals) // n) - 1] for i in range(1, n)] if vals else [])
    assert exact_quantiles(df.limit(0), ["a"], [4], parts) == [[]]


def test_fit_spec_is_what_the_pipeline_applies(spark):
    df = spark.createDataFrame([(float(i), str(i % 3), float(i % 5), 1.0) for i in range(60)], "x double, s string, y double, z double")
    spec = {"x": "discretize(4)", "s": "onehot", "y": "bucket(min,2,max);onehot()", "z": "Untransform"}
    for err in (0.0, 0.001):
        out, _ = T.transform_pipeline(df, spec, relative_error=err)
        again = T.fit_spec(df, spec, relative_error=err).transform(df)
        assert sorted(map(str, out.collect())) == sorted(map(str, again.collect())) and out.columns == again.columns
