"""Rows that do not fit raise instead of losing values; one result whatever
other rows hold; wide carried columns stay out of the embedding's shuffle."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fmspark.operators import embed as E
from fmspark.operators import rows as R
from fmspark.sinks import writers as W
from fmspark.sources.latent import load_latent


def test_longer_vectors_raise(spark):
    lat = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "idx int, v array<double>")
    assert W.latent_columns(lat, 3).first().asDict() == {"idx": 1, "dim1": 1.0, "dim2": 2.0, "dim3": 3.0}
    with pytest.raises(PySparkException):
        W.latent_columns(lat, 2).collect()
    rows = lat.select(F.lit("o").alias("order_id"), F.lit(1).alias("target"), F.col("v").alias("out"))
    with pytest.raises(PySparkException):
        W.flatten_embedded(rows, 2).collect()
    with pytest.raises(PySparkException):
        W.flatten_embedded(rows, 4).collect()


def test_null_label_raises(spark):
    df = spark.createDataFrame([(None, 1.0)], "label double, a double")
    with pytest.raises(PySparkException):
        R.to_libsvm_line(df, "label", ["a"]).collect()
    out = spark.createDataFrame([(None, [1.0])], "order_id string, out array<double>")
    with pytest.raises(PySparkException):
        W.embedded_lines(out, dense=True).collect()


def test_nan_is_filled_whatever_other_rows_hold(spark):
    one = spark.createDataFrame([(float("nan"), 1, "x")], "a double, b int, c string")
    two = one.unionByName(spark.createDataFrame([(None, None, "y")], "a double, b int, c string"))
    assert [tuple(r) for r in R.numeric_frame(one).collect()] == [(0.0, 1)]
    assert sorted(tuple(r) for r in R.numeric_frame(two).collect()) == [(0.0, 0), (0.0, 1)]


def test_an_unreadable_latent_table_is_not_overwritten(spark, scratch):
    path = os.path.join(scratch, "latent")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.txt"), "w") as f:
        f.write("not parquet")
    fit = lambda: spark.createDataFrame([(1, [1.0])], "idx int, v array<double>")
    with pytest.raises(Exception):
        load_latent(spark, path, fit)
    assert os.listdir(path) == ["part-0.txt"]
    assert load_latent(spark, os.path.join(scratch, "new"), fit)[1] == 1


def test_wide_raw_part_is_no_grouping_key(spark):
    rows = spark.createDataFrame([(1, [(1, 0.5), (9, 1.0), (10, 1.0)])], "row_id long, features array<struct<idx:int,val:double>>")
    lat = spark.createDataFrame([(9, [1.0]), (10, [2.0])], "idx int, v array<double>")
    out = E.embed(rows, lat, 5)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    agg = [x for x in plan.split("\n") if "Aggregate [" in x and "collect_list" in x]
    assert agg and all("_raw" not in x.split("], [")[0] for x in agg)
    assert [(p.idx, p.val) for p in out.first().out] == [(1, 0.5), (6, 1.0), (7, 2.0)]
