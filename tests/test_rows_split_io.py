"""Rows (B), index map and split (D), readers and writers (A, G)."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from inputs import SF_SMALL
from fmspark.functions import sparse as S
from fmspark.functions.ordered import dense_positions, exclusive_prefix_sum, numbered
from fmspark.operators import rows as R
from fmspark.operators import split as D
from fmspark.plans import fixtures as fx
from fmspark.sinks import writers as W
from fmspark.sources import libsvm as L
from fmspark.sources import tables as T

PAIRS = "row_id long, label double, features array<struct<idx:int,val:double>>"


def test_parse_with_blanks_zero_based_and_zeros(spark, scratch):
    p = os.path.join(scratch, "a.txt")
    with open(p, "w") as f:
        f.write("1 0:0.5  3:0 7:1 \n0 0:1 2:-2.5\n\n")
    rows = sorted(L.read_libsvm(spark, p).collect(), key=lambda r: -r["label"])
    assert [r["label"] for r in rows] == [1.0, 0.0]
    assert [(q["idx"], q["val"]) for q in rows[0]["features"]] == [(0, 0.5), (3, 0.0), (7, 1.0)]
    assert [(q["idx"], q["val"]) for q in rows[1]["features"]] == [(0, 1.0), (2, -2.5)]


def test_prd_form_keeps_string_id(spark, scratch):
    p = os.path.join(scratch, "p.txt")
    with open(p, "w") as f:
        f.write("17040352933528 1:0 2:1 5:0\n")
    r = L.read_libsvm(spark, p, is_prd=True).first()
    assert r["order_id"] == "17040352933528" and len(r["features"]) == 3


def test_labels_only(spark, scratch):
    p = os.path.join(scratch, "l.txt")
    with open(p, "w") as f:
        f.write("1.0 1:2\n-1 3:4\n0.7 1:1\n")
    assert sorted(r["label"] for r in L.read_labels(spark, p).collect()) == [-1, 0, 1]


def test_gzip_and_plain_parts_mixed(spark, scratch):
    d = os.path.join(scratch, "mixed")
    os.makedirs(d)
    with open(os.path.join(d, "part-0"), "w") as f:
        f.write("1 1:1\n")
    with gzip.open(os.path.join(d, "part-1.gz"), "wt") as f:
        f.write("0 2:1\n")
    assert L.read_libsvm(spark, d).count() == 2


def test_write_read_round_trip(spark, scratch):
    rows = fx.sparse_rows(spark, SF_SMALL).select("row_id", F.col("label").cast("double").alias("label"),
                                                  "features")
    out = os.path.join(scratch, "fm")
    W.write_text(W.fm_lines(rows), out)
    back = L.read_libsvm(spark, out)
    a = sorted((r["label"], tuple((q["idx"], q["val"]) for q in r["features"])) for r in rows.collect())
    b = sorted((r["label"], tuple((q["idx"], q["val"]) for q in r["features"])) for r in back.collect())
    assert a == b


def test_relabel_variants(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.4,)], "l double")
    r = df.select(S.relabel_pm1("l").alias("a"), S.relabel_zero_only("l").alias("b"),
                  S.relabel_linear("l").alias("c")).collect()
    assert [x["a"] for x in r] == [1, -1, 0]  # int(2*0.4-1) = int(-0.2) = 0
    assert [x["b"] for x in r] == [1.0, -1.0, 0.4]
    assert [round(x["c"], 6) for x in r] == [1.0, -1.0, -0.2]


def test_drop_zero_numeric_not_textual(spark):
    rows = spark.createDataFrame([(0, 1.0, [(3, 0.5), (4, 0.0), (5, 10.0)])], PAIRS)
    once = rows.select(S.drop_zero("features").alias("f"))
    twice = once.select(S.drop_zero("f").alias("f"))
    assert [(q["idx"], q["val"]) for q in once.first()["f"]] == [(3, 0.5), (5, 10.0)]
    assert once.collect() == twice.collect()


def test_feature_map_golden(spark):
    rows = spark.createDataFrame([(0, 1.0, [(66, 1.0), (75, 0.0)]), (1, 0.0, [(67, 1.0), (66, 1.0)])], PAIRS)
    fmap, n = D.feature_map(rows)
    assert n == 3
    assert {r["idx"]: r["pos"] for r in fmap.collect()} == {66: 0, 67: 1, 75: 2}


def test_row_ids_do_not_change_with_the_files(spark, scratch):
    lines = [f"{i % 2} {i % 7}:1 {8 + i % 3}:0.5" for i in range(400)] + [f"1 {i}:2" for i in range(50)]
    many, one = os.path.join(scratch, "many"), os.path.join(scratch, "one")
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(6).write.text(many)
    spark.createDataFrame([(x,) for x in reversed(lines)], "value string").coalesce(1).write.option("compression", "gzip").text(one)
    a, b = ([(r.row_id, r.label, str(r.features)) for r in L.read_libsvm(spark, p).collect()] for p in (many, one))
    assert sorted(a) == sorted(b) and len({r[0] for r in a}) == len(lines)
    x, y = ({r.row_id for r in D.split(L.read_libsvm(spark, p), "row_id", 0.8)[0].collect()} for p in (many, one))
    assert x == y and 0 < len(x) < len(lines)
    assert sorted(r.row_id for r in L.read_labels(spark, one).collect()) == sorted(r[0] for r in a)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_dense_positions_do_not_depend_on_ranges(spark, parts):
    vals = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("v")).unionByName(spark.createDataFrame([(None,), (3,)], "v long"))
    got, n = dense_positions(vals, "v", "pos", parts=parts)
    want = sorted({i * 7 % 5003 for i in range(5000)} | {3})
    assert n == len(want) and {r["v"]: r["pos"] for r in got.collect()} == {v: i for i, v in enumerate(want)}


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_prefix_sum_does_not_depend_on_ranges(spark, parts):
    df = spark.range(1, 2001).select(F.col("id").alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("v"))
    got = {r["k"]: r["s"] for r in exclusive_prefix_sum(df, "k", "v", "s", parts=parts).collect()}
    run, want = 0, {}
    for k in range(1, 2001):
        want[k] = run
        run += k % 3 if k % 5 else 0
    assert got == want


def test_prefix_sum_null_first_nan_last(spark):
    df = spark.createDataFrame([(None, 1.5), (float("nan"), 4.0), (float("inf"), 2.0), (-1.0, None)], "k double, v double")
    got = exclusive_prefix_sum(df, "k", "v", "s", parts=3).orderBy("s").collect()
    assert sorted(r["s"] for r in got) == [0.0, 1.5, 1.5, 3.5] and got[-1]["v"] == 4.0


def test_numbered_within_groups_that_span_ranges(spark):
    df = spark.range(0, 900).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.when(F.col("id") % 2 == 0, F.lit("b"))).alias("g"),
                                    ((F.col("id") * 389) % 907).alias("v"))
    got = numbered(df, [F.col("v")], by=["g"], parts=20).collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append((r["v"], r["pos"]))
    assert set(by) == {None, "b", "hot"} and len(got) == 900
    for rows in by.values():
        assert [p for _, p in sorted(rows)] == list(range(len(rows)))
    assert numbered(df.limit(0), [F.col("v")], by=["g"]).count() == 0


def test_reindex_unknown_raises(spark):
    rows = spark.createDataFrame([(0, 1.0, [(5, 1.0), (9, 1.0)])], PAIRS)
    fmap = spark.createDataFrame([(5, 0)], "idx int, pos int")
    with pytest.raises(Exception, match="not in the index map"):
        R.reindex(rows, fmap).collect()
    assert [(q["idx"], q["val"]) for q in R.reindex(rows, fmap, on_unknown="drop").first()["features"]] == [(0, 1.0)]


def test_split_disjoint_total_and_stable(spark):
    df = fx.feature_rows(spark, SF_SMALL).select("order_id")
    tr, te = D.split(df, "order_id", 0.8)
    a = {r[0] for r in tr.collect()}
    b = {r[0] for r in te.collect()}
    assert not (a & b) and len(a | b) == df.count()
    tr2, _ = D.split(df.repartition(5), "order_id", 0.8)
    assert {r[0] for r in tr2.collect()} == a


def test_table_to_sparse_sorted_columns(spark):
    df = spark.createDataFrame([(1, 0.0, 2.0, "x", 3.0)], "target int, b double, a double, s string, c double")
    r = R.table_to_sparse(df, label="target").first()
    assert [(q["idx"], q["val"]) for q in r["features"]] == [(0, 2.0), (2, 3.0)]


def test_libsvm_line_from_wide_row(spark):
    df = spark.createDataFrame([(1, 0.0, 2.5, 3)], "y int, a double, b double, c int")
    assert R.to_libsvm_line(df, "y", ["a", "b", "c"]).first()["line"] == "1 1:0 2:2.5 3:3"


def test_numeric_frame_fills_nulls_and_drops_strings(spark, scratch):
    p = os.path.join(scratch, "c.csv")
    with open(p, "w") as f:
        f.write("a,b,s\n1,,x\n2,3.5,\n")
    out = T.read_csv_numeric(spark, p)
    assert out.columns == ["a", "b"]
    assert sorted(map(tuple, out.collect())) == [(1, 0.0), (2, 3.5)]


def test_transform_spec_from_metadata(spark):
    meta = spark.createDataFrame([("age", "discretize(20)", "m1", 3), ("sex", "onehot", "m1", 600),
                                  ("x", "onehot", "m2", 1)], "fieldname string, transform string, modelname string, indexnum int")
    assert T.transform_spec(meta, "m1") == {"age": "discretize(20)"}


def test_dt_range_is_pushed_to_the_scan(spark, scratch):
    fr = fx.feature_rows(spark, SF_SMALL)
    p = os.path.join(scratch, "fr")
    W.write_parquet(fr, p, partition_by=("dt",))
    df = T.read_range(spark.read.parquet(p), "19960101", "19960131")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "19960101" in plan
    assert df.count() == fr.where("dt between '19960101' and '19960131'").count()


def test_latent_and_embedded_tables(spark, scratch):
    spark.sql(f"create database if not exists t_fm location '{scratch}/wh'")
    lat = fx.latent(spark, SF_SMALL)
    W.latent_to_table(lat, "t_fm.latent", 8)
    assert spark.table("t_fm.latent").columns == ["idx"] + [f"dim{i}" for i in range(1, 9)]
    from fmspark.operators.embed import embed
    out = embed(fx.sparse_rows(spark, SF_SMALL), lat, 5, keep=("order_id", "label"), dense=True) \
        .withColumnRenamed("label", "target")
    W.embedded_to_table(out, "t_fm.emb", 29, mode="overwrite")
    t = spark.table("t_fm.emb")
    assert t.columns[:3] == ["order_id", "target", "f0"] and t.count() == out.count()


def test_csv_sink_and_file_sizing(spark, scratch):
    import glob
    fr = fx.feature_rows(spark, SF_SMALL).select("order_id", "target", "f_price")
    W.write_csv(fr, os.path.join(scratch, "csv"))
    back = spark.read.option("header", True).csv(os.path.join(scratch, "csv"))
    assert back.columns == ["order_id", "target", "f_price"] and back.count() == fr.count()
    lines = fr.select(F.col("order_id").alias("value")).coalesce(1)
    W.write_text(lines, os.path.join(scratch, "txt"), compression=None, max_records_per_file=400)
    files = glob.glob(os.path.join(scratch, "txt", "part-*"))
    assert len(files) == -(-fr.count() // 400)
