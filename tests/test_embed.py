"""Golden and property tests of the embedding."""

import pytest
from pyspark.sql import functions as F

from fmspark.operators import embed as E
from fmspark.operators.embed import embed, width_report, attach_target, embed_sets
from fmspark.plans import fixtures as fx
from inputs import SF_SMALL

PAIRS = "row_id long, order_id string, label int, features array<struct<idx:int,val:double>>"


def readme_rows(spark):
    # the README's worked example: 8 one-hot features, two fields of 4, k = 2;
    # threshold 0, so every feature is an embedding candidate
    r1 = [0, 1, 0, 0, 1, 0, 0, 0]
    r2 = [1, 0, 0, 0, 0, 0, 0, 1]
    rows = [(i, str(i), 1, [(j + 1, float(v)) for j, v in enumerate(r)]) for i, r in enumerate((r1, r2))]
    return spark.createDataFrame(rows, PAIRS)


def readme_latent(spark):
    # v_f = (10 f + 1, 10 f + 2) for feature f, so v21 v22 = 21, 22
    return spark.createDataFrame([(f, [10.0 * f + 1, 10.0 * f + 2]) for f in range(1, 9)],
                                 "idx int, v array<double>")


def collect_out(df):
    return {r["order_id"]: r["out"] for r in df.collect()}


def test_readme_embedding_only(spark):
    out = collect_out(embed(readme_rows(spark), readme_latent(spark), 0, keep=("order_id",),
                            append=False, dense=True))
    assert out["0"] == [21.0, 22.0, 51.0, 52.0]
    assert out["1"] == [11.0, 12.0, 81.0, 82.0]


def test_readme_append_keep_onehot(spark):
    out = collect_out(embed(readme_rows(spark), readme_latent(spark), 0, keep=("order_id",),
                            dense=True, keep_onehot=True))
    assert out["0"] == [0, 1, 0, 0, 1, 0, 0, 0, 21.0, 22.0, 51.0, 52.0]
    assert out["1"] == [1, 0, 0, 0, 0, 0, 0, 1, 11.0, 12.0, 81.0, 82.0]


def test_offset_and_zero_numbering(spark):
    rows = spark.createDataFrame([(0, "a", 1, [(1, 0.5), (2, 3.0), (3, 1.0), (4, 0.0), (6, 1.0)])], PAIRS)
    lat = spark.createDataFrame([(3, [1.0, 2.0]), (4, [9.0, 9.0]), (6, [3.0, 4.0])], "idx int, v array<double>")
    off = embed(rows, lat, 2, keep=("order_id",)).first()["out"]
    assert [(p["idx"], p["val"]) for p in off] == [(1, 0.5), (2, 3.0), (3, 1.0), (4, 2.0), (5, 3.0), (6, 4.0)]
    zero = embed(rows, lat, 2, keep=("order_id",), numbering="zero").first()["out"]
    assert [(p["idx"], p["val"]) for p in zero] == [(0, 0.5), (1, 3.0), (2, 1.0), (3, 2.0), (4, 3.0), (5, 4.0)]


def test_candidates_with_other_values_are_dropped(spark):
    # idx 3 has value 0.5 above the threshold: neither raw nor embedded
    rows = spark.createDataFrame([(0, "a", 1, [(1, 2.0), (3, 0.5), (4, 1.0)])], PAIRS)
    lat = spark.createDataFrame([(3, [7.0]), (4, [8.0])], "idx int, v array<double>")
    out = embed(rows, lat, 2, keep=("order_id",), dense=True).first()["out"]
    assert out == [2.0, 8.0]


def test_row_without_active_feature_survives(spark):
    rows = spark.createDataFrame([(0, "a", 1, [(1, 2.0), (3, 0.0)]), (1, "b", 0, [(1, 1.0), (3, 1.0)])], PAIRS)
    lat = spark.createDataFrame([(3, [7.0, 8.0])], "idx int, v array<double>")
    out = collect_out(embed(rows, lat, 2, keep=("order_id",), dense=True))
    assert out == {"a": [2.0], "b": [1.0, 7.0, 8.0]}
    only = collect_out(embed(rows, lat, 2, keep=("order_id",), dense=True, append=False))
    assert only == {"a": [], "b": [7.0, 8.0]}


def test_unknown_index_raises_or_drops(spark):
    rows = spark.createDataFrame([(0, "a", 1, [(1, 2.0), (9, 1.0)])], PAIRS)
    lat = spark.createDataFrame([(3, [7.0])], "idx int, v array<double>")
    with pytest.raises(Exception, match="no latent vector"):
        embed(rows, lat, 2, keep=("order_id",)).collect()
    out = embed(rows, lat, 2, keep=("order_id",), dense=True, on_unknown="drop").first()["out"]
    assert out == [2.0]


def test_embedding_preserves_rows_and_width(spark):
    rows = fx.sparse_rows(spark, SF_SMALL)
    out = embed(rows, fx.latent(spark, SF_SMALL), fx.THRESHOLD, keep=("order_id",), dense=True)
    assert out.count() == rows.count()
    widths = {r[0] for r in out.select(F.size("out")).distinct().collect()}
    assert widths == {5 + 3 * fx.K}


def test_result_independent_of_partitioning(spark):
    rows = fx.sparse_rows(spark, SF_SMALL)
    lat = fx.latent(spark, SF_SMALL)
    base = sorted(map(tuple, embed(rows, lat, 5, keep=("order_id",), dense=True).collect()))
    for n in (1, 7, 64):
        again = sorted(map(tuple, embed(rows.repartition(n), lat, 5, keep=("order_id",), dense=True).collect()))
        assert again == base


def test_single_exchange_in_plan(spark):
    rows = fx.sparse_rows(spark, SF_SMALL)
    out = embed(rows, fx.latent(spark, SF_SMALL), 5, keep=("order_id",))
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the input repartition is the only exchange after the fixture build: the
    # explode, broadcast join and regroup keep the key partitioning
    assert plan.count("hashpartitioning(row_id") == 1


def test_shuffle_join_fallback_matches_broadcast(spark):
    rows = fx.sparse_rows(spark, SF_SMALL)
    lat = fx.latent(spark, SF_SMALL)
    a = sorted(map(tuple, embed(rows, lat, 5, keep=("order_id",), dense=True).collect()))
    b = sorted(map(tuple, embed(rows, lat, 5, keep=("order_id",), dense=True, max_broadcast_bytes=1).collect()))
    assert a == b


def test_width_report_strict(spark):
    rows = spark.createDataFrame([(0, "a", 1, [(1, 2.0), (3, 1.0)]), (1, "b", 0, [(1, 1.0)])], PAIRS)
    lat = spark.createDataFrame([(3, [0.1, 0.2, 0.3, 0.4]), (4, [0.5, 0.6])], "idx int, v array<double>")
    rep = width_report(rows, 2, lat).first()
    assert rep["n_rows"] == 2 and rep["emb_widths"] == 2 and rep["max_total"] == 5
    with pytest.raises(ValueError):
        width_report(rows, 2, lat, strict=True)


def test_short_latent_vector_is_a_ragged_row(spark, scratch):
    rows = spark.createDataFrame([(0, "a", 1, [(1, 2.0), (3, 1.0)]), (1, "b", 0, [(1, 1.0), (4, 1.0)])], PAIRS)
    lat = spark.createDataFrame([(3, [0.1, 0.2]), (4, [0.5])], "idx int, v array<double>")
    with pytest.raises(ValueError):
        width_report(rows, 2, lat, strict=True)
    df, seen = E.observed(embed(rows, lat, 2, dense=True))
    df.write.parquet(f"{scratch}/out")
    assert E.check_widths(seen) == {"n_rows": 2, "min_width": 2, "max_width": 3}
    with pytest.raises(ValueError):
        E.check_widths(seen, strict=True)


def test_shuffle_path_copies_hot_latents_only(spark):
    """A latent table beyond the broadcast budget: an index that is active in every
    row is broadcast, the rest joined once, without copies."""
    rows = spark.createDataFrame([(r, str(r), 0, [(1, 0.5), (3, 1.0), (4 + r % 90, 1.0)]) for r in range(300)], PAIRS)
    lat = spark.createDataFrame([(i, [float(i), -float(i)]) for i in range(3, 100)], "idx int, v array<double>")
    want = sorted(embed(rows, lat, 2).collect())
    from fmspark.operators.embed import hot_indices
    pairs = rows.select(F.explode("features").alias("p")).select("p.idx").where("idx > 2")
    assert [r[0] for r in hot_indices(pairs).collect()] == [3]
    out = embed(rows, lat, 2, max_broadcast_bytes=1)
    assert sorted(out.collect()) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence" not in plan and "_hidx" in plan


def test_attach_target_by_key_not_position(spark):
    prd = spark.createDataFrame([(0, "b", [(1, 1.0)]), (1, "a", [(1, 2.0)])],
                                "row_id long, order_id string, features array<struct<idx:int,val:double>>")
    train = spark.createDataFrame([(5, "a", 1, []), (6, "b", 0, [])], PAIRS)
    got = {r["order_id"]: r["target"] for r in attach_target(prd, train).collect()}
    assert got == {"a": 1, "b": 0}


def test_embed_sets_tags_both(spark):
    rows = fx.sparse_rows(spark, SF_SMALL)
    lat = fx.latent(spark, SF_SMALL)
    from fmspark.operators.split import split
    tr, te = split(rows, "order_id", 0.5)
    out = embed_sets(tr, te.drop("label"), lat, 5, keep=("order_id",))
    counts = {r["set"]: r["count"] for r in out.groupBy("set").count().collect()}
    assert counts["train"] + counts["prd"] == rows.count()


def test_bucketed_input_needs_no_exchange(spark, scratch):
    from fmspark.sinks.writers import write_bucketed
    spark.sql(f"create database if not exists t_emb location '{scratch}/wh'")
    rows = fx.sparse_rows(spark, SF_SMALL)
    write_bucketed(rows, "t_emb.rows", "row_id", 8)
    t = spark.table("t_emb.rows")
    out = embed(t, fx.latent(spark, SF_SMALL), 5, keep=("order_id",), clustered=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan.lower()
    a = sorted(map(tuple, out.select("order_id", "out").collect()))
    b = sorted(map(tuple, embed(rows, fx.latent(spark, SF_SMALL), 5, keep=("order_id",)).select("order_id", "out").collect()))
    assert a == b


def test_null_label_and_null_features_survive(spark, scratch):
    import os
    from fmspark.sources.libsvm import read_libsvm
    p = os.path.join(scratch, "bad.txt")
    with open(p, "w") as f:
        f.write("NA 1:0.5 7:1\n1\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_libsvm(spark, p).collect()
    rows = read_libsvm(spark, p, bad="null").withColumn("order_id", F.col("row_id").cast("string"))
    lat = spark.createDataFrame([(7, [1.0, 2.0])], "idx int, v array<double>")
    out = {r["label"]: r["out"] for r in embed(rows, lat, 5, keep=("order_id", "label"), dense=True).collect()}
    assert out == {None: [0.5, 1.0, 2.0], 1.0: []}
    nulls = spark.createDataFrame([(0, "a", 1, None)], PAIRS)
    assert embed(nulls, lat, 5, keep=("order_id",), dense=True).first()["out"] == []


def test_feature_expression_evaluated_once(spark):
    from fmspark.plans.queries import QUERIES
    segs = fx.categories(fx.feature_rows(spark, SF_SMALL), "f_seg")["f_seg"]
    plan = QUERIES["embed_dense"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # each build of the one-hot array holds one CASE WHEN per segment
    assert plan.count("CASE WHEN (f_seg") == len(segs)


def test_fallback_plan_has_no_upfront_repartition(spark):
    rows = fx.sparse_rows(spark, SF_SMALL)
    out = embed(rows, fx.latent(spark, SF_SMALL), 5, keep=("order_id",), max_broadcast_bytes=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" not in plan
