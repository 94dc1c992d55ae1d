"""Streaming embedding and the end-to-end pipeline."""

import glob
import gzip
import os

from pyspark.sql import functions as F

from inputs import SF_SMALL
from fmspark.operators.embed import embed
from fmspark.plans import fixtures as fx
from fmspark.sinks import writers as W
from fmspark.streaming.embed_stream import embed_stream


def _lines_of(path):
    out = []
    for f in glob.glob(os.path.join(path, "**", "part-*"), recursive=True):
        op = gzip.open if f.endswith(".gz") else open
        with op(f, "rt") as h:
            out += [x.rstrip("\n") for x in h if x.strip()]
    return sorted(out)


def test_stream_equals_batch(spark, scratch):
    rows = fx.sparse_rows(spark, SF_SMALL)
    src = os.path.join(scratch, "in")
    W.write_text(W.prd_lines(rows), src, compression=None)
    lat = fx.latent(spark, SF_SMALL)
    q = embed_stream(spark, src, lat, fx.THRESHOLD, os.path.join(scratch, "out"), os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    streamed = _lines_of(os.path.join(scratch, "out"))
    batch = sorted(r["value"] for r in W.embedded_lines(
        embed(rows, lat, fx.THRESHOLD, keep=("order_id",))).collect())
    assert streamed == batch and len(batch) == rows.count()


def test_pipeline_end_to_end(spark, scratch):
    from fmspark.plans.pipeline import Config, run
    rows = fx.sparse_rows(spark, SF_SMALL, label="target_planted")
    tr = os.path.join(scratch, "train.txt")
    prd = os.path.join(scratch, "prd.txt")
    W.write_text(W.fm_lines(rows.withColumn("label", F.col("label").cast("double"))), tr, compression=None)
    W.write_text(W.prd_lines(rows), prd, compression=None)
    out = run(spark, Config(train_path=tr, prd_path=prd, out_dir=os.path.join(scratch, "out"), threshold=5,
                            dim_k=4, iter_num=20))
    n = rows.count()
    assert len(_lines_of(out["train"])) == n and len(_lines_of(out["prd"])) == n
    lat = spark.read.parquet(out["latent"])
    assert lat.count() == 40  # every feature index of the rows, keyed by its original index
    assert {r[0] for r in lat.select("idx").collect()} == set(range(1, 41))


def test_run_writes_tables_metrics_and_predictions(spark, scratch):
    """Every value of the written tables against the written model and rows; a
    second run replaces its own rows."""
    import uuid

    import pytest

    from fmspark.operators import fm as M
    from fmspark.plans.pipeline import Config, run
    rows = fx.sparse_rows(spark, SF_SMALL, label="target_planted").where("row_id < 800")
    tr, prd, base = (os.path.join(scratch, n) for n in ("tr", "prd", "out"))
    W.write_text(W.fm_lines(rows.withColumn("label", F.col("label").cast("double"))), tr)
    W.write_text(W.prd_lines(rows.where("row_id < 300")), prd)
    table = f"emb_{uuid.uuid4().hex[:8]}"
    cfg = Config(train_path=tr, prd_path=prd, out_dir=base, threshold=5, dim_k=2, iter_num=3, method="sgda", reg=(0.0, 0.01, 0.02), scale=True,
                 dense=True, table=table)
    out = run(spark, cfg)
    again = run(spark, cfg)
    assert out["metrics"] == pytest.approx(again["metrics"])
    got = spark.table(f"{table}_embedded")
    assert got.columns == ["order_id", "target", *[f"f{i}" for i in range(11)], "part"]
    assert {r.part: r["count"] for r in got.groupBy("part").count().collect()} == {"train": rows.count(), "prd": rows.where("row_id < 300").count()}
    lat = {r.idx: list(r.v) for r in spark.read.parquet(out["latent"]).collect()}
    table_lat = {r.idx: [r.dim1, r.dim2] for r in spark.table(f"{table}_latent").collect()}
    assert table_lat == lat
    want = {}
    for r in rows.where("row_id < 300").collect():
        vals = [p.val for p in r.features if p.idx <= 5]
        for p in r.features:
            if p.idx > 5 and p.val == 1:
                vals += lat[p.idx]
        want[r.order_id] = vals
    prd_rows = got.where("part = 'prd'").collect()
    assert {r.order_id for r in prd_rows} == set(want) and all(r.target is None for r in prd_rows)
    for r in prd_rows:
        assert [r[f"f{i}"] for i in range(11)] == pytest.approx(want[r.order_id], abs=1e-6)
    linear = spark.read.parquet(os.path.join(base, "linear"))
    bias = spark.read.parquet(os.path.join(base, "bias")).first().w0
    pred = {r.row_id: (r.label, r.y, r.p) for r in spark.read.parquet(os.path.join(base, "predictions")).collect()}
    from fmspark.operators.split import split
    from fmspark.sources.libsvm import read_libsvm
    _, held = split(read_libsvm(spark, tr), "row_id", cfg.train_ratio, seed=cfg.seed)
    score = {r.row_id: r.y for r in M.fm_score(held, bias, M.model_table(linear, spark.read.parquet(out["latent"])), 2).collect()}
    assert {k: v[1] for k, v in pred.items()} == pytest.approx(score)
    assert spark.read.parquet(os.path.join(base, "objective")).count() == 3
    scored = spark.createDataFrame([(int(a), p) for a, _, p in pred.values()], "y int, p double")
    assert out["metrics"]["auc"] == pytest.approx(M.auc(scored, "y", "p").first()[0])
    for t in ("embedded", "latent"):
        spark.sql(f"DROP TABLE {table}_{t}")
