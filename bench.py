"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line.

Each query is executed to completion through the ``noop`` sink (every row
and column computed, nothing collected to the driver). ``embed_to_text``
also runs the embedding into gzip libsvm text (G5) in a fresh scratch folder.
Times are the best of ``$BENCH_REPS`` runs (default 2: the first run warms
the JVM), per query.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["embed_append", "embed_dense", "embed_width_check", "feature_map", "reindex", "to_fm",
            "fm_score", "ffm_score", "auc", "split_counts", "transform_spec", "drop_zero"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "2"))
    from fmspark.session import local_session
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="fmspark-bench")
    from fmspark.plans import fixtures as fx
    from fmspark.plans.queries import QUERIES
    from fmspark.operators.embed import embed
    from fmspark.sinks.writers import embedded_lines, write_text

    times: dict[str, float] = {}

    def run(name, fn):
        best = None
        for _ in range(reps):
            t = time.time()
            fn()
            dt = time.time() - t
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)

    for q in HEADLINE:
        run(q, lambda q=q: QUERIES[q](spark, sf_dir).write.format("noop").mode("overwrite").save())

    scratch = tempfile.mkdtemp(prefix="fmspark-bench-")

    def to_text():
        out = embed(fx.sparse_rows(spark, sf_dir), fx.latent(spark, sf_dir), fx.THRESHOLD, keep=("order_id",))
        write_text(embedded_lines(out), os.path.join(scratch, f"emb-{time.time_ns()}"))

    run("embed_to_text", to_text)

    # core operators over the sparse rows as a prepare step leaves them
    # (parquet), so the times are the operators' own
    from fmspark.operators import ffm as FF
    from fmspark.operators import fm as M
    from fmspark.operators.rows import reindex
    from fmspark.operators.split import feature_map
    rows_path = os.path.join(scratch, "rows")
    fx.sparse_rows(spark, sf_dir).write.parquet(rows_path)
    rows = spark.read.parquet(rows_path)
    lat = fx.latent(spark, sf_dir)
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    run("core_embed", lambda: noop(embed(rows, lat, fx.THRESHOLD, keep=("order_id",))))
    bias, lin, _ = fx.fm_model(spark, sf_dir)
    run("core_fm_score", lambda: noop(M.fm_score(rows, bias, M.model_table(lin, lat), fx.K)))
    act = rows.withColumn("features", fx.F.filter("features", lambda p: p["idx"] > fx.THRESHOLD))
    ffm_m, fmap_f = fx.ffm_model(spark, sf_dir), fx.field_table(lat)
    run("core_ffm_score", lambda: noop(FF.ffm_score(act, ffm_m, fmap_f, fx.FFM_K)))

    def fmap_reindex():
        fmap, n = feature_map(rows)
        noop(reindex(rows, fmap, map_rows=n))
    run("core_feature_map_reindex", fmap_reindex)
    n_rows = fx.table(spark, sf_dir, "orders").count()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "rows_embedded": n_rows,
                      "embed_rows_per_sec": round(n_rows / times["embed_to_text"], 1) if times["embed_to_text"] else None}))
    spark.stop()


if __name__ == "__main__":
    main()
