"""The embedding as a Structured Streaming query.

New libsvm text files arriving in a folder are parsed and embedded per
micro-batch with the batch operator (``operators.embed.embed``) inside
``foreachBatch``: the regroup after the explode is a per-batch aggregation,
so no streaming state is kept, and every batch is written to its own
``batch=<id>`` folder with ``overwrite``, so a replayed batch (after a
failure, from the checkpointed offsets) replaces its own output instead of
duplicating it. The latent table is static and read once per batch.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fmspark.operators.embed import embed
from fmspark.sinks.writers import embedded_lines
from fmspark.sources.libsvm import parse_lines


def embed_stream(spark: SparkSession, src_dir: str, latent: DataFrame, threshold: int, out_dir: str,
                 checkpoint_dir: str, *, is_prd: bool = True, available_now: bool = True,
                 max_files_per_trigger: int | None = None, compression: str | None = "gzip", **embed_kw):
    """Start the stream; returns the ``StreamingQuery``. ``available_now``
    processes what is there and stops (a scheduled incremental job);
    otherwise it runs until stopped."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(src_dir)

    def per_batch(df: DataFrame, batch_id: int) -> None:
        rows = parse_lines(df, is_prd=is_prd)
        if not is_prd:
            rows = rows.withColumn("order_id", F.col("row_id").cast("string"))
        out = embed(rows, latent, threshold, keep=("order_id",), **embed_kw)
        w = embedded_lines(out, key="order_id", dense=embed_kw.get("dense", False)).write.mode("overwrite")
        if compression:
            w = w.option("compression", compression)
        w.text(os.path.join(out_dir, f"batch={batch_id}"))

    ws = lines.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_dir)
    ws = ws.trigger(availableNow=True) if available_now else ws.trigger(processingTime="10 seconds")
    return ws.start()
