"""Session helpers: building a local session for tests and the bench, the
checkpoint folder, and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default budget for a broadcast side. A side is only hinted for broadcast
# after a bounded count proves it is below this many bytes (estimated).
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024
BROADCAST_CONF = "fmspark.broadcast.maxBytes"


def local_session(cores: str = "*", shuffle_partitions: int = 8,
                  app: str = "fmspark", extra: dict | None = None) -> SparkSession:
    """A local session configured the way tests and the bench use it."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only where it is unset (local tests) a fresh scratch folder is made.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="fmspark-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def ship(spark: SparkSession) -> None:
    """Let Python workers find this package when the driver's own import path
    does not reach them (a local session started from another folder). Where
    the package is installed on the executors this changes nothing."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([p for p in known if p] + [root])


def broadcast_budget(spark: SparkSession) -> int:
    v = spark.conf.get(BROADCAST_CONF, None)
    return int(v) if v else DEFAULT_BROADCAST_BYTES


def maybe_broadcast(df: DataFrame, row_bytes: int, max_bytes: int | None = None,
                    known_rows: int | None = None) -> tuple[DataFrame, bool]:
    """Hint ``df`` for broadcast only if a bounded count proves it small.

    ``row_bytes`` is the caller's estimate of one row. The count stops after
    ``max_rows + 1`` rows, so the check costs at most one bounded scan; a
    caller that has already counted the side passes ``known_rows``. When
    the side is too large the plain DataFrame is returned and Catalyst / AQE
    choose a shuffle join.
    """
    budget = max_bytes if max_bytes is not None else broadcast_budget(df.sparkSession)
    max_rows = max(1, budget // max(1, row_bytes))
    n = known_rows if known_rows is not None else df.limit(max_rows + 1).count()
    if n <= max_rows:
        return F.broadcast(df), True
    return df, False


def collect_bounded(df: DataFrame, max_rows: int, what: str) -> list:
    """Collect a result that is small by construction (a category list, a
    set of cut points); refuse if it is not."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} values; refusing to collect to the driver")
    return rows


def materialize(df: DataFrame, name: str, run_id: str | None = None, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as parquet under the session's checkpoint folder (shared on
    a cluster) and read it back: cuts the lineage like ``checkpoint()`` and
    survives executor loss, and the re-read plan's size estimate is the file
    size. ``checkpoint()`` keeps the estimate of the plan it came from, and in
    an iterative job the join estimates then multiply step after step."""
    import uuid
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/fmspark-{run_id or uuid.uuid4().hex}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_conf(input_bytes: int, total_cores: int, *, target_partition_bytes: int = 256 * 1024 * 1024,
                 broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> dict:
    """Session settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions are sized so that a partition holds about
    ``target_partition_bytes`` at the largest exchange (at least two waves of
    tasks); AQE coalesces small ones and splits skewed ones at run time.
    ``spark.checkpoint.dir`` is not set here: it must name a shared folder
    chosen by the cluster."""
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        BROADCAST_CONF: str(broadcast_bytes),
    }
