"""Session and checkpoint-folder helpers for tests, the bench and jobs."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings a job on a cluster would also want: AQE on (coalesce small
# partitions, split skewed join partitions, broadcast a join side only when
# its *measured* size is under the threshold), UTC session clock.
# On a cluster also raise spark.sql.shuffle.partitions well above the core
# count (AQE coalesces small partitions back) and keep
# spark.sql.files.maxPartitionBytes near the advisory partition size, so a
# task's input and shuffle blocks fit executor memory at any scale.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "rowgate", extra: dict | None = None) -> SparkSession:
    """A ``local[cores]`` session for tests and the bench (UI off, no ports
    beyond Spark's own)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**CLUSTER_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system every executor sees).
    Only when it is unset -- tests, local runs -- a fresh local folder is
    created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder is invisible to other executors and lost with them
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        d = tempfile.mkdtemp(prefix="rowgate-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's state under the shared checkpoint root."""
    import uuid

    return f"{checkpoint_root(spark).rstrip('/')}/rowgate/{name}/{uuid.uuid4().hex}"
