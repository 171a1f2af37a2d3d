"""Session construction and shared scratch locations.

Library code does not change session settings; ``build_session`` is for tests,
the bench and local runs.  Scratch data (lineage cuts, exported landing files, pipeline runs inside registered queries) goes under the cluster's
shared ``spark.checkpoint.dir``; only when that is unset (local tests) a
private temporary folder is created and registered as the checkpoint dir.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "strata",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # AQE: coalesce small shuffle partitions, split skewed join partitions,
        # and broadcast a join side only when its measured size (a finished
        # shuffle stage) is under 64MB.  The static, estimate-based threshold
        # stays at Spark's 10MB default.
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB")
        .config("spark.sql.files.maxPartitionBytes", "128MB")
        .config("spark.sql.sources.partitionOverwriteMode", "static")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.  Only a local-mode
    session without one (tests) gets a private temporary folder; on a cluster
    a machine-local folder would be invisible to executors and lost with the
    driver, so a missing setting is an error there."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # no JVM-side context (e.g. a Spark Connect session)
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if root:
        return root.rstrip("/")
    if sc is None or not str(sc.master).startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder on shared storage")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/strata-{name}-{uuid.uuid4().hex[:12]}"
