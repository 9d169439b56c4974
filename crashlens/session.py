"""Session helpers: a local session for tests and benches, and the shared
folder used to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "crashlens") -> SparkSession:
    """A local[N] session for tests and benches. A cluster job passes its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    try:
        d = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf lookup differs across deployments
        d = None
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint folder. Only a local session without one (tests)
    gets a fresh temporary folder; a cluster session without one is an error."""
    d = checkpoint_dir(spark)
    if d is None:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder shared by the cluster (HDFS, S3, ...): "
                "the profile-day table and intermediate tables are written there"
            )
        d = tempfile.mkdtemp(prefix="crashlens-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the checkpoint folder for a written intermediate table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/crashlens/{name}-{uuid.uuid4().hex[:12]}"


def cores_from_env(default: int = 8) -> int:
    try:
        return int(os.environ.get("BENCH_CPUS", default))
    except ValueError:
        return default
