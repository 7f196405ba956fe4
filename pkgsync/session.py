"""Session helpers: local builder for tests, scratch folders on the shared checkpoint root."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; all are plain Spark SQL confs.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Binary-file rows carry a whole file; keep the split size modest.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Spark's base64() chunks output into 76-char lines by default; the npm
    # attachment wants one line (as Python's b64encode gives).
    "spark.sql.chunkBase64String.enabled": "false",
}


# Removes a query's shuffle files at its end.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pkgsync") -> SparkSession:
    """Session for tests and the local bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL confs to an existing session (idempotent)."""
    for k, v in SCALE_CONF.items():
        if k == "spark.sql.files.maxPartitionBytes":
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # a conf unknown to this Spark build is not fatal
            pass


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    On a cluster this is ``spark.checkpoint.dir`` (or the context's checkpoint
    dir) and must be a shared filesystem; unset on a cluster is an error.  Only
    a local session with nothing configured (tests) gets a fresh folder under /tmp.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        return root
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not str(sc.master).startswith("local"):
                # executors on other machines would not see a local folder
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            root = tempfile.mkdtemp(prefix="pkgsync-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared checkpoint root (never reused)."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}pkgsync-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` worked out once, on the scratch root, and read from there.

    The shuffle files behind it are removed as soon as it is written, not when the driver's garbage happens to be
    collected: a job in stored steps holds the shuffle files of one step, not of all.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FILE_CLEANUP)
        else:
            spark.conf.set(FILE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def local_dir(path: str) -> str:
    """Strip a ``file:`` scheme so Python code inside tasks can open the path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def ensure_local_dir(path: str) -> str:
    p = local_dir(path)
    os.makedirs(p, exist_ok=True)
    return p
