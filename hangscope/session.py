"""Session helpers for tests and the bench (jobs take the caller's session)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


_WRITTEN: dict[str, list[str]] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "hangscope") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("HANGSCOPE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Only a local session (a test run) that names none gets a scratch folder; on
    a cluster ``spark.checkpoint.dir`` must point at shared storage.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="hangscope-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df):
    """Compute ``df`` once, as a Parquet table in the shared checkpoint folder.

    Used for intermediates read by several branches of a plan (frame
    dictionary, rates, pruned rows): without it each branch, pruning different
    columns, would rerun the scan and exchanges above it.  Branches read only
    the columns they need.  The folder is the cluster's
    ``spark.checkpoint.dir``, so a lost executor does not lose the data;
    :func:`clear_materialized` removes the tables of a session.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/hangscope-tmp/{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialized_mark(spark: SparkSession) -> int:
    """How many tables :func:`materialize` has written so far."""
    return len(_WRITTEN.get(spark.sparkContext.applicationId, []))


def clear_materialized(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables that :func:`materialize` wrote (from the mark ``since`` on), once no result needs them."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _WRITTEN.get(spark.sparkContext.applicationId, [])
    while len(paths) > since:
        p = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        p.getFileSystem(conf).delete(p, True)
