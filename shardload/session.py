"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale.  The shuffle partition count is left to
# the caller / cluster defaults; AQE coalesces small partitions and splits
# skewed ones at run time.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "shardload", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback_root: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must exist (a shared file system).  Only when it
    is unset, as in local tests, a folder is made under ``fallback_root`` (or a
    fresh temporary folder) and registered with the session.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    master = spark.sparkContext.master
    if not master.startswith("local") and fallback_root is None:
        raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
    root = fallback_root or tempfile.mkdtemp(prefix="shardload-ckpt-")
    os.makedirs(root, exist_ok=True)
    spark.sparkContext.setCheckpointDir(root)
    try:
        spark.conf.set("spark.checkpoint.dir", root)
    except Exception:  # core setting not modifiable at run time: the context dir is enough
        pass
    return root


_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/shardload/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def purge_scratch(spark: SparkSession) -> int:
    """Delete what ``scratch_path`` named in this process.  For the end of a
    job: frames that read from these folders can no longer be evaluated."""
    n = 0
    while _made:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_made.pop())
        n += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n


def materialize(df):
    """Cut lineage of a (small) result with a reliable checkpoint in the
    shared ``spark.checkpoint.dir``, so that several consumers read it
    without re-running the plan below it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
