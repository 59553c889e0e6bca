"""Spark session settings for the library and its tests."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are planned for: AQE re-plans joins and shuffle
# sizes at run time (runtime broadcast of small join sides by their measured
# size, skew-join split of hot keys, partition coalescing).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "runlens", conf: dict | None = None) -> SparkSession:
    """Build or reuse a session. On a cluster, pass no master: the launcher
    sets it. ``shuffle_partitions`` is for local runs (cores, not 200)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` as the cluster sets it. Only when it is
    unset (local tests) a fresh local folder is made and set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote session has no context; the setting must be given
        sc = None
    if sc is None:
        if not path:
            raise RuntimeError("spark.checkpoint.dir must name a folder that the cluster shares")
        return path
    path = path or sc.getCheckpointDir()
    if not path and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not path:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="runlens-ckpt-"))
        path = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def app_id(spark: SparkSession) -> str:
    """An id of this application, for folders that belong to one session."""
    app = spark.conf.get("spark.app.id", None)
    if app:
        return app
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return "session"


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), *parts)
