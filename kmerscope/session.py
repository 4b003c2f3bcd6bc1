"""Session and scratch-space helpers.

The library never picks a machine-local folder on a cluster: shared scratch
space comes from ``spark.checkpoint.dir``.  Only a local-mode session (tests,
the bench) that has no checkpoint dir gets one under the system temp folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, app: str = "kmerscope",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from the session; a local-mode session without one gets a fresh temp
    folder (tests).  A cluster session without one is an error: executors
    cannot share a machine-local path.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="kmerscope-ckpt-"))
        d = sc.getCheckpointDir()
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
