"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on for right results or for surviving skew. Sizes (executors, memory) stay with the cluster.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "convoy", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session. On a cluster leave ``master`` out and let spark-submit set it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path for one run, below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine: executors elsewhere could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="convoy-")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")
