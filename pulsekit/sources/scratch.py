"""Where plans put files that several executors have to see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the cluster names in spark.checkpoint.dir.

    Only a local session that names none gets one on this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/pulsekit-{name}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.split("[")[0] != "local":  # executors of a local cluster are processes of their own
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"pulsekit-{name}-")
