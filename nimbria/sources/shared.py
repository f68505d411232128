"""The folder that the driver and all executors share, and what a session has written there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a local session (one machine) gets a folder of its own and any other an
    error: on a cluster a machine's folder would be lost with the machine."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="nimbria-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return (found or sc.getCheckpointDir()).rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def clean_up(spark: SparkSession) -> int:
    """Delete the tables that this driver has written to the shared folder, once no result needs them; how many there were."""
    done = 0
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        done += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return done
