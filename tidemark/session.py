"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def get_spark(app_name: str, master: str | None = None) -> SparkSession:
    """A session with dates in UTC and declared (not guessed) partition column types."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder all executors share, for written tables and checkpoints.

    The cluster names that folder in ``spark.checkpoint.dir``. A temporary folder of this machine
    is used only where the setting is missing and the executors run inside the driver.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, so that two spellings of one place compare equal."""
    found, system = _path(spark, path)
    return system.makeQualified(found).toString().rstrip("/")


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What a directory holds; nothing if there is none."""
    found, system = _path(spark, path)
    return [entry.getPath().getName() for entry in system.listStatus(found)] if system.exists(found) else []


def last_batch(spark: SparkSession, path: str, below: int | None = None) -> int:
    """The greatest number (below a bound) that a file of a stream's log directory is named by; -1 without one."""
    names = [name.split(".")[0] for name in names_in(spark, path)]
    numbers = [int(name) for name in names if name.isdigit()]
    return max((n for n in numbers if below is None or n < below), default=-1)
