"""Session settings the package relies on.

Only settings that are unset are filled in, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}
# can only be given when a session starts: call sites per column expression cost a driver round trip each
AT_START = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def sizing(input_bytes: int, partition_bytes: int = 128 * 2**20, least: int = 200) -> dict[str, str]:
    """Shuffle settings for an input of a known size.

    Shuffles start with about one partition per ``partition_bytes`` of input, so that a task's share fits in memory;
    adaptive execution merges the small ones of later, smaller shuffles.
    """
    partitions = max(least, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
    }


def explicit(spark: SparkSession) -> set[str]:
    """The settings that somebody has set, at submission or since."""
    return {row["key"] for row in spark.sql("SET").collect()}


@contextmanager
def sized(spark: SparkSession, input_bytes: int):
    """``sizing`` for the jobs inside, as far as nothing else is set."""
    given = explicit(spark)
    mine = {k: v for k, v in sizing(input_bytes).items() if k not in given}
    for key, value in mine.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in mine:
            spark.conf.unset(key)


def build_session(master: str | None = None, app: str = "stockyard", **conf: str) -> SparkSession:
    """A session with the defaults above, where they are unset; keyword options use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    start = {} if SparkSession.getActiveSession() else AT_START
    for key, value in {**start, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = explicit(spark)
    for key, value in DEFAULTS.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, the context's own, or a new one for local runs.

    On a cluster one of the two must be set: executors do not see each other's disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="stockyard-shared-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for tables of this application in the shared folder."""
    return f"{shared_dir(spark)}/stockyard/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
