"""Spark session set-up."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

DEFAULT_APP_NAME = "ordertide"

#: Bytes that a task reads of files and of a shuffle, where the session has no setting of its own.
#: Sorts and hash tables hold rows at ten times their compressed bytes and more, several at a time.
#: Spark joins parts of a shuffle up to these bytes but cuts none, so there are many: enough for 16 GB
#: in one shuffle, also in a session with a small fixed ``spark.sql.shuffle.partitions``.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": "16MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
}


def small_tasks(spark: SparkSession) -> None:
    """Let larger tables be more tasks, not larger ones: the session's tasks read TASK_BYTES at most,
    as long as adaptive execution joins the parts of its shuffles. Settings that it has already stay."""
    own = spark.conf.getAll
    for name, value in TASK_BYTES.items():
        if name not in own:
            spark.conf.set(name, value)


def open_session(
    app_name: str = DEFAULT_APP_NAME,
    jdbc_jar: str | None = None,
    conf: Mapping[str, object] | None = None,
) -> SparkSession:
    """A session for one job. Master and resources come from the submit command,
    so the same job runs on a laptop and on a cluster."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in (conf or {}).items():
        builder = builder.config(name, value)
    if jdbc_jar:
        builder = builder.config("spark.jars", jdbc_jar)
    return builder.getOrCreate()
