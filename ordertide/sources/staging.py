"""Intermediate tables that more than one part of a query reads."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. A session on one machine that names none gets a folder of
    its own, set in the session and removed at exit."""
    folder = spark.conf.get(SHARED_FOLDER, None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {SHARED_FOLDER} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="ordertide-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set(SHARED_FOLDER, folder)
    return folder


def new_location(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the stored table.

    Its readers start from the files: nothing upstream runs again for a second
    reader or when an executor is lost.
    """
    location = new_location(df.sparkSession, name)
    df.write.parquet(location)
    return df.sparkSession.read.schema(df.schema).parquet(location)
