"""Written intermediates and per-run names in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


#: Rows of a batch between Spark and Python. Texts are long: at Spark's default of 10,000
#: rows a batch of documents takes tens of megabytes, several times in each task.
BATCH_ROWS = "1000"
_ROWS_SETTING, _DEFAULT_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application.

    Functions that run in tasks are pickled by name, so workers must import them. Also
    sets smaller Arrow batches for the session, unless it has its own setting.
    """
    if spark.conf.get(_ROWS_SETTING, _DEFAULT_ROWS) == _DEFAULT_ROWS:
        spark.conf.set(_ROWS_SETTING, BATCH_ROWS)
    application = spark.sparkContext.applicationId
    if application in _shipped or _PACKAGE.suffix == ".zip" or not _PACKAGE.is_dir():
        return
    folder = Path(tempfile.mkdtemp(prefix="modules-"))
    with zipfile.ZipFile(folder / f"{_PACKAGE.name}_llm.zip", "w") as made:
        for source in (_PACKAGE / "__init__.py", *sorted((_PACKAGE / "llm").glob("*.py"))):
            made.write(source, f"{_PACKAGE.name}/{source.relative_to(_PACKAGE)}")
    spark.sparkContext.addPyFile(str(folder / f"{_PACKAGE.name}_llm.zip"))
    _shipped.add(application)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. A session on one machine that names none gets a
    folder of its own, set in the session and removed at exit."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="shared-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet; its readers and their retries start from the files."""
    location = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(location)
    return df.sparkSession.read.schema(df.schema).parquet(location)


def partitions(spark: SparkSession) -> int:
    """How many parts a shuffle has, which the cluster sizes to the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def piece(text: Column, size: int) -> Column:
    """A text of at most ``size`` bytes as it is; of a longer one a quarter as many characters, which are
    no more bytes, from a place that its hash draws."""
    count = size // 4
    begin = 1 + F.pmod(F.xxhash64(text), F.greatest(F.length(text) - count, F.lit(0)) + 1)
    return F.when(F.octet_length(text) <= size, text).otherwise(F.substring(text, begin.cast("int"), F.lit(count)))
