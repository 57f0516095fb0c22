"""Folders for what a query writes and reads again."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_made: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``, in a local session without one below
    a temporary folder. It goes when the driver ends."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="weftline-")
    path = f"{named.rstrip('/')}/weftline-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@atexit.register
def _drop_all() -> None:
    for spark, path in _made:
        _drop(spark, path)


def _drop(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone already
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` stored, and the files of ``old`` (of :func:`stored`), which nothing else reads, dropped."""
    spark, out = old.sparkSession, stored(new)
    for folder_ in {f.rpartition("/")[0] for f in old.inputFiles()}:
        if any(folder_.endswith(path.rpartition("/")[2]) for _, path in _made):
            _drop(spark, folder_)
    return out


def put_lines(rows: DataFrame, *keys: str, **options) -> str:
    """The column ``value`` of some rows as text files, in folders by the keys; the new folder."""
    path = folder(rows.sparkSession)
    rows.select(*keys, F.col("value")).coalesce(1).write.options(**options).partitionBy(*keys).text(path) if keys else rows.select("value").coalesce(1).write.options(**options).text(path)
    return path


def stored(rows: DataFrame) -> DataFrame:
    """The rows, written to a new folder and read again: their lineage is cut and nothing is worked out twice."""
    path = folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
