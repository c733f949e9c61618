"""What several operators need: the shared folder, written intermediate tables, column names that cannot clash."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that goes to Python; texts can be long, so fewer than Spark's default.
BATCH_ROWS = 1_000

#: A word: what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a new one on a local master where that is unset, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="kwarta-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark reads it under, so that other readers do not take it for a local one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path, as executors' Python reaches it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return qualified(spark, f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}")


def written(frame: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The frame as a table in the shared folder, which cuts its lineage, and the table's path."""
    spark = frame.sparkSession
    path = new_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete intermediate tables of this run that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def small_batches(spark: SparkSession) -> None:
    """At most BATCH_ROWS rows go to Python at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def carried(frame: DataFrame, columns: Iterable[str]) -> list[Column]:
    """The named columns under names that an operator's own columns cannot have."""
    return [frame[f"`{name}`"].alias(f"_in_{i}") for i, name in enumerate(columns)]


def restored(columns: Iterable[str]) -> list[Column]:
    """The columns of carried() under their own names again."""
    return [F.col(f"_in_{i}").alias(name) for i, name in enumerate(columns)]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: A group is large if it holds this share of all rows at least: there are at most 1 / LARGE such groups.
LARGE = 0.001
#: Rows up to which all groups are broadcast, at some twenty bytes each: there are no more groups than rows.
FEW = 500_000


def told(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, value: str) -> DataFrame:
    """Rows with their group's value: an inner join on the key, whose large groups meet no task of their own.

    `groups` has one row per key with its number of rows, `total` is the number of all rows. Of few rows all groups are
    broadcast; else the large ones are, at most 1 / LARGE, so that their rows stay where they are, and the others
    are joined as usual.
    """
    if total <= FEW:
        return rows.join(F.broadcast(groups.select(key, value)), key)
    least = max(2.0, LARGE * total)
    large = groups.where(F.col(size) >= least).select(F.col(key).alias("_large"), value)
    others = groups.where(F.col(size) < least).select(key, value)
    here = rows.join(F.broadcast(large), F.col(key) == F.col("_large")).drop("_large")
    rest = rows.join(F.broadcast(large.select("_large")), F.col(key) == F.col("_large"), "left_anti")
    return here.unionByName(rest.join(others, key))
