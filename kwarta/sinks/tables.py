"""Parquet tables: the default store."""

from __future__ import annotations

import re
import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kwarta import schemas

BY_NAME = {
    "dim_users": schemas.USERS,
    "dim_merchants": schemas.MERCHANTS,
    "fact_transactions": schemas.FACTS,
    "quarantine": schemas.QUARANTINE,
    "user_activity": schemas.ACTIVITY,
    "alert_decisions": schemas.DECISIONS,
    "mart_fraud_alerts": schemas.ALERTS,
    "mart_daily_user_dashboard": schemas.USER_DAILY,
    "mart_merchant_performance": schemas.MERCHANT_DAILY,
    "mart_hourly_velocity": schemas.HOURLY,
    "mart_merchant_customers": schemas.CUSTOMERS,
    "fact_profiles": schemas.PROFILES,
}


def exists(spark: SparkSession, name: str) -> bool:
    """Whether there is a catalog table, or a folder, of this name."""
    if "/" not in name:
        return spark.catalog.tableExists(name)
    try:
        spark.read.schema("probe int").parquet(name)  # resolves the path, reads no file
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read(spark: SparkSession, name: str) -> DataFrame:
    """A stored table. The engine's own tables are read with their declared schema, so no footer
    is opened to infer one and an empty table has its columns. The frame remembers its folder, for
    :func:`stored_dates`."""
    if "/" not in name:
        return spark.table(name)
    declared = BY_NAME.get(name.rstrip("/").rsplit("/", 1)[-1])
    reader = spark.read if declared is None else spark.read.schema(declared)
    frame = reader.parquet(name)
    frame._stored_at = name
    return frame


def create(spark: SparkSession, path: str, *partitions: str) -> None:
    """Make one of the engine's tables, empty, unless it is there."""
    schema = BY_NAME[path.rstrip("/").rsplit("/", 1)[-1]]
    empty = spark.range(0, 0, 1, 1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    writer = empty.write.mode("ignore")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _spread(df: DataFrame, partition: str | None) -> DataFrame:
    """Group rows by output folder before writing.

    Without it every task writes one small file into every folder. The rebalance hint also splits a
    folder that holds most of the rows over many tasks, where a plain repartition would not.
    """
    return df if partition is None else df.hint("rebalance", F.col(partition))


def append(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Add rows. Without any, nothing is written: a partitioned write makes no file then, and any other
    is looked at first."""
    if partition is None:
        df = df.persist()
        try:
            if not df.isEmpty():
                df.write.mode("append").parquet(path)
        finally:
            df.unpersist()
        return
    _spread(df, partition).write.mode("append").partitionBy(partition).parquet(path)


def _place(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or a file, if it is there."""
    place, files = _place(spark, path)
    files.delete(place, True)


def make_folder(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.mkdirs(place)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    place, files = _place(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    (place, files), (draft, _) = _place(spark, path), _place(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.rename(draft, place)


def text_of(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    place, files = _place(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove_if_empty(spark: SparkSession, folder: str) -> None:
    """Delete a folder that holds nothing."""
    place, files = _place(spark, folder)
    if files.exists(place) and not files.listStatus(place):
        files.delete(place, False)


def is_there(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def compact(spark: SparkSession, path: str, stage: str, partition: str | None = None, where: Column | None = None) -> None:
    """Rewrite a table, or the partitions that ``where`` names, in fewer files.

    The rows are copied to ``stage`` first and written from there. Run it while nothing appends to those
    partitions: closed days, or dimensions between two loads.
    """
    rows = read(spark, path)
    (rows if where is None else rows.filter(where)).write.parquet(stage)
    copied = spark.read.schema(rows.schema).parquet(stage)
    if partition is None:
        copied.hint("rebalance").write.mode("overwrite").parquet(path)
    else:
        replace_partitions(copied, path, partition)
    remove(spark, stage)


def stored_dates(df: DataFrame, partition: str = "event_date") -> list[date]:
    """The days a stored table, as :func:`read` gives it, has partitions of, newest first, by listing its folders.

    Files are not listed. Empty for other frames.
    """
    path, prefix = getattr(df, "_stored_at", None), f"{partition}="
    names = names_in(df.sparkSession, path) if path else []
    found = (n.removeprefix(prefix) for n in names if n.startswith(prefix))
    return sorted((date.fromisoformat(day) for day in found if re.fullmatch(r"\d{4}-\d\d-\d\d", day)), reverse=True)


def replace_partitions(df: DataFrame, path: str, *partitions: str) -> None:
    """Replace exactly the partitions that ``df`` holds; the others are not touched."""
    (
        _spread(df, partitions[0])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
