"""Files as a source of payloads or of rows, for a batch and for a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Text files with one JSON payload per line."""
    return spark.read.text(path)


def stream_payloads(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def stream_parquet(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str = "*.parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files of one folder whose names match, as they appear.

    Zone-less timestamps become instants, because watermarks are only defined on those.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.parquet(folder)
    return rows.select(
        *[
            F.col(f.name).cast("timestamp").alias(f.name)
            if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
            for f in schema.fields
        ]
    )
