"""Keyed merge (insert-or-update) on Parquet tables, which have no MERGE INTO."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kwarta.sinks import tables


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
) -> DataFrame:
    """The rows of ``target`` after merging ``source`` into it.

    Keys only in ``target`` stay, keys only in ``source`` are inserted whole, and for keys in both
    the ``update_cols`` are replaced. By default that is every column but the keys and
    ``created_at``, so rebuilding a day gives the same row as building it once. Keys are unique on
    both sides. One full outer join: a shuffle of each side on the key, no group is ever collected.
    """
    columns = target.columns
    if update_cols is None:
        update_cols = [c for c in columns if c not in keys and c != "created_at"]
    unknown = set(update_cols) - set(columns)
    if unknown:
        raise ValueError(f"not columns of the target: {sorted(unknown)}")
    old, new = target.alias("old"), source.select(*columns).alias("new")
    joined = old.withColumn("_stored", F.lit(True)).alias("old").join(
        new.withColumn("_fresh", F.lit(True)).alias("new"),
        [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys],
        "full_outer",
    )
    stored, fresh = F.col("_stored").isNotNull(), F.col("_fresh").isNotNull()

    def pick(name: str) -> Column:
        take_new = fresh if name in update_cols or name in keys else fresh & ~stored
        return F.when(take_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    return joined.select(*[pick(c) for c in columns])


def merge_by_key(
    path: str,
    source: DataFrame,
    keys: list[str],
    partition: str,
    touched: list[date],
    update_cols: list[str] | None = None,
) -> None:
    """Merge ``source`` into the table at ``path``, rewriting only the partitions in ``touched``.

    ``touched`` must name every partition value the source holds; a daily build knows its own.
    The new files are staged by Spark's dynamic partition overwrite and put in place when all tasks
    have succeeded, so reading the old ones in the same job is safe and a failed job changes nothing.
    """
    spark = source.sparkSession
    inside = F.col(partition).isin(*touched)
    if not tables.exists(spark, path):
        tables.replace_partitions(source.filter(inside), path, partition)
        return
    target = tables.read(spark, path).filter(inside)
    merged = merge_rows(target, source.filter(inside), keys, update_cols)
    tables.replace_partitions(merged, path, partition)
