"""Keyed operators: first row per key, missing keys, lookups.

A single key may hold a large share of all rows. Everything here either reduces such a key on the
map side, before any shuffle, or leaves the skewed side of a join splittable by AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kwarta.sinks import tables


def first_per_key(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key in the given order.

    Filtering ``row_number() = 1`` lets Spark put a group limit below the shuffle, so each map
    task sends at most one row per key, hot keys included.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")
    )


def _keys_in_use(stored: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of ``stored`` that ``rows`` names. Where the rows are few, as in a cached micro-batch, their
    keys go to the stored table's scan and the table is not shuffled; the optimizer decides by their size."""
    return stored.select(*keys).join(rows.select(*keys), keys, "left_semi")


def missing_from(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored yet (left anti). Only the keys of ``stored`` are read."""
    return rows.join(_keys_in_use(stored, rows, keys), keys, "left_anti")


def present_in(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is stored (left semi). Equal to an inner join on a unique key, but needs
    no column of the other side and cannot multiply rows."""
    return rows.join(stored.select(*keys), keys, "left_semi")


def lookup(rows: DataFrame, dim: DataFrame, key: str, columns: list[str | Column]) -> DataFrame:
    """Left join with a dimension that has one row per key.

    Null keys match nothing, yet an outer join hashes them all to one task. They take the row's own
    hash, marked so that it matches nothing, instead. A hot key that does match is split by AQE's skew join.
    """
    spread = F.concat(F.lit("\u0000"), F.xxhash64(*rows.columns).cast("string"))
    right = dim.select(F.col(key).alias("_dim_key"), *columns)
    joined = rows.withColumn("_row_key", F.coalesce(F.col(key), spread)).join(
        right, F.col("_row_key") == F.col("_dim_key"), "left"
    )
    return joined.drop("_row_key", "_dim_key")


def newest_partitions(rows: DataFrame, limit: int, partition: str = "event_date", kept: Column | None = None) -> DataFrame:
    """The newest partitions of a stored table that hold ``limit`` rows, for an order that begins with them.

    Partitions are counted from the newest on, twice as many each time, until there are enough: no file of an
    older one is opened. That is a small job per doubling, while the report is being built. A frame that is not a
    stored table comes back as it is.
    """
    days, take = tables.stored_dates(rows, partition), 1
    while take < len(days):
        some = rows.filter(F.col(partition) >= F.lit(days[take - 1]))
        if (some if kept is None else some.filter(kept)).limit(limit).count() >= limit:
            return some
        take *= 2
    return rows


def newest(rows: DataFrame, order: list[Column], limit: int | None) -> DataFrame:
    """The first ``limit`` rows in the given order (all of them, sorted, when it is None)."""
    ordered = rows.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)
