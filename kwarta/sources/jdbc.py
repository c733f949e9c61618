"""Tables in a relational database, read and written through Spark's JDBC source.

Needs the database's driver on the class path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    driver: str
    user: str
    password: str
    # Connection properties of the driver itself, such as stringtype=unspecified.
    properties: dict[str, str] = field(default_factory=dict)

    def options(self, table: str) -> dict[str, str]:
        return {
            "url": self.url, "driver": self.driver, "user": self.user, "password": self.password,
            "dbtable": table, **self.properties,
        }


@dataclass(frozen=True)
class Split:
    """How to read a table in parallel: ranges of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column, "lowerBound": self.lower,
            "upperBound": self.upper, "numPartitions": str(self.parts),
        }


def read_options(db: Database, table: str, split: Split | None = None, fetch: int = 10_000) -> dict[str, str]:
    return {**db.options(table), "fetchsize": str(fetch), **(split.options() if split else {})}


def write_options(db: Database, table: str, connections: int = 16, rows: int = 10_000) -> dict[str, str]:
    return {**db.options(table), "numPartitions": str(connections), "batchsize": str(rows)}


def read(spark: SparkSession, db: Database, table: str, split: Split | None = None) -> DataFrame:
    """A table as a DataFrame. Without a ``split`` it comes through one connection into one task,
    which only suits small tables; projections and filters are pushed to the database either way."""
    return spark.read.format("jdbc").options(**read_options(db, table, split)).load()


def append(df: DataFrame, db: Database, table: str, connections: int = 16) -> None:
    """Append rows that are known to be new. Duplicates are removed before (see ``load.new_rows``):
    an error from the database is an error."""
    df.write.format("jdbc").options(**write_options(db, table, connections)).mode("append").save()


def exists(spark: SparkSession, db: Database, table: str) -> bool:
    """Whether the table is listed in the database's catalogue."""
    schema, _, name = table.rpartition(".")
    where = f"table_name = '{name}'" + (f" AND table_schema = '{schema}'" if schema else "")
    probe = f"(SELECT table_name FROM information_schema.tables WHERE {where}) AS probe"
    return not spark.read.format("jdbc").options(**db.options(probe)).load().isEmpty()
