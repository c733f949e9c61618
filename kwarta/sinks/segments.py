"""Keyed tables in sorted segments: the rows of a few keys are found without reading the others.

A load adds one segment, its rows sorted by the hash of their key, in short Parquet pages. When there are FAN
segments of a level they are folded into one of the next, so a table of any age has a few dozen. A search has
the hashes of its keys as a list: files are chosen by their bounds, row groups and pages by theirs (Parquet's
column index), so each key costs one page per large segment, whatever the segment's size. A list longer than a
segment has pages goes over it in one plain scan of its hashes.

A Bloom filter per row group would not help: a list of n keys passes one of error e with probability
1 - (1 - e)^n, so thousands of keys pass nearly all of them, while page bounds tell keys one by one.

A segment counts from the moment its entry stands in the log, one small file; the entry of a fold names the
segments it replaces. One writer at a time: a load, or a fold between two loads.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kwarta import schemas
from kwarta.sinks import tables

#: Segments of a level that are folded into one, rows of a page, and rows of a file.
FAN, PAGE_ROWS, FILE_ROWS = 8, 1_000, 4_000_000
#: Hashes that one scan compares page by page; the comparison is a chain of as many alternatives.
LISTED_AT_ONCE = 1_000
_LISTING = "spark.sql.parquet.pushdown.inFilterThreshold"
_FIRST = 0


@dataclass(frozen=True)
class Kind:
    """The key of a table, its columns beside `key_hash`, and how the rows of several loads become fewer, if they do."""

    key: str
    schema: T.StructType
    merged: Callable[[DataFrame], DataFrame] | None = None


def _merged_stretches(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id", "stretch").agg(
        F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.lit(None).cast("string").alias("load_id"))


KINDS = {
    "event_keys": Kind("transaction_id", schemas.EVENT_KEYS),
    "user_keys": Kind("user_id", schemas.USER_KEYS),
    "merchant_keys": Kind("merchant_id", schemas.MERCHANT_KEYS),
    "user_stretches": Kind("user_id", schemas.STRETCHES, _merged_stretches),
}


@dataclass(frozen=True)
class Segment:
    """A segment as its log entry has it. `files` are name, least and greatest hash, by hash; none if there is one file."""

    path: str
    name: str
    level: int
    rows: int
    files: tuple[tuple[str, int, int], ...]
    replaces: tuple[str, ...]


def kind_of(path: str) -> Kind:
    return KINDS[path.rstrip("/").rsplit("/", 1)[-1]]


def _stored_schema(kind: Kind) -> T.StructType:
    return T.StructType([T.StructField("key_hash", T.LongType()), *kind.schema.fields])


def hash_of(key: Column | str) -> Column:
    """The hash a table is sorted by."""
    return F.xxhash64(key)


def create(spark: SparkSession, path: str) -> None:
    """An empty table, unless it is there."""
    tables.make_folder(spark, f"{path}/_log")


_entries: dict[str, dict[str, Segment]] = {}  # by table and name: an entry never changes


def segments(spark: SparkSession, path: str) -> list[Segment]:
    """The segments that count, by one listing of the log."""
    known, found = _entries.get(path, {}), {}
    for name in tables.names_in(spark, f"{path}/_log"):
        if name.endswith(".json"):
            found[name] = known.get(name) or _entry(path, name, json.loads(tables.text_of(spark, f"{path}/_log/{name}")))
    _entries[path] = found
    gone = {name for segment in found.values() for name in segment.replaces}
    return sorted((s for s in found.values() if s.name not in gone), key=lambda s: (-s.level, s.name))


def _entry(path: str, file: str, entry: dict) -> Segment:
    name = file.removesuffix(".json")
    files = tuple((n, low, high) for n, low, high in entry["files"])
    return Segment(f"{path}/{name}", name, entry["level"], entry["rows"], files, tuple(entry["replaces"]))


def _nothing(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, and known to the optimizer for it."""
    return spark.range(1).filter(F.lit(False)).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))


def read(spark: SparkSession, path: str, some: Sequence[Segment] | None = None) -> DataFrame:
    """All rows of the segments."""
    schema = _stored_schema(kind_of(path))
    chosen = segments(spark, path) if some is None else some
    if not chosen:
        return _nothing(spark, schema)
    return spark.read.schema(schema).parquet(*(s.path for s in chosen))


def _write(rows: DataFrame, path: str, name: str, level: int, replaces: Sequence[str], few: bool) -> int:
    """A new segment and then its log entry; without rows there is neither. Back comes the number of rows."""
    spark, kind, place = rows.sparkSession, kind_of(path), f"{path}/{name}"
    seen = Observation()
    ready = tables.conform(rows, kind.schema).select(hash_of(kind.key).alias("key_hash"), *kind.schema.names)
    ordered = ready.coalesce(1).sortWithinPartitions("key_hash") if few else ready.orderBy("key_hash")
    (
        ordered.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        .option("parquet.page.row.count.limit", PAGE_ROWS).option("maxRecordsPerFile", FILE_ROWS).parquet(place)
    )
    count = seen.get["rows"]
    if not count:
        tables.remove(spark, place)
        if not replaces:
            return 0
    files = []
    if count and not few:
        own = F.col("_metadata.file_name").alias("file")
        bounds = spark.read.schema("key_hash bigint").parquet(place).select(own, "key_hash").groupBy("file").agg(
            F.min("key_hash").alias("low"), F.max("key_hash").alias("high"))
        files = sorted(map(list, bounds.collect()), key=lambda f: f[1:])
    entry = {"level": level, "rows": count, "files": files, "replaces": list(replaces)}
    tables.put_text(spark, f"{path}/_log/{name}.json", json.dumps(entry))
    return count


def append(rows: DataFrame, path: str, load: str, few: bool = False) -> int:
    """Store a load's rows as a segment of their own. `few`: one task is enough for them. Back comes their number."""
    return _write(rows, path, f"l0-{load}-{uuid.uuid4().hex}", _FIRST, (), few)


def load_of(segment: Segment) -> str:
    """The load that wrote a segment of the first level."""
    return segment.name.removeprefix("l0-").rpartition("-")[0]


def fold(spark: SparkSession, path: str, finished: Callable[[str], bool] = lambda load: True, fan: int | None = None) -> int:
    """Fold every level that has `fan` segments (default: FAN) into one of the next, the lowest first. Back comes how often.

    `finished` tells of a load whether it is: only then may what it stored lose its name.
    Folders that an earlier fold replaced go now, after their last readers.
    """
    _sweep(spark, path)
    kind, fan, folds, level = kind_of(path), fan or FAN, 0, _FIRST
    while level <= max((s.level for s in segments(spark, path)), default=-1):
        some = [s for s in segments(spark, path) if s.level == level]
        if len(some) >= fan:
            some = [s for s in some if level > _FIRST or finished(load_of(s))]
        if len(some) >= fan:
            rows = read(spark, path, some).drop("key_hash")
            few = sum(s.rows for s in some) <= FILE_ROWS // 4
            _write(kind.merged(rows) if kind.merged else rows, path, f"l{level + 1}-{uuid.uuid4().hex}", level + 1, [s.name for s in some], few)
            folds += 1
        level += 1
    return folds


def is_due(spark: SparkSession, path: str, fan: int | None = None) -> bool:
    """Whether some level has as many segments as are folded into one."""
    levels = [s.level for s in segments(spark, path)]
    return any(levels.count(level) >= (fan or FAN) for level in set(levels))


def _sweep(spark: SparkSession, path: str) -> None:
    """Remove the folders, then the log entries, of replaced segments."""
    now = {f"{s.name}.json" for s in segments(spark, path)}
    for file in tables.names_in(spark, f"{path}/_log"):
        if file.endswith(".json") and file not in now:
            tables.remove(spark, f"{path}/{file.removesuffix('.json')}")
            tables.remove(spark, f"{path}/_log/{file}")


def _in_list(hashes: Sequence[int]) -> Column:
    return F.expr(f"key_hash IN ({', '.join(f'{h}L' if h > -2**63 else '-9223372036854775807L - 1L' for h in hashes)})")


def _holds(hashes: Sequence[int], low: int, high: int) -> bool:
    at = bisect_left(hashes, low)
    return at < len(hashes) and hashes[at] <= high


def lookup(spark: SparkSession, path: str, hashes: Sequence[int], columns: Sequence[str] | None = None) -> DataFrame:
    """The stored rows whose key has one of the hashes, `key_hash` among the columns: other keys of these hashes too."""
    if int(spark.conf.get(_LISTING)) < LISTED_AT_ONCE:
        spark.conf.set(_LISTING, str(LISTED_AT_ONCE))  # or a longer list would only be compared by its least and greatest
    schema, wanted, current = _stored_schema(kind_of(path)), sorted(set(hashes)), segments(spark, path)
    names = list(columns or schema.names)
    nothing = _nothing(spark, schema).select(names)
    if not wanted or not current:
        return nothing
    small = [s for s in current if 2 * s.rows <= len(wanted) * PAGE_ROWS]
    parts = [read(spark, path, small).where(_in_list(wanted))] if small else []
    large = [s for s in current if s not in small]
    for start in range(0, len(wanted) if large else 0, LISTED_AT_ONCE):
        some = wanted[start : start + LISTED_AT_ONCE]
        files = [f"{s.path}/{name}" for s in large for name, low, high in s.files if _holds(some, low, high)]
        files += [s.path for s in large if not s.files]
        if files:
            parts.append(spark.read.schema(schema).parquet(*files).where(_in_list(some)))
    return reduce(DataFrame.unionByName, [p.select(names) for p in parts], nothing)


def known_hashes(spark: SparkSession, path: str, hashes: Sequence[int]) -> list[int]:
    """Those of the hashes that are stored. Only the column of hashes is read."""
    return [h for (h,) in lookup(spark, path, hashes, ["key_hash"]).distinct().collect()]
