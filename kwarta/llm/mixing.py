"""Mixing sources to target weights by balanced sampling (the cube method).

Each source gets a target in words. A document is taken floor(target / size of its source) times, and once more
with the fractional probability that is left. Rows that repeat are one unit: of their once-mores the whole number
that is due is taken for sure, and the unit stands for one document with the fraction that is left. Which
documents are taken once more is drawn by the cube method:
the vector of probabilities moves through the null space of two constraints, the source's words and its
documents, until each probability is 0 or 1. Three open documents always have a direction that keeps both
totals, so a pass over a chunk of a source moves three documents at a time and leaves a handful. What the
chunks leave is passed again, 256 chunks at a time; the last handful of a source lands where its words come
nearest to the target.
"""

from __future__ import annotations

import math
import random
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kwarta.llm.shared import WORD, written

#: Weights of sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix in shares of all words, and the most of a source in shares of its size.
SHARE, MOST = 1.5, 2.0
#: Documents that one pass of the flight settles, and chunks whose rests meet in the next.
CHUNK, MERGED = 8_192, 256

#: Repetitions of a row that one task gives out.
REPEATED = 65_536
#: Documents of a source whose landing is searched: 2 ** LANDING ways.
LANDING = 9

_NEAR = 1e-9


class Flight:
    """Moves the probabilities of one group's documents until a handful is left."""

    def __init__(self, seed: str) -> None:
        self._random, self.open, self._held = random.Random(seed), [], deque()

    def add(self, unit: list) -> list[list]:
        """unit: [probability, documents, words a document, ...]; gives back those that are settled now."""
        self._held.append(unit)
        if len(self._held) <= LANDING - 2:
            return []
        self.open.append(self._held.popleft())
        return self._move() if len(self.open) == 3 else []

    def rest(self) -> list[list]:
        """What is not settled: two open documents and those that wait."""
        units, self.open = [*self.open, *self._held], []
        self._held.clear()
        return units

    def land(self) -> list[list]:
        """Settle the rest: of all ways, the one that comes nearest to the words, then the documents, it stands for."""
        units = self.rest()

        def missed(ends: tuple[float, ...]) -> tuple[float, float]:
            off = [(end - u[0]) * u[1] for end, u in zip(ends, units, strict=True)]
            return round(abs(sum(o * u[2] for o, u in zip(off, units, strict=True))), 6), abs(sum(off))

        for unit, end in zip(units, min(product((1.0, 0.0), repeat=len(units)), key=missed), strict=True):
            unit[0] = end
        return units

    @staticmethod
    def _keeping_both(units: list[list]) -> list[float]:
        a, b, c = (u[2] for u in units)
        moves = (1.0, -1.0, 0.0) if a == b == c else (c - b, a - c, b - a)
        return [v / u[1] for v, u in zip(moves, units, strict=True)]

    def _move(self) -> list[list]:
        units = self.open
        move = self._keeping_both(units)
        up = min((((1 - u[0]) if v > 0 else -u[0]) / v for u, v in zip(units, move, strict=True) if v), default=0.0)
        down = min(((u[0] if v > 0 else u[0] - 1) / v for u, v in zip(units, move, strict=True) if v), default=0.0)
        step = up if self._random.random() * (up + down) < down else -down
        done, self.open = [], []
        for unit, v in zip(units, move, strict=True):
            unit[0] += step * v
            if unit[0] < _NEAR or unit[0] > 1 - _NEAR:
                unit[0] = 0.0 if unit[0] < 0.5 else 1.0
                done.append(unit)
            else:
                self.open.append(unit)
        return done


def _flights(level: int, land: bool):
    """A pass over rows sorted by group; every row comes back once, with its probability where it now stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, flight, schema = None, None, None

        def close() -> list[list]:
            if flight is None:
                return []
            return flight.land() if land else flight.rest()

        for batch in batches:
            schema, out = batch.schema, []
            names = schema.names
            at = [names.index(c) for c in ("_p", "_size", "_src", "_none", "_chunk")]
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                p, size, *key = (row[i] for i in at)
                if key != group:
                    out += close()
                    group, flight = key, Flight(f"{level}|{key}")
                out += flight.add([p, 1, size, row])
            yield _batch(out, schema, at[0])
        if schema is not None:
            yield _batch(close(), schema, at[0])

    return run


def _batch(units: list[list], schema: pa.Schema, p_at: int) -> pa.RecordBatch:
    columns = list(zip(*(u[3] for u in units), strict=True)) or [()] * len(schema)
    columns[p_at] = [u[0] for u in units]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], names=schema.names)


def _fly(units: DataFrame, level: int, land: bool) -> DataFrame:
    keys = ["_src", "_none", "_chunk"]
    dealt = units.repartition(*keys).sortWithinPartitions(*keys, "_order", "_key", "_size")
    return dealt.mapInArrow(_flights(level, land), units.schema)


def _levels(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Each source with its target: a common level times its weight, but at most `most` times its size."""
    n = len(weights)
    ordered, _ = written(
        sources.orderBy("_none", "_src").withColumn("_part", F.spark_partition_id()), "mix-sources")
    counts = sorted(ordered.groupBy("_part").count().collect())  # a row per partition
    starts, before = [], 0
    for part, count in counts:
        starts.append((part, before % n))
        before += count
    spark = sources.sparkSession
    first = spark.createDataFrame(starts, "_part int, _start int")
    place = F.row_number().over(Window.partitionBy("_part").orderBy("_none", "_src")) - 1
    ranked = ordered.join(F.broadcast(first), "_part").withColumn("_rank", ((place + F.col("_start")) % n).cast("int"))
    weighed = ranked.withColumn("_weight", F.element_at(F.array(*map(F.lit, map(float, weights))), F.col("_rank") + 1))
    weighed, _ = written(weighed.drop("_part", "_start", "_rank"), "mix-weights")
    most_of = F.col("source_size") * F.lit(float(most))
    total, all_weights = weighed.agg(F.sum("source_size"), F.sum("_weight")).first()
    wanted, level, held = share * (total or 0), 0.0, -1
    if total:
        level = wanted / all_weights
    while total:
        full = most_of <= F.col("_weight") * F.lit(level)
        capped, filled, open_weight = weighed.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, most_of)), F.sum(F.when(~full, F.col("_weight")))).first()
        if capped == held or not open_weight:
            break
        held, level = capped, (wanted - (filled or 0)) / open_weight
    target = F.least(most_of, F.col("_weight") * F.lit(level))
    return weighed.select("_src", "_none", "source_size", "_docs", target.alias("target"))


def plan(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", *,
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, chunk: int = CHUNK,
) -> DataFrame:
    """One row per distinct (source, doc_id, text): how often the mix takes it.

    Columns _id, _key (a hash of doc_id and text), _src, _none, _size, _rows (how often the row occurs),
    source_size, target, copies (of each of these rows) and more (rows that are taken once more). A null source is a source of
    its own, the last; a null doc_id or text (no words) is a document like others. A source without words
    has target 0 and is not taken. Empty table: no rows. The draw depends on the data only, not on partitions.
    """
    rows = docs.select(
        docs[f"`{doc_id}`"].alias("_id"),
        F.xxhash64(docs[f"`{doc_id}`"], docs[f"`{text}`"]).alias("_key"),
        F.coalesce(docs[f"`{source}`"].cast("string"), F.lit("")).alias("_src"),
        docs[f"`{source}`"].isNull().alias("_none"),
        F.coalesce(F.regexp_count(docs[f"`{text}`"], F.lit(WORD)), F.lit(0)).cast("long").alias("_size"),
    )
    units, _ = written(
        rows.groupBy("_id", "_key", "_src", "_none", "_size").agg(F.count(F.lit(1)).alias("_rows")), "mix-units")
    sources = units.groupBy("_src", "_none").agg(
        F.sum(F.col("_size") * F.col("_rows")).alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    targets = _levels(sources, weights, share, most)
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(times + F.lit(_NEAR)).cast("int")
    placed = units.join(targets, ["_src", "_none"]).select(
        "_id", "_key", "_src", "_none", "_size", "_rows", "source_size", "target", whole.alias("_whole"),
        (F.greatest(times - whole, F.lit(0.0)) * F.col("_rows")).alias("_due"),
        F.pmod(F.xxhash64("_key", F.lit(1)), F.ceil(F.col("_docs") / F.lit(float(chunk)))).alias("_chunk"),
        F.xxhash64("_key", F.lit(2)).alias("_order"),
    )
    sure = F.floor(F.col("_due") + F.lit(_NEAR))
    placed = placed.withColumns({"_sure": sure, "_p": F.greatest(F.col("_due") - sure, F.lit(0.0))}).drop("_due")
    open_p = (F.col("_p") > _NEAR) & (F.col("_p") < 1 - _NEAR)
    most_docs = targets.agg(F.max("_docs")).first()[0] or 0
    groups, level = math.ceil(most_docs / chunk), 0
    flown, _ = written(placed.where(~open_p).unionByName(_fly(placed.where(open_p), 0, False)), "mix-flight")
    settled = [flown.where(~open_p)]
    while True:
        level, groups = level + 1, math.ceil(groups / MERGED)
        rest = flown.where(open_p).withColumn("_chunk", F.floor(F.col("_chunk") / F.lit(float(MERGED))).cast("long"))
        flown, _ = written(_fly(rest, level, groups <= 1), f"mix-rest-{level}")
        settled.append(flown.where(~open_p))
        if groups <= 1:
            break
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out.select(
        "_id", "_key", "_src", "_none", "_size", "_rows", "source_size", "target",
        F.col("_whole").alias("copies"), (F.col("_sure") + F.round("_p").cast("long")).alias("more"))


def _numbered(units: DataFrame) -> DataFrame:
    """Every unit once per row, numbered from 0 in _nth; many repetitions are dealt over tasks."""
    parts = units.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1, F.lit(REPEATED).cast("long"))))
    each = F.sequence(F.col("_from"), F.least(F.col("_from") + REPEATED, F.col("_rows")) - 1)
    return parts.repartition("_key", "_from").withColumn("_nth", F.explode(each)).drop("_from")


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", **settings) -> DataFrame:
    """Per row: doc_id, size, source_size, target and taken, the words the mix takes of it (repeats counted).

    Nulls, repeated rows and empty tables are as in :func:`plan`; columns that are not named are not read.
    """
    rows = _numbered(plan(docs, text, doc_id, source, **settings))
    times = F.col("copies") + F.when(F.col("_nth") < F.col("more"), 1).otherwise(0)
    return rows.select(
        F.col("_id").alias(doc_id), F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * times).alias("taken"))


def mixed(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", **settings,
) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with all their columns, whatever their names."""
    key = ["_key", "_src", "_none"]
    units = plan(docs, text, doc_id, source, **settings).select(*key, "_rows", "copies", "more")
    # rows of other doc_ids and texts that share a hash are one unit here
    units, _ = written(units.groupBy(*key).agg(
        F.sum("_rows").alias("_rows"), F.max("copies").cast("long").alias("copies"), F.sum("more").alias("more")), "mix-taken")
    names: Iterable[str] = docs.columns
    rows = docs.select(
        *(docs[f"`{n}`"].alias(f"_in_{i}") for i, n in enumerate(names)),
        F.xxhash64(docs[f"`{doc_id}`"], docs[f"`{text}`"]).alias("_key"),
        F.coalesce(docs[f"`{source}`"].cast("string"), F.lit("")).alias("_src"), docs[f"`{source}`"].isNull().alias("_none"),
    )
    alike = (F.col("more") == 0) | (F.col("more") == F.col("_rows"))
    same = units.where(alike).select(*key, (F.col("copies") + F.when(F.col("more") > 0, 1).otherwise(0)).alias("times"))
    taken = rows.join(same.where("times > 0"), key)
    if not (unlike := units.where(~alike)).isEmpty():
        taken = taken.unionByName(_some_once_more(rows.join(unlike, key), key))
    return (
        taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        .select(*(F.col(f"_in_{i}").alias(n) for i, n in enumerate(names)))
    )


def _some_once_more(rows: DataFrame, key: list[str]) -> DataFrame:
    """Of each unit's rows `copies` each, and `more` of them once more. They are numbered by written partition: what is
    counted per unit is a row per partition."""
    kept, _ = written(rows.withColumn("_at", F.monotonically_increasing_id()), "mix-repeated")
    kept = kept.withColumn("_part", F.shiftright("_at", 33))
    counts = kept.groupBy(*key, "_part").agg(F.count(F.lit(1)).alias("_own"))
    before = F.sum("_own").over(Window.partitionBy(*key).orderBy("_part")) - F.col("_own")
    placed = kept.join(counts.withColumn("_before", before).drop("_own"), [*key, "_part"])
    nth = F.col("_before") + F.row_number().over(Window.partitionBy(*key, "_part").orderBy("_at")) - 1
    times = F.col("copies") + F.when(nth < F.col("more"), 1).otherwise(0)
    return placed.withColumn("times", times).where("times > 0").drop("_rows", "copies", "more", "_at", "_part", "_before")
