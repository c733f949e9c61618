"""Approximate nearest neighbours by adaptive dimension scans over inverted lists.

Vectors are rotated at random and filed under the nearest of a set of centres. A query scans the lists of its
nearest centres. A list is kept in blocks, and a block is scanned by columns: after every few dimensions the
partial distance, scaled to all dimensions, is tested against the query's current k-th distance, and candidates
that almost surely lie beyond are abandoned. The random rotation makes that test hold for any data. Distances
reported are those of the original vectors.

Blocks are dealt in groups, a task's each. A query goes once to each group that holds a list it probes, with the
numbers of its blocks there, and streams past the group's vectors: nothing is broadcast that grows with either.

Equal vectors are one entry that holds their k + 1 smallest ids, which are all that can be among the k nearest,
so a very common vector is one row of its list, and one query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kwarta.llm.shared import remove, written

#: Vectors the centres are fitted on and that give first bounds, in expectation; vectors per list aimed at; rounds.
SAMPLE, PER_LIST, ROUNDS = 20_000, 500, 8
#: Most centres; lists then grow with the data, and are split into blocks all the same.
MOST_LISTS = 4_096
#: Share of the sample's own nearest neighbours that the probed lists hold, and sample queries it is measured on.
RECALL, MEASURED = 0.97, 256
#: Vectors of a block, queries of a pack, rows scanned before bounds shrink, and dimensions between two tests.
BLOCK, PACK, CHUNK, STEP = 2_048, 256, 512, 16
#: Components of a group's vectors, at 8 bytes each in a task; groups per core, if there are blocks for them.
GROUP, SPREAD = 8_000_000, 4
#: Queries whose hits a task holds at once, and hits of them before the farthest are left out.
ASKED, HITS = 1_024, 2_000_000
#: Numbers in a matrix of distances to centres, or of differences.
CELLS = 1 << 20
#: Queries whose distances to all centres a task holds at once.
PROBED = 512
#: How far in standard deviations a partial distance may mislead the test.
EPSILON = 2.1
#: Share of the squared lengths that rounding may add to a partial distance or take from it.
ROUNDING = 1e-13
#: Times the rows asked for that a pack may find in a block, before single rows are compared without rounding of products.
LOOSE = 4


class Model:
    """The rotation, the centres, and rotated sample vectors for first bounds."""

    def __init__(self, sample: np.ndarray, rows: int, seed: int, per_list: int) -> None:
        draw = np.random.default_rng(seed)
        size = sample.shape[1]
        self.rotation = np.linalg.qr(draw.standard_normal((size, size)))[0]
        turned = sample @ self.rotation
        lists = int(np.clip(rows // per_list, 1, min(MOST_LISTS, max(1, len(sample) // 4))))
        centres = turned[np.sort(draw.choice(len(turned), lists, replace=False))]
        for _ in range(ROUNDS):
            near = self._nearest(turned, centres, 1)[:, 0]
            sums = np.zeros_like(centres)
            np.add.at(sums, near, turned)
            counts = np.bincount(near, minlength=lists)
            centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        self.centres = centres
        self.sample = turned[:4_096]
        self._turned = turned

    def probes(self, k: int, recall: float) -> int:
        """Nearest lists that hold that share of the k nearest neighbours, measured within the sample.

        Neighbours in the sample lie farther off than those in all data, so it is no fewer than all data need.
        """
        turned = self._turned
        asked = turned[:: max(1, len(turned) // MEASURED)][:MEASURED]
        home, order = self.lists(turned, 1)[:, 0], self.lists(asked, len(self.centres))
        near = min(k + 1, len(turned))
        rank = np.argsort(order, axis=1)
        found = [rank[i, home[np.argpartition(_squares(asked[i : i + 1], turned)[0], near - 1)[:near]]] for i in range(len(asked))]
        return int(np.quantile(np.concatenate(found), recall, method="higher")) + 1

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_turned"}

    @staticmethod
    def _nearest(vectors: np.ndarray, centres: np.ndarray, count: int) -> np.ndarray:
        out = np.empty((len(vectors), count), np.int64)
        rows = max(1, min(1_024, CELLS // len(centres)))
        for i in range(0, len(vectors), rows):
            d = _squares(vectors[i : i + rows], centres)
            if count == 1:
                out[i : i + rows, 0] = d.argmin(axis=1)
                continue
            best = np.argpartition(d, count - 1, axis=1)[:, :count] if count < d.shape[1] else np.tile(np.arange(d.shape[1]), (len(d), 1))
            order = np.argsort(np.take_along_axis(d, best, 1), axis=1, kind="stable")
            out[i : i + rows] = np.take_along_axis(best, order, 1)
        return out

    def lists(self, turned: np.ndarray, count: int) -> np.ndarray:
        """Numbers of the nearest lists, nearest first."""
        return self._nearest(turned, self.centres, min(count, len(self.centres)))

    def probed(self, turned: np.ndarray, counts: np.ndarray, need: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query's place and a list to scan: the nearest `probes`, and further ones until `need` entries are there."""
        nearest = self.lists(turned, probes)
        places, found = [np.repeat(np.arange(len(turned)), nearest.shape[1])], [nearest.ravel()]
        short = np.flatnonzero(counts[nearest].sum(axis=1) < need)
        if len(short):
            order = self.lists(turned[short], len(self.centres))
            enough = (np.cumsum(counts[order], axis=1) < need).sum(axis=1) + 1
            at = np.arange(order.shape[1])[None, :]
            q, more = np.nonzero((at >= nearest.shape[1]) & (at < enough[:, None]))
            places.append(short[q])
            found.append(order[q, more])
        return np.concatenate(places), np.concatenate(found)

    def bounds(self, turned: np.ndarray, k: int) -> np.ndarray:
        """Per query a squared distance within which k entries lie for sure."""
        if len(self.sample) < k:
            return np.full(len(turned), np.inf)
        return np.concatenate([
            np.partition(_squares(turned[i : i + 512], self.sample), k - 1, axis=1)[:, k - 1] for i in range(0, len(turned), 512)
        ]) * (1 + 1e-9) + 1e-9


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T, 0.0)


def scan(block: np.ndarray, query: np.ndarray, bound: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a rotated block that may be among the k nearest, with their squared distances.

    `block` is stored by columns: (dimensions, rows). Candidates go while the test rejects that they lie within
    the bound, which shrinks as full distances become known.
    """
    size, rows = block.shape
    kept_rows, kept = np.zeros(0, np.int64), np.zeros(0)
    for first in range(0, rows, 512):
        alive = np.arange(first, min(first + 512, rows))
        part = np.zeros(len(alive))
        for at in range(0, size, STEP):
            columns = block[at : at + STEP, alive] - query[at : at + STEP, None]
            part += (columns * columns).sum(0)
            seen = min(at + STEP, size)
            if seen < size:
                stays = part * (size / seen) <= bound * (1 + EPSILON / np.sqrt(seen)) ** 2
                if not stays.all():
                    alive, part = alive[stays], part[stays]
                    if not len(alive):
                        break
        inside = part <= bound
        kept_rows, kept = np.concatenate([kept_rows, alive[inside]]), np.concatenate([kept, part[inside]])
        if len(kept) > k:
            least = np.partition(kept, k - 1)[k - 1]
            bound = min(bound, least * (1 + 1e-9) + 1e-12)
            kept_rows, kept = kept_rows[kept <= bound], kept[kept <= bound]
    return kept_rows, kept


class Block:
    """Rows of a list, ready to be scanned for many queries at once: by steps, about their middle."""

    def __init__(self, turned: np.ndarray) -> None:
        self.rows, self.size = turned.shape
        self.middle = turned.mean(0)
        parts = _by_steps(turned - self.middle)
        lengths = (parts * parts).sum(2)
        self.longest = lengths.sum(0).max()
        self.steps = np.concatenate([parts, np.ones_like(lengths)[:, :, None], lengths[:, :, None]], axis=2)

    def scan(self, queries: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Places of queries and of rows that may be among the k nearest: what :func:`scan` finds, query by query.

        Partial distances of all pairs are one product per step, until few pairs are left. None: too large to be squared.
        """
        parts = _by_steps(queries - self.middle)
        lengths = (parts * parts).sum(2)
        slack = ROUNDING * (lengths.sum(0) + self.longest)
        if not np.isfinite(slack).all():
            return None
        asked = np.concatenate([-2.0 * parts, lengths[:, :, None], np.ones_like(lengths)[:, :, None]], axis=2)
        bounds, kept = bounds.copy(), [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        for first in range(0, self.rows, CHUNK):
            rows = self.steps[:, first : first + CHUNK]
            part, alive, pairs = np.zeros((len(queries), rows.shape[1])), None, None
            for step in range(len(rows)):
                if pairs is None:
                    part += asked[step] @ rows[step].T
                else:
                    q, r = pairs
                    part = part + ((parts[step, q] - rows[step, r, :STEP]) ** 2).sum(1)
                seen = min((step + 1) * STEP, self.size)
                most = (bounds * (1 + EPSILON / np.sqrt(seen)) ** 2 * (seen / self.size) if seen < self.size else bounds) + slack
                if pairs is None:
                    alive = part <= most[:, None] if alive is None else alive & (part <= most[:, None])
                    if seen == self.size or 8 * np.count_nonzero(alive) < alive.size:
                        pairs = np.nonzero(alive)
                        part = part[pairs]
                else:
                    stays = part <= most[q]
                    pairs, part = (q[stays], r[stays]), part[stays]
                if pairs is not None and not len(part):
                    break
            kept = [np.concatenate(x) for x in zip(kept, (pairs[0], pairs[1] + first, part), strict=True)]
            q, r, d = kept
            if (np.bincount(q, minlength=len(queries)) > k).any():
                kth = _least(q, d, np.zeros(len(q)), k, rank=k - 1)
                bounds[q[kth]] = np.minimum(bounds[q[kth]], d[kth] * (1 + 1e-9) + 1e-12 + slack[q[kth]])
                stays = d <= bounds[q]
                kept = [q[stays], r[stays], d[stays]]
        return kept[0], kept[1]


def _by_steps(vectors: np.ndarray) -> np.ndarray:
    """(steps, rows, STEP): the last step is filled up with zeros."""
    padded = np.pad(vectors, ((0, 0), (0, -vectors.shape[1] % STEP)))
    return np.ascontiguousarray(padded.reshape(len(vectors), -1, STEP).transpose(1, 0, 2))


def _least(q: np.ndarray, d: np.ndarray, ids: np.ndarray, k: int, rank: int | None = None) -> np.ndarray:
    """Places of each query's k least by distance and id; of the one of that rank alone, where there is one."""
    order = np.lexsort((ids, d, q))
    at = np.arange(len(order))
    starts = np.flatnonzero(np.diff(q[order], prepend=-1))
    ranks = at - np.repeat(starts, np.diff(starts, append=len(order)))
    return order[ranks < k if rank is None else ranks == rank]


class Group:
    """The vectors of the blocks that a task holds, and the search in them."""

    def __init__(self, number: int, known: Model, size: int, need: int) -> None:
        self.number, self.known, self.size, self.need = number, known, size, need
        self._taken: list[pa.RecordBatch] = []
        self._blocks: dict[int, tuple[int, Block]] = {}

    def take(self, rows: pa.RecordBatch) -> None:
        """Rows of the group, by unit."""
        self._taken.append(rows)

    def _close(self) -> None:
        rows = pa.Table.from_batches(self._taken).select(["unit", "v", "ids"]).combine_chunks()
        self._taken = []
        v, ids = rows.column("v").chunk(0), rows.column("ids").chunk(0)
        self._vectors = v.flatten().to_numpy().reshape(-1, self.size)
        self._many = ids.value_lengths().to_numpy()
        self._ids, self._at = ids.flatten().to_numpy(), np.cumsum(self._many) - self._many
        units, starts = np.unique(rows.column("unit").to_numpy(), return_index=True)
        for unit, start, end in zip(units.tolist(), starts.tolist(), [*starts[1:].tolist(), len(v)], strict=True):
            self._blocks[unit] = start, Block(self._turned(start, end))

    def _turned(self, start: int, end: int) -> np.ndarray:
        return self._vectors[start:end].astype(float) @ self.known.rotation

    def _hits(self, unit: int, turned: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, block = self._blocks[unit]
        found = block.scan(turned, bounds, self.need)
        if found is None or len(found[0]) > LOOSE * self.need * len(turned):
            columns = np.ascontiguousarray(self._turned(start, start + block.rows).T)
            each = [scan(columns, one, bound, self.need)[0] for one, bound in zip(turned, bounds, strict=True)]
            found = np.repeat(np.arange(len(each)), list(map(len, each))), np.concatenate(each)
        return found[0], found[1] + start

    def _distances(self, queries: np.ndarray, q: np.ndarray, row: np.ndarray) -> np.ndarray:
        few = max(1, CELLS // self.size)
        pieces = [np.zeros(0)]
        for at in range(0, len(q), few):
            apart = self._vectors[row[at : at + few]].astype(float) - queries[q[at : at + few]]
            pieces.append(np.sqrt((apart**2).sum(1)))
        return np.concatenate(pieces)

    def near(self, asking: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """(q, vec_id, score): the nearest of the group, as many as any answer needs."""
        if self._taken:
            self._close()
        for low in range(0, asking.num_rows, ASKED):
            batch = asking.slice(low, ASKED)
            queries, bounds = _matrix(batch.column("v"), self.size), batch.column("bound").to_numpy()
            turned, units = queries @ self.known.rotation, batch.column("units")
            places = np.repeat(np.arange(len(queries)), units.value_lengths().to_numpy())
            unit = units.flatten().to_numpy()
            order = np.argsort(unit, kind="stable")
            hits, waiting = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))], 0
            for some in np.split(order, np.flatnonzero(np.diff(unit[order])) + 1):
                for at in range(0, len(some), PACK):
                    pack = places[some[at : at + PACK]]
                    q, row = self._hits(int(unit[some[at]]), turned[pack], bounds[pack])
                    exact, many = self._distances(queries, pack[q], row), self._many[row]
                    first = np.repeat(self._at[row] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                    hits.append((np.repeat(pack[q], many), np.repeat(exact, many), self._ids[first]))
                    waiting += len(first)
                    if waiting > HITS:
                        hits, waiting = [self._nearest(hits)], 0
            q, d, ids = self._nearest(hits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(q)), pa.array(ids, pa.int64()), pa.array(d)], names=["q", "vec_id", "score"])

    def _nearest(self, hits: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        q, d, ids = (np.concatenate(x) for x in zip(*hits, strict=True))
        least = _least(q, d, ids, self.need)
        return q[least], d[least], ids[least]


class Deal:
    """Which blocks a list has, by number, and which group holds a block: even in rows, as far as blocks allow."""

    def __init__(self, rows: np.ndarray, size: int, cores: int) -> None:
        self.parts = -(-rows // BLOCK)
        self.first = np.cumsum(self.parts) - self.parts
        sizes = np.repeat(rows / np.maximum(self.parts, 1), self.parts)
        self.groups = int(min(len(sizes), max(SPREAD * cores, -(-int(rows.sum()) * size // GROUP))))
        self.group = np.zeros(len(sizes), np.int32)
        load = [(0.0, g) for g in range(self.groups)]
        for unit in np.argsort(-sizes, kind="stable"):
            most, g = load[0]
            self.group[unit] = g
            heapq.heapreplace(load, (most + sizes[unit], g))

    def by_list(self) -> list[tuple[int, int, list[int]]]:
        """(list, number of its first block, group of each of its blocks), of lists that are not empty."""
        held = np.flatnonzero(self.parts)
        return [(int(x), int(self.first[x]), self.group[self.first[x] : self.first[x] + self.parts[x]].tolist()) for x in held]

    def asked(self, places: np.ndarray, lists: np.ndarray) -> Iterator[tuple[int, np.ndarray, pa.ListArray]]:
        """Of pairs of a query's place and a list: per group the places, and for each the blocks to scan."""
        many = self.parts[lists]
        units = np.repeat(self.first[lists] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        places, group = np.repeat(places, many), self.group[units]
        order = np.lexsort((units, places, group))
        places, units, group = places[order], units[order].astype(np.int32), group[order]
        for at in np.split(np.arange(len(group)), np.flatnonzero(np.diff(group)) + 1):
            if len(at):
                starts = np.flatnonzero(np.diff(places[at], prepend=-1))
                blocks = pa.ListArray.from_arrays(pa.array(np.append(starts, len(at)), pa.int32()), pa.array(units[at]))
                yield int(group[at[0]]), places[at][starts], blocks


def _usable(vectors: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """(id, v): rows that take part. Single precision stays so, at half the bytes; Python reckons in double."""
    v = vectors[f"`{vector}`"]
    kind = vectors.select(v).schema[0].dataType
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)):
        v = v.cast("array<double>")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(vectors[f"`{vec_id}`"].cast("long").alias("id"), v.alias("v")).where(usable & F.col("id").isNotNull())


def _hashed() -> Column:
    """The hash of a vector, whatever its precision."""
    return F.xxhash64(F.col("v").cast("array<double>"))


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): distinct vectors with their k + 1 smallest ids."""
    by = Window.partitionBy("h", "v").orderBy("id")  # sorting compares hashes, and vectors only of the same hash
    # the limit below the shuffle leaves each task k + 1 rows of a vector, which are collected where they meet
    least = rows.distinct().withColumn("h", _hashed()).withColumn("r", F.row_number().over(by)).where(F.col("r") <= k + 1)
    ids = F.collect_list("id").over(by.rowsBetween(0, k))
    return least.withColumn("ids", ids).where(F.col("r") == 1).select("v", "ids")


def search(
    vectors: DataFrame, queries: DataFrame, k: int, vector: str = "embedding", vec_id: str = "vec_id", *,
    recall: float = RECALL, sample: int = SAMPLE, per_list: int = PER_LIST, seed: int = 7,
) -> DataFrame:
    """(query_id, rank, vec_id, score): per row of queries the k nearest found, nearest first, ties by vec_id.

    score is the Euclidean distance in double precision. A query's own id is no candidate. Vectors that are null,
    empty, zero, or hold a null or non-finite component take no part, nor rows without an id, nor vectors of
    another length than most have. A query with fewer than k candidates gets all of them. Repeated rows of
    one id and vector are one candidate and one query. Empty tables: no rows.
    """
    spark = vectors.sparkSession
    all_entries, entries_path = written(_entries(_usable(vectors, vector, vec_id), k), "ann-entries")
    sizes = all_entries.groupBy(F.size("v").alias("size")).agg(F.sum(F.size("ids")).alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not sizes:
        return nothing
    size = sizes[0]["size"]
    entries = all_entries.where(F.size("v") == size)
    rows = entries.count()
    draw = F.pmod(_hashed(), F.lit(1_000_003)) < F.lit(int(1_000_003 * min(1.0, sample / rows)) + 1)
    drawn = entries.where(draw).select("v").orderBy(_hashed(), "v").limit(2 * sample).toArrow().column(0)
    if not len(drawn):
        drawn = entries.select("v").limit(sample).toArrow().column(0)
    model = Model(_matrix(drawn.combine_chunks(), size), rows, seed, per_list)
    sent = spark.sparkContext.broadcast(model)
    need, probes = k + 1, model.probes(k, recall)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            if batch.num_rows:
                turned = _matrix(batch.column(0), size) @ known.rotation
                lists = known.lists(turned, 1)[:, 0]
                yield pa.RecordBatch.from_arrays([pa.array(lists), batch.column(0), batch.column(1)], names=["list", "v", "ids"])

    kind = entries.schema["v"].dataType.simpleString()
    filed, filed_path = written(entries.select("v", "ids").mapInArrow(file, f"list long, v {kind}, ids array<long>"), "ann-lists")
    remove(spark, [entries_path])
    counts, held = np.zeros((2, len(model.centres)), np.int64)
    for r in filed.groupBy("list").agg(F.sum(F.size("ids")).alias("n"), F.count(F.lit(1)).alias("rows")).collect():  # a row per list
        counts[r["list"]], held[r["list"]] = r["n"], r["rows"]
    deal = Deal(held, size, spark.sparkContext.defaultParallelism)
    dealt = spark.sparkContext.broadcast((counts, deal))
    asked, _ = written(_usable(queries, vector, vec_id).where(F.size("v") == size).distinct(), "ann-queries")
    searched, _ = written(asked.groupBy("v").agg(F.min("id").alias("q")), "ann-searched")  # equal queries: one search
    # v of both sides has one type, as a group has them in one table
    both = kind if asked.schema["v"].dataType.simpleString() == kind else "array<double>"

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, deal = dealt.value
        for whole in batches:
            for low in range(0, whole.num_rows, PROBED):
                batch = whole.slice(low, PROBED)
                turned = _matrix(batch.column(0), size) @ sent.value.rotation
                bounds = sent.value.bounds(turned, need)
                for group, q, blocks in deal.asked(*sent.value.probed(turned, counts, need, probes)):
                    at = pa.array(q)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(q), group, np.int32)), batch.column(1).take(at), batch.column(0).take(at),
                         pa.array(bounds[q]), blocks],
                        names=["g", "id", "v", "bound", "units"])

    asking = searched.select(F.col("v").cast(both).alias("v"), "q").mapInArrow(
        probe, f"g int, id long, v {both}, bound double, units array<int>")
    lists = spark.createDataFrame(deal.by_list(), "list long, first int, groups array<int>")
    part = F.pmod(_hashed(), F.size("groups")).cast("int")
    members = filed.join(F.broadcast(lists), "list").select(
        F.get("groups", part).alias("g"), (F.col("first") + part).alias("unit"), F.get("ids", 0).alias("id"),
        F.col("v").cast(both).alias("v"), "ids")
    nulls = {"unit": "int", "ids": "array<long>", "bound": "double", "units": "array<int>"}
    columns = ["g", "asks", "unit", "id", "v", "ids", "bound", "units"]
    meet = [
        side.withColumns({"asks": F.lit(asks)} | {n: F.lit(None).cast(t) for n, t in nulls.items() if n not in side.columns}).select(*columns)
        for side, asks in ((members, False), (asking, True))
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = None
        for batch in batches:
            numbers, asks = batch.column("g").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.diff(2 * numbers + asks, prepend=-1)).tolist()
            for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                if group is None or group.number != numbers[start]:
                    group = Group(int(numbers[start]), sent.value, size, need)
                if asks[start]:
                    yield from group.near(batch.slice(start, end - start))
                else:
                    group.take(batch.slice(start, end - start))

    # a group's vectors come first, block by block, then the queries that look into it
    together = meet[0].unionByName(meet[1]).repartitionById(deal.groups, F.col("g")).sortWithinPartitions("g", "asks", "unit", "id")
    near, _ = written(together.mapInArrow(run, "q long, vec_id long, score double"), "ann-near")
    remove(spark, [filed_path])
    best = Window.partitionBy("q").orderBy("score", "vec_id")
    found = near.withColumn("r", F.row_number().over(best)).where(F.col("r") <= need)
    mine = found.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    each = asked.join(searched, "v").select("q", F.col("id").alias("query_id"))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return each.join(mine, "q").select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(), float).reshape(-1, size)
