"""Near-duplicate documents: SuperMinHash signatures, banding, exact confirmation, union-find grouping.

A document is its set of distinct five-word shingles. SuperMinHash ranks the shingles by m random numbers whose
integer parts are a permutation per shingle; ranks are drawn in steps, and a document stops once a further
step could not lower any component. Documents that agree on a band of components meet in a bucket.

Buckets are worked off in two rounds, so that no group is expanded into its pairs:
1. each member is held against the bucket's leader; confirmed links are grouped;
2. in buckets whose members still lie in several groups, members are held against those of other groups in
   blocks. Where signatures allow the similarity, the full sets come to the block and a union-find there
   leaves out what is connected already.
Every link used is confirmed on the full shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kwarta.llm.components import components
from kwarta.llm.shared import carried, remove, restored, small_batches, told, written

#: Words of a shingle; least similarity in percent.
WORDS, PERCENT = 5, 75
#: Bands x rows components: a pair at 0.75 shares no band with probability (1 - 0.75**4)**32 < 6e-6.
BANDS, ROWS = 32, 4
#: Pairs whose signatures agree less than this many standard deviations below the least similarity are no links.
DEVIATIONS = 4.0
#: Members of a bucket in a block, and shingles worked on at once.
BLOCK, AT_ONCE = 256, 200_000
#: Bytes up to which the table of documents whose text is wanted is broadcast to the texts; above, both are shuffled.
BROADCAST_BYTES = 64 << 20

_U = np.uint64
_GOLDEN, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def _nth(n: int) -> np.uint64:
    """The n-th multiple of the golden step, modulo 2**64."""
    return _U(n * int(_GOLDEN) & 0xFFFFFFFFFFFFFFFF)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted 64-bit hashes of the distinct shingles; a shorter text is one shingle, no words are none."""
    if not text:
        return np.zeros(0, np.uint64)
    found = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    size = min(words, n)
    out = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        out = (out * _M2 + hashes[i : n - size + 1 + i]) * _GOLDEN
        out ^= out >> _U(29)
    return np.unique(_mix(out))


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash: per set (not empty) m components, as a matrix."""
    out = np.full((len(sets), m), np.inf)
    first = 0
    while first < len(sets):
        last, room = first + 1, AT_ONCE - len(sets[first])
        while last < len(sets) and len(sets[last]) <= room:
            room -= len(sets[last])
            last += 1
        _rank(sets[first:last], out[first:last])
        first = last
    return out


def _rank(sets: list[np.ndarray], out: np.ndarray) -> None:
    m = out.shape[1]
    item = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    swaps: list[np.ndarray] = []
    flat = out.reshape(-1)
    for step in range(m):
        drawn = _mix(item + _nth(2 * step + 1))
        chosen = (step + _mix(item + _nth(2 * step + 2)) % _U(m - step)).astype(np.int64)
        place = chosen
        for earlier in range(step - 1, -1, -1):  # what the swaps before have put there
            place = np.where(place == swaps[earlier], earlier, place)
        np.minimum.at(flat, of * m + place, (drawn >> _U(11)) * 2.0**-53 + step)
        going = (out.max(axis=1) >= step + 1)[of]  # ranks of the next step are at least step + 1
        if not going.any():
            return
        swaps.append(chosen)
        if not going.all():
            item, of = item[going], of[going]
            swaps = [s[going] for s in swaps]


def bands(ranks: np.ndarray, count: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key per band."""
    bits = ranks.view(np.uint64).reshape(len(ranks), count, rows)
    keys = np.broadcast_to(_mix(np.arange(1, count + 1, dtype=np.uint64) * _GOLDEN), (len(ranks), count)).copy()
    for i in range(rows):
        keys = _mix(keys * _M1 + bits[:, :, i])
    return keys


def _bytes_of(ranks: np.ndarray) -> np.ndarray:
    """A byte per component, equal where components are equal."""
    return (_mix(ranks.view(np.uint64)) >> _U(56)).astype(np.uint8)


def least_agreeing(m: int, percent: float) -> int:
    """Components that a link's signatures share at least."""
    share = percent / 100
    return math.floor(m * share - DEVIATIONS * math.sqrt(m * share * (1 - share)))


def _features(words: int, count: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch.column("_text").to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(sizes)
            keys, prints, node = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            if len(some):
                ranks = signatures([sets[i] for i in some], count * rows)
                for i, k, p in zip(some, bands(ranks, count, rows).view(np.int64), _bytes_of(ranks), strict=True):
                    keys[i], prints[i] = k, p.tobytes()
                    node[i] = int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(sets[i].tobytes()))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_hash"), pa.array(sizes), pa.array(node, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(prints, pa.binary())],
                names=["_id", "_hash", "n", "node", "keys", "print"])

    return run


def _agreeing(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Of pairs with both signatures, those that may be links."""
    for batch in batches:
        if not batch.num_rows:
            continue
        both = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("pa", "pb")]
        ok = pa.array((both[0] == both[1]).sum(axis=1) >= least)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["a", "b"])


_BLOCK_TYPES = {
    "key": pa.int64(), "i": pa.int32(), "j": pa.int32(), "band": pa.int32(), "side": pa.int32(), "node": pa.int64(),
    "root": pa.int64(), "n": pa.int64(), "print": pa.binary(), "keys": pa.list_(pa.int64()),
}
_BLOCK = list(_BLOCK_TYPES)


class _Block:
    """Members of a bucket that are held against each other, side 0 against side 1 or (side 2) all."""

    def __init__(self, rows: list[tuple], least: int, percent: int) -> None:
        self.rows, self.least, self.percent, self.band = rows, least, percent, rows[0][3]
        self.side = np.array([r[4] for r in rows])
        self.node, self.root, self.size = (np.array([r[k] for r in rows], np.int64) for k in (5, 6, 7))
        self.prints = np.frombuffer(b"".join(r[8] for r in rows), np.uint8).reshape(len(rows), -1)
        self.keys = np.array([r[9] for r in rows], np.int64)

    def partners(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that row i may be linked with, of other groups, met in no earlier band; and their agreement."""
        right = np.arange(i + 1, len(self.rows)) if self.side[i] == 2 else np.flatnonzero(self.side == 1)
        small, large = np.minimum(self.size[right], self.size[i]), np.maximum(self.size[right], self.size[i])
        right = right[(self.root[right] != self.root[i]) & (100 * small >= self.percent * large)]
        agree = (self.prints[right] == self.prints[i]).sum(axis=1)
        right, agree = right[agree >= self.least], agree[agree >= self.least]
        new = ~(self.keys[right, : self.band] == self.keys[i, : self.band]).any(axis=1)
        return right[new], agree[new]

    def left(self) -> np.ndarray:
        return np.flatnonzero(self.side != 1)

    def involved(self) -> list[int]:
        """Rows with a partner."""
        found = np.zeros(len(self.rows), bool)
        for i in self.left():
            right, _ = self.partners(i)
            found[right] = True
            found[i] |= len(right) > 0
        return np.flatnonzero(found).tolist()

    def links(self, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        """Links confirmed on full sets that join groups; what agrees most is looked at first."""
        group = {r: r for r in self.root.tolist()}

        def find(r: int) -> int:
            while group[r] != r:
                group[r] = group[group[r]]
                r = group[r]
            return r

        out = []
        for i in self.left():
            right, agree = self.partners(i)
            for j in right[np.argsort(-agree, kind="stable")].tolist():
                a, b = find(int(self.root[i])), find(int(self.root[j]))
                if a == b:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= self.percent * (len(sets[i]) + len(sets[j]) - both):
                    group[max(a, b)] = min(a, b)
                    out.append((int(self.node[i]), int(self.node[j])))
        return out


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], list[np.ndarray]]]:
    """The rows of each block of a stream sorted by block, and their sets where there are any."""
    block, rows, sets = None, [], []
    for batch in batches:
        with_sets = "set" in batch.schema.names
        columns = [batch.column(c).to_pylist() for c in _BLOCK]
        for at, row in enumerate(zip(*columns, strict=True)):
            if row[:4] != block:
                if rows:
                    yield rows, sets
                block, rows, sets = row[:4], [], []
            rows.append(row)
            if with_sets:
                sets.append(batch.column("set")[at].values.to_numpy().copy())
    if rows:
        yield rows, sets


def _involved(least: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in _each_block(batches):
            kept = [rows[i] for i in _Block(rows, least, percent).involved()]
            if kept:
                columns = zip(zip(*kept, strict=True), _BLOCK_TYPES.values(), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=_BLOCK)

    return run


def _linked(least: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets in _each_block(batches):
            found = _Block(rows, least, percent).links(sets)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


class _Run:
    """One grouping: the documents, their features, and the tables to remove at its end."""

    def __init__(self, docs: DataFrame, text: str, doc_id: str, words: int, percent: int, count: int, rows: int) -> None:
        self.spark, self.words, self.percent, self.paths = docs.sparkSession, words, percent, []
        self.least = least_agreeing(count * rows, percent)
        self.docs = docs.select(
            docs[f"`{doc_id}`"].alias("_id"), F.xxhash64(docs[f"`{text}`"]).alias("_hash"), docs[f"`{text}`"].alias("_text"))
        kind = self.docs.schema["_id"].dataType.simpleString()
        self.features, self.path = written(
            self.docs.select("_id", "_hash", "_text").mapInArrow(
                _features(words, count, rows),
                f"_id {kind}, _hash long, n long, node long, keys array<long>, print binary"), "near-features")

    def kept(self, frame: DataFrame, name: str) -> DataFrame:
        frame, path = written(frame, name)
        self.paths.append(path)
        return frame

    def members(self) -> DataFrame:
        """(key, band, node, n, lead): distinct sets in buckets that hold more than one."""
        in_band = self.features.select("node", "n", F.posexplode("keys").alias("band", "key"))
        shared = in_band.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("other")).where("lead <> other")
        return self.kept(in_band.join(shared.select("key", "lead"), "key").distinct(), "near-members")

    def prints(self) -> DataFrame:
        return self.features.where("n > 0").select("node", "n", "print", "keys")

    def near_leader(self, members: DataFrame) -> DataFrame:
        pairs = members.where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
        wanted = self.kept(members.select("node").distinct(), "near-wanted")
        self.known = self.kept(
            self.prints().join(wanted, "node", "left_semi").groupBy("node")
            .agg(F.first("n").alias("n"), F.first("print").alias("print"), F.first("keys").alias("keys")), "near-prints")
        a = self.known.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("print").alias("pa"))
        b = self.known.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("print").alias("pb"))
        sized = pairs.join(a, "a").join(b, "b").where(100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb"))
        least = self.least
        return self.kept(sized.select("a", "b", "pa", "pb").mapInArrow(lambda x: _agreeing(x, least), "a long, b long"), "near-pairs")

    def between_groups(self, members: DataFrame, groups: DataFrame) -> DataFrame:
        """Confirmed links between members of a bucket that lie in different groups."""
        placed = members.join(groups, "node", "left").select("key", "band", "node", "n", F.coalesce("root", "node").alias("root"))
        placed = self.kept(placed, "near-placed")
        split = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo <> hi")
        parts = F.ceil(F.col("size") / F.lit(float(BLOCK))).cast("int")
        some = placed.join(split.select("key", parts.alias("parts")), "key").join(self.known.select("node", "print", "keys"), "node")
        own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
        dealt = some.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        side = F.when(F.col("own") == F.col("with"), 2).when(F.col("own") < F.col("with"), 0).otherwise(1)
        blocks = dealt.withColumns({"i": F.least("own", "with"), "j": F.greatest("own", "with"), "side": side}).select(*_BLOCK)
        block = ["key", "i", "j", "band"]
        found = blocks.repartition(*block).sortWithinPartitions(*block).mapInArrow(_involved(self.least, self.percent), blocks.schema)
        found = self.kept(found, "near-involved")
        full = found.join(self.sets_of(found.select("node").distinct()), "node").select(*_BLOCK, "set")
        return self.kept(
            full.repartition(*block).sortWithinPartitions(*block).mapInArrow(_linked(self.least, self.percent), "a long, b long"), "near-links")

    def sets_of(self, nodes: DataFrame) -> DataFrame:
        """(node, set): the full shingle sets, from the text of one document of each."""
        one = self.features.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("_hash", "_id")).alias("row"))
        wanted = self.kept(one.select("node", "row._hash", "row._id"), "near-wanted")
        size = wanted.agg(F.sum(F.lit(24) + F.coalesce(F.octet_length(F.col("_id").cast("string")), F.lit(0)))).first()[0] or 0
        side = wanted.select("node", F.col("_hash").alias("h"), F.col("_id").alias("i"))
        where = (F.col("_hash") == F.col("h")) & F.col("_id").eqNullSafe(F.col("i"))
        texts = self.docs.join(F.broadcast(side) if size <= BROADCAST_BYTES else side, where).select("node", "_text")
        words = self.words

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [shingles(t, words).view(np.int64) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "set"])

        return self.kept(texts.mapInArrow(sets, "node long, set array<long>").dropDuplicates(["node"]), "near-sets")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose full shingle sets are similar enough."""
        known = self.sets_of(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct())
        a = known.select(F.col("node").alias("a"), F.col("set").alias("sa"))
        b = known.select(F.col("node").alias("b"), F.col("set").alias("sb"))
        common = F.size(F.array_intersect("sa", "sb"))
        both = pairs.join(a, "a").join(b, "b").select("a", "b", common.alias("both"), (F.size("sa") + F.size("sb")).alias("all"))
        return self.kept(both.where(100 * F.col("both") >= self.percent * (F.col("all") - F.col("both"))).select("a", "b"), "near-links")

    def grouped(self, links: DataFrame) -> DataFrame:
        groups, path = components(links)
        self.paths.append(path)
        return groups


def classes(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, words: int = WORDS, percent: int = PERCENT,
    count: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id, kept, and text_hash (xxhash64 of the text).

    Words stand between ASCII white space, A-Z lowered; whole texts count. Two documents are linked if
    100 x intersection >= percent x union of their shingle sets; classes are the links' closure.
    component_id is the smallest doc_id of the class. Null, empty and wordless texts are classes of their own.
    A null doc_id counts only if its class has no other; then component_id is null. kept: doc_id is
    component_id, so repeated rows share their fate. Empty table: no rows. Sets are named by a 64-bit hash.
    """
    small_batches(docs.sparkSession)
    run = _Run(docs, text, doc_id, words, percent, count, rows)
    members = run.members()
    links = run.confirmed(run.near_leader(members))
    groups = run.grouped(links)
    more = run.between_groups(members, groups)
    if not more.isEmpty():
        groups = run.grouped(links.union(more))
    final, _ = written(groups, "near-groups")
    remove(run.spark, run.paths)
    own = run.features.select("_id", "_hash", "n", "node")
    # copies of a set are one row until their class is known
    some = own.where("n > 0")
    sets = some.groupBy("node").agg(F.min("_id").alias("low"), F.count(F.lit(1)).alias("size"))
    placed, _ = written(sets.join(final, "node", "left").select("node", "low", "size", F.coalesce("root", "node").alias("root")), "near-sets")
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("members"))
    of_set, _ = written(told(placed.select("node", "size", "root"), lowest, "root", "members", placed.count(), "component_id"), "near-classes")
    named = told(some, of_set, "node", "size", own.count(), "component_id").select("_id", "_hash", "n", "component_id")
    without = own.where("n = 0").select("_id", "_hash", "n", F.col("_id").alias("component_id"))
    return named.unionByName(without).select(
        F.col("_id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id",
        F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"), F.col("_hash").alias("text_hash"))


def without_near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """The rows of docs that stay: one document of each class, with all columns, whatever their names. Nulls, repeated
    rows and empty tables are as in :func:`classes`."""
    gone = classes(docs, text, doc_id, **settings).where("not kept").select(
        F.col(doc_id).alias("_gone_id"), F.col("text_hash").alias("_gone_hash")).distinct()
    names = docs.columns
    rows = docs.select(*carried(docs, names), F.xxhash64(docs[f"`{text}`"]).alias("_hash"), docs[f"`{doc_id}`"].alias("_id"))
    same = (F.col("_hash") == F.col("_gone_hash")) & F.col("_id").eqNullSafe(F.col("_gone_id"))
    return rows.join(gone, same, "left_anti").select(*restored(names))
