"""Merkle manifest of a dataset: a tree of digests whose parents can be resumed at any child.

Leaves are digests of rows, in the order of doc_id within their source. Sixteen consecutive nodes become one, level
by level, until a source has a single node, its subroot; the subroots become the root in the same way. A parent
keeps a copy of its hash state before each child. To see what a changed child makes of the parent, the
matching state goes on with the replacement and the siblings on its right; what stands on its left is never
hashed again.

Spark works on blocks of sixteen times sixteen nodes, which are two levels: one row per block, never more than 256
nodes in it, however large a source is. A block's way to the root is found from the top down, and each block
then folds its own leaves. Sources with millions of rows and millions of sources cost the same per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kwarta.llm.shared import small_batches, written

#: Children of a parent, and nodes of a block.
ARITY = 16
BLOCK = ARITY * ARITY
#: Blocks that go to Python at once; a block has up to BLOCK rows.
BLOCKS_AT_ONCE = 32

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROW_BITS = 33  # of monotonically_increasing_id, below the partition's number


def field(value: Column) -> Column:
    """A value with its size in bytes, so that no two rows of values run together alike; `-` for null."""
    data = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(data).cast("string"), F.lit(":"), data), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    """Digest of a row's values."""
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def _positions(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with `idx`, their place in their group by the order, `size`, the group's rows, and `sid`, the group's place.

    Rows are dealt into ranges of (group, order), so a large group lies in many of them; what is added up over
    the ranges is one row per group and range. Also the groups as sid and size.
    """
    keys = [group, *order]
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())  # equal rows in several ranges
    ordered = salted.repartitionByRange(*keys, "_salt").sortWithinPartitions(*keys, "_salt").drop("_salt")
    placed, _ = written(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("_range", F.shiftright("_at", _ROW_BITS))
    parts = placed.groupBy("_range", group).agg(F.min("_at").alias("_base"), F.count(F.lit(1)).alias("_n"))
    parts, _ = written(parts, "parts")
    ranges = Window.partitionBy(group).orderBy("_range")
    # ranges follow one another in the order of groups, so groups are numbered within ranges and ranges counted
    first = parts.withColumn("_new", F.row_number().over(ranges) == 1)
    inside = F.count(F.lit(1)).over(Window.partitionBy("_range").orderBy(F.col(group).asc_nulls_first())) - 1
    new = first.where("_new").select(group, "_range", inside.alias("_inside"))
    begun = new.groupBy("_range").agg(F.count(F.lit(1)).alias("_groups"))
    before = begun.select("_range", (F.sum("_groups").over(Window.orderBy("_range")) - F.col("_groups")).alias("_before"))
    sizes = parts.groupBy(F.col(group).alias("_sized")).agg(F.sum("_n").alias("size"))
    numbered = new.join(before, "_range").select(F.col(group).alias("_group"), (F.col("_before") + F.col("_inside")).alias("sid"))
    groups = numbered.join(sizes, F.col("_group").eqNullSafe(F.col("_sized"))).select("_group", "sid", "size")
    shift = (F.sum("_n").over(ranges) - F.col("_n") - F.col("_base")).alias("_shift")
    parts = parts.select("_range", F.col(group).alias("_part"), shift)
    parts = parts.join(groups, F.col("_part").eqNullSafe(F.col("_group"))).select("_range", "_part", "_shift", "sid", "size")
    found = placed.withColumnRenamed("_range", "_r").join(
        parts, (F.col("_r") == F.col("_range")) & F.col(group).eqNullSafe(F.col("_part")))
    out = found.withColumn("idx", F.col("_at") + F.col("_shift")).drop("_at", "_shift", "_r", "_range", "_part")
    return out, groups.select("sid", "size")


def parent(children: list[bytes]) -> tuple[bytes, list]:
    """A parent's digest, and its hash state before each child."""
    state, before = hashlib.sha256(), []
    for child in children:
        before.append(state.copy())
        state.update(child)
    return state.hexdigest().encode(), before


def folded(before, replacement: bytes, right: bytes) -> bytes:
    """The parent's digest with another child: the state before it goes on with the replacement and what is on its right."""
    state = before.copy()
    state.update(replacement + right)
    return state.hexdigest().encode()


class Block:
    """Up to two levels over consecutive nodes of a source: a subtree with the states of all its parents.

    `size` is the number of nodes that the whole source has on this level. With one node nothing is above it; with
    up to ARITY there is one level; otherwise two, even over a single node.
    """

    def __init__(self, nodes: list[bytes], size: int) -> None:
        self.levels: list[list[bytes]] = [nodes]
        self.before: list[list[list]] = []
        for _ in range(0 if size == 1 else 1 if size <= ARITY else 2):
            low = self.levels[-1]
            made = [parent(low[i : i + ARITY]) for i in range(0, len(low), ARITY)]
            self.levels.append([digest for digest, _ in made])
            self.before.append([states for _, states in made])
        self.top = self.levels[-1][0]

    def siblings(self, slot: int) -> list[tuple[bytes, bytes]]:
        """Per level, the digests to the left and to the right of a node's way up."""
        out = []
        for low in self.levels[: len(self.before)]:
            run = slot - slot % ARITY
            out.append((b"".join(low[run:slot]), b"".join(low[slot + 1 : run + ARITY])))
            slot //= ARITY
        return out

    def fold(self, slot: int, replacement: bytes) -> bytes:
        """The block's digest with another node in that slot."""
        for low, before in zip(self.levels, self.before):  # noqa: B905 - a level more than there are states
            run = slot - slot % ARITY
            replacement = folded(before[slot // ARITY][slot % ARITY], replacement, b"".join(low[slot + 1 : run + ARITY]))
            slot //= ARITY
        return replacement


class Way:
    """The way from a block's digest to the root: per level the state before it and the siblings on its right."""

    def __init__(self, steps: list[tuple[bytes, bytes]]) -> None:
        self.steps = [(hashlib.sha256(left), right) for left, right in steps]
        self.siblings = b"".join(left + right for left, right in steps)

    def fold(self, replacement: bytes) -> bytes:
        for before, right in self.steps:
            replacement = folded(before, replacement, right)
        return replacement


_STEPS = "array<struct<left: binary, right: binary>>"
_STEP = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))


def _blocks(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """One row per block: sid, block, size and its nodes in order, each with the columns."""
    node = F.struct("idx", *columns)
    return nodes.groupBy("sid", F.floor(F.col("idx") / BLOCK).alias("block")).agg(
        F.first("size").alias("size"), F.sort_array(F.collect_list(node)).alias("nodes"))


def _batched(blocks: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow over few blocks at a time, whatever the session's batch size is."""
    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCKS_AT_ONCE):
                yield from run(batch.slice(low, BLOCKS_AT_ONCE))

    return blocks.mapInArrow(few, schema)


def _tops(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    tops = [Block([n["digest"].encode() for n in nodes], size).top.decode()
            for nodes, size in zip(batch.column("nodes").to_pylist(), batch.column("size").to_pylist(), strict=True)]
    yield pa.RecordBatch.from_arrays([batch.column("sid"), batch.column("block"), batch.column("size"), pa.array(tops, pa.string())],
                                     names=["sid", "block", "size", "digest"])


def _raised(nodes: DataFrame) -> DataFrame:
    """The nodes two levels up, or fewer where a source has a single one by then."""
    tops = _batched(_blocks(nodes, ["digest"]), _tops, "sid long, block long, size long, digest string")
    return tops.select("sid", F.col("block").alias("idx"), F.ceil(F.col("size") / BLOCK).alias("size"), "digest")


def _ways(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sid, idx, way = [], [], []
    for source, nodes, size, above in zip(*(batch.column(c).to_pylist() for c in ("sid", "nodes", "size", "way")), strict=True):
        block = Block([n["digest"].encode() for n in nodes], size)
        for slot, node in enumerate(nodes):
            sid.append(source)
            idx.append(node["idx"])
            way.append([{"left": a, "right": b} for a, b in block.siblings(slot)] + above)
    yield pa.RecordBatch.from_arrays([pa.array(sid, pa.int64()), pa.array(idx, pa.int64()), pa.array(way, _STEP)], names=["sid", "idx", "way"])


def _tree(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The nodes of every second level, up to a single one per source. `most`: the largest source's nodes."""
    levels = [nodes]
    while most > 1:
        levels.append(written(_raised(levels[-1]), "nodes")[0])
        most = -(-most // BLOCK)
    return levels


def _ways_down(levels: list[DataFrame], above: DataFrame, lowest: int) -> DataFrame:
    """sid, idx and way of the nodes of a level. `above`: those of each source's single node, with idx 0."""
    for nodes in levels[lowest:-1][::-1]:
        blocks = _blocks(nodes, ["digest"]).join(above.withColumnRenamed("idx", "block"), ["sid", "block"])
        above, _ = written(_batched(blocks, _ways, f"sid long, idx long, way {_STEPS}"), "ways")
    return above


def _proofs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    out: dict[str, list] = {n: [] for n in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")}
    for nodes, size, subroot, root, above in zip(*(batch.column(c).to_pylist() for c in ("nodes", "size", "subroot", "root", "way")), strict=True):
        block = Block([n["digest"].encode() for n in nodes], size)
        way = Way([(s["left"], s["right"]) for s in above])
        for slot, node in enumerate(nodes):
            proof = hashlib.sha256(b"".join(a + b for a, b in block.siblings(slot)) + way.siblings)
            replacement = (node["digest"] if node["other"] is None else node["other"]).encode()
            again = way.fold(block.fold(slot, replacement)).decode()
            for name, value in zip(out, (node["doc_id"], node["digest"], subroot, root, proof.hexdigest(), again, again == root), strict=True):
                out[name].append(value)
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))


_SCHEMA = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(
    docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), *, doc_id: str = "doc_id",
    source: str = "source", changes: dict[str, Column] | None = None, where: Column | None = None,
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified, one row per row.

    A leaf is the digest of the given columns. `changes` names columns that are put to other values in the rows
    that `where` names, as somebody might do after the manifest was made; folded_root is the root that the row's
    present values and its siblings give, and verified tells whether that is still the root. proof_sha256 is
    the digest of all siblings, from the leaf up to the root. A null source is a source of its own and comes
    first; a null doc_id comes first in its source; rows of one doc_id follow in the order of their digests.
    Nulls, empty and very long values are told apart by their sizes. Repeated rows are leaves of their own. Empty
    table: no rows. Columns besides the given ones are not read. doc_id is returned as a long.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = {n: docs[f"`{n}`"] for n in columns}
    other = F.lit(None).cast("string")
    if changes:
        other = F.when(F.lit(True) if where is None else where, leaf([changes.get(n, own[n]) for n in columns]))
    rows, _ = written(docs.select(
        docs[f"`{source}`"].cast("string").alias("source"), docs[f"`{doc_id}`"].cast("long").alias("doc_id"),
        leaf(list(own.values())).alias("digest"), other.alias("other")), "leaves")
    placed, sources = _positions(rows, "source", ["doc_id", "digest"])
    leaves, _ = written(placed.select("sid", "idx", "size", "doc_id", "digest", "other"), "placed")
    most, count = sources.agg(F.max("size"), F.count(F.lit(1))).first()
    if not count:
        return spark.createDataFrame([], _SCHEMA)
    levels = _tree(leaves.select("sid", "idx", "size", "digest"), most)
    subroots = levels[-1].select("sid", F.col("digest").alias("subroot"))
    # the sources' subroots are the leaves of one more tree
    one = F.lit(0).cast("long")
    upper = _tree(subroots.select(
        one.alias("sid"), F.col("sid").alias("idx"), F.lit(count).cast("long").alias("size"), F.col("subroot").alias("digest")), count)
    root = upper[-1].first()["digest"]
    ways = _ways_down(upper, upper[-1].select("sid", one.alias("idx"), F.array().cast(_STEPS).alias("way")), 0)
    ways = _ways_down(levels, ways.select(F.col("idx").alias("sid"), one.alias("idx"), "way"), 1)
    blocks = _blocks(leaves, ["doc_id", "digest", "other"]).join(ways.withColumnRenamed("idx", "block"), ["sid", "block"])
    return _batched(blocks.join(subroots, "sid").withColumn("root", F.lit(root)), _proofs, _SCHEMA)
