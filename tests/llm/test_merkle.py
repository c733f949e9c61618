"""Merkle manifest against trees built in plain Python from the definition."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from kwarta.llm import merkle, queries

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, source string, lang string, n_chars int, text string"


def sha(data):
    return hashlib.sha256(data.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i : i + 16])) for i in range(0, len(low), 16)])
    return levels


def way_up(levels, at):
    """The runs that a node's way goes through, with its place in each."""
    for low in levels[:-1]:
        run = at - at % 16
        yield low[run : run + 16], at - run
        at //= 16


def brute(rows, hit):
    lower = lambda t: t if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append((leaf_of(r), r))
    names = sorted(sources, key=lambda s: b"" if s is None else b"\1" + s.encode())
    trees = {}
    for s in names:
        sources[s].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees[s] = levels_of([leaf for leaf, _ in sources[s]])
    top = levels_of([trees[s][-1][0] for s in names])
    root, out = top[-1][0], []
    for k, s in enumerate(names):
        for i, (leaf, r) in enumerate(sources[s]):
            cur = leaf_of((*r[:4], lower(r[4]))) if hit(r[0]) else leaf
            proof = ""
            for run, slot in [*way_up(trees[s], i), *way_up(top, k)]:
                proof += "".join(run[:slot] + run[slot + 1 :])
                cur = sha("".join([*run[:slot], cur, *run[slot + 1 :]]))
            out.append((r[0], leaf, trees[s][-1][0], root, sha(proof), cur, cur == root))
    return sorted(map(repr, out))


def by_checksum(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def ours(docs):
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.manifest(docs, changes={"text": merkle.lowered(docs["text"])}, where=changed)


def check(spark, rows, parts=5):
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], COLUMNS + ", digest string, idx int, sid int").repartition(parts)
    assert sorted(repr(tuple(r)) for r in ours(docs).collect()) == brute(rows, by_checksum)


def test_odd_rows(spark):
    rows = [(1, "a", "en", 3, "ABC"), (1, "a", "en", 3, "abd"), (1, "a", "en", 3, "ABC"), (None, "a", None, None, None), (None, "a", "en", 0, ""),
            (7, None, "de", 1, "Ä"), (3, "", "en", 2, "Z" * 100_000), (-4, "é", "en", 5, "1:2-"), (10, "a\x7f", "x", 1, "Q"), (15, "b", "fr", 4, "été A")]
    check(spark, rows)
    check(spark, rows[:1])
    check(spark, [(None, None, None, None, None)] * 3)
    assert ours(spark.createDataFrame([], COLUMNS)).count() == 0


@pytest.mark.parametrize("sizes", [[16], [17], [256], [257], [1, 16, 300, 2], [4097, 5]])
def test_sizes_around_the_levels(spark, sizes):
    draw = random.Random(1)
    rows = [(draw.randrange(10**6), f"s{k}", "en", i, f"Text {i}") for k, n in enumerate(sizes) for i in range(n)]
    draw.shuffle(rows)
    check(spark, rows)


def test_many_sources(spark):
    check(spark, [(i, f"s{i % 290}", "en", 1, f"T{i}") for i in range(600)])


def test_a_large_group_of_equal_rows(spark):
    check(spark, [(5, "hot", "en", 1, "Same")] * 700 + [(i, "cold", "en", 1, "A") for i in range(9)], parts=7)


def test_states_resume_at_any_child():
    nodes = [sha(str(i)).encode() for i in range(250)]
    block = merkle.Block(nodes, 10**6)
    for slot in (0, 15, 16, 240, 249):
        other = sha("other").encode()
        assert block.fold(slot, nodes[slot]) == block.top
        assert block.fold(slot, other) == merkle.Block([*nodes[:slot], other, *nodes[slot + 1 :]], 10**6).top != block.top


def test_a_fold_hashes_nothing_on_its_left():
    nodes = [sha(str(i)).encode() for i in range(16)]
    block = merkle.Block(nodes, 16)
    block.levels[0][:9] = [b"gone"] * 9
    assert block.fold(9, nodes[9]) == block.top


def test_all_documents_of_the_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = sorted(repr(tuple(r)) for r in queries.op13_merkle(spark, SF).collect())
    assert got == brute(rows, by_checksum)
    assert 0 < sum("False" in g for g in got) < len(got) / 2
