"""Neighbours at size: nothing is broadcast that grows, packs are scanned as single queries are, blocks are dealt evenly."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kwarta.llm import neighbours


def _frame(spark, data, kind="float"):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], f"vec_id long, embedding array<{kind}>")


def _vectors(n, size, seed):
    return np.random.default_rng(seed).standard_normal((n, size)).astype(np.float32)


def test_no_vectors_are_broadcast(spark, monkeypatch):
    frame, plans, written = _frame(spark, _vectors(3_000, 8, 1)), {}, neighbours.written

    def watched(rows, name):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return written(rows, name)

    monkeypatch.setattr(neighbours, "written", watched)
    assert neighbours.search(frame, frame.where("vec_id % 100 = 0"), 10, per_list=20).count() > 250
    lines = plans["ann-near"].splitlines()
    depth = [len(re.match(r"[ :+|-]*", line)[0]) for line in lines]
    for at in (i for i, line in enumerate(lines) if "BroadcastExchange" in line):
        below = next((i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]), len(lines))
        assert not re.search("MapInArrow|FileScan", "\n".join(lines[at + 1 : below]))  # a row per list may be
    assert "MapInArrow" in plans["ann-near"]


def _singly(block, queries, bounds, k):
    columns = np.ascontiguousarray(block.T)
    return [set(neighbours.scan(columns, q, b, k)[0].tolist()) for q, b in zip(queries, bounds, strict=True)]


@pytest.mark.parametrize("size, rows, offset", [(64, 500, 0.0), (20, 1_400, 0.0), (16, 700, 1e6), (5, 3, 0.0)])
def test_a_pack_finds_what_single_queries_find(size, rows, offset):
    draw = np.random.default_rng(size)
    block, queries = draw.standard_normal((rows, size)) + offset, draw.standard_normal((40, size)) + offset
    squares = ((block[None] - queries[:, None]) ** 2).sum(2)
    for bounds in (np.sort(squares, axis=1)[:, min(rows - 1, 30)], np.full(40, np.inf), np.zeros(40)):
        q, r = neighbours.Block(block).scan(queries, bounds, 11)
        assert len(q) == len(set(zip(q.tolist(), r.tolist(), strict=True)))
        got = [set(r[q == i].tolist()) for i in range(len(queries))]
        expected = _singly(block, queries, bounds, 11)
        assert got == expected if not offset else all(a >= b for a, b in zip(got, expected, strict=True))


def test_what_cannot_be_squared_is_compared_singly():
    block, queries = np.ones((4, 8)), np.ones((2, 8))
    block[0] = 1e200
    with np.errstate(all="ignore"):
        assert neighbours.Block(block).scan(queries, np.full(2, 1.0), 3) is None
    # one far row takes all precision from the products: what they find is too much, and is not believed
    model = neighbours.Model.__new__(neighbours.Model)
    model.rotation = np.eye(8)
    group = neighbours.Group(0, model, 8, 3)
    rows = np.vstack([np.full(8, 1e100), np.random.default_rng(2).standard_normal((600, 8))])
    group.take(pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(601, np.int32)), pa.array(rows.tolist()), pa.array([[i] for i in range(601)], pa.list_(pa.int64()))],
        names=["unit", "v", "ids"]))
    asking = pa.RecordBatch.from_arrays(
        [pa.array([7]), pa.array([rows[5].tolist()]), pa.array([4.0]), pa.array([[0]], pa.list_(pa.int32()))],
        names=["id", "v", "bound", "units"])
    found = pa.Table.from_batches(list(group.near(asking))).to_pylist()
    near = np.sqrt(((rows - rows[5]) ** 2).sum(1))
    assert [r["vec_id"] for r in found] == np.argsort(near)[:3].tolist() and [r["q"] for r in found] == [7] * 3
    assert [r["score"] for r in found] == np.sort(near)[:3].tolist()


def test_blocks_are_dealt_evenly():
    draw = np.random.default_rng(4)
    rows = draw.integers(0, 900, 300)
    rows[7], rows[8] = 40 * neighbours.BLOCK, 0  # a list that holds more than a group's share
    deal = neighbours.Deal(rows, 64, 6)
    held = np.zeros(deal.groups)
    for number, first, groups in deal.by_list():
        assert rows[number] and first == deal.first[number]
        np.add.at(held, groups, rows[number] / len(groups))
    assert held.sum() == pytest.approx(rows.sum()) and held.max() < 1.2 * held.mean() and 8 not in [x[0] for x in deal.by_list()]
    places, lists = np.array([0, 0, 0, 1, 1]), np.array([7, 8, 3, 3, 299])
    got = collections.defaultdict(list)
    for group, q, blocks in deal.asked(places, lists):
        for place, units in zip(q.tolist(), blocks.to_pylist(), strict=True):
            assert (deal.group[units] == group).all()
            got[place] += units
    assert sorted(got[0]) == sorted([*range(deal.first[7], deal.first[7] + 40), deal.first[3]])
    assert sorted(got[1]) == sorted([deal.first[3], deal.first[299]])
    assert neighbours.Deal(rows * 1_000, 64, 6).groups == -(-int(rows.sum()) * 64_000 // neighbours.GROUP)


def test_equal_vectors_and_both_precisions(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "HITS", 50)
    monkeypatch.setattr(neighbours, "ASKED", 7)
    monkeypatch.setattr(neighbours, "PACK", 5)
    data = _vectors(400, 8, 3)
    data[100:140] = data[0]
    data[141] = -0.0
    data[142, 0] = -0.0
    data[143] = data[142]
    data[143, 0] = 0.0  # the same vector
    both = []
    for kind in ("float", "double"):
        frame = _frame(spark, data, kind)
        both.append(sorted(neighbours.search(frame, frame, 5, recall=1.0, per_list=40).collect()))
    assert both[0] == both[1]
    mixed = neighbours.search(_frame(spark, data), _frame(spark, data, "double"), 5, recall=1.0, per_list=40)
    assert sorted(mixed.collect()) == both[0]
    got = collections.defaultdict(list)
    for r in both[0]:
        got[r.query_id].append((r.vec_id, r.score))
    wide = data.astype(float)
    for q in set(range(400)) - {141}:
        d = np.sqrt(((wide - wide[q]) ** 2).sum(1))
        near = sorted((x, i) for i, x in enumerate(d) if i not in (q, 141))[:5]
        assert got[q] == [(i, x) for x, i in near]
    assert 141 not in got and len(got) == 399
