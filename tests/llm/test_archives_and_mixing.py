"""WARC archives, nearest neighbours, mixing and the pipeline: round trips, brute force and limits."""

import collections
import gzip
import hashlib
import re
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from kwarta.llm import mixing, neighbours, queries, warc

SF = "/root/testdata/sf0.001"


def pages(spark):
    long = "é" * 600
    rows = [(1, "http://A.example.org/x?y=1", long), (2, "http://a.example.org/x?y=1", long), (3, None, None), (4, "::bad url\r\n", ""),
            (5, "http://b.example.org:8080/WARC/1.1\r\nX: y", "WARC/1.1\r\n\r\n" * 200), (6, "http://a.example.org", "short"),
            (7, "http://c.example.org", "short"), (None, "http://d.example.org", long)]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(3)


def test_round_trip(spark):
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages(spark)).collect()}
    expected = {}
    for r in pages(spark).collect():
        data = (r.html or "").encode()
        again = r.html == "é" * 600 and r.page_id != 2
        expected[r.page_id] = (len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", 2 if again else None)
    assert got == expected


def test_archives_are_warc_and_ranges_are_members(spark, tmp_path):
    folder = str(tmp_path / "warc")
    captures = warc.write_archives(pages(spark), folder)
    assert captures.count() == 8
    for path in Path(folder).iterdir():
        records = re.findall(rb"WARC/1\.1\r\nWARC-Type: (\w+)\r\n", gzip.decompress(path.read_bytes()))
        assert len(records) >= captures.where(captures.path == path.name).count()
    index = warc.build_index(captures, folder, str(tmp_path / "index"), lines=2)
    urls = spark.createDataFrame([("http://a.example.org/x?y=1",), ("http://none.example.org",), (None,)], "url string")
    found = warc.read(warc.lookup(spark, index, urls), folder).collect()
    assert {(r.page_id, r.record_type) for r in found} == {(1, "revisit"), (2, "response"), (3, "response")}


def test_a_key_with_captures_in_many_blocks(spark, tmp_path):
    rows = [(i, "http://hot.example.org/", f"page {i}") for i in range(300)]
    many = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = str(tmp_path / "warc")
    index = warc.build_index(warc.write_archives(many, folder), folder, str(tmp_path / "index"), lines=7)
    found = warc.read(warc.lookup(spark, index, many), folder)
    assert {r.page_id: bytes(r.payload).decode() for r in found.collect()} == {i: p for i, _, p in rows}
    assert warc.round_trip(many.where("false")).count() == 0


def brute_neighbours(rows, k):
    used = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, v in used.items():
        near = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in used.items() if i != q)
        out[q] = [(i, d) for d, i in near[:k]]
    return out


def test_small_and_odd_vectors(spark):
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in draw.standard_normal(8)]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]  # equal vectors
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [None] + [1.0] * 7), (204, [float("nan")] + [1.0] * 7), (None, [1.0] * 8), (205, [1.0])]
    vectors = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<double>, list string, score double")
    expected = brute_neighbours([r for r in rows if r[0] != 205], 5)
    got = collections.defaultdict(list)
    for r in neighbours.search(vectors, vectors, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(expected)
    right = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in got)
    assert right >= 0.95 * sum(map(len, expected.values()))
    assert [i for i, _ in got[0]] == [100, 101, 102, 103, 104] and [i for i, _ in got[100]] == [0, 101, 102, 103, 104]
    few = vectors.where("vec_id in (1, 2, 3)")
    assert [r.vec_id for r in neighbours.search(few, few.where("vec_id = 1"), 5).orderBy("rank").collect()] == [i for i, _ in brute_neighbours(rows[1:4], 5)[1]]
    assert neighbours.search(vectors.where("false"), vectors, 5).count() == 0


def test_recall_of_the_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.search(vectors, vectors.where("vec_id % 100 = 0"), 10, per_list=20)
    got = collections.defaultdict(set)
    for r in found.collect():
        got[r.query_id].add(r.vec_id)
    expected = brute_neighbours(rows, 10)
    assert np.mean([len(got[q] & {i for i, _ in expected[q]}) / 10 for q in got]) >= 0.9


def test_mix_meets_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    total = sum(r["size"] for r in rows)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    sizes = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(by))}
    target, open_ = {}, set(by)
    left = 1.5 * total
    while True:  # the excess is shared again until none is above
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not over:
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    target |= {s: level * weight[s] for s in open_}
    for s, rs in by.items():
        assert {r.source_size for r in rs} == {sizes[s]}
        assert rs[0].target == pytest.approx(target[s])
        assert abs(sum(r.taken for r in rs) - target[s]) <= 0.02 * target[s] + 5
        assert all(r.taken <= 2 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0) for r in rs)


def test_mix_is_the_same_on_every_run_and_partitioning(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = sorted(map(tuple, mixing.mix(docs, chunk=7).collect()))
    assert first == sorted(map(tuple, mixing.mix(docs.repartition(5), chunk=7).collect()))


def test_mix_of_odd_rows(spark):
    rows = [(1, "a b", None), (1, "a b", None), (None, None, "s"), (2, "", "s"), (3, "x " * 50_000, "t"), (4, "y z", ""), (None, "q", "t")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, source string, size int, _key string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and sum(r["size"] for r in got) == 50_007
    assert {tuple(r) for r in mixing.mixed(docs).collect()} <= {(*r, 1, "k") for r in rows}
    assert mixing.mix(docs.where("false")).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    odd = spark.createDataFrame([(9_001, None, "en", "s", 0), (9_002, "12 34", None, None, None)], docs.schema)
    now = docs.union(odd)
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
        seen.append((name, {r.doc_id for r in now.select("doc_id").collect()}))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == docs.columns
    assert [n for n, _ in seen] == ["language", "exact dedup", "near dedup", "mixing", "BPE encoding"]
    assert not {9_001, 9_002} & seen[0][1] and len(seen[0][1]) == 120
    assert seen[4][1] <= seen[3][1] <= seen[2][1] <= seen[1][1] <= seen[0][1]


def test_queries_have_sql_where_it_can_say_it():
    from kwarta.llm.oracle import ORACLE_SQL

    assert set(ORACLE_SQL) <= set(queries.QUERIES)
    assert set(queries.QUERIES) == {n for n in queries.QUERIES if re.match(r"op\d+_", n)} and len(queries.QUERIES) == 13


@pytest.mark.parametrize("name", ["op2_warc", "op3_exact_dedup", "op4_html", "op5_near_dedup", "op7_secrets", "op8_licenses"])
def test_same_rows_as_the_sql(spark, name):
    import duckdb

    from kwarta.llm.oracle import ORACLE_SQL

    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    got = queries.QUERIES[name](spark, SF).select(names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, found.fetchall()))
