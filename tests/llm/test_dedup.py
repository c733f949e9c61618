"""Exact and near deduplication against brute force, and the rows that break things."""

import collections
import hashlib
import re

import numpy as np
import pytest

from kwarta.llm import components, exact_dedup, near_dedup, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, keep_id string, _digest int, node int"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))


def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like results."""
    texts = [None, "", " \t\n", "one two", "one two", LONG, LONG + " more", "A b c d e f", "a B c d e f", None]
    rows = [(i, t, "en", "s", 1, "x", "y", 3, 4) for i, t in enumerate(texts)]
    rows += [rows[3], (None, "one two", None, None, None, None, None, None, None), (None, None, "en", "s", 0, "", "", 0, 0)]
    return spark.createDataFrame(rows, SCHEMA)


def test_exact_copies_match_brute_force(spark):
    docs = odd_docs(spark)
    groups = collections.defaultdict(list)
    for r in docs.collect():
        groups[r.text or ""].append(r.doc_id)
    got = exact_dedup.mark_copies(docs, columns=docs.columns).collect()
    assert len(got) == docs.count()
    assert [c for c in got[0].asDict()].count("kept") == 1
    stays = collections.Counter()
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    for r in got:
        ids = groups[by_hash[r.text_sha256]]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        if r.kept:
            stays[r.text_sha256] += 1
            assert r.doc_id == r.keep_id
    assert set(stays.values()) == {1} and len(stays) == len(groups)


def test_frequent_text_is_settled_before_the_shuffle(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in exact_dedup.mark_copies(docs, support=0.1).collect()}
    assert sum(r.kept for r in got.values()) == 2_001
    assert got[0].keep_id == 2_997 and got[0].group_size == 1_000 and got[2_997].kept and not got[0].kept
    assert exact_dedup.mark_copies(docs, support=0.1, dropped=False).count() == 2_001


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.mark_copies(empty).count() == 0
    assert near_dedup.classes(empty).count() == 0


def brute(rows):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    sets = []
    for _, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = word.findall(low)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 4 >= 3 * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    parent[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def test_near_classes_match_brute_force(spark):
    docs = odd_docs(spark).unionByName(spark.read.parquet(f"{SF}/documents.parquet"), allowMissingColumns=True)
    got = near_dedup.classes(docs).collect()
    expected = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_a_group_of_near_copies_and_texts_that_share_a_passage(spark):
    draw = np.random.default_rng(3)
    base = [f"b{i}" for i in range(200)]
    passage = " ".join(f"p{i}" for i in range(70))
    rows = []
    for i in range(150):  # each differs from the base in a few words, pairs among them by more
        words = list(base)
        for at in draw.choice(200, 4, replace=False):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    rows += [(1_000 + i, passage + " " + " ".join(f"q{i}_{k}" for k in range(60))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.classes(docs).collect()), key=str)
    assert got == brute(rows)
    left = {r.doc_id for r in near_dedup.without_near_copies(docs).collect()}
    assert left == {d for d, _, c in got if d == c}


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(5)
    common, a, b = (draw.integers(0, 2**63, n).astype(np.uint64) for n in (600, 100, 100))
    sets = [np.unique(np.concatenate([common, x])) for x in (a, b)]
    ranks = near_dedup.signatures([*sets, sets[0][:1]], 128)
    assert abs((ranks[0] == ranks[1]).mean() - 0.75) < 0.15
    assert sorted(np.floor(ranks[2])) == list(range(128))  # one shingle fills every component once
    assert (near_dedup.bands(ranks)[0] == near_dedup.bands(ranks)[1]).any()


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1_000, 1_000 + i) for i in range(1, 200)] + [(7, 7)]
    got, _ = components.components(spark.createDataFrame(links, "a long, b long").repartition(5))
    roots = {r.node: r.root for r in got.collect()}
    assert roots == {i: 0 for i in range(1, 61)} | {1_000 + i: 1_000 for i in range(1, 200)}


@pytest.mark.parametrize("name", ["op3_exact_dedup", "op5_near_dedup"])
def test_queries_return_each_document(spark, name):
    assert queries.QUERIES[name](spark, SF).count() == 200
