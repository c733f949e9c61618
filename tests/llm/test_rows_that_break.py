"""Rows that once gave a wrong result or too large a table: markup, repeated rows, long words, marks, hubs, labels."""

import collections
import random
import time
import tracemalloc
import unicodedata
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kwarta.llm import bpe, components, html_text, language, licenses, mixing, neighbours, queries, shared, warc
from kwarta.llm.shared import told

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "The history of the town began long ago, when people settled by the river. They built houses, and they stayed."


@pytest.mark.parametrize("page, expected", [
    ('<article><p title="5" wide">A</p><p>B</p><p class="x">C</p><p class=y">D</p></article>', "A B C D"),
    ("<article><p don't>It's first.<p>It's second.<p>It's third.</article>", "It's first. It's second. It's third."),
    ("<article><p title='a>b' x=1>one</p><p a=\"c>d\">two</p></article>", "one two"),
    ("<article><p>one</p><!--><p>two</p><!---><p>three</p><!-- <p>no</p> --!><p>four</p></article>", "one two three four"),
    ("<article><p>one</p><p title=\"never closed>two</p></article>", "one two"),
    ("<article><p>one</p></article><a ", "one"),
])
def test_stray_quotes_and_comments_lose_no_text(page, expected):
    assert html_text.main_text(page) == expected


def test_parts_of_an_article_are_judged_by_their_text():
    page = (f"<article><p>{PROSE}</p><section class='social-history'><p>{PROSE} One.</p><p>{PROSE} Two.</p></section>"
            f"<div id='search'><p>{PROSE} Three.</p><p>{PROSE} Four.</p></div><div class='comments'><p>{PROSE} No.</p><p>{PROSE} No.</p></div>"
            f"<article class='reply'><p>{PROSE} No.</p><p>{PROSE} No.</p></article><div id='discussion'><p>3 replies</p><p>me: no!</p></div>"
            "<div class='ad'>Buy now. No.</div><div class='related'><p><a href='x'>No</a></p><p><a href='y'>No</a></p></div></article>")
    assert html_text.main_text(page) == " ".join([PROSE, *(f"{PROSE} {n}." for n in ("One", "Two", "Three", "Four"))])


def test_a_deep_page_costs_no_more_per_element():
    tracemalloc.start()
    assert html_text.main_text("<div>" * 40_000 + "<p>Deep text, really.</p>") == "Deep text, really."
    assert tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()
    began = time.perf_counter()
    html_text.main_text("<div>" * 3_000 + "</b>" * 30_000 + "x")
    html_text.main_text("<a " * 60_000)
    assert time.perf_counter() - began < 5


def test_repeated_rows_are_mixed_one_by_one(spark):
    rows = [(i, "w " * (5 + i % 7), "a") for i in range(400)] + [(1009, "w " * 4, "b")] * 1000 + [(1010, "x y", "c")] * 7 + [(1011, "z", "c")]
    docs = spark.createDataFrame([(i, t, s, f"row{n}") for n, (i, t, s) in enumerate(rows)], "doc_id long, text string, source string, _rows string")
    taken, targets = collections.Counter(), {}
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    source = {1009: "b", 1010: "c", 1011: "c"}
    for r in got:
        taken[source.get(r.doc_id, "a")] += r.taken
        targets[source.get(r.doc_id, "a")] = r.target
        assert r.taken <= 2 * r.size
    for name, target in targets.items():
        assert abs(taken[name] - target) <= {"a": 11, "b": 4, "c": 2}[name]
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    words = collections.Counter()
    for r in mixed.collect():
        words[r.source] += len(r.text.split())
    assert words == taken
    copies = collections.Counter(r._rows for r in mixed.collect())
    assert len({copies[f"row{n}"] for n in range(400, 1400)}) == 2 and max(copies.values()) <= 2


@pytest.fixture
def model(spark):
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate([
        ("the house and the river", "en"), ("das haus und der fluss", "de"), ("घर और नदी हिन्दी भाषा", "hi"), ("日本語の文章です", "ja")] * 3)]
    return language.fit(spark.createDataFrame(rows, DOCS), queries.PIECE_VOCABULARY)


def test_words_keep_their_marks():
    assert language.words_of("हिन्दी भाषा, CAFÉ naïve 12 ² ½ x") == ["हिन्दी", "भाषा", "café", "naïve", "x"]
    assert language.words_of("12 ² ½ ́") == [] == language.words_of(None)


def test_long_words_are_scored_over_all_cuts(model):
    """A long word in the moving window scores as in the whole lattice, and a cut nowhere changes it."""
    _, chances = model
    lattice = language.pieces(queries.PIECE_VOCABULARY)
    draw = random.Random(2)
    for n in (10, 65, 200, 1_000):
        word = "".join(draw.choices("thehouseandriver日本語です", k=n))
        grid = lattice._grid("▁" + word, min(n + 1, lattice.longest))
        whole = language.forward(grid, chances)[0][0]
        assert np.allclose(lattice.long_score(word, chances), whole)
    (_, few), = list(lattice.lattices(["thehouse"]))
    assert (few == lattice._grid("▁thehouse", few.shape[2])).all()


def test_long_runs_and_corpora_without_labels(spark, model):
    rows = [(1, "日本語" * 5_000, None, "s", 1), (2, "the " * 9, "en", "s", 1), (3, "12 ½", "en", "s", 1), (4, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in language.identify(docs, queries.PIECE_VOCABULARY, model).collect()}
    assert (got[1].lang_pred, got[2].lang_pred, got[3].lang_pred, got[4].lang_pred) == ("ja", "en", "und", "und")
    assert [got[i].rejected for i in (1, 2, 3, 4)] == [False, False, True, True]
    bare = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("score", F.lit("x")).withColumn("rejected", F.lit(1)).withColumn("_own_0", F.lit(2))
    kept = corpus_pipeline.identify(spark, bare, "")
    assert kept.columns == bare.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_scores_remembered_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(language, "BYTES_KEPT", 8 * 2 * 300)
    vocabulary = language.pieces(queries.PIECE_VOCABULARY)
    scorer = language.Scorer(queries.PIECE_VOCABULARY, np.full((vocabulary.none + 1, 2), 1e-5))
    for n in range(20):
        scorer.score([" ".join(f"w{chr(97 + i % 26)}{chr(97 + n)}{chr(97 + i // 26)}" for i in range(100))])
        assert len(scorer._scores) <= 1024 and len(scorer._row) <= 300


def test_repeated_page_ids_with_other_payloads(spark):
    long = "é" * 600
    rows = [(9, "http://a.org/1", long), (9, "http://a.org/2", "x" * 2_000), (1, "http://a.org/3", long), (2, "http://a.org/3", "x" * 2_000)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == [
        (1, 1_200, "revisit", 9), (2, 2_000, "revisit", 9), (9, 1_200, "response", None), (9, 2_000, "response", None)]


def test_a_payload_above_what_is_read_at_once(spark, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 1_000)
    draw = random.Random(1)
    rows = [(i, f"http://a.org/{i % 3}", "".join(draw.choices("abcdefgh ", k=n))) for i, n in enumerate([5, 9_000, 200_000, 0, 3_000])]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in got) == [(i, len(t)) for i, _, t in rows]


def test_bpe_of_every_character():
    library, mine = Tokenizer.from_file(queries.WORD_VOCABULARY), bpe.Codec(queries.WORD_VOCABULARY)
    library.no_truncation()
    for start in range(0, 0x20000, 0x2000):
        chars = [chr(c) for c in range(start, start + 0x2000) if not 0xD800 <= c < 0xE000]
        for text in (" ".join(chars), "".join(f"{c}̀{c}a " for c in chars)):
            assert np.frombuffer(mine.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, hex(start)


def test_bpe_of_marks_in_any_order():
    library, mine = Tokenizer.from_file(queries.WORD_VOCABULARY), bpe.Codec(queries.WORD_VOCABULARY)
    marks = [chr(c) for c in range(0x300, 0x3000) if unicodedata.combining(chr(c))] + ["ᫀ", "࣐", "Ᲊ", "౜"]
    draw = random.Random(6)
    texts = ["a" + "".join(draw.choices(marks, k=4)) + draw.choice(["", " é", "Σ"]) for _ in range(1_500)]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == found.ids


def union_find(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent if find(x) != x}


@pytest.mark.parametrize("few", [500_000, 10])
@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(300)], [(0, i) for i in range(1, 3_000)], [(5_000, i) for i in range(3_000)],
    [(0, i) for i in range(1, 2_000)] + [(i, i + 10_000) for i in range(500)] + [(7, 7)], [],
])
def test_components_with_hubs(spark, monkeypatch, links, few):
    monkeypatch.setattr(components, "FEW", few)
    monkeypatch.setattr(shared, "FEW", few)
    frame = spark.createDataFrame(links, "a long, b long").repartition(11)
    groups, _ = components.components(frame)
    assert {r.node: r.root for r in groups.collect()} == union_find(links)


def test_rows_of_large_groups_are_told_in_place(spark):
    rows = spark.createDataFrame([(1, i) for i in range(900)] + [(2 + i, i) for i in range(100)], "k long, v long").repartition(9)
    groups = rows.groupBy("k").agg(F.max("v").alias("m"), F.count(F.lit(1)).alias("n"))
    for total in (1_000, 1_000_000):
        out = told(rows, groups, "k", "n", total, "m")
        assert sorted(map(tuple, out.select("k", "v", "m").collect())) == sorted([(1, i, 899) for i in range(900)] + [(2 + i, i, i) for i in range(100)])


def test_clashing_names_pass_all_stages(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(i, f"{text} {i % 3}", "en", "s", 1, *"abcdefg") for i in range(6)]
    names = ["_gone_hash", "_gone_id", "_hash", "keep_id", "_in_0", "copies", "_key"]
    docs = spark.createDataFrame(rows, DOCS + ", " + ", ".join(f"{n} string" for n in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == [*(c.split()[0] for c in DOCS.split(", ")), *names] and docs.count() > 0


@pytest.mark.parametrize("rows", [
    [], [(None, None, None, None, None)] * 3, [(1, "", "en", "s", 0)] * 2 + [(2, "12 3", None, None, 4)],
    [(1, "one text for all of these rows", "en", "s", 1)] * 5 + [(2, "une autre phrase ici", "fr", None, 2)],
])
def test_stages_against_their_definitions(spark, rows):
    """Each stage on what the one before left, against plain Python: which rows stay, with all their columns."""
    docs = spark.createDataFrame(rows, DOCS)
    before = [tuple(r) for r in docs.collect()]
    docs = corpus_pipeline.identify(spark, docs, "")
    kept = [r for r in before if r[1] and any(c.isalpha() for c in r[1])]
    assert sorted(map(repr, map(tuple, docs.collect()))) == sorted(map(repr, kept))
    docs = corpus_pipeline.exact(spark, docs, "")
    last = {t: max((r for r in kept if r[1] == t), key=lambda r: -1 if r[0] is None else r[0]) for t in {r[1] for r in kept}}
    assert sorted(map(repr, map(tuple, docs.collect()))) == sorted(map(repr, last.values()))
    docs = corpus_pipeline.near(spark, docs, "")
    assert sorted(map(repr, map(tuple, docs.collect()))) == sorted(map(repr, last.values()))  # none is near another
    mixed = [tuple(r) for r in corpus_pipeline.mix(spark, docs, "").collect()]
    assert set(map(repr, mixed)) <= set(map(repr, last.values())) and all(mixed.count(r) <= 2 for r in mixed)
    encoded = corpus_pipeline.encode(spark, docs, "").collect()
    assert len(encoded) == len(last) and all(r.n_tokens == len(r.ids) > 0 for r in encoded)


GNU = ("This program is free software{}: you can redistribute it and/or modify\nit under the terms of the GNU {} as published by\nthe Free Software "
       "Foundation, either version {} of the License, or\n(at your option) any later version.")


@pytest.mark.parametrize("text, expected", [
    ("// SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"), ("SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
    ("# SPDX-License-Identifier: (MIT OR Apache-2.0)\nint main;", "Apache-2.0,MIT"), ("SPDX-License-Identifier: LGPL-2.1", "LGPL-2.1"),
    ("SPDX-License-Identifier: GPL-2.0+ AND BSD-3-Clause WITH x", "BSD-3-Clause,GPL-2.0"),
    ("Licensed under the terms of the MIT license.", "MIT"), (GNU.format("", "General Public License", "3"), "GPL-3.0"),
    ("A tool.\n\n" + GNU.format("", "Affero General Public License", "3") + "\n\nMore.", "AGPL-3.0"),
    (GNU.replace("program", "library").format("", "Lesser General Public License", "2.1"), "LGPL-2.1"),
    ("MIT or Harvard", ""), ("this or that license", ""),
])
def test_expressions_and_notices_of_licences(spark, text, expected):
    docs = spark.createDataFrame([(1, text, "x", True), (1, text, "y", False)], "doc_id long, text string, license string, whole boolean")
    assert [r.licenses for r in licenses.scan(docs).collect()] == [expected] * 2


@pytest.mark.parametrize("file, name", [
    ("LGPL-2.1", "LGPL-2.1"), ("LGPL-2", "LGPL-2.0"), ("GPL-1", "GPL-1.0"), ("GFDL-1.3", "GFDL-1.3"), ("GFDL-1.2", "GFDL-1.2"),
    ("Artistic", "Artistic-1.0-Perl"), ("MPL-1.1", "MPL-1.1"), ("BSD", "BSD-3-Clause"),
])
def test_more_licences_in_full(spark, file, name):
    path = Path("/usr/share/common-licenses") / file
    if not path.exists():
        pytest.skip("not on this machine")
    full = path.read_text(errors="replace")
    docs = spark.createDataFrame([(1, full), (2, f"Third parties\n\n{full}\n\nEnd.")], "doc_id long, text string")
    got = {r.doc_id: (r.licenses, r.whole_license) for r in licenses.scan(docs).collect()}
    assert got[1] == (name, name) and got[2][1] is None
    if name != "MPL-1.1":  # known as a whole text only
        assert name in got[2][0].split(",")


def clustered(n, size, clusters, seed):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((clusters, size)) * 3
    return (centres[draw.integers(0, clusters, n)] + draw.standard_normal((n, size))).astype(float)


def test_recall_with_production_settings_on_a_hundred_lists(spark):
    data = clustered(50_000, 24, 400, 3)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    asked = list(range(0, 50_000, 500))
    found = neighbours.search(frame, frame.where(F.col("vec_id") % 500 == 0), 10).collect()
    near = collections.defaultdict(set)
    for r in found:
        near[r.query_id].add(r.vec_id)
    hits = 0
    for q in asked:
        d = ((data - data[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(near[q] & set(np.argsort(d)[:10].tolist()))
    assert hits >= 0.9 * 10 * len(asked)


def test_probing_holds_few_queries_at_once():
    draw = np.random.default_rng(1)
    model = neighbours.Model.__new__(neighbours.Model)
    model.centres, counts = draw.standard_normal((4_096, 16)), draw.integers(0, 900, 4_096)
    turned = draw.standard_normal((neighbours.PROBED, 16))
    tracemalloc.start()
    q, lists = model.probed(turned, counts, 11, 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120e6 and len(q) >= 20 * len(turned)
    q, lists = model.probed(turned[:5], np.where(np.arange(4_096) % 50 == 0, 3, 0), 11, 20)
    for i in range(5):
        own = lists[q == i]
        assert len(own) == len(set(own.tolist())) and (np.asarray(own) % 50 == 0).sum() * 3 >= 11
