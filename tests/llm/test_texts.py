"""BPE, secrets, licences, languages and pages: against other implementations, and the rows that break things."""

import hashlib
import html
import os
import random
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from kwarta.llm import bpe, html_text, language, licenses, queries, secrets

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n", "a" * 3_000, "Σ ΑΣ İ ß é <|endoftext|>x", "it's 12½ 日本 😀 \x1c\x00 -- ",
       "token = deadbeefdeadbeefdeadbeef00", "Licensed under the MIT License."]


def odd(spark):
    rows = [(i, t, "x", 1, "y", 2.0, "z") for i, t in enumerate([*ODD, ODD[5]])] + [(None, "one", None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, n_tokens long, spans string, score double, key string")


def empty(spark):
    return odd(spark).where("false")


def test_bpe_equals_the_library(spark):
    path = queries.WORD_VOCABULARY
    library, mine = Tokenizer.from_file(path), bpe.Codec(path)
    library.no_truncation()
    draw = random.Random(1)
    texts = [t for t in ODD if t] + ["".join(draw.choices("abcdeéñß'!?. \n0129ΣσİÅ中</w>|́", k=80)) for _ in range(1_500)]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = np.frombuffer(mine.encode(text), "<u4").tolist()
        assert ids == found.ids
        assert mine.decode(mine.encode(text)) == library.decode(found.ids, skip_special_tokens=False)


def test_bpe_rows(spark):
    got = bpe.encode(odd(spark), queries.WORD_VOCABULARY, columns=odd(spark).columns, ids=True).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
    assert {r.n_tokens for r in got if not (r.doc_id is None or ODD[r.doc_id % 8] if r.doc_id != 8 else 1)} <= {0}
    assert bpe.encode(empty(spark), queries.WORD_VOCABULARY).count() == 0


def spans_of(text):
    found = []
    for order, (kind, pattern, group, least) in enumerate((
        ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24),
    )):
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return [s for _, _, s in sorted(found)]


def test_secrets_match_brute_force(spark):
    draw = random.Random(2)
    parts = ["token=", "PASSWORD : '", "api_key\":", "abc", "AKIA", "0123456789abcdef", "ABCDEF0123456789", "é😀", " ", "\n", "secret=token:", "x.y-z=/+"]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 30))) for _ in range(300)] + ODD + ["token=abcdefg " * 1_200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in secrets.find(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        base = spans_of(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert got[i].n_assign == sum(s.startswith("assign") for s in base)
        assert set(base) <= set(got[i].spans.split(",")) or not base


def test_weak_candidates_need_their_complement(spark):
    key, bare = "AKIA" + "A1" * 8, "Zz9+" * 10
    texts = [
        f"{key} then {bare} end", f"{bare} alone", key + " " * 300 + bare,
        f"user.name@example.com token=abcdef123 https://api.example.com/x", "mail user.name@example.com only",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_linked, re.sub(r"[:\d]", "", r.spans)) for r in secrets.find(docs.union(docs)).distinct().collect()}
    assert got == {0: (1, "access,bare"), 1: (0, ""), 2: (0, "access"), 3: (2, "account,assign,endpoint"), 4: (0, "")}


def test_linked_parts_exactly_the_scope_apart(spark):
    key, bare = "AKIA" + "A1" * 8, "Zz9+" * 10
    texts = []
    for end in (199, 200, 201, 400):
        for gap in (secrets.SCOPE - 1, secrets.SCOPE, secrets.SCOPE + 1):
            texts += [" " * (end - len(key)) + key + " " * gap + bare, " " * (end - len(bare)) + bare + " " * gap + key]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_linked for r in secrets.find(docs).collect()}
    assert got == {i: int(i // 2 % 3 < 2) for i in range(len(texts))}


def test_licences(spark):
    mit = next(t for k, t in licenses.known_texts() if k == "MIT")
    texts = [
        mit, "Copyright (c) 2020 Me\n\n" + mit.upper().replace("LICENSE", "LICENCE"), "some\nReleased under the MIT License.\nmore",
        "Licensed under CC BY-NC 4.0.", "MIT is a school in Cambridge", *ODD[:3],
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, digest string")
    got = {r.doc_id: (r.licenses, r.whole_license) for r in licenses.scan(docs.union(docs)).distinct().collect()}
    assert got == {0: ("MIT", "MIT"), 1: ("MIT", "MIT"), 2: ("MIT", None), 3: ("CC-BY-NC-4.0", "CC-BY-NC-4.0"), 4: ("", None)} | {
        i: ("", None) for i in (5, 6, 7)}
    assert licenses.scan(docs.where("false")).count() == 0


def test_licences_in_full_and_inside_texts(spark):
    text = {k: ts[0] for k, ts in licenses.TEXTS.items()}
    wrapped = "\n".join(" * " + line for line in re.findall(r"\S.{1,60}(?:\s|\Z)", text["MIT"].replace("\n\n", " ")))
    texts = [
        ("Copyright (c) 2020, Me\nAll rights reserved.\n\n" + text["BSD-2-Clause"], "BSD-2-Clause", "BSD-2-Clause"),
        ("Some words.\n\n" + text["BSD-3-Clause"] + "\n\nMore words.", "BSD-3-Clause", None),
        (f"/*\n{wrapped}\n */\nint main;", "MIT", None),
        (f"One\n{text['ISC']} and\n{text['MIT']}\n{text['MIT']}\n\n{text['0BSD']}\n\n{text['Apache-2.0']}", "0BSD,Apache-2.0,ISC,MIT", None),
        (text["MIT"][:-40] + " but not the end", "", None), ("x " + text["MIT"][:-1] + "s", "", None), ("All rights reserved.", "", None),
    ]
    kept = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0"}
    for name, file in kept.items():
        if os.path.exists(path := f"/usr/share/common-licenses/{file}"):
            with open(path) as f:
                full = f.read()
            texts += [(full, name, name), (f"# Third parties\n\n{full}\nEnd.", name, None)]
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.licenses, r.whole_license) for r in licenses.scan(docs).collect()}
    for i, (_, found, whole) in enumerate(texts):
        assert found == got[i][0] or set(found.split(",")) <= set(got[i][0].split(",")) and i >= 7, (i, got[i])
        assert whole == got[i][1], (i, got[i])


def test_language_of_documents_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = queries.op10_language(spark, SF).collect()
    out = [r for r in got if r.held_out]
    assert len(got) == 200 and len(out) > 20
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs, queries.PIECE_VOCABULARY, docs_per_language=20, rounds=1)
    got = {r.doc_id: r for r in language.identify(odd(spark), queries.PIECE_VOCABULARY, model, columns=odd(spark).columns).collect()}
    assert [got[i].lang_pred for i in range(3)] == ["und"] * 3 and got[3].lang_pred in model[0]
    untrained = language.fit(docs.where("false"), queries.PIECE_VOCABULARY)
    assert {r.lang_pred for r in language.identify(docs, queries.PIECE_VOCABULARY, untrained).collect()} == {"und"}
    assert language.identify(empty(spark), queries.PIECE_VOCABULARY, model).count() == 0


def test_numbers_that_are_no_digits_are_no_letters(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs, queries.PIECE_VOCABULARY, docs_per_language=20, rounds=1)
    texts = ["12 ² ½", "Ⅷ ① ೬ ⅔ ㊗", "² the ½"]
    odd = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score > 0) for r in language.identify(odd, queries.PIECE_VOCABULARY, model).collect()}
    assert got[0] == got[1] == ("und", False) and got[2][0] in model[0]


def test_the_pipeline_keeps_texts_between_languages(spark):
    rows = [(i, f"the cat sat on mat {i // 3}", "abc"[i % 3]) for i in range(120)] + [(-2, "12 ² ½", None), (-3, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    scores = [r.score for r in language.identify(docs, queries.PIECE_VOCABULARY, queries.language_model(docs)).collect()]
    assert sum(0 < s < 0.5 for s in scores) == 120
    assert {r.doc_id for r in corpus_pipeline.identify(spark, docs, SF).collect()} == set(range(120))



def test_forward_sums_all_segmentations():
    pieces = language.Pieces.__new__(language.Pieces)
    pieces.number, pieces.longest, pieces.other, pieces.none = {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4}, 2, 5, 6
    chances = np.array([[0.3], [0.2], [0.1], [0.25], [0.1], [0.05], [0.0]])
    (places, grid), = pieces.lattices(["ab"])
    expected = 0.3 * 0.2 * 0.1 + 0.3 * 0.25 + 0.1 * 0.1
    assert np.exp(language.forward(grid, chances)[0][0, 0]) == pytest.approx(expected)
    counts = np.zeros(7)
    language.expected(grid, chances[:, 0], np.ones(1), counts)
    assert counts[3] == pytest.approx(0.3 * 0.25 / expected)
    long, _ = next(pieces.lattices(["ab" * 90]))[1], None
    assert np.isfinite(language.forward(long, chances)[0]).all()


PAGES = {
    "<body><nav><a href=x>Menu</a></nav><article><h1>Title &amp; more</h1><p>First <b>par</b>t.<p>Second&nbsp;one.</article><footer>c</footer>":
        "Title & more First part. Second one.",
    "<div class='content'><p>A long paragraph, with text; it goes on for the reader.</p><p>Another, as long as the first one is.</p></div>"
    "<ul class=menu><li><a>x</a></ul><div id='comments'><p>Nice post, I liked it very much indeed!</p></div>":
        "A long paragraph, with text; it goes on for the reader. Another, as long as the first one is.",
    "<script>var a='<p>no</p>';</script><style>p{}</style><main>Only <!-- not --> this.</main>": "Only this.",
    "": "", "plain": "plain",
}


def test_pages(spark):
    rows = [(i, f"u{i}", page, "x", 1) for i, page in enumerate([*PAGES, None, "<p>" * 5_000 + "deep"])]
    pages = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string, text string, n_chars int")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(pages).collect()}
    expected = [*PAGES.values(), "", "deep"]
    assert got == {i: (t, len(t)) for i, t in enumerate(expected)}
    assert html_text.extract(pages.where("false")).count() == 0


def test_article_of_every_test_page(spark):
    for r in queries.op4_html(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search("<article>(.*)</article>", r.html, re.S)[1]
        plain = html.unescape(re.sub("</?[a-z][^>]*>", "", re.sub("</?(p|h1|br)>", " ", article)))
        assert r.text == " ".join(plain.split())


BODY = "".join(f"<p>Sentence {i} of the body, which is long enough to be read; it has marks, too.</p>" for i in range(6))
BODY_TEXT = " ".join(f"Sentence {i} of the body, which is long enough to be read; it has marks, too." for i in range(6))


@pytest.mark.parametrize(("page", "text"), [
    (f"<main><h1>Head</h1>{BODY}<article class='teaser related'><h2>More</h2><p>Short, a teaser.</p></article></main>", f"Head {BODY_TEXT}"),
    (f"<div><h1>Head</h1>{BODY}</div><article class=x><p>One line</p></article>", f"Head {BODY_TEXT} One line"),
    (f"<main><article><h2>One</h2>{BODY}<ul><li>Short</ul></article><article><h2>Two</h2>{BODY}</article></main>",
     f"One {BODY_TEXT} Short Two {BODY_TEXT}"),
    (f"<ul><li><a href=x>Menu</a></ul><div><h1>Head</h1>{BODY}<h2>Part</h2>{BODY}</div><div><span>Posted</span></div>",
     f"Head {BODY_TEXT} Part {BODY_TEXT}"),
])
def test_names_do_not_overrule_the_ratios(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page", [
    f"<div class='layout has-sidebar'><article>{BODY}</article><div class=sidebar>Side text.</div></div>",
    f"<div id='search-results-page'><div>{BODY}</div></div><footer>End of the page.</footer>",
    f"<div class='no-comments'><main>{BODY}</main></div><div class=related><article><p>A teaser.</p></article></div>",
    f"<form id='aspnetForm'><ul class=menu><li>Menu</ul><article>{BODY}</article></form>",
    f"<article data-id='comments-12' title='a class=ad b'>{BODY}</article>", f"<div data-id='comments-12'>{BODY}</div>",
    f"<article class='post has-related'>{BODY}</article>",
    f"<div class='page with-banner'><article>{BODY}</article></div><div>{'<p>x y.</p>' * 300}</div>",
    f"<head><title>t</title><body>{BODY}", f"<article>{BODY}</article><div id=comments>{'<p>Nice, I like it.</p>' * 80}</div>",
    f"<article>{BODY}</article><section class=related><article><h3>Other</h3><p>Short.</p></article></section>",
])
def test_furniture_words_on_wrappers(page):
    assert html_text.main_text(page) == BODY_TEXT


@pytest.mark.parametrize(("page", "text"), [
    (f"<article><svg width='1'/>{BODY}<p>x <math/> y</p></article>", f"{BODY_TEXT} x y"),
    (f"<article><svg><title/><path d=''/><text>Label</text></svg>{BODY}</article>", BODY_TEXT),
    (f"<article><svg><text>Label</text>{BODY}</article>", BODY_TEXT),
    (f"<article><object data=x>{BODY}</article><p>z</p>", BODY_TEXT), (f"<div><noscript>{BODY}</div>", BODY_TEXT),
    (f"<article><select><option>One<option>Two{BODY}</article>", BODY_TEXT), (f"<template>{BODY}", BODY_TEXT),
    (f"<article><p>In <math><mi>a</mi><mo>=</mo><mi>b</mi></math>.</p>{BODY}</article>", f"In a=b. {BODY_TEXT}"),
    (f"<article>{BODY}<p>Pick <select><option>One<option>Two</select> now</p></article>", f"{BODY_TEXT} Pick now"),
    (f"<article><object>Old</object><noscript><p>No</noscript><template><p>T</p></template>{BODY}</article>", BODY_TEXT),
    (f"<script>'<p>'</script><textarea><p>t</textarea><div>{BODY}</div>", BODY_TEXT),
])
def test_elements_that_are_not_raw_text(page, text):
    assert html_text.main_text(page) == text
