"""Periodic runs: Lyndon arrays and runs against brute force, the query's rows against plain Python."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kwarta.llm import periodic, queries

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


def longest_lyndon(symbols, start, largest_first):
    word, best = [-s if largest_first else s for s in symbols[start:]], 1
    for end in range(2, len(word) + 1):
        if all(word[:end] < word[k:end] for k in range(1, end)):
            best = end
    return best


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=16), st.booleans())
def test_lyndon_lengths(symbols, largest_first):
    expected = [longest_lyndon(symbols, i, largest_first) for i in range(len(symbols))]
    assert periodic.lyndon_lengths(symbols, largest_first) == expected


def brute_runs(words, exponent=4, least=6):
    """Every maximal stretch of every period, kept if the period is its smallest."""
    n, out = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                run = words[i : j + q]
                if not any(run[r:] == run[:-r] for r in range(1, q)):
                    out.add((i, j - i + q, q))
            i = j + 1
    return sorted(out)


def brute_row(words, exponent=4, least=6):
    runs = brute_runs(words, exponent, least)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def repetitive(draw):
    words = []
    while len(words) < draw.randrange(1, 150):
        base = [f"w{draw.randrange(draw.choice([1, 2, 3, 40]))}" for _ in range(draw.randrange(1, 16))]
        words += (base * draw.randrange(1, 8))[: draw.randrange(1, 90)]
    return words


@pytest.mark.parametrize("wanted", [periodic.Wanted(), periodic.Wanted(2, 2), periodic.Wanted(3, 100), periodic.Wanted(5, 1)])
def test_runs_of_many_texts_at_once(wanted):
    draw = random.Random(7)
    for _ in range(60):
        texts = [repetitive(draw) for _ in range(draw.randrange(1, 8))]
        spaced = [draw.choice(["", " ", "\n\n"]) + draw.choice([" ", "\t \r"]).join(t) + draw.choice(["", " "]) for t in texts]
        found = list(periodic.found_in([t.encode() for t in spaced], wanted))
        for words, (runs, digest) in zip(texts, found, strict=True):
            expected = brute_row(words, wanted.exponent, wanted.least)
            assert runs == brute_runs(words, wanted.exponent, wanted.least)
            assert digest == expected[-1]


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_odd_rows(spark):
    texts = [None, "", " \n ", "a " * 5, "a " * 6, "a b " * 4, "a b c " * 3, "日 é " * 9, "x y " * 8, "a\x1cb " * 7, "b" * 100_000, "n " * 50_000,
             "one two three four five six seven eight nine ten " * 40, "a " * 6]
    rows = [(i if i else None, t, "kept", "own") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_runs string").repartition(3)
    got = periodic.find(docs, columns=["doc_id", "n_runs"], listed=True).collect()
    assert len(got) == len(rows)
    for r in got:
        words = WORDS(texts[r.doc_id or 0] or "")
        expected = brute_row(words) if len(set(words)) > 1 or len(words) < 100 else None
        if expected:
            assert tuple(r[c] for c in COLUMNS) == expected
        else:
            assert [tuple(x) for x in r.runs] == ([(0, len(words), 1)] if len(words) >= 6 else [])
    assert periodic.find(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        periodic.find(docs, exponent=1)


def planted(doc_id, words):
    checksum = zlib.crc32(str(doc_id).encode())
    n, g = len(words), checksum // 10
    if checksum % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_all_documents_of_the_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op12_periodic(spark, SF).collect()}
    short = [r for r in docs if len(WORDS(r.text or "")) <= 1500]
    assert len(got) == len(docs) and len(short) > len(docs) * 0.8
    assert sum(g[0] > 0 for g in got.values()) > 10
    for r in short:
        assert got[r.doc_id] == brute_row(planted(r.doc_id, WORDS(r.text or "")))


def test_time_grows_with_the_text():
    draw = random.Random(3)
    taken = []
    for n in (20_000, 80_000):
        words = np.array(([draw.randrange(4) for _ in range(9)] * n)[:n])
        began = time.perf_counter()
        assert periodic.runs(words, 0, n, periodic.Wanted()) >= {(0, n, 9)}
        taken.append(time.perf_counter() - began)
    assert taken[1] < 12 * taken[0]
