"""Token files: ids as the library gives them, random access against the plain array, odd rows."""

import io
import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kwarta.llm import token_store
from kwarta.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY
from kwarta.llm.shared import new_folder

LIBRARY = Tokenizer.from_file(BYTE_VOCABULARY)
SF = "/root/testdata/sf0.001"


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def ours(text, vocabulary=BYTE_VOCABULARY):
    return np.frombuffer(token_store.encoder(vocabulary).encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b's", " ", "  ", "\n", "\t ", "\x1c ", "\x85 ", "᠎ ", "​ ", "　", "7", "é", "'", "<|endoftext|>", "<|end", "日本", "!"]), max_size=20))
def test_ids_of_any_spacing(parts):
    text = "".join(parts)
    assert ours(text) == library_ids(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=" \t\n\r'sdtmrevlaZ09.!<|>éßŵ×·\u00a0", max_size=40))
def test_ids_of_any_mix_of_classes(text):
    assert ours(text) == library_ids(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    assert ours(text) == library_ids(text)


def test_every_character_before_a_space():
    for start in range(0, 0x20000, 0x1000):
        chars = [chr(c) for c in range(start, start + 0x1000) if not 0xD800 <= c < 0xE000]
        texts = ["x".join(f"{c} {c}a" for c in chars), "".join(f"b{c}7{c}{c}\n{c}'s" for c in chars if start < 0x3000)]
        for text in texts:
            assert ours(text) == library_ids(text), hex(start)


def test_a_vocabulary_that_may_look_across_spaces_gets_whole_texts():
    text = "Two  words, and <|endoftext|> more."
    assert ours(text, WORD_VOCABULARY) == Tokenizer.from_file(WORD_VOCABULARY).encode(text, add_special_tokens=False).ids


def bits_taken(chosen, ids):
    """Bits of chunks and flags, counted id by id."""
    total = 0
    for i in ids:
        for level, width in enumerate(chosen):
            total += width + (level + 1 < len(chosen))
            i >>= width
            if not i:
                break
    return total


@pytest.mark.parametrize("seed", range(8))
def test_widths_are_the_cheapest(seed):
    draw = random.Random(seed)
    ids = [draw.randrange(1 << draw.randrange(1, 8)) for _ in range(100)]
    most = max(ids).bit_length()
    every = [c for n in range(1, most + 1) for c in itertools.product(range(1, most + 1), repeat=n) if sum(c) == most]
    found = token_store.widths(np.array(ids, np.uint32))
    assert sum(found) == most
    assert bits_taken(found, ids) == min(bits_taken(c, ids) for c in every)


@pytest.mark.parametrize("ids", [
    [0], [0] * 1024, list(range(5000)), [2**32 - 1, 0, 1], [1, 70000] * 513, [random.Random(1).randrange(50257) for _ in range(4097)],
])
def test_any_token_and_any_run(tmp_path, ids):
    out, array = io.BytesIO(), np.array(ids, np.uint32)
    cut = len(ids) // 2
    token_store.write_file(out, array, [7, None], np.array([0, cut, len(ids)]))
    path = tmp_path / "a.dac"
    path.write_bytes(out.getvalue())
    file = token_store.TokenFile(str(path))
    assert (file.tokens, file.documents) == (len(ids), 2)
    assert file.docs(0, 2)[0] == [7, None] and file.docs(0, 2)[1].tolist() == [0, cut, len(ids)]
    draw = random.Random(2)
    for at in {0, len(ids) - 1, *(draw.randrange(len(ids)) for _ in range(200))}:
        assert file.token(at) == ids[at]
    for _ in range(50):
        a, b = sorted(draw.randrange(len(ids) + 1) for _ in range(2))
        assert file.read(a, b - a).tolist() == ids[a:b]
    with pytest.raises(IndexError):
        file.read(len(ids), 1)


def test_one_token_reads_few_bytes(tmp_path):
    out = io.BytesIO()
    ids = np.array([random.Random(3).randrange(50257) for _ in range(200_000)], np.uint32)
    token_store.write_file(out, ids, [1], np.array([0, len(ids)]))
    (tmp_path / "a.dac").write_bytes(out.getvalue())
    file = token_store.TokenFile(str(tmp_path / "a.dac"))
    seen, plain = [], file._read
    file._read = lambda at, size: seen.append(size) or plain(at, size)
    file.token(123_457)
    assert sum(seen) <= len(file.footer["levels"]) * (64 + 8 + 8)


ROWS = [(5, "five words are in here"), (3, None), (None, "no id"), (9, ""), (3, "again three"), (3, "again three"), (1, "x" * 50_000),
        (2, "long " * 30_000), (4, "  two  spaces \n and <|endoftext|>")]


def docs(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "p", 1) for i, t in rows], "doc_id long, text string, path string, start int").repartition(3)


@pytest.mark.parametrize("file_tokens", [1, 10_000, 1 << 24])
def test_round_trip_of_odd_rows(spark, file_tokens):
    store = token_store.write(docs(spark), new_folder(spark, "t"), BYTE_VOCABULARY, end_id=2, file_tokens=file_tokens)
    got = sorted(token_store.read(store, ids=True).collect(), key=lambda r: r.start)
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda d: -1 if d is None else d)
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(i), library_ids(t) + [2]) for i, t in ROWS)
    at, whole = 0, []
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens
        whole += r.ids
    places = [0, 1, 17, 17, len(whole) - 1, len(whole), -1, None, 30_000]
    found = token_store.take(store, spark.createDataFrame([(p,) for p in places], "position long")).collect()
    assert sorted((r.position, r.token) for r in found) == sorted((p, whole[p]) for p in places if p is not None and 0 <= p < len(whole))


def test_without_end_id_and_without_rows(spark):
    store = token_store.write(docs(spark, [(1, ""), (2, None)]), new_folder(spark, "t"), BYTE_VOCABULARY)
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in token_store.read(store).collect()) == [(1, 0, 0), (2, 0, 0)]
    assert token_store.round_trip(docs(spark).where("false"), BYTE_VOCABULARY, end_id=2).count() == 0


def test_all_documents_of_the_query(spark):
    from kwarta.llm import queries

    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op11_token_files(spark, SF).collect()}
    at, expected = 0, {}
    for r in sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = library_ids(r.text) + [2]
        expected[r.doc_id] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == expected
