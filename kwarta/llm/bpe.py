"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word exactly one token can be the last of its encoding: a token that ends there
(found by a suffix automaton over the vocabulary) and that may stand after the last token of the prefix it
leaves. Two tokens may stand side by side if no merge crosses their border before both are complete. Following
the stored last tokens back from the word's end gives the ids that merging by rank gives.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kwarta.llm.shared import small_batches

#: Words whose ids a task remembers; when full, it starts anew.
WORDS_KEPT = 600_000
#: Pairs of tokens whose fit a task remembers.
PAIRS_KEPT = 400_000
#: Words longer than this many characters are encoded but not remembered.
LONGEST_KEPT = 64

#: First symbol for "last byte of a word"; the 256 symbols below it are the bytes.
_END = 0x2000

#: How the vocabulary's normaliser and pre-tokeniser cut text of the first 256 characters, in lower case.
#: Classes and composition of all others depend on the library's version of Unicode, so the library cuts such text.
_WIDE = re.compile("[^\x00-\xff]")
_NARROW_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\x09-\x0D\x20\x85\xA0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+"
).findall


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    others = (b for b in range(256) if b not in letters)
    letters |= {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


def pack(ids: Iterable[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return np.fromiter(ids, "<u4").tobytes()


class Found(dict):
    """Packed ids of pieces of text, found on first use."""

    def __init__(self, find: Callable[[str], bytes]) -> None:
        super().__init__()
        self._find = find

    def __missing__(self, piece: str) -> bytes:
        ids = self._find(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """A word-level BPE vocabulary with word ends: lower case, white space dropped."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        by_id = {i: t for t, i in (model["vocab"] | self.special).items()}
        self.token_text = [by_id.get(i, "") for i in range(max(by_id) + 1)]
        letters = byte_letters()
        self._symbol_of = {letter: chr(b) for b, letter in enumerate(letters)}
        vocab = model["vocab"]
        self._parts, self._rank = {}, {}
        for rank, (left, right) in enumerate(model["merges"]):
            made = vocab[left + right]
            self._rank[vocab[left], vocab[right]] = rank
            self._parts.setdefault(made, (rank, vocab[left], vocab[right]))
        self._left, self._right = lru_cache(None)(self._left_edge), lru_cache(None)(self._right_edge)
        self._pairs: dict[int, bool] = {}
        self._reached: dict[int, bool] = {}
        self._length, self._automaton = {}, ahocorasick.Automaton()
        for text, i in vocab.items():
            if text in self.special or not self._whole(i):
                continue
            symbols = self._symbols(text, end)
            self._length[i] = len(symbols)
            self._automaton.add_word(symbols, (len(symbols), i))
        self._automaton.make_automaton()
        self.words = Found(lambda word: pack(self.word_ids(word)))
        library = Tokenizer.from_file(path)
        self._normaliser, self._cutter = library.normalizer, library.pre_tokenizer
        self._specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def _symbols(self, token: str, end: str) -> str:
        """One symbol per byte; the last byte of a word has symbols of its own."""
        last = len(end) if token.endswith(end) and len(token) > len(end) else 0
        letters = [self._symbol_of[c] for c in token[: len(token) - last]]
        if last:
            letters[-1] = chr(_END + ord(letters[-1]))
        return "".join(letters)

    def _right_edge(self, token: int) -> list[tuple[int, float]]:
        """From the last byte up to the token: each token on its right edge and the rank of the merge that takes it in."""
        edge, above = [], math.inf
        while True:
            edge.append((token, above))
            if token not in self._parts:
                return edge[::-1]
            above, _, token = self._parts[token]

    def _left_edge(self, token: int) -> list[tuple[int, float]]:
        edge, above = [], math.inf
        while True:
            edge.append((token, above))
            if token not in self._parts:
                return edge[::-1]
            above, token, _ = self._parts[token]

    def fits(self, left: int, right: int, before: float = math.inf) -> bool:
        """Whether no merge of rank under `before` crosses the border while both sides are being built.

        Merges fire by rank, equal ones from the left: a crossing merge loses to an equal one inside the left
        token and wins over an equal one inside the right.
        """
        a, b = self._right(left), self._left(right)
        i = j = 0
        while True:
            (x, x_above), (y, y_above) = a[i], b[j]
            crossing = self._rank.get((x, y))
            if crossing is not None and crossing < before and crossing < x_above and crossing <= y_above:
                return False
            if x_above == y_above == math.inf:
                return True
            if x_above <= y_above:
                i += 1
            else:
                j += 1

    def _whole(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token: its halves are whole and meet by its own merge."""
        if token not in self._parts:
            return True
        if token not in self._reached:
            rank, left, right = self._parts[token]
            self._reached[token] = self._whole(left) and self._whole(right) and self.fits(left, right, rank)
        return self._reached[token]

    def word_ids(self, word: str) -> list[int]:
        """Ids of one piece of text, by the last token of every prefix."""
        data = word.encode("utf-8", "surrogatepass").decode("latin-1")
        symbols = data[:-1] + chr(_END + ord(data[-1]))
        last = [-1] * len(symbols)
        pairs = self._pairs
        for at, (length, token) in self._automaton.iter(symbols):
            if last[at] >= 0:
                continue
            if length > at:
                last[at] = token
            elif (before := last[at - length]) >= 0:
                pair = before << 24 | token
                fit = pairs.get(pair)
                if fit is None:
                    if len(pairs) >= PAIRS_KEPT:
                        pairs.clear()
                    fit = pairs[pair] = self.fits(before, token)
                if fit:
                    last[at] = token
        ids, at = [], len(symbols) - 1
        while at >= 0:
            ids.append(last[at])
            at -= self._length[last[at]]
        return ids[::-1]

    def _plain_ids(self, text: str) -> bytes:
        pieces = self._cut(text) if _WIDE.search(text) else _NARROW_PIECES(text.lower())
        return b"".join(map(self.words.__getitem__, pieces))

    def _cut(self, text: str) -> list[str]:
        """Pieces of any text by the library's normaliser and pre-tokeniser, which gives a letter for each byte."""
        cut = self._cutter.pre_tokenize_str(self._normaliser.normalize_str(text))
        return ["".join(map(self._symbol_of.__getitem__, piece)).encode("latin-1").decode() for piece, _ in cut]

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a whole text; special tokens written out in it keep their ids. Null and empty: none."""
        if not text:
            return b""
        if not self._specials or "<|" not in text:
            return self._plain_ids(text)
        parts = self._specials.split(text)
        return b"".join(pack([self.special[p]]) if p in self.special else self._plain_ids(p) for p in parts)

    def decode(self, ids: bytes) -> str:
        """The tokens of packed ids with a space between, as the vocabulary names no decoder."""
        return " ".join(map(self.token_text.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def codec(path: str) -> Codec:
    """The vocabulary, once per Python process."""
    return Codec(path)


SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(
    docs: DataFrame, vocabulary: str, text: str = "text", *, columns: Iterable[str] = ("doc_id",), ids: bool = False,
) -> DataFrame:
    """The given columns with n_tokens, ids_sha256 and decoded_sha256; with ids=True also ids (array<int>).

    The whole text is encoded and its ids decoded again. Null and empty texts have no ids, and decode to the
    empty text. Repeated rows give repeated results. Empty table: no rows. Input columns that have the name of
    a result are not carried. `vocabulary` is a file that every executor has at that path.
    """
    own = {"n_tokens", "ids_sha256", "decoded_sha256", "ids"}
    names = [n for n in columns if n not in own]
    small_batches(docs.sparkSession)
    rows = docs.select(docs[f"`{text}`"].cast("string").alias("_text"), *(docs[f"`{n}`"].alias(f"_in_{i}") for i, n in enumerate(names)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(vocabulary)
        for batch in batches:
            counts, hashes, decoded, all_ids = [], [], [], []
            for value in batch.column(0).to_pylist():
                found = words.encode(value)
                counts.append(len(found) // 4)
                hashes.append(hashlib.sha256(found).hexdigest())
                decoded.append(hashlib.sha256(words.decode(found).encode()).hexdigest())
                if ids:
                    all_ids.append(np.frombuffer(found, "<u4").astype(np.int32))
            out = [*batch.columns[1:], pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            labels = [*batch.schema.names[1:], "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                out.append(pa.array(all_ids, pa.list_(pa.int32())))
                labels.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=labels)

    kept = ", ".join(f"_in_{i} {rows.schema[f'_in_{i}'].dataType.simpleString()}" for i in range(len(names)))
    schema = ", ".join(filter(None, [kept, SCHEMA, "ids array<int>" if ids else ""]))
    done = rows.mapInArrow(run, schema)
    return done.select(*(F.col(f"_in_{i}").alias(n) for i, n in enumerate(names)), *[c for c in done.columns if not c.startswith("_in_")])
