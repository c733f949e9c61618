"""Language identification by unigram pieces, summed over all segmentations.

Pieces come from a fixed public vocabulary. Each language has a probability per piece, learned by expectation
maximisation: the forward-backward algorithm counts a piece in every segmentation of a word by the
segmentation's share. A text is scored with the forward algorithm: the probability of a word in a language is
the sum over all ways to cut it into pieces, and a text is the product of its words. A word is a letter and all
letters and marks that follow it, however many.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kwarta.llm.shared import small_batches

#: Labelled documents per language the model is fitted on, in expectation (chosen by a hash), and rounds.
DOCS_PER_LANGUAGE, ROUNDS = 500, 2
#: Added to each piece's expected count.
SMOOTHING = 0.1
#: Words longer than this are scored in a window that moves along them, and not remembered.
LONG = 64
#: Words whose scores a task remembers, and bytes of these scores; when full, it starts anew.
WORDS_KEPT, BYTES_KEPT = 600_000, 128 << 20
#: What texts without a letter get.
UNKNOWN = "und"

_START = "▁"
#: A word: letters with the marks that stand on them, as many as there are.
_RUN = r"\p{L}[\p{L}\p{M}]*"
_LETTERS = regex.compile(_RUN).findall
#: The same in lower-case text of the first 256 characters only; the plain engine is several times faster.
_WIDE, _NARROW_LETTERS = re.compile("[^\x00-\xff]").search, re.compile("[a-zªµºß-öø-ÿ]+").findall
_PIECE = regex.compile(r"[\p{L}\p{M}]+").fullmatch


def words_of(text: str | None) -> list[str]:
    """The lower-case words of a text."""
    if not text:
        return []
    low = text.lower()
    return _LETTERS(low) if _WIDE(low) else _NARROW_LETTERS(low)


class Pieces:
    """The vocabulary's pieces of lower-case letters, and the lattice of a word's segmentations."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_byte(i))
        usable = [p for p in found if (p == _START or _PIECE(p.removeprefix(_START))) and p == p.lower()]
        self.number = {p: i for i, p in enumerate(dict.fromkeys(usable))}
        self.longest = max(map(len, self.number), default=1)
        #: Two numbers behind the pieces: a letter that is no piece, and no piece at all.
        self.other, self.none = len(self.number), len(self.number) + 1

    def lattices(self, words: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
        """For words of one length at a time: their places, and the piece that ends at each letter, by length."""
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word) + 1, []).append(i)
        get, none, longest = self.number.get, self.none, self.longest
        for n, places in by_length.items():
            width = min(n, longest)
            if n > LONG + 1:
                for k in places:
                    yield [k], self._grid(_START + words[k], width)
                continue
            spans = [(max(0, i - size), i) for i in range(1, n + 1) for size in range(1, width + 1)]
            for first in range(0, len(places), 512):
                some = places[first : first + 512]
                grid = np.array([[get(w[a:b], none) for a, b in spans] for w in (_START + words[k] for k in some)], np.int32)
                grid = grid.reshape(len(some), n, width)
                for i in range(1, min(n, width)):
                    grid[:, i - 1, i:] = none  # spans that would begin before the word
                single = grid[:, :, 0]
                single[single == none] = self.other
                yield some, grid


    def _grid(self, word: str, width: int) -> np.ndarray:
        """The lattice of one long word, a column of pieces at a time."""
        get, none, n = self.number.get, self.none, len(word)
        grid = np.full((1, n, width), none, np.int32)
        for size in range(1, width + 1):
            grid[0, size - 1 :, size - 1] = np.fromiter((get(word[i : i + size], none) for i in range(n - size + 1)), np.int32, n - size + 1)
        single = grid[0, :, 0]
        single[single == none] = self.other
        return grid

    def long_score(self, word: str, chances: np.ndarray) -> np.ndarray:
        """The log of a long word's summed probability per language; only the sums that a piece can reach are held."""
        word, get, scale = _START + word, self.number.get, 0.0
        window = deque([np.ones(chances.shape[1])], maxlen=self.longest)  # sums of the places before, the nearest last
        for end in range(1, len(word) + 1):
            here = np.zeros(chances.shape[1])
            for size in range(1, len(window) + 1):
                piece = get(word[end - size : end], self.other if size == 1 else None)
                if piece is not None:
                    here += window[-size] * chances[piece]
            window.append(here)
            if here.max() < _TINY:
                for sums in window:
                    sums *= _LIFT
                scale -= np.log(_LIFT)
        return np.log(np.maximum(window[-1], 1e-300)) + scale


_TINY, _LIFT = 1e-100, 1e100


def forward(grid: np.ndarray, chances: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word and language the log of the summed probability; and the scaled sums with each place's log scale."""
    words, n, width = grid.shape
    sums = np.zeros((words, n + 1, chances.shape[1]))
    scale, scales = np.zeros(words), np.zeros((words, n + 1))
    sums[:, 0] = 1.0
    for i in range(1, n + 1):
        for size in range(1, min(i, width) + 1):
            sums[:, i] += sums[:, i - size] * chances[grid[:, i - 1, size - 1]]
        low = sums[:, i].max(axis=1) < _TINY
        if low.any():
            sums[low, max(0, i - width) : i + 1] *= _LIFT
            scale[low] -= np.log(_LIFT)
            scales[low, max(0, i - width) : i + 1] -= np.log(_LIFT)
        scales[:, i] = scale
    return np.log(np.maximum(sums[:, n], 1e-300)) + scale[:, None], sums, scales


def expected(grid: np.ndarray, chances: np.ndarray, weight: np.ndarray, counts: np.ndarray) -> None:
    """Add to counts, for one language, how often each piece occurs in the words' segmentations, by their share."""
    words, n, width = grid.shape
    total, sums, scales = forward(grid, chances[:, None])
    ahead = np.zeros((words, n + 1))  # log probability of what follows each place
    ahead[:, :n] = -np.inf
    with np.errstate(divide="ignore"):
        before, each = np.log(sums[:, :, 0]) + scales, np.log(chances)
    for i in range(n, 0, -1):
        for size in range(1, min(i, width) + 1):
            piece = grid[:, i - 1, size - 1]
            through = each[piece] + ahead[:, i]
            ahead[:, i - size] = np.logaddexp(ahead[:, i - size], through)
            np.add.at(counts, piece, weight * np.exp(np.minimum(before[:, i - size] + through - total[:, 0], 0.0)))


@lru_cache(2)
def pieces(path: str) -> Pieces:
    """The vocabulary, once per Python process."""
    return Pieces(path)


def fit(
    docs: DataFrame, vocabulary: str, text: str = "text", language: str = "lang", doc_id: str = "doc_id", *,
    docs_per_language: int = DOCS_PER_LANGUAGE, rounds: int = ROUNDS, smoothing: float = SMOOTHING,
) -> tuple[list[str], np.ndarray]:
    """The languages in order, and per piece (rows) and language (columns) a probability.

    Fitted on labelled rows (language, text and doc_id not null): about docs_per_language of each language,
    chosen by a hash, all where there are fewer. What reaches the driver is languages x pieces.
    """
    spark = docs.sparkSession
    labelled = docs.select(
        docs[f"`{language}`"].cast("string").alias("lang"), docs[f"`{text}`"].cast("string").alias("text"),
        docs[f"`{doc_id}`"].alias("id")).dropna()
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    langs, vocab = sorted(sizes), pieces(vocabulary)
    chances = np.full((vocab.none + 1, len(langs)), 1.0 / max(1, vocab.none))
    chances[vocab.none] = 0.0
    if not langs:
        return langs, chances
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, docs_per_language / sizes[lang]))])
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    chosen = labelled.where(draw < share[F.col("lang")])
    runs = F.regexp_extract_all(F.lower("text"), F.lit(_RUN), F.lit(0))
    words = chosen.select("lang", F.explode(runs).alias("word")).groupBy("lang", "word").count().persist()
    place = {lang: i for i, lang in enumerate(langs)}
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(chances)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice, known = pieces(vocabulary), now.value
            sums = np.zeros((known.shape[1], known.shape[0]))
            for batch in batches:
                lang = np.array([place[x] for x in batch.column(0).to_pylist()])
                times, word = batch.column(2).to_numpy(), batch.column(1).to_pylist()
                for k in np.unique(lang):
                    of = np.flatnonzero(lang == k)
                    for some, grid in lattice.lattices([word[i] for i in of]):
                        expected(grid, known[:, k], times[of[some]].astype(float), sums[k])
            k, piece = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(piece), pa.array(sums[k, piece])], names=["k", "piece", "n"])

        counted = words.mapInArrow(count, "k long, piece long, n double").groupBy("k", "piece").agg(F.sum("n").alias("n")).toArrow()
        sums = np.zeros((vocab.none + 1, len(langs)))
        sums[counted["piece"].to_numpy(), counted["k"].to_numpy()] = counted["n"].to_numpy()
        sums[: vocab.none] += smoothing
        sums[vocab.none] = 0.0
        chances = sums / sums.sum(axis=0)
    words.unpersist()
    return langs, np.round(chances, 12)


class Scorer:
    """Log probability of texts in each language, with the words' scores remembered."""

    def __init__(self, vocabulary: str, chances: np.ndarray) -> None:
        self._pieces, self._chances = pieces(vocabulary), chances
        self._row: dict[str, int] = {}
        self._kept = max(1, min(WORDS_KEPT, BYTES_KEPT // (8 * max(1, chances.shape[1]))))
        self._scores = np.zeros((1024, chances.shape[1]))

    def _learn(self, words: list[str]) -> None:
        first = len(self._row)
        if (need := first + len(words)) > len(self._scores):
            size = max(need, min(2 * len(self._scores), self._kept))
            self._scores = np.concatenate([self._scores[:first], np.zeros((size - first, self._scores.shape[1]))])
        for some, grid in self._pieces.lattices(words):
            self._scores[first + np.array(some)] = forward(grid, self._chances)[0]
        self._row.update(zip(words, range(first, need), strict=True))

    def score(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Per text the log probability per language; None without a letter."""
        cut, long = [], []
        for text in texts:
            words = words_of(text)
            long.append([w for w in words if len(w) > LONG])
            cut.append([w for w in words if len(w) <= LONG] if long[-1] else words)
        row = self._row
        new = {w: None for words in cut for w in words if w not in row}
        if len(row) + len(new) > self._kept:
            row.clear()
            new = {w: None for words in cut for w in words}
        if new:
            self._learn(list(new))
        return [self._sum(words, far) if words or far else None for words, far in zip(cut, long, strict=True)]

    def _sum(self, words: list[str], long: list[str]) -> np.ndarray:
        known = np.fromiter(map(self._row.__getitem__, words), np.int64, len(words))
        return sum((self._pieces.long_score(w, self._chances) for w in long), self._scores[known].sum(axis=0))


def identify(
    docs: DataFrame, vocabulary: str, model: tuple[list[str], np.ndarray], text: str = "text", *, columns: Iterable[str] = ("doc_id",),
) -> DataFrame:
    """The given columns with lang_pred, score, the language's share of the text's probability (0 to 1), and rejected.

    Whole texts count. rejected are null and empty texts, and those without a letter: they are und, score 0, and so
    are all if no language was learned. Ties go to the first language in code point order. Repeated rows give repeated results. Empty
    table: no rows. Input columns named like a result are not carried. The model's size is languages x
    pieces of the vocabulary; it is broadcast.
    """
    names = [n for n in columns if n not in ("lang_pred", "score", "rejected")]
    small_batches(docs.sparkSession)
    langs, chances = model
    sent = docs.sparkSession.sparkContext.broadcast(chances)
    rows = docs.select(docs[f"`{text}`"].cast("string").alias("_text"), *(docs[f"`{n}`"].alias(f"_in_{i}") for i, n in enumerate(names)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(vocabulary, sent.value)
        for batch in batches:
            found, sure, out = [], [], []
            texts = batch.column(0).to_pylist()
            for logs in scorer.score(texts) if langs else [np.zeros(0) if words_of(t) else None for t in texts]:
                out.append(logs is None)
                if logs is None or not langs:
                    found.append(UNKNOWN)
                    sure.append(0.0)
                    continue
                best = int(np.argmax(logs))
                found.append(langs[best])
                sure.append(float(1.0 / np.exp(logs - logs[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found, pa.string()), pa.array(sure, pa.float64()), pa.array(out, pa.bool_())],
                names=[*batch.schema.names[1:], "lang_pred", "score", "rejected"])

    kept = "".join(f"_in_{i} {rows.schema[f'_in_{i}'].dataType.simpleString()}, " for i in range(len(names)))
    done = rows.mapInArrow(run, kept + "lang_pred string, score double, rejected boolean")
    return done.select(*(F.col(f"_in_{i}").alias(n) for i, n in enumerate(names)), "lang_pred", "score", "rejected")
