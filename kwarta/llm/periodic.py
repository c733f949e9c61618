"""Periodic runs of words: Lyndon arrays by grouping suffixes, Lyndon roots extended to runs.

The first phase of Baier's suffix sorter orders suffixes into groups that share the text up to their next smaller
suffix. That common part is the longest Lyndon word which starts there, so the phase alone, run under an order
of the words and under its reverse, yields both Lyndon arrays. Every run has a root among these words under one
of the two orders; from a root the run is as long as the text agrees with itself a period further on.

A run of many repetitions can only lie where words, or phrases of eight words, return soon and without a gap.
The rest of a text is set aside by that exact condition before suffixes are grouped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kwarta.llm.shared import small_batches

#: A run is this many periods long at least, and this many words.
EXPONENT, LEAST = 4, 6
#: Words of a phrase; periods below it are looked for by single words.
PHRASE = 8
#: Text handled at once, and words hashed at once.
TEXT_BYTES, HASHED_WORDS = 4 << 20, 1 << 16

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def lyndon_lengths(symbols: list[int], largest_first: bool = False) -> list[int]:
    """Length of the longest Lyndon word from each place on, by grouping suffixes from the highest group down.

    The members of a group have the same context: the text up to their next smaller suffix, as far as known. When
    a group is reached, its context is final. It then belongs to the context of the nearest earlier place that
    is still in a lower group; a place that is preceded so `k` times grows by `k` contexts and rises into a
    group of its own kind directly above the one it leaves, the higher the more often.
    """
    n = len(symbols)
    first: dict[int, list[int]] = {}
    for place, symbol in enumerate(symbols):
        first.setdefault(symbol, []).append(place)
    members, context, of = [], [], [0] * n
    for group, symbol in enumerate(sorted(first, reverse=largest_first)):
        members.append(first[symbol])
        context.append(1)
        for place in first[symbol]:
            of[place] = group
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    length = [0] * n
    open_to = list(range(n))  # where the nearest place at or before this one is that no group reached has

    group = len(members) - 1
    while group >= 0:
        own = [place for place in members[group] if of[place] == group]
        members[group] = own
        size = context[group]
        for place in own:
            length[place] = size
            open_to[place] = place - 1
        if len(own) == 1:
            place = _nearest(open_to, own[0])
            if place >= 0:
                _rise(place, 1, size, of, members, context, below, above, {})
        elif own:
            times: dict[int, int] = {}
            for place in own:
                place = _nearest(open_to, place)
                if place >= 0:
                    times[place] = times.get(place, 0) + 1
            made: dict[tuple[int, int], int] = {}
            for place in sorted(times, key=times.__getitem__, reverse=True):
                _rise(place, times[place], size, of, members, context, below, above, made)
        group = below[group]
    return length


def _nearest(open_to: list[int], place: int) -> int:
    """The nearest open place at or before this one, -1 if none; paths are shortened on the way."""
    root = place
    while root >= 0 and open_to[root] != root:
        root = open_to[root]
    while place != root:
        open_to[place], place = root, open_to[place]
    return root


def _rise(place, times, size, of, members, context, below, above, made) -> None:
    """Move a place into the group directly above its own for that many contexts of the reached group."""
    old = of[place]
    new = made.get((old, times))
    if new is None:
        new = made[old, times] = len(members)
        members.append([])
        context.append(context[old] + times * size)
        upper = above[old]
        below.append(old)
        above.append(upper)
        above[old] = new
        below[upper] = new
    members[new].append(place)
    of[place] = new


def common(a: np.ndarray, x: int, y: int) -> int:
    """How far the array agrees with itself from x and from y > x on."""
    most, got, step = len(a) - y, 0, 32
    while got < most:
        n = min(step, most - got)
        differ = np.flatnonzero(a[x + got : x + got + n] != a[y + got : y + got + n])
        if len(differ):
            return got + int(differ[0])
        got += n
        step = min(step * 2, 1 << 16)
    return most


@dataclass(frozen=True)
class Wanted:
    """Runs of at least max(least, exponent x period) words; the exponent is 2 at least."""

    exponent: int = EXPONENT
    least: int = LEAST

    def near(self) -> int:
        """Words in a row that have returned within PHRASE - 1 words, in any run of a period below PHRASE."""
        return min(max(self.least, self.exponent * q) - q for q in range(1, PHRASE))

    def far(self) -> int:
        """Phrases in a row that have been there before, in any run of a longer period."""
        return (self.exponent - 1) * PHRASE - PHRASE + 1


def _before(keys: np.ndarray) -> np.ndarray:
    """Distance to the previous equal key, 0 where there is none."""
    order = np.argsort(keys, kind="stable")
    again = np.flatnonzero(keys[order[1:]] == keys[order[:-1]]) + 1
    back = np.zeros(len(keys), np.int64)
    back[order[again]] = order[again] - order[again - 1]
    return back


def _stretches(mark: np.ndarray) -> np.ndarray:
    """[start, end) of every stretch of true values, one row each."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8)))
    return edge.reshape(-1, 2)


def regions(symbols: np.ndarray, starts: np.ndarray, wanted: Wanted) -> list[tuple[int, int]]:
    """Disjoint ranges of words, each within one document, that hold every wanted run whole.

    In a run of period q, the words after the first q have returned within q words, and so have its phrases. Words
    in a row therefore tell where short periods can be, and phrases in a row where longer ones can; how many
    there are in a row bounds the period, and so how far the run may reach back.
    """
    n = len(symbols)
    sizes = np.diff(starts)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    back = _before((doc << 32) | symbols)
    found = []
    short = _stretches((back > 0) & (back < PHRASE))
    short = short[short[:, 1] - short[:, 0] >= wanted.near()]
    found += [(int(a) - PHRASE + 1, int(b), int(doc[a])) for a, b in short]
    if n >= PHRASE:
        mixed = (symbols.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        phrase = doc[: n - PHRASE + 1].astype(np.uint64)
        for k in range(PHRASE):
            phrase = phrase * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : n - PHRASE + 1 + k]
        again = (_before(phrase) > 0) & (doc[: n - PHRASE + 1] == doc[PHRASE - 1 :])
        again[starts[starts < len(again)]] = False  # whatever the hashes say, no stretch goes on in the next document
        for a, b in _stretches(again).tolist():
            if b - a >= wanted.far():
                reach = (b - a + PHRASE - 1) // (wanted.exponent - 1) + 1
                found.append((a - reach, b + PHRASE - 1, int(doc[a])))
    out: list[list[int]] = []
    for a, b, d in sorted(found, key=lambda r: (r[2], r[0])):
        a, b = max(a, int(starts[d])), min(b, int(starts[d + 1]))
        if out and a <= out[-1][1] and out[-1][2] == d:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b, d])
    return [(a, b) for a, b, _ in out]


def runs(symbols: np.ndarray, start: int, end: int, wanted: Wanted) -> set[tuple[int, int, int]]:
    """(start, length, period) of the wanted runs that have a root in [start, end), extended over all symbols."""
    part = symbols[start:end].tolist()
    backward, n = symbols[::-1], len(symbols)
    found, reached = set(), {}
    for largest_first in (False, True):
        size = np.array(lyndon_lengths(part, largest_first), np.int64)
        at = np.arange(start, end)
        for i, p in zip(*_hopeful(symbols, at, size, wanted.exponent), strict=True):
            if reached.get(p, -1) >= i + p:
                continue
            right = common(symbols, i, i + p) + i + p
            left = i - common(backward, n - i - p, n - i)
            if right - left >= 2 * p:
                reached[p] = right
                if right - left >= max(wanted.least, wanted.exponent * p):
                    found.add((left, right - left, p))
        reached.clear()
    return found


def _hopeful(symbols: np.ndarray, at: np.ndarray, size: np.ndarray, exponent: int) -> tuple[list[int], list[int]]:
    """Roots that may belong to a run of that exponent.

    The run goes on by exponent - 1 periods in all, so from three on by a whole period to one side at least: the
    root's first and last word then stand there too. Below, only the word next to one of its ends must.
    """
    n = len(symbols)
    last = at + size - 1
    right, left = last + 1 < n, at > 0
    right[right] = symbols[at[right]] == symbols[last[right] + 1]
    left[left] = symbols[last[left]] == symbols[at[left] - 1]
    if exponent > 2:
        right &= last + size < n
        right[right] = symbols[last[right]] == symbols[last[right] + size[right]]
        left &= at >= size
        left[left] = symbols[at[left]] == symbols[at[left] - size[left]]
    keep = right | left
    return at[keep].tolist(), size[keep].tolist()


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word in texts that lie one after another, and the number of words before each text."""
    inside = ~_SPACE[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cuts = ends[:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]  # a text's first word is its own even where the text before ends without space
    stops[cuts - 1] = inside[cuts - 1]
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(stops) + 1, np.searchsorted(first, np.concatenate([[0], ends]))


def _symbols(data: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A number per word, equal for equal words."""
    if not len(first):
        return np.zeros(0, np.int64)
    inside = data[~_SPACE[data]]
    offsets = np.concatenate([[0], np.cumsum(stop - first)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(inside)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _collapsed(data: np.ndarray, first: np.ndarray, stop: np.ndarray, keep: np.ndarray) -> str:
    """Digest of the kept words joined by one space."""
    digest, glue = hashlib.sha256(), b""
    for low in range(0, len(first), HASHED_WORDS):
        part = slice(low, low + HASHED_WORDS)
        words = data[first[part][0] : stop[part][-1]].tobytes().split()
        kept = keep[part]
        if not kept.all():
            words = [w for w, k in zip(words, kept.tolist(), strict=True) if k]
        if words:
            digest.update(glue + b" ".join(words))
            glue = b" "
    return digest.hexdigest()


def found_in(texts: list[bytes], wanted: Wanted) -> Iterator[tuple[list[tuple[int, int, int]], str]]:
    """Per text its wanted runs, by start and period, and the digest of the text without the repetitions."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    first, stop, starts = _words(data, np.cumsum([len(t) for t in texts]))
    symbols = _symbols(data, first, stop)
    own: list[list[tuple[int, int]]] = [[] for _ in texts]
    for a, b in regions(symbols, starts, wanted):
        own[int(np.searchsorted(starts, a, "right")) - 1].append((a, b))
    for i, ranges in enumerate(own):
        low, high = int(starts[i]), int(starts[i + 1])
        keep, all_runs = np.ones(high - low, bool), set()
        for a, b in ranges:
            all_runs |= runs(symbols[low:high], a - low, b - low, wanted)
        for start, length, period in all_runs:
            keep[start + period : start + length] = False
        yield sorted((s, n, p) for s, n, p in all_runs), _collapsed(data, first[low:high], stop[low:high], keep)


def _longest(some: list[tuple[int, int, int]]) -> tuple[int | None, int | None, int | None]:
    return min(some, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))


_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find(
    docs: DataFrame, text: str = "text", *, columns: Iterable[str] = ("doc_id",), exponent: int = EXPONENT, least: int = LEAST,
    listed: bool = False,
) -> DataFrame:
    """The given columns with n_runs, the longest run, and digests of all runs and of the text without repetitions.

    Words are what stands between ASCII white space. A run is a stretch of words with smallest period q, at
    least max(least, exponent x q) words long, that no neighbour extends. start, length, period and
    exponent_milli are those of the longest run (ties: smallest start, then period), null without runs.
    runs_sha256 is over `start,length,period` lines by start and period; collapsed_sha256 over the words joined by
    one space without those that any run holds after its first q words. With listed=True also runs (array).
    Null and empty texts have no words. Repeated rows give repeated results. Empty table: no rows. Input columns
    that have the name of a result are not carried.
    """
    if exponent < 2:
        raise ValueError("a run repeats at least once: the exponent is 2 or more")
    wanted = Wanted(exponent, least)
    results = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", *(["runs"] if listed else [])]
    names = [n for n in columns if n not in results]
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.coalesce(docs[f"`{text}`"].cast("string"), F.lit("")).cast("binary").alias("_text"),
        *(docs[f"`{n}`"].alias(f"_in_{i}") for i, n in enumerate(names)))

    def some_rows(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        found, digests, lines = [], [], []
        for one, digest in found_in(texts, wanted):
            found.append(one)
            digests.append(digest)
            lines.append(hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in one).encode()).hexdigest())
        best = [_longest(one) for one in found]
        columns = [
            pa.array([len(one) for one in found], pa.int64()),
            *(pa.array([b[k] for b in best], pa.int64()) for k in range(3)),
            pa.array([None if b[0] is None else 1000 * b[1] // b[2] for b in best], pa.int64()),
            pa.array(lines, pa.string()), pa.array(digests, pa.string()),
        ]
        if listed:
            columns.append(pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in one] for one in found], _FOUND))
        return pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=[*batch.schema.names[1:], *results])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, texts, size = 0, [], 0
            for i, value in enumerate(batch.column(0)):
                texts.append(value.as_py())
                size += len(texts[-1])
                if size >= TEXT_BYTES or i + 1 == batch.num_rows:
                    yield some_rows(batch.slice(low, len(texts)), texts)
                    low, texts, size = i + 1, [], 0

    kept = [f"_in_{i} {rows.schema[f'_in_{i}'].dataType.simpleString()}" for i in range(len(names))]
    numbers = [f"{n} long" for n in results[:5]]
    schema = ", ".join([*kept, *numbers, "runs_sha256 string", "collapsed_sha256 string", *([f"runs {_RUNS}"] if listed else [])])
    done = rows.mapInArrow(run, schema)
    return done.select(*(F.col(f"_in_{i}").alias(n) for i, n in enumerate(names)), *results)
