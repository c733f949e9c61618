"""Token ids in files of directly addressable codes.

An id is cut into chunks, the lowest bits first. Level k of a file holds the k-th chunks of all ids that have
one, packed at the level's own width, with a bitmap that says which of them go on in level k + 1 and a
directory of the ones before every 512 bits of it. A token's place in the next level is the rank of its bit, so
any token is read with one chunk, one directory entry and at most 64 bytes of bitmap per level; nothing before
it is decoded. A run of tokens is a run in every level. The widths are those that make the file smallest.

A file ends with a JSON footer, its length in eight bytes and the magic. Files are written under names that no
other attempt uses, and only those named in the committed table of files count.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import Split

from kwarta.llm.bpe import byte_letters, pack
from kwarta.llm.shared import new_folder, place, qualified, small_batches, written

MAGIC = b"KWDACID1"
#: Tokens after which a file is closed; a task holds them at four bytes each.
FILE_TOKENS = 1 << 24
#: Bits of a bitmap per entry of its directory.
BLOCK = 512
#: Ids packed at once, documents of one reading task's unit, tokens read at once, positions of a bin of take().
PACKED, READ_DOCS, READ_TOKENS, BIN = 1 << 20, 4_096, 1 << 20, 1 << 20
#: Pieces whose ids a task remembers, the longest of them, those learned at once, and bytes of texts encoded at once.
PIECES_KEPT, LONGEST_KEPT, LEARNED_AT_ONCE, TEXT_AT_ONCE = 1_200_000, 64, 10_000, 4 << 20

# What the vocabulary's pre-tokeniser takes as one piece, for letters that have been letters in all
# versions of Unicode, digits and signs. Anything else goes through the library's own.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
_PLAIN = re.compile(f" ?[{_LETTERS}]+| ?[0-9]+| ?[!-&(-/:-@[-`{{-~]+").fullmatch
# Last bytes of characters that are white space in some version of Unicode, after the bytes before them.
_SPACE_ENDS = {
    b"\xc2": b"\x85\xa0", b"\xe1\x9a": b"\x80", b"\xe1\xa0": b"\x8e", b"\xe2\x80": bytes([*range(0x80, 0x8C), 0xA8, 0xA9, 0xAF]),
    b"\xe2\x81": b"\x9f", b"\xe3\x80": b"\x80", b"\xef\xbb": b"\xbf",
}

# Classes of bytes: the space, letters, digits, signs, other white space, and what only the library knows.
_BLANK, _LETTER, _DIGIT, _SIGN, _GAP, _OPEN = range(6)
_CLASS = np.full(256, _OPEN, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
for _first, _last, _kind in ((0x41, 0x5A, _LETTER), (0x61, 0x7A, _LETTER), (0x30, 0x39, _DIGIT), (0x09, 0x0D, _GAP), (0x20, 0x20, _BLANK)):
    _CLASS[_first : _last + 1] = _kind
#: Whether a piece always ends between bytes of two classes: at the end of letters, digits, signs or a gap.
_CUT = np.zeros((6, 6), bool)
for _before in (_LETTER, _DIGIT, _SIGN):
    _CUT[_before, [k for k in (_BLANK, _LETTER, _DIGIT, _SIGN, _GAP) if k != _before]] = True
_CUT[_GAP, [_LETTER, _DIGIT, _SIGN]] = True


def borders(data: np.ndarray) -> np.ndarray:
    """Places of the spaces that follow something else than white space: there, whatever follows, a new piece begins."""
    at = np.flatnonzero(data == 0x20)
    at = at[at > 0]
    last = data[at - 1]
    free = last > 0x20
    high = np.flatnonzero(last >= 0x80)
    for before, ends in _SPACE_ENDS.items():
        hit = high[np.isin(last[high], np.frombuffer(ends, np.uint8)) & (at[high] > len(before))]
        for back, byte in enumerate(reversed(before), 2):
            hit = hit[data[at[hit] - back] == byte]
        free[hit] = False
    return at[free]


def cuts(data: np.ndarray, edges: np.ndarray, whole: list[bytes]) -> np.ndarray:
    """Places between which texts are encoded alone, with the edges of the texts. None lies within one of `whole`."""
    kinds = _CLASS[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))  # letters of two bytes, but for two signs
    lead = lead[(data[lead] != 0xC3) | ((data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7))]
    kinds[lead] = kinds[lead + 1] = _LETTER
    mark = np.zeros(len(data) + 1, bool)
    mark[1:-1] = _CUT[kinds[:-1], kinds[1:]]
    last = np.flatnonzero(mark[1:-1] & (kinds[:-1] == _GAP))
    mark[last] = True  # the last of several gaps before a word is a piece of its own
    quoted = np.flatnonzero(data[:-1] == 0x27)  # what an apostrophe takes with it is left to the pattern
    mark[quoted + 1] &= kinds[quoted + 1] != _LETTER
    mark[borders(data)] = True
    text = data.tobytes() if whole else b""
    for content in whole:
        at = text.find(content)
        while at >= 0:
            mark[at + 1 : at + len(content)] = False
            mark[max(at - 1, 0)] = False  # before it, gaps are at an end, not before a word
            at = text.find(content, at + 1)
    mark[edges] = True
    return np.flatnonzero(mark)


class Encoder:
    """Ids of whole texts by the tokenizers library, each piece encoded once where the vocabulary allows it.

    A byte-level vocabulary encodes the pieces that its pattern cuts a text into one by one. Where such a piece ends
    whatever its neighbours are, texts are cut here; the pieces that a task has not met are all that the library sees.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._by_piece = self._cuts_at_spaces(spec)
        self._added = [t["content"].encode() for t in spec.get("added_tokens") or []]
        letters = byte_letters()
        self._letters, self._line = dict(enumerate(letters)), self._tokenizer.token_to_id(letters[ord("\n")])
        self._plain = Tokenizer(self._tokenizer.model)
        self._plain.pre_tokenizer = Split(letters[ord("\n")], "isolated")
        self._pieces: dict[bytes, bytes] = {}

    @staticmethod
    def _cuts_at_spaces(spec: dict) -> bool:
        """Whether the vocabulary is a byte-level one with the usual pattern, and nothing in it spans a space."""
        cutter, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        return (
            all(cutter.get(k) == v for k, v in plain.items()) and not spec.get("normalizer") and not spec["model"].get("dropout")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in added)
        )

    def _whole(self, text: str) -> bytes:
        return pack(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _learn(self, new: list[bytes]) -> Iterator[bytes]:
        """Ids of pieces: of plain ones by the library's model, many as one text with a line's end between, of others by
        all of the library."""
        plain = [bool(_PLAIN(piece.decode())) and not any(t in piece for t in self._added) for piece in new]
        text = b"\n".join(piece for piece, one in zip(new, plain, strict=True) if one)
        ids = np.frombuffer(pack(self._plain.encode_batch_fast([text.decode("latin-1").translate(self._letters)])[0].ids), "<u4")
        ends = np.flatnonzero(ids == self._line).tolist()
        runs = zip([0, *(e + 1 for e in ends)], [*ends, len(ids)], strict=True)
        for piece, one in zip(new, plain, strict=True):
            if one:
                first, last = next(runs)
                yield ids[first:last].tobytes()
            else:
                yield self._whole(piece.decode())

    def _found(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece; those not met before are learned and, unless they are long, remembered."""
        found = list(map(self._pieces.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        for low in range(0, len(missing), LEARNED_AT_ONCE):
            some = missing[low : low + LEARNED_AT_ONCE]
            for i, ids in zip(some, self._learn([pieces[i] for i in some]), strict=True):
                found[i] = ids
                if len(pieces[i]) <= LONGEST_KEPT:
                    self._pieces[pieces[i]] = ids
        return found

    def encode_all(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of whole texts in UTF-8; none for empty ones."""
        if not self._by_piece:
            return [np.frombuffer(self._whole(text.decode()) if text else b"", "<u4") for text in texts]
        if len(self._pieces) > PIECES_KEPT:
            self._pieces.clear()
        data = b"".join(texts)
        if not data:
            return [np.zeros(0, "<u4") for _ in texts]
        edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        places = cuts(np.frombuffer(data, np.uint8), edges, self._added)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data)])
        which = pieces.dictionary_encode().indices.to_numpy()
        sample = np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1))  # codes are given by first occurrence
        found = self._found([data[a:b] for a, b in zip(places[sample].tolist(), places[sample + 1].tolist(), strict=True)])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first, own = np.cumsum(sizes) - sizes, sizes[which]
        before = np.concatenate([[0], np.cumsum(own)])
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(first[which] - before[:-1], own) + np.arange(before[-1])]
        limits = before[np.searchsorted(places, edges)].tolist()
        return [ids[a:b] for a, b in zip(limits[:-1], limits[1:], strict=True)]

    def encode(self, text: str | None) -> bytes:
        """Packed little-endian ids of one text; none for null and empty."""
        return self.encode_all([(text or "").encode()])[0].tobytes()


@lru_cache(2)
def encoder(vocabulary: str) -> Encoder:
    """The vocabulary, once per Python process."""
    return Encoder(vocabulary)


def widths(ids: np.ndarray) -> list[int]:
    """Chunk widths that take the fewest bits in all: an id costs width + 1 in each level it reaches, no flag in the last."""
    most = int(ids.max()).bit_length() if len(ids) else 0
    above = [int(np.count_nonzero(ids >> t)) if t else len(ids) for t in range(most + 1)]
    best: list[tuple[int, list[int]]] = [(0, [])] * (most + 1)
    for t in range(most - 1, -1, -1):
        choices = [(above[t] * (b + (t + b < most)) + best[t + b][0], [b, *best[t + b][1]]) for b in range(1, most - t + 1)]
        best[t] = min(choices)
    return best[0][1] or [1]


def packed(values: np.ndarray, width: int) -> bytes:
    """Values side by side at that many bits each, lowest bit first."""
    out = []
    for start in range(0, len(values), PACKED):
        part = np.ascontiguousarray(values[start : start + PACKED], "<u4").view(np.uint8).reshape(-1, 4)
        out.append(np.packbits(np.unpackbits(part, axis=1, count=width, bitorder="little"), bitorder="little").tobytes())
    return b"".join(out)


def unpacked(data: bytes, skip: int, count: int, width: int) -> np.ndarray:
    """`count` values of that width, after `skip` bits of the data."""
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=skip + count * width, bitorder="little")[skip:]
    part = np.zeros((count, 32), np.uint8)
    part[:, :width] = bits.reshape(count, width)
    return np.packbits(part, axis=1, bitorder="little").view("<u4").ravel()


def write_file(out, ids: np.ndarray, doc_ids: list[int | None], starts: np.ndarray) -> None:
    """Ids of whole documents as one file; `starts` has a place more than there are documents."""
    at = len(MAGIC)
    out.write(MAGIC)

    def section(data: bytes) -> list[int]:
        nonlocal at
        out.write(data)
        at += len(data)
        return [at - len(data), len(data)]

    levels, left = [], ids
    chunk_widths = widths(ids)
    for level, width in enumerate(chunk_widths):
        entry = {"width": width, "count": len(left), "chunks": section(packed(left & np.uint32((1 << width) - 1), width))}
        if level + 1 < len(chunk_widths):
            more = (left >> np.uint32(width)) != 0
            bits = np.packbits(more, bitorder="little").tobytes()
            ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint32) if len(more) else np.zeros(0, np.uint32)
            before = np.concatenate([[0], np.cumsum(ones, dtype=np.uint64)[:-1]]) if len(ones) else ones
            entry |= {"bitmap": section(bits), "ranks": section(before.astype("<u8").tobytes())}
            left = (left >> np.uint32(width))[more]
        levels.append(entry)
    footer = {
        "tokens": len(ids), "documents": len(doc_ids), "levels": levels,
        "doc_ids": section(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()),
        "null_ids": section(np.array([d is None for d in doc_ids], np.uint8).tobytes()),
        "starts": section(starts.astype("<u8").tobytes()),
    }
    tail = json.dumps(footer).encode()
    out.write(tail + len(tail).to_bytes(8, "little") + MAGIC)


class TokenFile:
    """Random access to one file: any token, any run of tokens, any document, by ranges of its bytes."""

    def __init__(self, path: str) -> None:
        system, inner = place(path)
        self._file = system.open_input_file(inner)
        size = self._file.size()
        tail = self._read(size - len(MAGIC) - 8, len(MAGIC) + 8)
        if tail[8:] != MAGIC:
            raise ValueError(f"{path} is no token file")
        length = int.from_bytes(tail[:8], "little")
        self.footer = json.loads(self._read(size - len(tail) - length, length))
        self.tokens, self.documents = self.footer["tokens"], self.footer["documents"]

    def close(self) -> None:
        self._file.close()

    def _read(self, at: int, size: int) -> bytes:
        self._file.seek(at)
        return self._file.read(size)

    def _slice(self, section: str, first: int, count: int, kind: str) -> np.ndarray:
        wide = np.dtype(kind).itemsize
        return np.frombuffer(self._read(self.footer[section][0] + first * wide, count * wide), kind)

    def _values(self, place: list[int], first: int, count: int, width: int) -> np.ndarray:
        start, end = first * width, (first + count) * width
        data = self._read(place[0] + start // 8, (end + 7) // 8 - start // 8)
        return unpacked(data, start % 8, count, width)

    def _rank(self, level: dict, at: int) -> int:
        """Ones of a level's bitmap before that bit."""
        block = at // BLOCK
        if at == 0:
            return 0
        if block * 8 == level["ranks"][1]:  # the end of a bitmap of whole blocks
            block -= 1
        before = int.from_bytes(self._read(level["ranks"][0] + block * 8, 8), "little")
        bits = int.from_bytes(self._read(level["bitmap"][0] + block * BLOCK // 8, (at - block * BLOCK + 7) // 8), "little")
        return before + (bits & ((1 << (at - block * BLOCK)) - 1)).bit_count()

    def read(self, first: int, count: int) -> np.ndarray:
        """Ids of a run of tokens: one run of chunks per level."""
        if not 0 <= first <= first + count <= self.tokens:
            raise IndexError(f"tokens {first} to {first + count} of {self.tokens}")
        out, rows, shift = np.zeros(count, np.uint32), np.arange(count), 0
        for level in self.footer["levels"]:
            if not len(rows):
                break
            out[rows] |= self._values(level["chunks"], first, len(rows), level["width"]) << np.uint32(shift)
            shift += level["width"]
            if "bitmap" not in level:
                break
            more = self._values(level["bitmap"], first, len(rows), 1).astype(bool)
            first, rows = self._rank(level, first), rows[more]
        return out

    def token(self, at: int) -> int:
        """The id of one token."""
        return int(self.read(at, 1)[0])

    def docs(self, first: int, count: int) -> tuple[list[int | None], np.ndarray]:
        """Ids of documents, and where their tokens start, with the end of the last."""
        ids, null = self._slice("doc_ids", first, count, "<i8"), self._slice("null_ids", first, count, "u1")
        return [None if n else d for d, n in zip(ids.tolist(), null.tolist(), strict=True)], self._slice("starts", first, count + 1, "<u8").astype(np.int64)


@dataclass
class Store:
    """Written token files: their table has path, seq, first, tokens and documents, in the order of the documents."""

    files: DataFrame


_FILES = "task long, seq long, path string, tokens long, documents long"


def _encoded(words: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, np.ndarray]]:
    """Ids of documents and of their texts, a few texts at a time."""
    for batch in batches:
        doc_ids, low, texts, size = batch.column(0).to_pylist(), 0, [], 0
        for i, value in enumerate(batch.column(1)):
            texts.append(value.as_py())
            size += len(texts[-1])
            if size >= TEXT_AT_ONCE or i + 1 == batch.num_rows:
                yield from zip(doc_ids[low : i + 1], words.encode_all(texts), strict=True)
                low, texts, size = i + 1, [], 0


def _writer(folder: str, vocabulary: str, end_id: int | None, file_tokens: int):
    end = np.array([] if end_id is None else [end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        system, root = place(folder)
        task, seq, held, doc_ids, sizes = TaskContext.get().partitionId(), 0, [], [], []

        def close() -> pa.RecordBatch:
            nonlocal seq
            path = f"{uuid.uuid4().hex}.dac"
            starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            with system.open_output_stream(f"{root}/{path}", compression=None) as out:
                write_file(out, np.concatenate(held), doc_ids, starts)
            row = [[task], [seq], [f"{folder}/{path}"], [int(starts[-1])], [len(doc_ids)]]
            seq += 1
            for kept in (held, doc_ids, sizes):
                kept.clear()
            return pa.RecordBatch.from_arrays(list(map(pa.array, row)), names=["task", "seq", "path", "tokens", "documents"])

        total = 0
        for doc_id, ids in _encoded(words, batches):
            held += [ids, end]
            doc_ids.append(doc_id)
            sizes.append(len(ids) + len(end))
            total += sizes[-1]
            if total >= file_tokens:
                yield close()
                total = 0
        if doc_ids:
            yield close()

    return run


def write(
    docs: DataFrame, folder: str, vocabulary: str, *, end_id: int | None = None, text: str = "text", doc_id: str = "doc_id",
    file_tokens: int = FILE_TOKENS,
) -> Store:
    """Token files of all documents below the folder, in ascending order of doc_id.

    The texts are dealt into ranges of doc_id and sorted there; a range's task encodes them and closes a file
    after `file_tokens` tokens. A null doc_id comes first; rows of one doc_id follow in the order of their
    texts' hashes, and may lie in several ranges. Null and empty texts have only the end id, if there is one.
    Repeated rows are all written. Empty table: no file. Other columns are not read, whatever their names.
    `vocabulary` is a file of the tokenizers library that every executor has at that path.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = qualified(spark, folder)
    system, root = place(folder)
    system.create_dir(root, recursive=True)
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("_id"), F.coalesce(docs[f"`{text}`"].cast("string"), F.lit("")).cast("binary").alias("_text"))
    rows = rows.withColumns({"_tie": F.xxhash64("_text"), "_row": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange("_id", "_tie", "_row").sortWithinPartitions("_id", "_tie", "_row").select("_id", "_text")
    files, _ = written(ordered.mapInArrow(_writer(folder, vocabulary, end_id, file_tokens), _FILES), "token-files")
    # one row per task that wrote, so the global order is no more than a list of tasks
    tasks = files.groupBy("task").agg(F.sum("tokens").alias("_own"))
    before = tasks.select("task", (F.sum("_own").over(Window.orderBy("task")) - F.col("_own")).alias("_before"))
    inside = F.sum("tokens").over(Window.partitionBy("task").orderBy("seq")) - F.col("tokens")
    placed = files.withColumn("_inside", inside).join(before, "task")
    return Store(placed.select("path", "task", "seq", (F.col("_before") + F.col("_inside")).alias("first"), "tokens", "documents"))


def _document_rows(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, first, at, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            file = TokenFile(path)
            doc_ids, starts = file.docs(at, count)
            low = 0
            while low < count:
                # whole documents, as many as READ_TOKENS hold, one at least
                high = max(low + 1, int(np.searchsorted(starts, starts[low] + READ_TOKENS, "right")) - 1)
                ids = file.read(int(starts[low]), int(starts[high] - starts[low])).astype("<u4")
                cuts = starts[low : high + 1] - starts[low]
                own = [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                out = [
                    pa.array(doc_ids[low:high], pa.int64()), pa.array(starts[low:high] + first, pa.int64()),
                    pa.array(np.diff(cuts), pa.int64()), pa.array([zlib.crc32(i.tobytes()) for i in own], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)
                low = high
            file.close()


def read(store: Store, *, ids: bool = False) -> DataFrame:
    """Every document as the files have it: doc_id, start, n_tokens, ids_crc32, and with ids=True its ids (array<int>)."""
    small_batches(store.files.sparkSession)
    units = F.explode(F.sequence(F.lit(0).cast("long"), F.col("documents") - 1, F.lit(READ_DOCS).cast("long")))
    parts = store.files.where("documents > 0").select("path", "first", units.alias("at"), "documents").select(
        "path", "first", "at", F.least(F.lit(READ_DOCS), F.col("documents") - F.col("at")).alias("count"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")
    return parts.repartition("path", "at").mapInArrow(lambda batches: _document_rows(batches, ids), schema)


def _taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, file = None, None
    for batch in batches:
        found = []
        for name, at in zip(batch.column("path").to_pylist(), batch.column("at").to_pylist(), strict=True):
            if name != path:
                if file is not None:
                    file.close()
                path, file = name, TokenFile(name)
            found.append(file.token(at))
        yield pa.RecordBatch.from_arrays([batch.column("position"), pa.array(found, pa.int64())], names=["position", "token"])


def take(store: Store, positions: DataFrame, position: str = "position") -> DataFrame:
    """position, token: the ids at those places of the whole sequence, each read alone. Places that no file has, and
    nulls, give no row; repeated ones give one row each."""
    bins = F.explode(F.sequence(F.floor(F.col("first") / BIN), F.floor((F.col("first") + F.col("tokens") - 1) / BIN)))
    files = store.files.where("tokens > 0").select("path", "first", "tokens", bins.alias("_bin"))
    wanted = positions.select(positions[f"`{position}`"].cast("long").alias("position")).withColumn("_bin", F.floor(F.col("position") / BIN))
    found = wanted.join(files, "_bin").where("position >= first AND position < first + tokens")
    rows = found.select("position", "path", (F.col("position") - F.col("first")).alias("at"))
    return rows.sortWithinPartitions("path", "at").mapInArrow(_taken, "position long, token long")


def round_trip(docs: DataFrame, vocabulary: str, *, end_id: int) -> DataFrame:
    """All documents written to files in the shared folder and read back from them."""
    return read(write(docs, new_folder(docs.sparkSession, "tokens"), vocabulary, end_id=end_id))
