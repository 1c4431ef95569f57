"""Packing of token sequences with a fixed number of open windows per partition."""

from __future__ import annotations

import functools
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clustertrace.llm.shared import give_back, stored

#: Fixed values of the byte-level format: how texts are cut before merging.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SPACE_AFTER_SPACE = re.compile(r"\s ")
_SPACE_AFTER_WORD = re.compile(r"(?<=\S) ")
_LONG_UNIT = 64
_MARKS = ".,;:!?%$#&*"
_LATIN = "ɏ"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: printable ones for themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Units(dict):
    """Ids of the units between spaces, as little-endian unsigned 32-bit numbers; filled on demand."""

    def __init__(self, encode, lead: str) -> None:
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, unit: str) -> bytes:
        ids = self.encode(self.lead + unit)
        if len(unit) <= _LONG_UNIT:
            self[unit] = ids
        return ids


class ByteLevelIds:
    """Ids of texts under a byte-level vocabulary file, equal to those of the tokenizers library.

    A text is cut where a space follows a word, which no merge crosses, and each unit is encoded
    once and remembered, up to ``remember`` units. Units beyond Latin letters, whose classes differ
    between Unicode versions, go to the tokenizers library itself, which is loaded with the first of them.
    """

    def __init__(self, path: str, remember: int = 150_000) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        of = byte_alphabet()
        ranks = {bytes(of[c] for c in token): k for token, k in spec["model"]["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_re = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.plain = tiktoken.Encoding("plain", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})
        self.piece = self.plain._core_bpe.encode_single_piece
        self.path = path
        self.remember = remember
        self.first, self.rest = _Units(self._unit, ""), _Units(self._unit, " ")

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _unit(self, unit: str) -> bytes:
        word = unit.rstrip(_MARKS)
        if unit[:1] == " " and word[1:].isalpha() and (word.isascii() or max(word) <= _LATIN):
            # Letters after a space, then marks: one piece each, that need no cutting.
            ids = self.piece(word.encode())
            if len(word) < len(unit):
                ids = ids + self.piece(unit[len(word) :].encode())
        elif unit.isascii() or max(unit) <= _LATIN:
            ids = self.plain.encode_ordinary(unit)
        else:
            ids = self.library.encode(unit, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _part(self, text: str) -> bytes:
        parts = text.split(" ") if _SPACE_AFTER_SPACE.search(text) is None else _SPACE_AFTER_WORD.split(text)
        return self.first[parts[0]] + b"".join(map(self.rest.__getitem__, parts[1:]))

    def forget(self) -> None:
        self.first.clear()
        self.rest.clear()

    def ids(self, text: str) -> bytes:
        if len(self.rest) + len(self.first) > self.remember:
            self.forget()
        if self.special_re is None or self.special_re.search(text) is None:
            return self._part(text)
        parts = self.special_re.split(text)
        return b"".join(
            np.uint32(self.special[p]).astype("<u4").tobytes() if k % 2 else self._part(p) if p else b""
            for k, p in enumerate(parts)
        )


@functools.lru_cache(maxsize=2)
def byte_level_ids(path: str) -> ByteLevelIds:
    return ByteLevelIds(path)


class OpenWindows:
    """At most ``n_open`` partly filled windows of ``size`` ids; yields pieces as windows fill up.

    A piece is placed whole in the window it fits best. Where none fits and all are open, it is cut:
    its first ids fill up the fullest window, which is emitted. So every emitted window is full.
    """

    def __init__(self, size: int, n_open: int, first_sequence: int) -> None:
        self.size, self.n_open, self.next = size, n_open, first_sequence
        self.open: dict[int, int] = {}  # sequence -> free ids

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def _fill(self, sequence: int, n: int) -> int:
        """Takes ``n`` ids of a window; the offset at which they go."""
        free = self.open[sequence]
        self.open[sequence] = free - n
        if free == n:
            del self.open[sequence]
        return self.size - free

    def place(self, n: int) -> Iterator[tuple[int, int, int, int]]:
        """Where ``n`` ids go: (start among them, length, sequence, offset) of each piece."""
        start = 0
        while n - start >= self.size:
            yield start, self.size, self._new(), 0
            start += self.size
        while start < n:
            rest = n - start
            fitting = min(((f, s) for s, f in self.open.items() if f >= rest), default=None)
            if fitting is not None:
                length, sequence = rest, fitting[1]
            elif len(self.open) < self.n_open:
                length, sequence = rest, self._new()
                self.open[sequence] = self.size
            else:
                length, sequence = min((f, s) for s, f in self.open.items())
            yield start, length, sequence, self._fill(sequence, length)
            start += length


_PIECE = ["start", "length", "doc_tokens", "sequence_id", "offset"]


#: Bytes of ids that a task holds before it gives their pieces out.
_HELD = 4_000_000


def _pack_partition(path: str, size: int, n_open: int, end_id: int, fan_in: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_level_ids(path)
        task = TaskContext.get().partitionId()
        windows = OpenWindows(size, n_open, task << 32)
        end = np.uint32(end_id).astype("<u4").tobytes()
        waiting: dict[int, list] = {}  # pieces of windows that are still open

        def rows(pieces: list, kind: pa.DataType, group: int | None) -> pa.RecordBatch:
            columns = list(zip(*pieces, strict=True))
            arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:6])]
            arrays += [pa.array(columns[6], pa.binary()), pa.array([group] * len(pieces), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["doc", *_PIECE, "ids", "merge_group"])

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            full, held = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.ids(text) + end
                n = len(ids) // 4
                for start, length, sequence, offset in windows.place(n):
                    piece = (doc, start, length, n, sequence, offset, ids[4 * start : 4 * (start + length)])
                    waiting.setdefault(sequence, []).append(piece)
                    if sequence not in windows.open:
                        full += waiting.pop(sequence)
                held += len(ids)
                if held > _HELD and full:
                    yield rows(full, kind, None)
                    full, held = [], 0
            if full:
                yield rows(full, kind, None)
        if waiting:
            yield rows([p for pieces in waiting.values() for p in pieces], kind, task // fan_in)
        encoder.forget()
        give_back()

    return pack


def _merge_group(size: int, n_open: int):
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        """The leftovers of some partitions, packed again; the last ids go to windows of powers of two."""
        group = key[0].as_py()
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        windows = OpenWindows(size, n_open, (1 << 61) + (group << 32))
        out, waiting = [], {}
        for row in table.to_pylist():
            for start, length, sequence, _ in windows.place(row["length"]):
                ids = row["ids"][4 * start : 4 * (start + length)]
                piece = [row["doc"], row["start"] + start, length, row["doc_tokens"], sequence, 0, ids]
                waiting.setdefault(sequence, []).append(piece)
                if sequence not in windows.open:
                    out += [(sequence, p) for p in waiting.pop(sequence)]
        rest = [p for pieces in waiting.values() for p in pieces]
        left = sum(p[2] for p in rest)
        while left:
            room = min(size, 1 << (left.bit_length() - 1))
            left -= room
            sequence = windows._new()
            while room:
                piece = rest.pop(0)
                if piece[2] > room:
                    cut = [*piece[:6], piece[6][: 4 * room]]
                    cut[2] = room
                    rest.insert(0, [piece[0], piece[1] + room, piece[2] - room, *piece[3:6], piece[6][4 * room :]])
                    piece = cut
                room -= piece[2]
                out.append((sequence, piece))
        offsets: dict[int, int] = {}
        rows = []
        for sequence, p in out:
            offset = offsets.get(sequence, 0)
            offsets[sequence] = offset + p[2]
            rows.append((p[0], p[1], p[2], p[3], sequence, offset, p[6]))
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(columns[0], table.schema.field("doc").type)]
        arrays += [*(pa.array(c, pa.int64()) for c in columns[1:6]), pa.array(columns[6], pa.binary())]
        return pa.Table.from_arrays(arrays, names=["doc", *_PIECE, "ids"])

    return merge


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 1024,
    n_open: int = 32,
    end_id: int = 0,
    fan_in: int = 64,
) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most ``size`` ids.

    Per piece: the id column, ``start`` (the document's ids before it), ``length``, ``doc_tokens``
    (ids of the document, with the ``end_id`` that closes it), ``sequence_id``, ``offset`` in the
    sequence (without gaps, from 0) and ``ids`` (little-endian unsigned 32-bit numbers).
    ``tokenizer`` names a byte-level vocabulary file that all executors can read.

    Each partition packs its documents in one pass with ``n_open`` open windows, which bounds its
    memory. Its leftovers, less than ``n_open`` windows, are merged with those of ``fan_in``
    partitions, cutting pieces where needed; what remains there, less than one window, goes to
    sequences whose lengths are powers of two. So no sequence needs padding, if only a power of two
    needs none and ``size`` is one. The first pass is written to the shared folder, so that the
    merge reads the same pieces whichever executors are lost.

    NULL and empty texts are one closing id. Rows with a repeated or NULL id are packed one by one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    numbers = ", ".join(f"{c} bigint" for c in _PIECE)
    rows = docs.select(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    schema = f"doc {kind}, {numbers}, ids binary"
    first = rows.mapInArrow(
        _pack_partition(tokenizer, size, n_open, end_id, fan_in), f"{schema}, merge_group bigint"
    )
    first = stored(first, "packed")
    merged = (
        first.filter("merge_group IS NOT NULL").groupBy("merge_group").applyInArrow(_merge_group(size, n_open), schema)
    )
    pieces = first.filter("merge_group IS NULL").drop("merge_group").unionByName(merged)
    return pieces.withColumnRenamed("doc", id_col)
