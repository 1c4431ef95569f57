"""Byte-pair encoding with a pair occurrence index, and decoding."""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clustertrace.llm.packing import byte_alphabet

_LATIN = "ɏ"


class PairIndex:
    """Merges many words at once: each pair's rank maps to all positions where the pair occurs.

    The active ranks are applied in ascending order, each to all its positions. A merge changes its
    neighbours' pairs only; those that have a rank are added to its list, and the old entries are
    recognised as stale when their turn comes. As no word holds a lower active rank than the one
    applied, every word goes through the same merges as on its own.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray, n_symbols: int) -> None:
        self.n_symbols, self.left, self.right, self.made = n_symbols, left, right, made
        keys = left * n_symbols + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of = keys[order], order

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it has none."""
        if not len(self.keys):
            return np.full(len(left), -1)
        keys = left * self.n_symbols + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank_of[at], -1)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left of words laid end to end, and how many each word has."""
        n = len(symbols)
        word = np.repeat(np.arange(len(lengths)), lengths)
        # Position n stands before the first and after the last symbol of a word.
        symbol = np.append(symbols.astype(np.int64), -1)
        after = np.arange(1, n + 2)
        before = np.arange(-1, n)
        border = np.flatnonzero(word[1:] != word[:-1])
        after[border], before[border + 1] = n, n
        if n:
            after[n - 1], before[0] = n, n
        alive = np.ones(n + 1, bool)
        alive[n] = False
        positions: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            rank = self.ranks(symbol[at], symbol[after[at]])
            found = rank >= 0
            if not found.any():
                return
            at, rank = at[found], rank[found]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            starts = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
            for r, part in zip(rank[starts].tolist(), np.split(at, starts[1:]), strict=True):
                if r not in positions:
                    positions[r] = []
                    heapq.heappush(active, r)
                positions[r].append(part)

        all_at = np.arange(n)
        note(all_at[after[:n] < n])
        while active:
            rank = heapq.heappop(active)
            parts = positions.pop(rank)
            at = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
            left, right = self.left[rank], self.right[rank]
            at = at[alive[at] & (symbol[at] == left) & (symbol[after[at]] == right)]
            if left == right and len(at) > 1:
                # In a run of the same symbol every second pair is taken, from the left.
                linked = np.append(False, after[at[:-1]] == at[1:])
                start = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - start) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            symbol[at] = self.made[rank]
            alive[gone] = False
            follows = after[gone]
            after[at] = follows
            inner = follows < n
            before[follows[inner]] = at[inner]
            previous = before[at]
            note(np.concatenate([previous[previous < n], at[inner]]))
        left_over = np.flatnonzero(alive)
        return symbol[left_over], np.bincount(word[left_over], minlength=len(lengths))


class WordBPE:
    """Encoder and decoder of a vocabulary file with word ends: lower-cased words, no white space kept.

    Chunks between ASCII white space are encoded once and remembered, up to ``remember`` chunks.
    """

    def __init__(self, path: str, remember: int = 400_000) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.token = {k: t for t, k in vocab.items()} | {x["id"]: x["content"] for x in spec["added_tokens"]}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        columns = np.array([[vocab[a], vocab[b], vocab[a + b]] for a, b in pairs], np.int64).reshape(-1, 3)
        self.index = PairIndex(*columns.T, max(self.token) + 1)
        of = byte_alphabet()
        self.inner, self.last = np.full(256, -1), np.full(256, -1)
        for character, byte in of.items():
            self.inner[byte] = vocab.get(character, -1)
            self.last[byte] = vocab.get(character + end, -1)
        self.byte_of = of
        self.special = {x["content"].encode(): x["id"] for x in spec["added_tokens"]}
        self.special_re = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")")
        cutter = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.cut = regex.compile(cutter["pattern"]["Regex"])
        self.library = Tokenizer.from_file(path)
        self.remember = remember
        self.ids_of: dict[bytes, bytes] = {}
        self.text_of: dict[bytes, str] = {}

    def _words(self, chunk: bytes) -> list[bytes]:
        """The words of a chunk as bytes, after normalisation; what is not Latin goes through the library."""
        text = chunk.decode()
        if text.isascii():
            return [w.encode() for w in self.cut.findall(text.lower())]
        if max(text) <= _LATIN:
            return [w.encode() for w in self.cut.findall(unicodedata.normalize("NFC", text).lower())]
        normal = self.library.normalizer.normalize_str(text)
        return [bytes(self.byte_of[c] for c in w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def _merged(self, words: list[bytes]) -> tuple[list[bytes], list[str]]:
        """Ids and decoded text of each word."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.last[data[ends - 1]]
        ids, counts = self.index.merge(symbols, lengths)
        packed = ids.astype("<u4").tobytes()
        tokens = list(map(self.token.__getitem__, ids.tolist()))
        ends = np.cumsum(counts).tolist()
        spans = list(zip([0, *ends], ends, strict=False))
        return [packed[4 * a : 4 * b] for a, b in spans], [" ".join(tokens[a:b]) for a, b in spans]

    def learn(self, chunks: list[bytes]) -> None:
        """Encodes and decodes chunks that aren't known yet, all with one index."""
        parts_of: list[list[int]] = []
        words: dict[bytes, int] = {}
        for chunk in chunks:
            if b"<|" in chunk and self.special_re.search(chunk):
                parts: list[int] = []
                for k, piece in enumerate(self.special_re.split(chunk)):
                    if k % 2:
                        parts.append(-1 - self.special[piece])
                    else:
                        parts += [words.setdefault(w, len(words)) for w in self._words(piece)]
                parts_of.append(parts)
            else:
                parts_of.append([words.setdefault(w, len(words)) for w in self._words(chunk)])
        ids, texts = self._merged(list(words)) if words else ([], [])
        for chunk, parts in zip(chunks, parts_of, strict=True):
            if len(parts) == 1 and parts[0] >= 0:
                self.ids_of[chunk], self.text_of[chunk] = ids[parts[0]], texts[parts[0]]
            else:
                own = [(ids[p], texts[p]) if p >= 0 else self._special(-1 - p) for p in parts]
                self.ids_of[chunk] = b"".join(x for x, _ in own)
                self.text_of[chunk] = " ".join(x for _, x in own)

    def _special(self, k: int) -> tuple[bytes, str]:
        return np.uint32(k).astype("<u4").tobytes(), self.decode([k])

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens with one space between them, as the file names no decoder; special ones are kept."""
        return " ".join(map(self.token.__getitem__, ids))

    def encode_all(self, texts: list[str], at_once: int = 16_000_000) -> Iterator[tuple[bytes, str]]:
        """Ids and decoded text of each text; new chunks of ``at_once`` characters are learnt together."""
        first = held = 0
        for k, text in enumerate(texts, 1):
            held += len(text)
            if held >= at_once or k == len(texts):
                yield from self._encode_some(texts[first:k])
                first, held = k, 0

    def _encode_some(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        if len(self.ids_of) > self.remember:
            self.ids_of.clear()
            self.text_of.clear()
        fresh: set[bytes] = set()
        for text in texts:
            fresh.update(set(text.encode().split()).difference(self.ids_of))
        self.learn(list(fresh))
        for text in texts:
            chunks = text.encode().split()
            decoded = " ".join(filter(None, map(self.text_of.__getitem__, chunks)))
            yield b"".join(map(self.ids_of.__getitem__, chunks)), decoded


@functools.lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBPE:
    return WordBPE(path)


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the id column, ``ids`` (little-endian unsigned 32-bit numbers) and ``decoded``.

    ``tokenizer`` names a word-end BPE vocabulary file that all executors can read. A task encodes
    the distinct new words of a batch (64 MB at most) together; nothing is shuffled.

    NULL and empty texts have no ids and decode to an empty text. Rows with a repeated or NULL id
    are encoded one by one.
    """
    kind = docs.schema[id_col].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(tokenizer)
        names = ["doc", "ids", "decoded"]
        for batch in batches:
            ids, decoded, first, held = [], [], 0, 0
            texts = batch.column(1).to_pylist()
            for k, (a, b) in enumerate(encoder.encode_all(texts), 1):
                ids.append(a)
                decoded.append(b)
                held += len(a) + len(b)
                if held > 24_000_000 or k == len(texts):
                    arrays = [batch.column(0).slice(first, k - first), pa.array(ids, pa.binary()), pa.array(decoded)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
                    ids, decoded, first, held = [], [], k, 0

    rows = docs.select(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    out = rows.mapInArrow(encode, f"doc {kind.simpleString()}, ids binary, decoded string")
    return out.withColumnRenamed("doc", id_col)
