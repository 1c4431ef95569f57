"""Words of texts as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_LONG_WORD = 48


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts laid end to end and where each text begins, with the end as a last entry."""
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return every[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(texts: pa.Array, at_once: int = 1_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``at_once`` bytes, or one longer text: index of the first, bytes, bounds."""
    data, bounds = utf8(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + at_once, "right")) - 1)
        yield first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def lower_latin(data: np.ndarray) -> np.ndarray:
    """A-Z and the capital letters of the Latin-1 block lower-cased; all other bytes as they are."""
    low = lower_ascii(data)
    if len(low) > 1:  # the multiplication sign lies among the capitals
        capital = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
        low[1:][capital] += 32
    return low


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word (bytes other than 0x20 and 0x09-0x0D) and the index of its text."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before = np.append(False, inside[:-1]) if len(data) else inside
    after = np.append(inside[1:], False) if len(data) else inside
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    before[cuts] = False
    after[cuts - 1] = False
    begins, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return begins, ends, np.searchsorted(bounds, begins, "right") - 1


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    lengths = ends - begins
    hashes = mixed(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    short = np.flatnonzero(lengths <= _LONG_WORD)
    order = short[np.argsort(-lengths[short], kind="stable")]
    sizes = lengths[order]
    part = hashes[order]
    for k in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -k, "left"))  # words longer than k
        part[:n] = mixed((part[:n] ^ data[begins[order[:n]] + k]) * np.uint64(0x9FB21C651E98DF25) + np.uint64(k + 1))
    hashes[order] = part
    for i in np.flatnonzero(lengths > _LONG_WORD):
        hashes[i] = xxhash.xxh64_intdigest(data[begins[i] : ends[i]].tobytes())
    return hashes


def shingles(hashes: np.ndarray, text: np.ndarray, n_texts: int, size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's runs of ``size`` words.

    A text of fewer words has one run, all its words; one without words has none.
    """
    counts = np.bincount(text, minlength=n_texts)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    n = len(hashes)
    runs = np.full(n, np.uint64(size), np.uint64)
    for k in range(size):
        runs[: max(0, n - k)] = mixed(runs[: max(0, n - k)] * np.uint64(0x9E3779B97F4A7C15) + hashes[k:])
    out = []
    for i in range(n_texts):
        a, b = int(firsts[i]), int(firsts[i + 1])
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            own = np.full(1, np.uint64(b - a), np.uint64)
            for h in hashes[a:b]:
                own = mixed(own * np.uint64(0x9E3779B97F4A7C15) + h)
            out.append(own)
        else:
            out.append(np.empty(0, np.uint64))
    return out
