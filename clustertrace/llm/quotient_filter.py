"""Counting quotient filters of packed numbers: lossless, compact, and merged in sorted order.

A key is a row of whole numbers of ``width`` bits each, packed into ``bits`` bits. The packed key is permuted by an
invertible map, so that any keys spread evenly. The permuted key is its quotient (the first bits) and its full
remainder (the rest), so nothing is lost: a filter gives its keys back. Permuted keys are held as a list of arrays,
first the leading 64 bits (or all, where there are fewer), then the next 64 and so on.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ROUNDS = 3
_HEAD = struct.Struct("<QHHQ")
#: Counts from here on are held apart from the others, which take a byte each.
_LARGE = 255

Keys = list[np.ndarray]


def limb_bits(bits: int) -> list[int]:
    """The bits of each array that holds a part of a key."""
    return [min(64, bits - k) for k in range(0, max(1, bits), 64)]


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _stir(x: np.ndarray, bits: int, salt: int) -> np.ndarray:
    """A bijection of numbers of so many bits."""
    half, mask = np.uint64((bits + 1) // 2), _mask(bits)
    for k in range(2):
        x = (x * _ODD + np.uint64(salt + k)) & mask
        x = x ^ (x >> half)
    return x


def _unstir(x: np.ndarray, bits: int, salt: int) -> np.ndarray:
    half, mask = np.uint64((bits + 1) // 2), _mask(bits)
    for k in (1, 0):
        x = x ^ (x >> half)
        x = ((x - np.uint64(salt + k)) * _INVERSE) & mask
    return x


def _blend(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    return x ^ (x >> np.uint64(29))


def permuted(limbs: Keys, bits: int) -> Keys:
    """The permuted keys: each part is stirred, and the parts are blended into each other by turns."""
    sizes, limbs = limb_bits(bits), list(limbs)
    for turn in range(_ROUNDS):
        for i, size in enumerate(sizes):
            limbs[i] = _stir(limbs[i], size, 2 * turn + 1)
            other = (i + 1) % len(sizes)
            if other != i:
                limbs[other] = limbs[other] ^ (_blend(limbs[i]) & _mask(sizes[other]))
    return limbs


def restored(limbs: Keys, bits: int) -> Keys:
    """The keys of permuted ones."""
    sizes, limbs = limb_bits(bits), list(limbs)
    for turn in reversed(range(_ROUNDS)):
        for i in reversed(range(len(sizes))):
            other = (i + 1) % len(sizes)
            if other != i:
                limbs[other] = limbs[other] ^ (_blend(limbs[i]) & _mask(sizes[other]))
            limbs[i] = _unstir(limbs[i], sizes[i], 2 * turn + 1)
    return limbs


def packed(columns: Iterable[np.ndarray], n_columns: int, width: int) -> Keys:
    """Numbers below ``2 ** width``, a column each, packed into keys of ``width * n_columns`` bits."""
    sizes, limbs = limb_bits(width * n_columns), []
    for c, column in enumerate(columns):
        limbs = limbs or [np.zeros(len(column), np.uint64) for _ in sizes]
        _place(limbs, sizes, column.astype(np.uint64), c * width, width)
    return limbs


def _place(limbs: Keys, sizes: list[int], values: np.ndarray, begin: int, width: int) -> None:
    """Writes values to the bits from ``begin`` on, counted from the first limb's first."""
    for i, size in enumerate(sizes):
        shift = 64 * i + size - begin - width  # of the value within this limb, to the left
        if 64 * i < begin + width and begin < 64 * i + size:
            limbs[i] |= (values << np.uint64(shift) if shift >= 0 else values >> np.uint64(-shift)) & _mask(size)


def unpacked(limbs: Keys, width: int, n_columns: int) -> list[np.ndarray]:
    sizes = limb_bits(width * n_columns)
    out = []
    for c in range(n_columns):
        begin, values = c * width, np.zeros(len(limbs[0]), np.uint64)
        for i, size in enumerate(sizes):
            shift = 64 * i + size - begin - width
            if 64 * i < begin + width and begin < 64 * i + size:
                values |= limbs[i] >> np.uint64(shift) if shift >= 0 else limbs[i] << np.uint64(-shift)
        out.append(values & _mask(width))
    return out


def counted(limbs: Keys, counts: np.ndarray | None = None) -> tuple[Keys, np.ndarray]:
    """The distinct keys in ascending order with the sums of their counts (1 each, if not given)."""
    n = len(limbs[0])
    if n == 0:
        return limbs, np.zeros(0, np.uint64)
    order = np.argsort(limbs[0], kind="stable" if counts is not None else None)
    first = limbs[0][order]
    same = first[1:] == first[:-1]
    rest = [x[order] for x in limbs[1:]]
    if rest and any(np.any(same & (x[1:] != x[:-1])) for x in rest):
        # Different keys that begin alike may lie mixed.
        order = np.lexsort(tuple(reversed(limbs)))
        first, rest = limbs[0][order], [x[order] for x in limbs[1:]]
        same = first[1:] == first[:-1]
    for x in rest:
        same = same & (x[1:] == x[:-1])
    starts = np.flatnonzero(np.append(True, ~same))
    if counts is None:
        sums = np.diff(np.append(starts, n)).astype(np.uint64)
    else:
        sums = np.add.reduceat(counts[order], starts)
    return [x[starts] for x in (first, *rest)], sums


def bucket_of(limbs: Keys, bits: int, bucket_bits: int) -> np.ndarray:
    """The number that the first ``bucket_bits`` bits make."""
    size = limb_bits(bits)[0]
    return (limbs[0] >> np.uint64(size - bucket_bits)) if bucket_bits else np.zeros(len(limbs[0]), np.uint64)


def bounded_bits(bits: int, wanted: int) -> int:
    """``wanted`` bits, or as many as the first part of a key has, less one."""
    return max(0, min(wanted, limb_bits(bits)[0] - 1, 62))


def encode(limbs: Keys, counts: np.ndarray, bits: int, bucket_bits: int) -> bytes:
    """A filter of distinct ascending keys that all lie in one bucket, whose number isn't stored.

    As many slots as keys, to the next power of two. A bit per slot tells whether a key's quotient is its number, and a bit
    per key whether it is the last of its slot's run; then come the full remainders and the counters.
    """
    n = len(counts)
    size = limb_bits(bits)[0]
    quotient_bits = min(max(1, int(n).bit_length()), size - bucket_bits)
    remainder_bits = size - bucket_bits - quotient_bits
    inner = limbs[0] & _mask(size - bucket_bits)
    quotients = (inner >> np.uint64(remainder_bits)).astype(np.int64)
    occupied = np.zeros(1 << quotient_bits, np.uint8)
    occupied[quotients] = 1
    run_ends = np.append(quotients[1:] != quotients[:-1], True) if n else np.zeros(0, bool)
    parts = [np.packbits(occupied).tobytes(), np.packbits(run_ends).tobytes()]
    for k, limb in enumerate(limbs):
        # The first limb's part that quotient and bucket don't give, and the others whole, in as few bytes as hold them.
        n_bytes = -(-(remainder_bits if k == 0 else limb_bits(bits)[k]) // 8)
        kept = limb & _mask(remainder_bits) if k == 0 else limb
        parts.append(np.ascontiguousarray(kept.astype("<u8").view(np.uint8).reshape(n, 8)[:, :n_bytes]).tobytes())
    large = np.flatnonzero(counts >= _LARGE)
    parts.append(np.minimum(counts, _LARGE).astype(np.uint8).tobytes())
    parts.append(counts[large].astype("<u8").tobytes())
    return _HEAD.pack(n, quotient_bits, bucket_bits, len(large)) + b"".join(parts)


def decode(blob: bytes, bits: int, bucket: int) -> tuple[Keys, np.ndarray]:
    """The permuted keys, ascending, and their counts."""
    n, quotient_bits, bucket_bits, n_large = _HEAD.unpack_from(blob)
    sizes, at = limb_bits(bits), _HEAD.size

    def take(n_bytes: int) -> np.ndarray:
        nonlocal at
        at += n_bytes
        return np.frombuffer(blob, np.uint8, n_bytes, at - n_bytes)

    slots = np.flatnonzero(np.unpackbits(take(-(-(1 << quotient_bits) // 8)), count=1 << quotient_bits))
    ends = np.unpackbits(take(-(-n // 8)), count=n).astype(np.int64)
    quotients = slots[np.cumsum(ends) - ends].astype(np.uint64) if n else np.zeros(0, np.uint64)
    remainder_bits = sizes[0] - bucket_bits - quotient_bits
    limbs = []
    for k, size in enumerate(sizes):
        n_bytes = -(-(remainder_bits if k == 0 else size) // 8)
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :n_bytes] = take(n * n_bytes).reshape(n, n_bytes)
        limbs.append(whole.view("<u8").reshape(n).astype(np.uint64))
    lead = np.uint64(bucket << (sizes[0] - bucket_bits)) if bucket_bits else np.uint64(0)
    limbs[0] |= lead | (quotients << np.uint64(remainder_bits))
    counts = take(n).astype(np.uint64)
    counts[counts == _LARGE] = take(8 * n_large).view("<u8")
    return limbs, counts


def split(limbs: Keys, counts: np.ndarray, bits: int, bucket_bits: int) -> list[tuple[int, bytes]]:
    """Distinct ascending keys as a filter per bucket that has any."""
    if len(counts) == 0:
        return []
    buckets = bucket_of(limbs, bits, bucket_bits)
    starts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1]))
    ends = np.append(starts[1:], len(buckets))
    return [
        (int(buckets[a]), encode([x[a:b] for x in limbs], counts[a:b], bits, bucket_bits))
        for a, b in zip(starts, ends, strict=True)
    ]


def merged(filters: list[tuple[int, bytes]], bits: int) -> tuple[Keys, np.ndarray]:
    """The keys of sorted filters, given with their buckets' numbers, in order, with their counts added up."""
    read = [decode(blob, bits, bucket) for bucket, blob in filters]
    if not read:
        return [np.zeros(0, np.uint64) for _ in limb_bits(bits)], np.zeros(0, np.uint64)
    limbs = [np.concatenate([r[0][k] for r in read]) for k in range(len(read[0][0]))]
    return counted(limbs, np.concatenate([r[1] for r in read]))
