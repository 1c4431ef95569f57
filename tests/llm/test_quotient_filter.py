import random
from collections import Counter

import numpy as np
import pytest

from clustertrace.llm import quotient_filter as qf


def keys_of(limbs, bits):
    out = [0] * len(limbs[0])
    for limb, size in zip(limbs, qf.limb_bits(bits), strict=True):
        out = [o << size | int(x) for o, x in zip(out, limb, strict=True)]
    return out


@pytest.mark.parametrize("width,columns", [(1, 2), (7, 2), (12, 5), (13, 5), (20, 3), (21, 3), (26, 5), (32, 2), (32, 5), (40, 5)])
def test_round_trip(width, columns):
    rnd = np.random.default_rng(width)
    top = 1 << width
    rows = [rnd.integers(0, min(top, 40), 2000, np.uint64) for _ in range(columns)]
    rows[0][:9] = top - 1
    bits = width * columns
    limbs = qf.packed(rows, columns, width)
    expected = [sum(int(r[i]) << width * (columns - 1 - c) for c, r in enumerate(rows)) for i in range(2000)]
    assert keys_of(limbs, bits) == expected
    mixed = qf.permuted(limbs, bits)
    assert all(np.array_equal(a, b) for a, b in zip(qf.restored(mixed, bits), limbs, strict=True))
    assert all(np.array_equal(a, b) for a, b in zip(qf.unpacked(limbs, width, columns), rows, strict=True))
    keys, counts = qf.counted(mixed)
    assert dict(zip(keys_of(keys, bits), counts.tolist(), strict=True)) == Counter(keys_of(mixed, bits))
    assert keys_of(keys, bits) == sorted(set(keys_of(mixed, bits)))
    for bucket_bits in (0, qf.bounded_bits(bits, 5)):
        parts = qf.split(keys, counts, bits, bucket_bits)
        back = [qf.decode(blob, bits, bucket) for bucket, blob in parts]
        assert [k for limbs, _ in back for k in keys_of(limbs, bits)] == keys_of(keys, bits)
        assert np.array_equal(np.concatenate([c for _, c in back]), counts)


def test_permutation_is_one_to_one_and_spreads():
    for bits in (2, 5, 12, 16):
        every = qf.permuted([np.arange(1 << bits, dtype=np.uint64)], bits)[0]
        assert np.array_equal(np.sort(every), np.arange(1 << bits))
    for width, columns in ((14, 5), (11, 4)):
        n = 60_000
        rows = [np.arange(n) % 50 if c else np.arange(n) // 50 for c in range(columns)]
        bits = width * columns
        buckets = np.bincount(qf.bucket_of(qf.permuted(qf.packed(rows, columns, width), bits), bits, 4).astype(int))
        assert len(buckets) == 16 and buckets.max() < 1.3 * n / 16


def test_keys_that_begin_alike_are_told_apart():
    limbs = [np.array([5, 5, 5, 1], np.uint64), np.array([2, 1, 2, 7], np.uint64)]
    keys, counts = qf.counted(limbs)
    assert [k.tolist() for k in keys] == [[1, 5, 5], [7, 1, 2]] and counts.tolist() == [1, 1, 2]


def test_merge_adds_large_and_small_counts():
    rnd = random.Random(1)
    total, filters, bits = Counter(), [], 30
    for _ in range(7):
        own = Counter({rnd.randrange(1 << 30): rnd.choice([1, 2, 254, 255, 256, 10**12]) for _ in range(50)})
        own[77] = 1
        total += own
        keys = np.array(sorted(own), np.uint64)
        filters += qf.split([keys], np.array([own[int(k)] for k in keys], np.uint64), bits, 3)
    by_bucket = {}
    for bucket, blob in filters:
        by_bucket.setdefault(bucket, []).append((bucket, blob))
    got = {}
    for parts in by_bucket.values():
        (keys,), counts = qf.merged(parts, bits)
        assert np.all(np.diff(keys.astype(np.int64)) > 0)
        got |= dict(zip(keys.tolist(), counts.tolist(), strict=True))
    assert got == total


def test_empty():
    limbs, counts = qf.counted([np.zeros(0, np.uint64)])
    assert qf.split(limbs, counts, 20, 2) == [] and len(qf.merged([], 20)[1]) == 0
    assert len(qf.decode(qf.encode(limbs, counts, 20, 0), 20, 0)[1]) == 0
