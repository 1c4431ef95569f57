import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from clustertrace.llm import fingerprint as fp
from clustertrace.llm.queries import op13_fingerprint

UNIT = 1 << 20


def part(c):
    return round(c * math.log2(c) * UNIT) if c else 0


def brute_bins(data):
    most = part(64)
    out = []
    for i in range(len(data) - 63):
        total = sum(part(c) for c in Counter(data[i : i + 64]).values())
        out.append((most - total) * 1000 // (most + 1))
    return out


def brute_features(data, ranks, least_bin=100, least_points=16):
    keys = [ranks[b] if b >= least_bin else None for b in brute_bins(data)]
    points = Counter()
    for begin in range(-63, len(keys)):
        window = [(keys[p], p) for p in range(max(0, begin), min(len(keys), begin + 64)) if keys[p] is not None]
        if window:
            points[min(window)[1]] += 1
    chosen = [xxhash.xxh3_64_intdigest(data[p : p + 64]) for p in sorted(points) if points[p] >= least_points]
    return chosen or ([xxhash.xxh3_64_intdigest(data)] if data else [])


def brute_chain(data, ranks, most=160):
    found = list(dict.fromkeys(brute_features(data, ranks)))
    chain = []
    for begin in range(0, len(found), most):
        bits = {(h >> 11 * k) % 2048 for h in found[begin : begin + most] for k in range(5)}
        chain.append(np.packbits([i in bits for i in range(2048)]).tobytes())
    return chain


def brute_likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    if (len(a), b"".join(a)) > (len(b), b"".join(b)):
        a, b = b, a

    def score(x, y):
        x, y = int.from_bytes(x), int.from_bytes(y)
        n, m, common = x.bit_count(), y.bit_count(), (x & y).bit_count()
        chance = n * m / 2048
        return min(1, max(0, (common - chance) / (min(n, m) - chance))) if min(n, m) > chance else 0

    ones = [int.from_bytes(x).bit_count() for x in a]
    return sum(n * max(score(x, y) for y in b) for n, x in zip(ones, a, strict=True)) / sum(ones)


def text_of(rnd, n):
    return " ".join("".join(rnd.choice("etaoinshrdluéß日") for _ in range(rnd.randint(1, 9))) for _ in range(n))


def samples():
    rnd = random.Random(5)
    return ["", "a", "x" * 63, "x" * 64, "x" * 500, text_of(rnd, 8), text_of(rnd, 12), text_of(rnd, 300), "ab" * 300, text_of(rnd, 40) + "y" * 200 + text_of(rnd, 40)]


def ranks_of(seed=3):
    ranks = list(range(1000))
    random.Random(seed).shuffle(ranks)
    return np.array([r // 7 for r in ranks])


@pytest.mark.parametrize("at_once", [1 << 18, 200])
def test_features(monkeypatch, at_once):
    monkeypatch.setattr(fp, "_AT_ONCE", at_once)
    texts, ranks = samples(), ranks_of()
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        bins = [b for _, _, part_bins in fp._blocks(data) for b in part_bins.tolist()]
        assert bins == brute_bins(text.encode())
    got = fp._fingerprints(texts, (ranks, 100, 16, 20))
    for text, blooms in zip(texts, got, strict=True):
        assert [b.tobytes() for b in blooms] == brute_chain(text.encode(), ranks, 20)


def test_likeness():
    rnd = random.Random(6)
    chains = [brute_chain(t.encode(), ranks_of(), 20) for t in samples()]
    base = text_of(rnd, 200)
    chains += [brute_chain(x.encode(), ranks_of(), 20) for x in (base, base[:600] + text_of(rnd, 120), base + "!")]
    as_rows = [np.frombuffer(b"".join(c), np.uint8).reshape(-1, 256) for c in chains]
    for a, x in zip(chains, as_rows, strict=True):
        for b, y in zip(chains, as_rows, strict=True):
            assert fp.likeness(x, y) == pytest.approx(brute_likeness(a, b)) and 0 <= fp.likeness(x, y) <= 1
            assert fp.likeness(x, y) == fp.likeness(y, x)
    assert fp.likeness(as_rows[-3], as_rows[-1]) > 0.9 > 0.8 > fp.likeness(as_rows[-3], as_rows[-2]) > 0.3


def test_rarity(spark):
    texts = samples()
    frame = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string").repartition(3)
    counts = Counter(b for t in texts for b in brute_bins(t.encode()))
    order = sorted(range(1000), key=lambda b: (counts[b], b))
    assert [int(x) for x in np.argsort(fp.fit_rarity(frame))] == order


def expected(rows, ranks):
    """Results of rows in the operator's order."""
    out = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, other, nxt = (brute_chain(x.encode(), ranks) for x in (text, changed, following))
        names = [f"{len(c)}:{base64.b64encode(b''.join(c)).decode()}" for c in (own, other)]
        digest = hashlib.sha256(changed.encode()).hexdigest()
        out.append((i, len(text), digest, *names, round(brute_likeness(own, other), 9), round(brute_likeness(own, nxt), 9)))
    return out


def results(frame):
    return [(*r[:5], round(r[5], 9), round(r[6], 9)) for r in map(tuple, frame.collect())]


@pytest.mark.parametrize("at_once", [1 << 18, 100])
def test_edited(spark, monkeypatch, at_once):
    monkeypatch.setattr(fp, "_AT_ONCE", at_once)
    rows = [(k * 7 % 31, t) for k, t in enumerate([*samples(), None, *samples()[5:]])]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, task int, fingerprint string").repartition(5)
    ordered = sorted((i, t or "") for i, t in rows)
    ranks = fp.fit_rarity(frame)
    assert sorted(results(fp.edit_resistance(frame))) == sorted(expected(ordered, ranks))
    plain = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprints(frame, ranks).collect()}
    assert plain == {r[0]: r[3] for r in expected(ordered, ranks)}
    assert fp.fingerprints(frame, ranks).columns == frame.columns


def test_one_row_is_its_own_next(spark):
    frame = spark.createDataFrame([("k", "some text")], "doc_id string, text string")
    ((i, n, digest, a, b, x, y),) = results(fp.edit_resistance(frame))
    assert (i, n, a != b, x, y) == ("k", 9, True, 0, 1) and digest == hashlib.sha256(b"some some").hexdigest()


def test_odd_rows(odd, none):
    got = results(fp.edit_resistance(odd))
    assert sorted((r[0], r[1]) for r in got if r[0]) == sorted((r["doc_id"], len(r["text"] or "")) for r in odd.collect() if r["doc_id"])
    assert len(got) == odd.count() and all(0 <= r[5] <= 1 and 0 <= r[6] <= 1 for r in got)
    assert len({r[3] for r in got if r[0] in (9, 11)}) == 1
    assert fp.edit_resistance(none).collect() == [] == fp.fingerprints(none, ranks_of()).collect()


def test_equal_texts_and_partitions(spark, documents):
    ranks = fp.fit_rarity(documents)
    assert np.array_equal(ranks, fp.fit_rarity(documents.repartition(7)))
    one = documents.select("doc_id", "text")
    a = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprints(one.coalesce(1), ranks).collect()}
    b = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprints(one.repartition(9), ranks).collect()}
    assert a == b


def test_documents(spark, documents, sf_dir):
    result = op13_fingerprint(spark, sf_dir)
    assert result.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = {r["doc_id"]: r for r in result.collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(fp.edited(text, following).encode()).hexdigest()
    apart = [got[i]["near_edited"] > got[i]["near_next"] for i, t in rows if len(t) >= 300]
    assert sum(apart) / len(apart) > 0.97
