import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clustertrace.llm.components import components, forest
from clustertrace.llm.ngram_join import may_link, signature, similar_documents
from clustertrace.llm.queries import op7_ngram_join
from tests.llm.conftest import ODD


def set_of(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def smallest(edges, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def brute(rows, size=5, percent=75):
    """Rows by position, each with its set's size and the smallest id that links reach."""
    sets = [set_of(t, size) for _, t, *_ in rows]
    having = defaultdict(list)
    edges = []
    for k, own in enumerate(sets):
        common = Counter(j for x in own for j in having[x])
        edges += [(j, k) for j, n in common.items() if 100 * n >= percent * (len(own) + len(sets[j]) - n)]
        for x in own:
            having[x].append(k)
    root = smallest(edges, range(len(rows)))
    least = {}
    for k, r in root.items():
        if rows[k][0] is not None:
            least[r] = min(least.get(r, rows[k][0]), rows[k][0])
    out = [(rows[k][0], len(s), least.get(root[k]) if s else rows[k][0]) for k, s in enumerate(sets)]
    return sorted(out, key=repr)


def got(frame, **options):
    return sorted(map(tuple, similar_documents(frame, **options).collect()), key=repr)


def test_odd_rows(odd):
    assert got(odd) == brute(ODD)


def test_empty_table(none):
    assert got(none) == []


@pytest.mark.parametrize("options", [{}, {"tile": 2, "block": 3}])
def test_documents(documents, options):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert got(documents.repartition(5), **options) == brute(rows)


def near_copies(spark, n):
    """Chains of texts: neighbours are similar, ends are not; and texts that share a long passage only."""
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(3000)]
    passage = " ".join(rng.choice(words, 60))
    rows, text = [], list(rng.choice(words, 80))
    for k in range(n):
        text = list(text)
        for at in rng.integers(0, 80, 2):
            text[at] = str(rng.choice(words))
        rows.append((1000 - k, " ".join(text)))
    rows += [(2000 + k, passage + " " + " ".join(rng.choice(words, rng.integers(8, 30)))) for k in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


@pytest.mark.parametrize("options", [{}, {"tile": 1, "block": 7}, {"percent": 60, "tile": 3, "block": 4}, {"size": 2, "tile": 2}])
def test_no_link_is_lost(spark, options):
    rows, frame = near_copies(spark, 60)
    rule = {k: v for k, v in options.items() if k in ("size", "percent")}
    assert got(frame, **options) == brute(rows, **rule)


def one_above(spark, n):
    """Near copies, and a text of the next band of sizes that shares their shingles and links with none."""
    base = " ".join(f"b{k}" for k in range(40))
    filler = " ".join(f"f{k}" for k in range(18))
    rows = [(k, f"{base} own{k}") for k in range(n)]
    rows += [(5000, f"{base} {filler}"), (5001, f"{base} {filler} more")]
    rows += [(6000 + k, f"{base[-11:]} {filler} {k % 2}") for k in range(2 * n)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def test_groups_are_bounded_on_either_side(spark, monkeypatch):
    """Many linked near copies and a larger text that is apart from them."""
    rows, frame = one_above(spark, 300)
    seen, group_by = [], type(frame).groupBy

    def noted(self, *keys):
        if {"i", "j"} <= {k for k in keys if isinstance(k, str)}:
            sides = group_by(self, *keys).agg(F.count_if("left").alias("x"), F.count_if(~F.col("left")).alias("y"))
            seen.extend((r["x"], r["y"]) for r in sides.collect())
        return group_by(self, *keys)

    monkeypatch.setattr(type(frame), "groupBy", noted)
    assert got(frame, tile=4, block=20) == brute(rows)
    assert sum(y for _, y in seen) >= 300
    assert max(x for x, _ in seen) <= 60 and max(y for _, y in seen) <= 60


def test_query(spark, sf_dir, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    result = op7_ngram_join(spark, sf_dir)
    assert result.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, result.collect()), key=repr) == brute(rows)


def test_signatures_never_hide_a_link():
    rng = np.random.default_rng(5)
    for _ in range(300):
        base = rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64)
        a = np.unique(base[rng.random(len(base)) < 0.9]) if len(base) > 3 else np.unique(base)
        b = np.unique(np.concatenate([base[rng.random(len(base)) < 0.9], rng.integers(0, 2**63, 5).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 75 * (len(a) + len(b) - common):
            assert may_link(signature(a), signature(b), len(a), len(b), 75)
    far = [np.unique(rng.integers(0, 2**63, 200).astype(np.uint64)) for _ in range(2)]
    assert not may_link(signature(far[0]), signature(far[1]), 200, 200, 75)


@pytest.mark.parametrize("one_task", [0, 500_000])
def test_components(spark, one_task):
    rng = np.random.default_rng(6)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 200)] + [(5000, 5000)]
    edges += [tuple(map(int, rng.integers(300, 400, 2))) for _ in range(60)]
    frame = spark.createDataFrame([*edges, (None, 3)], "a bigint, b bigint").repartition(5)
    found = {r["node"]: r["component"] for r in components(frame, one_task).collect()}
    assert found == smallest(edges, {x for e in edges for x in e})
    assert components(frame.filter("a = -1"), one_task).collect() == []


def test_forest():
    a, b = forest(np.array([5, 4, 9, 2]), np.array([4, 3, 8, 2]))
    assert dict(zip(a.tolist(), b.tolist(), strict=True)) == {5: 3, 4: 3, 9: 8}
