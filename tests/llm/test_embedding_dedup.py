import numpy as np
import pytest

from clustertrace.llm.embedding_dedup import build, near_duplicates
from clustertrace.llm.queries import op8_embedding_dedup
from tests.llm.test_ngram_join import smallest

SCHEMA = "vec_id bigint, embedding array<float>, n_links string, node int"


def brute(rows):
    """Each row's number of links and component, by all cosines in double precision of vectors of one length."""
    usable = [k for k, (_, v, *_) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    n_links, edges = dict.fromkeys(usable, 0), []
    for dims in {len(rows[k][1]) for k in usable}:
        own = [k for k in usable if len(rows[k][1]) == dims]
        x = np.array([rows[k][1] for k in own], np.float32).astype(float)
        x = x / np.sqrt((x * x).sum(1, keepdims=True))
        linked = x @ x.T >= 0.95
        n_links |= {k: int(n) - 1 for k, n in zip(own, linked.sum(1), strict=True)}
        edges += [(own[i], own[j]) for i, j in zip(*np.nonzero(linked), strict=True) if i < j]
    root = smallest(edges, range(len(rows)))
    least = {}
    for k, r in root.items():
        if rows[k][0] is not None:
            least[r] = min(least.get(r, rows[k][0]), rows[k][0])
    out = []
    for k, row in enumerate(rows):
        component = least.get(root[k])
        out.append((row[0], n_links.get(k, 0), component, row[0] is not None and row[0] == component))
    return sorted(out, key=repr)


def got(frame, **options):
    return sorted(map(tuple, near_duplicates(frame, **options).collect()), key=repr)


def clouds(n, spread, rng, dims=16):
    centres = rng.normal(size=(6, dims))
    rows = [centres[k % 6] + spread * rng.normal(size=dims) for k in range(n)]
    return [(k * 3 % 1009, [float(np.float32(x)) for x in r], "x", 1) for k, r in enumerate(rows)]


@pytest.mark.parametrize("options", [{}, {"block": 8, "per_cell": 4}, {"per_cell": 2}])
@pytest.mark.parametrize("spread", [0.05, 0.25])
def test_clouds(spark, spread, options):
    rows = clouds(300, spread, np.random.default_rng(8))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    truth, found = brute(rows), got(frame, **options)
    links, hits = sum(r[1] for r in truth), sum(r[1] for r in found)
    assert links and hits >= 0.99 * links
    assert all(f[1] <= t[1] for f, t in zip(found, truth, strict=True))  # none below the threshold
    assert {f[2] == t[2] for f, t in zip(found, truth, strict=True) if f[1] == t[1]} <= {True} or hits < links


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], "a", 0), (2, [2.0, 4.0], "a", 0), (3, [1.0, 2.0], "a", 0), (4, None, "a", 0), (5, [], "a", 0),
        (6, [0.0, 0.0], "a", 0), (7, [1.0, None], "a", 0), (8, [nan, 1.0], "a", 0), (9, [inf, 1.0], "a", 0),
        (10, [1.0, 2.0, 3.0], "a", 0), (None, [1.0, 2.0], "a", 0), (None, [-1.0, 5.0], "a", 0), (11, [-1.0, -2.0], None, None),
        (12, [3e38, 3e38], "a", 0), (12, [3e38, 3e38], "a", 0), (None, None, None, None), (13, [1e-44, 1e-44], "a", 0),
    ]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


@pytest.mark.parametrize("block", [2048, 8])
def test_every_length_is_compared(spark, block):
    rng = np.random.default_rng(3)
    rows = []
    for dims, n in ((2, 30), (3, 24), (5, 20), (7, 2)):
        points = rng.normal(size=(3, dims))
        rows += [(len(rows) + k, (points[k % 3] + 0.02 * rng.normal(size=dims)).tolist(), "x", 1) for k in range(n)]
    rows += [(900, [1.0, 2.0, 3.0], "x", 1), (901, [1.0, 2.0, 3.0], "x", 1), (902, [1.0, 2.0, 3.0, 0.0], "x", 1)]
    assert got(spark.createDataFrame(rows, SCHEMA), block=block) == brute(rows)


def test_without_usable_vectors(spark):
    frame = spark.createDataFrame([(1, None, "a", 0), (2, [0.0], "a", 0)], SCHEMA)
    assert got(frame) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert got(frame.filter("vec_id = 9")) == []


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    result = op8_embedding_dedup(spark, sf_dir)
    assert result.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, result.collect()), key=repr) == brute(rows)


def test_many_near_copies_in_blocks(spark):
    """A third of all vectors around one point: recall against brute force over several blocks."""
    rng = np.random.default_rng(9)
    point = rng.normal(size=16)
    rows = [(k, (point + 0.05 * rng.normal(size=16)).tolist(), "x", 1) for k in range(200)]
    rows += [(k, rng.normal(size=16).tolist(), "x", 1) for k in range(200, 600)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    truth, found = brute(rows), got(frame, block=16)
    assert sum(r[1] for r in found) >= 0.99 * sum(r[1] for r in truth) > 30_000


def test_traversal_visits_nearest_first():
    rng = np.random.default_rng(10)
    rows = rng.normal(size=(500, 8))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    index = build(rows, 8, 0.95, 0.999)
    (one, two), _ = index.bounds(rows)
    own, visited = index.visited(rows)
    for k in range(50):
        total = (one[k][:, None] + two[k][None, :]).ravel()
        expected = set(np.flatnonzero(total <= index.reach).tolist()) - {int(own[k])}
        assert set(visited[k].tolist()) == expected
        assert (np.diff(total[visited[k]]) >= -1e-12).all()
