"""Sliced running values against brute force, for slices of many widths."""

import random

import pytest

from clustertrace.operators import carry_forward, gap_loss, over_limit_fraction, running, running_level
from tests.helpers import over_limit_sequentially

WIDTHS = [(), (7,), (10, 100)]


def points(seed, n=150, keys=3, span=400):
    rng = random.Random(seed)
    spots = {(rng.randrange(keys) if rng.random() < 0.6 else 0, rng.randrange(-span, span))
             for _ in range(n)}
    return [
        (key, time, rng.randint(-5, 5) if rng.random() < 0.7 else None) for key, time in sorted(spots)
    ]


def expected(rows):
    result = {}
    for key, time, _ in rows:
        before = [v for k, t, v in rows if k == key and t < time]
        after = [(t, v) for k, t, v in rows if k == key and t > time]
        known = [v for v in before if v is not None]
        later = [v for _, v in after if v is not None]
        result[key, time] = (
            sum(known),
            known[-1] if known else None,
            later[0] if later else None,
            after[0][0] if after else None,
        )
    return result


@pytest.mark.parametrize("widths", WIDTHS, ids=str)
@pytest.mark.parametrize("seed", [1, 2])
def test_running_values(spark, widths, seed):
    rows = points(seed)
    df = spark.createDataFrame(rows, "k long, t long, v long").repartition(5)
    result = running(
        df, ["k"], "t", {"total": "v"}, {"last": "v"}, {"next": "v", "until": "t"}, widths
    )
    assert result.columns == ["k", "t", "v", "total", "last", "next", "until"]
    got = {(r.k, r.t): (r.total, r["last"], r["next"], r.until) for r in result.collect()}
    assert got == expected(rows)


@pytest.mark.parametrize("widths", [(1,), (10**9,), (4, 16, 64)], ids=str)
def test_extreme_slices(spark, widths):
    """One point per slice, all points in one slice, and three levels."""
    rows = points(5, n=60)
    df = spark.createDataFrame(rows, "k long, t long, v long")
    result = running(
        df, ["k"], "t", {"total": "v"}, {"last": "v"}, {"next": "v", "until": "t"}, widths
    )
    got = [((r.k, r.t), (r.total, r["last"], r["next"], r.until)) for r in result.collect()]
    assert len(got) == len(rows)
    assert dict(got) == expected(rows)


@pytest.mark.parametrize("widths", WIDTHS, ids=str)
def test_one_kind_of_value_at_a_time(spark, widths):
    rows = points(3)
    df = spark.createDataFrame(rows, "k long, t long, v long")
    want = expected(rows)
    total = running(df, ["k"], "t", sums={"x": "v"}, widths=widths).collect()
    later = running(df, ["k"], "t", following={"x": "v"}, widths=widths).collect()
    assert {(r.k, r.t): r.x for r in total} == {spot: v[0] for spot, v in want.items()}
    assert {(r.k, r.t): r.x for r in later} == {spot: v[2] for spot, v in want.items()}


@pytest.mark.parametrize("widths", WIDTHS, ids=str)
def test_running_level_applies_a_whole_instant(spark, widths):
    rows = [(1, 5, 0.1), (1, 5, 0.2), (1, 9, -0.3), (1, 9, 0.05), (2, 7, 1.0), (1, None, 9.0),
            (1, 6, None)]
    df = spark.createDataFrame(rows, "k long, t long, d double")
    got = {(r.k, r.t): r.level for r in running_level(df, "k", "t", "d", widths=widths).collect()}
    assert got == {(1, 5): 0.3, (1, 9): 0.05, (2, 7): 1.0}


@pytest.mark.parametrize("widths", WIDTHS, ids=str)
def test_carry_forward(spark, widths):
    rows = [(1, 1, 0, None), (1, 3, 0, 0.5), (1, 4, 0, None), (1, 8, 2, 0.25), (1, 8, 1, 1.0),
            (1, 9, 0, None), (2, 4, 0, None)]
    df = spark.createDataFrame(rows, "k long, t long, e int, c double")
    got = {(r.k, r.t): r.c for r in carry_forward(df, "k", "t", "c", "e", widths).collect()}
    assert got == {(1, 1): 0.5, (1, 3): 0.5, (1, 4): 0.5, (1, 8): 0.25, (1, 9): 0.25, (2, 4): None}
    untied = {(r.k, r.t): r.c for r in carry_forward(df, "k", "t", "c", widths=widths).collect()}
    assert untied[1, 8] == 1.0


E2_CAPACITY = [(5, 0.5), (20, 1.0)]
E2_CHANGES = [(0, 0.3), (10, 0.3), (15, -0.3), (20, 0.6), (30, -0.6)]


def fraction(spark, capacity, changes, widths):
    levels = spark.createDataFrame([(1, t, d) for t, d in changes], "k long, time long, delta double")
    limits = spark.createDataFrame(
        [(1, t, c) for t, c in capacity], "k long, time long, limit double"
    )
    return [r.fraction for r in over_limit_fraction(levels, limits, "k", widths=widths).collect()]


@pytest.mark.parametrize("widths", WIDTHS, ids=str)
def test_step_overlap(spark, widths):
    assert fraction(spark, E2_CAPACITY, E2_CHANGES, widths) == [5 / 30]
    equal = [(t, 0.2 if t == 10 else d) for t, d in E2_CHANGES]
    assert fraction(spark, E2_CAPACITY, equal, widths) == [0.0]
    assert fraction(spark, [(4, 0.1)], [(4, 0.5)], widths) == [0.0]
    assert fraction(spark, [], E2_CHANGES, widths) == []
    assert fraction(spark, E2_CAPACITY, [], widths) == []


def test_sums_of_requests_that_meet_the_limit_exactly_are_not_over(spark):
    # As doubles 0.1 + 0.2 is above 0.3.
    assert 0.1 + 0.2 > 0.3
    changes = [(0, 0.1), (1, 0.2), (9, -0.3)]
    assert fraction(spark, [(0, 0.3)], changes, (3,)) == [0.0]


@pytest.mark.parametrize("widths", [(), (50,), (10, 100)], ids=str)
def test_step_overlap_on_random_series(spark, widths):
    rng = random.Random(11)
    changes, capacities = {}, {}
    for key in range(6):
        changes[key] = [(rng.randrange(600), rng.choice([-0.25, 0.25, 0.4])) for _ in range(60)]
        capacities[key] = sorted(
            (rng.randrange(600), rng.randrange(3), rng.choice([0.25, 0.5, 1.0])) for _ in range(9)
        )
    levels = spark.createDataFrame(
        [(k, t, d) for k in changes for t, d in changes[k]], "k long, time long, delta double"
    )
    limits = spark.createDataFrame(
        [(k, t, e, c) for k in capacities for t, e, c in capacities[k]],
        "k long, time long, event int, limit double",
    )
    result = over_limit_fraction(levels, limits, "k", tie="event", widths=widths).collect()
    want = {k: over_limit_sequentially(capacities[k], changes[k]) for k in changes}
    assert {r.k: r.fraction for r in result} == pytest.approx(want, abs=0)


@pytest.mark.parametrize("widths", [(0,), (-5,), (10, 10), (20, 10)], ids=str)
def test_slice_widths_must_increase(spark, widths):
    df = spark.createDataFrame([(1, 1, 1.0)], "k long, t long, v double")
    with pytest.raises(ValueError, match="increase"):
        running_level(df, "k", "t", "v", widths=widths)
    with pytest.raises(ValueError, match="increase"):
        gap_loss(df, "k", "t", "t", "v", widths=widths)


def test_further_columns_of_any_type_are_kept_and_read_once(spark, tmp_path):
    path = str(tmp_path / "points")
    rows = [(k % 3, k, k % 5, f"s{k}", {"a": k}) for k in range(60)]
    spark.createDataFrame(rows, "k long, t long, v long, s string, m map<string,int>").write.parquet(path)
    df = running(spark.read.parquet(path), ["k"], "t", {"total": "v"}, widths=(7, 21))
    got = {(r.k, r.t): (r.s, r.m, r.total) for r in df.collect()}
    assert got == {
        (k, t): (s, m, sum(v2 for k2, t2, v2, *_ in rows if k2 == k and t2 < t)) for k, t, v, s, m in rows
    }
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
    assert "SortAggregate" not in plan


@pytest.mark.parametrize("kind", ["long", "string"])
def test_columns_called_like_working_columns_are_kept(spark, kind):
    rows = [(k % 2, k, k % 5, k if kind == "long" else f"s{k}", k) for k in range(40)]
    points = spark.createDataFrame(rows, f"k long, t long, v long, _count_of_x {kind}, __count_of_v long")
    got = running(points, ["k"], "t", {"total": "v"}, widths=(5, 15)).collect()
    assert sorted(tuple(r) for r in got) == sorted(
        (*row, sum(v for k, t, v, *_ in rows if k == row[0] and t < row[1])) for row in rows
    )


def levels(spark, changes, partitions, **options):
    rows = spark.createDataFrame(changes, "k long, t long, d double").repartition(partitions)
    return {r.t: r.level for r in running_level(rows, "k", "t", "d", widths=(5,), **options).collect()}


@pytest.mark.parametrize("base", [1e6, 9e8, -9e8])
def test_levels_of_any_size_are_exact(spark, base):
    changes = [(1, 0, base), (1, 3, 1e-10), (1, 4, 1e-10), (1, 8, -base), (1, 9, 0.1), (1, 9, 0.2), (1, 12, -0.3)]
    whole = [round(d * 10**10) if abs(d) < 1 else int(d) * 10**10 for _, _, d in changes]
    expected = {t: sum(w for w, (_, u, _) in zip(whole, changes) if u <= t) for _, t, _ in changes}
    for seed in (1, 2, 3):
        shuffled = random.Random(seed).sample(changes, len(changes))
        got = levels(spark, shuffled, seed)
        # The result is a DOUBLE; what is left of the large level shows that nothing was lost on the way.
        assert {t: got[t] for t in (8, 9, 12)} == {t: expected[t] / 1e10 for t in (8, 9, 12)}
        assert got[4] == pytest.approx(expected[4] / 1e10, rel=1e-15)
        assert (got[4] != got[0]) == (float(base + 2e-10) != base)


def test_over_limit_at_a_large_level(spark):
    """A level just above, at and just below a limit of a million."""
    changes = spark.createDataFrame([(1, 0, 1e6), (1, 10, 1e-10), (1, 20, -1e-10), (1, 30, -1e-10)], "k long, time long, delta double")
    limits = spark.createDataFrame([(1, 0, 1e6), (1, 40, 1e6)], "k long, time long, limit double")
    for n in (1, 3):
        [row] = over_limit_fraction(changes.repartition(n), limits, "k", widths=(7,)).collect()
        assert row["fraction"] == 10 / 40


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    ("changes", "what"),
    [
        ([(1, 0, 4e-11)], "too small"),
        ([(1, 0, float("nan"))], "out of range"),
        ([(1, 0, 1e10)], "out of range"),
        ([(1, 0, 6e8), (1, 0, 6e8)], "out of range|overflow"),
        ([(1, 0, 6e8), (1, 1, 6e8)], "out of range|overflow"),
        ([(1, 0, 6e8), (1, 50, 6e8), (1, 99, -1.1e9)], "out of range|overflow"),
    ],
)
def test_what_units_cannot_hold_raises(spark, ansi, changes, what):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match=what):
            levels(spark, changes, 2)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_scale_is_a_parameter(spark):
    tiny = [(1, t, 4e-11) for t in range(3)]
    assert levels(spark, tiny, 2, scale=12) == {0: 4e-11, 1: 8e-11, 2: pytest.approx(1.2e-10)}
    assert levels(spark, [(1, 0, 5e13)], 1, scale=2) == {0: 5e13}
