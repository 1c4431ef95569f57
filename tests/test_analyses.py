"""The analytics on hand-made rows, with results worked out by hand."""

import random

import pytest
from pyspark.sql import functions as F

from clustertrace import plans
from clustertrace.operators import (
    event_rate,
    fanout_histogram,
    gap_loss,
    gap_loss_by_class,
    latest_by_key,
    max_with,
    share_by,
    trace_end,
    uptime_capacity,
)
from tests.helpers import (
    ADD,
    REMOVE,
    UPDATE,
    by_machine,
    class_sequentially,
    lost_by_definition,
    machine_rows,
    pairs,
    task_rows,
    usage_rows,
)

SUBMIT, SCHEDULE, EVICT, FAIL, FINISH, KILL = range(6)

GAPS = [
    (0, 1, ADD, 0.5),
    (10, 1, REMOVE, 0.5),
    (12, 1, UPDATE, 0.5),
    (15, 1, REMOVE, 0.25),
    (20, 1, ADD, 1.0),
    (30, 1, REMOVE, 1.0),
    (40, 2, UPDATE, 0.5),
    (50, 2, REMOVE, None),
]


def task(job, index, event, cls=None, priority=0, request=None, machine=None, time=0):
    return (time, job, index, machine, event, cls, priority, request)


@pytest.mark.parametrize("widths", [(), (6,), (1000,)], ids=str)
def test_maintenance_loss(spark, widths):
    rows = machine_rows(spark, GAPS)
    assert pairs(gap_loss(rows, "machine_id", widths=widths)) == {1: 1.25}
    assert plans.maintenance_loss_pct(rows, widths).first().pct_lost == 6.25
    assert pairs(plans.loss_share_by_capacity(rows, widths)) == {0.5: 0.0, 1.0: 100.0}


def test_uptime_ends_with_the_last_row_that_has_a_capacity(spark):
    rows = machine_rows(spark, GAPS).where("cpus IS NOT NULL")
    assert pairs(uptime_capacity(rows, "machine_id", trace_end(rows))) == {1: 20.0, 2: 0.0}


def test_no_uptime_gives_null_not_an_error(spark):
    rows = machine_rows(spark, [(1, 1, UPDATE, 0.5)])
    assert plans.maintenance_loss_pct(rows).first().pct_lost is None
    assert pairs(plans.loss_share_by_capacity(rows)) == {0.5: None}


@pytest.mark.parametrize("widths", [(), (9,), (10, 50)], ids=str)
def test_gaps_equal_a_sequential_walk(spark, widths):
    rng = random.Random(5)
    rows = [
        (rng.randrange(80), rng.randrange(5), rng.randrange(3), rng.choice([0.25, 0.5, 1.0, None]))
        for _ in range(300)
    ]
    rows += [(5, 99, REMOVE, 0.5), (5, 99, ADD, 1.0), (7, 99, ADD, 0.25)]
    machines = by_machine(rows)
    table = machine_rows(spark, rows).repartition(7)
    lost = {m: lost_by_definition(events) for m, events in machines.items()}
    assert pairs(gap_loss(table, "machine_id", widths=widths)) == lost
    both = {r.machine_id: (r.cpus, r.lost) for r in gap_loss_by_class(table, "machine_id", widths=widths).collect()}
    assert both == {m: (class_sequentially(e), lost[m]) for m, e in machines.items()}
    total, classes = sum(lost.values()), {}
    for machine, events in machines.items():
        cls = class_sequentially(events)
        classes[cls] = classes.get(cls, 0.0) + lost[machine] / total * 100
    assert pairs(plans.loss_share_by_capacity(table, widths)) == pytest.approx(classes)


def test_gap_codes_can_be_swapped(spark):
    """With the down code first, a down and an up at one instant leave no gap open."""
    rows = spark.createDataFrame(
        [(0, 1, 3, 0.5), (4, 1, 3, 1.0), (4, 1, 9, 1.0), (9, 1, 9, 1.0), (10, 1, 3, 0.25),
         (14, 1, 9, 0.5)],
        "time long, k long, event_type int, cpus double",
    )
    assert pairs(gap_loss(rows, "k", down=3, up=9)) == {1: 1.0}
    both = gap_loss_by_class(rows, "k", down=3, up=9).select("k", F.struct("cpus", "lost"))
    assert {k: tuple(v) for k, v in pairs(both).items()} == {1: (0.25, 1.0)}


def test_other_events_neither_end_nor_open_a_gap(spark):
    rows = machine_rows(spark, [
        (0, 1, UPDATE, 0.25), (2, 1, REMOVE, 0.5), (9, 1, UPDATE, 1.0), (30, 1, UPDATE, 0.1), (31, 1, ADD, 1.0),
        (1, 2, UPDATE, 0.75), (1, 2, UPDATE, 0.5), (8, 2, ADD, 1.0), (3, 3, REMOVE, 1.0), (3, 3, REMOVE, 0.5), (4, None, ADD, 1.0),
    ])
    for widths in ((), (4,), (4, 12)):
        got = {r.machine_id: (r.cpus, r.lost) for r in gap_loss_by_class(rows, "machine_id", widths=widths).collect()}
        assert got == {1: (0.5, 14.5), 2: (0.5, 0.0), 3: (1.0, 0.0)}
    assert gap_loss_by_class(rows.where("time < 0"), "machine_id").collect() == []


def test_hot_instants_are_combined_before_the_shuffle(spark):
    """Many rows of one machine and instant reach the second stage as one row per event and map task."""
    hot = spark.range(0, 20_000, 1, 4).selectExpr("5L AS time", "1L AS machine_id", "CAST(id % 2 AS INT) AS event_type", "(id % 7) / 8.0D AS cpus")
    rest = machine_rows(spark, [(1, 1, REMOVE, 0.5), (9, 1, ADD, 0.5)])
    result = gap_loss_by_class(hot.unionByName(rest.select(hot.columns)), "machine_id")
    assert [tuple(r) for r in result.collect()] == [(1, 0.75, 0.5 * 4 + 0.75 * 4)]
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "SortAggregate" not in plan


def test_capacity_distribution(spark):
    rows = [(1, 1, ADD, 0.5), (5, 1, REMOVE, 1.0), (3, 2, ADD, 0.25), (3, 2, UPDATE, 0.5),
            (9, 3, REMOVE, 0.5), (9, 2, UPDATE, None)]
    assert pairs(plans.capacity_distribution(machine_rows(spark, rows))) == {0.5: 2}


EVICTIONS = [
    task(1, 1, SCHEDULE, 0),
    task(1, 1, EVICT, 1),
    task(2, 1, EVICT, 0),
    task(2, 1, EVICT, 0),
    task(3, 1, FINISH, 2),
    task(4, 1, EVICT, None),
]


def test_eviction_rate_by_class(spark):
    rows = task_rows(spark, EVICTIONS)
    assert pairs(plans.eviction_rate_by_class(rows)) == {0: 50.0, 1: 100.0}
    assert pairs(plans.eviction_rate_by_class(rows, keep_zero=True)) == {0: 50.0, 1: 100.0, 2: 0.0}


def test_eviction_rate_by_priority(spark):
    rows = task_rows(
        spark, [(t, j, i, m, e, None, c, r) for t, j, i, m, e, c, _, r in EVICTIONS if c is not None]
    )
    assert pairs(plans.eviction_rate_by_priority(rows)) == {0: 50.0, 1: 100.0}
    counts = {r.priority: (r.n_entities, r.n_hit) for r in
              event_rate(rows, ["job_id", "task_index"], "priority", [EVICT], True).collect()}
    assert counts == {0: (2, 1), 1: (1, 1), 2: (1, 0)}


def test_class_shares_count_every_class_of_an_entity(spark):
    jobs = spark.createDataFrame(
        [(1, 0, 0), (1, 1, 0), (1, 1, 1), (2, 0, 0), (3, 0, None), (4, 0, 3)],
        "job_id long, event_type int, scheduling_class int",
    )
    tasks = task_rows(spark, [task(1, 1, SUBMIT, 0), task(1, 1, EVICT, 0), task(1, 2, SUBMIT, 2),
                              task(1, 2, EVICT, 0), task(9, 1, SUBMIT, None)])
    shares = {r.scheduling_class: (r.job_pct, r.task_pct)
              for r in plans.class_share_jobs_tasks(jobs, tasks).collect()}
    assert shares[0] == (50.0, pytest.approx(200 / 3))
    assert shares[1] == (25.0, None)
    assert shares[2] == (None, pytest.approx(100 / 3))
    assert shares[3] == (25.0, None)


def test_evicted_or_killed(spark):
    jobs = spark.createDataFrame(
        [(1, SUBMIT), (1, KILL), (1, EVICT), (2, FINISH), (3, FAIL), (4, EVICT)],
        "job_id long, event_type int",
    )
    tasks = task_rows(spark, [task(1, 1, KILL), task(1, 2, FINISH), task(1, 2, FINISH)])
    rows = {r.entity: (r.n_total, r.n_hit, r.pct)
            for r in plans.evicted_or_killed(jobs, tasks).collect()}
    assert rows == {"jobs": (4, 2, 50.0), "tasks": (2, 1, 50.0)}


def test_machines_per_job(spark):
    rows = task_rows(spark, [
        task(1, 1, SCHEDULE, machine=7), task(1, 2, SCHEDULE, machine=7),
        task(1, 3, SCHEDULE, machine=8), task(2, 1, SCHEDULE, machine=7),
        task(2, 1, EVICT, machine=9), task(3, 1, SCHEDULE), task(4, 1, SCHEDULE, machine=1),
    ])
    assert pairs(plans.machines_per_job(rows)) == {1: 2, 2: 1}


TASKS = [task(1, 1, SCHEDULE, 0, request=0.2), task(1, 1, EVICT, 2, request=0.4),
         task(2, 1, SCHEDULE, 1, request=0.5), task(3, 1, SCHEDULE, 1, request=0.5),
         task(4, 1, SCHEDULE, 1, request=0.5), task(3, 1, EVICT, 1, request=None)]
USAGE = [(1, 1, 5, 0.1), (1, 1, 5, 0.3), (2, 1, 5, 0.0), (3, 1, 6, 0.005), (3, 1, 6, None)]


def test_request_vs_usage(spark):
    rows = plans.request_vs_usage(task_rows(spark, TASKS), usage_rows(spark, USAGE)).collect()
    assert {(r.job_id, r.requested, r.used) for r in rows} == {
        (1, 0.4, 0.2), (2, 0.5, 0.0), (3, 0.5, 0.005)}


def test_overestimation(spark):
    tasks, usage = task_rows(spark, TASKS), usage_rows(spark, USAGE)
    assert pairs(plans.overestimation_by_class(tasks, usage)) == {2: 2.0}
    assert pairs(plans.overestimation_by_eviction(tasks, usage)) == {1: 2.0}
    # The eviction of task 3 has no request, so the task counts as never evicted.
    assert pairs(plans.overestimation_by_eviction(tasks, usage, 1000.0)) == {0: 100.0, 1: 2.0}


def test_ratio_limit_is_strict(spark):
    tasks = task_rows(spark, [task(1, 1, SCHEDULE, 0, request=0.5)])
    usage = usage_rows(spark, [(1, 1, 5, 0.25)])
    assert pairs(plans.overestimation_by_class(tasks, usage, 2.0)) == {}
    assert pairs(plans.overestimation_by_class(tasks, usage, 2.5)) == {0: 2.0}


def test_usage_vs_evictions_counts_events(spark):
    tasks = task_rows(spark, [task(1, 1, EVICT, machine=5), task(1, 1, EVICT, machine=5),
                              task(1, 2, KILL, machine=6), task(1, 3, EVICT, machine=8),
                              task(1, 4, EVICT)])
    rows = plans.usage_vs_evictions(tasks, usage_rows(spark, USAGE)).collect()
    assert [(r.machine_id, r.evictions) for r in rows] == [(5, 2)]
    assert rows[0].mean_cpu == pytest.approx(0.4 / 3)


@pytest.mark.parametrize("widths", [(), (4,)], ids=str)
def test_overcommit(spark, widths):
    machines = machine_rows(spark, [(5, 1, ADD, 0.5), (20, 1, UPDATE, 1.0), (1, 2, ADD, 1.0),
                                    (5, 1, ADD, 0.25), (0, 1, ADD, None), (5, 4, ADD, 0.1)])
    tasks = task_rows(spark, [
        task(1, 1, SCHEDULE, request=0.3, machine=1, time=0),
        task(1, 2, SCHEDULE, request=0.3, machine=1, time=10),
        task(1, 2, FAIL, request=0.3, machine=1, time=15),
        task(1, 2, 7, request=9.0, machine=1, time=16),
        task(1, 2, SUBMIT, request=9.0, machine=1, time=17),
        task(1, 3, SCHEDULE, request=0.6, machine=1, time=20),
        task(1, 3, 6, request=0.6, machine=1, time=30),
        task(1, 4, SCHEDULE, request=0.6, machine=3, time=30),
        task(1, 5, SCHEDULE, request=0.6, time=30),
        task(1, 6, FINISH, request=0.6, machine=4, time=9),
    ])
    per_machine = pairs(plans.overcommit_by_machine(machines, tasks, widths))
    # Before time 5 the first capacity in the fixed order holds: 0.25, then 0.5.
    assert per_machine == {1: pytest.approx(10 / 30), 4: 0.0}
    average = plans.overcommit_fraction(machines, tasks, widths).first().avg_fraction
    assert average == pytest.approx(10 / 60)


def test_ties_do_not_depend_on_the_order_of_the_rows(spark):
    rows = [(1, 1, e, c) for e in (ADD, UPDATE) for c in (0.25, 0.5)] * 3
    requests = [task(1, 1, SCHEDULE, c, request=0.5) for c in (0, 3, 1)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        random.Random(seed).shuffle(requests)
        table = machine_rows(spark, rows).repartition(seed + 1)
        latest = latest_by_key(table, "machine_id", ["time", "event_type"], "cpus").first()
        assert (latest.event_type, latest.cpus) == (UPDATE, 0.5)
        best = max_with(task_rows(spark, requests).repartition(seed + 1), "job_id", "cpu_request",
                        "scheduling_class").first()
        assert best.scheduling_class == 3


def test_share_by_weight_and_empty_input(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0)], "k string, w double")
    assert {r.k: r.pct for r in share_by(df, "k", "w").collect()} == {"a": 75.0, "b": 25.0}
    assert share_by(df.where("k = 'z'"), "k").collect() == []


def test_fanout_ignores_missing_keys_and_members(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, None), (None, 1)], "k int, m int")
    assert pairs(fanout_histogram(df, "k", "m")) == {2: 1}


def test_results_do_not_depend_on_partitioning(spark, sf_dir):
    from clustertrace.sources import mapped

    machine, tasks = mapped.machine_events(spark, sf_dir), mapped.task_events(spark, sf_dir)
    usage = mapped.task_usage(spark, sf_dir)

    def mixed(df):
        return df.repartition(9, F.rand(3))

    plain = plans.overcommit_by_machine(machine, tasks)
    shuffled = plans.overcommit_by_machine(mixed(machine), mixed(tasks))
    assert pairs(plain) == pairs(shuffled)
    assert pairs(plans.overestimation_by_class(tasks, usage)) == pytest.approx(
        pairs(plans.overestimation_by_class(mixed(tasks), mixed(usage)))
    )
    assert pairs(plans.capacity_distribution(machine)) == pairs(
        plans.capacity_distribution(mixed(machine))
    )


def test_percentages_of_nothing_have_no_text(spark):
    from clustertrace.functions import percent_text

    jobs = spark.createDataFrame([], "job_id long, event_type int, scheduling_class int")
    rows = plans.evicted_or_killed(jobs, task_rows(spark, [])).select(percent_text(F.col("pct")).alias("text"))
    assert [r["text"] for r in rows.collect()] == [None, None]
    assert spark.range(1).select(percent_text(F.lit(41.349))).first()[0] == "41.35%"


def test_max_with_settles_ties_by_the_payload(spark):
    rows = [(1, 0.5, 2, "b"), (1, 0.5, 3, "a"), (1, 0.4, 9, "z"), (2, None, 7, "x"), (3, 0.1, None, "y"), (3, 0.1, None, None)]
    df = spark.createDataFrame(rows, "k long, request double, class int, name string")
    for n in (1, 4):
        one = max_with(df.repartition(n), "k", "request", "class").collect()
        assert sorted(map(tuple, one)) == [(1, 0.5, 3), (3, 0.1, None)]
        two = max_with(df.repartition(n), "k", "request", ["class", "name"]).collect()
        assert sorted(map(tuple, two)) == [(1, 0.5, 3, "a"), (3, 0.1, None, "y")]
