"""What the plans must look like to hold at scale, and results under heavy skew."""

import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from clustertrace import plans
from clustertrace.operators import HOUR
from tests.helpers import pairs

PYTHON_NODES = ["Python", "Pandas", "BatchEval", "Scan ExistingRDD"]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry_module.PLANS))
def test_plan_has_no_python_and_no_unkeyed_gathering(spark, sf_dir, name):
    plan = executed(entry_module.queries()[name](spark, sf_dir))
    for node in [*PYTHON_NODES, "CartesianProduct", "BroadcastNestedLoopJoin", "collect_list"]:
        assert node not in plan
    # A single-partition exchange may only take the partial rows of a global aggregate.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert re.search(r"HashAggregate\(keys=\[\], functions=\[partial_", lines[i + 1])


@pytest.mark.parametrize(
    "name", ["overcommit_by_machine", "running_level", "carry_forward", "gap_loss", "gap_loss_by_class"]
)
def test_windows_over_rows_are_cut_into_slices(spark, sf_dir, name):
    plan = executed(entry_module.queries()[name](spark, sf_dir))
    lines = plan.splitlines()
    windows = [i for i, line in enumerate(lines) if re.search(r"[-:+] Window \[", line)]
    keys = {i: re.findall(r"\], \[([^\]]*)\], \[", lines[i])[-1] for i in windows}
    assert sorted("_slice_" in key for key in keys.values()) == [False, True]
    # The window by machine alone reads one aggregated row per slice.
    over_slices = next(i for i, key in keys.items() if "_slice_" not in key)
    below = next(line for line in lines[over_slices:] if "Aggregate(" in line)
    assert re.search(r"keys=\[machine_id#\d+L, _slice_\d+#\d+L\]", below)


# What each analytic asks of the stored trace tables: pushed filters and columns per table.
SCANS = {
    "capacity_distribution": {"machine": (["IsNotNull(cpus)"], "time machine_id event_type cpus")},
    "maintenance_loss_pct": {"machine": (["IsNotNull(cpus)"], "time machine_id event_type cpus")},
    "loss_share_by_capacity": {"machine": (["IsNotNull(cpus)"], "time machine_id event_type cpus")},
    "class_share_jobs_tasks": {
        "job": (["IsNotNull(scheduling_class)"], "job_id scheduling_class"),
        "task": (["IsNotNull(scheduling_class)"], "job_id task_index scheduling_class"),
    },
    "evicted_or_killed": {"job": ([], "job_id event_type"), "task": ([], "job_id task_index event_type")},
    "eviction_rate_by_class": {
        "task": (["IsNotNull(scheduling_class)"], "job_id task_index event_type scheduling_class")
    },
    "machines_per_job": {
        "task": (["EqualTo(event_type,1)", "IsNotNull(machine_id)"], "job_id machine_id event_type")
    },
    "request_vs_usage": {
        "task": (["IsNotNull(cpu_request)"], "job_id task_index cpu_request"),
        "usage": (["IsNotNull(cpu_rate)"], "job_id task_index cpu_rate"),
    },
    "usage_vs_evictions": {
        "task": (["EqualTo(event_type,2)", "IsNotNull(machine_id)"], "machine_id event_type"),
        "usage": (["IsNotNull(cpu_rate)"], "machine_id cpu_rate"),
    },
    "overcommit_fraction": {
        "machine": (["IsNotNull(cpus)"], "time machine_id event_type cpus"),
        "task": (["IsNotNull(machine_id)"], "time machine_id event_type cpu_request"),
    },
    "overestimation_by_class": {
        "task": (["IsNotNull(cpu_request)"], "job_id task_index scheduling_class cpu_request"),
        "usage": (["IsNotNull(cpu_rate)"], "job_id task_index cpu_rate"),
    },
    "overestimation_by_eviction": {
        "task": (["IsNotNull(cpu_request)"], "job_id task_index event_type cpu_request"),
        "usage": (["IsNotNull(cpu_rate)"], "job_id task_index cpu_rate"),
    },
    "eviction_rate_by_priority": {"task": ([], "job_id task_index event_type priority")},
}


@pytest.fixture(scope="module")
def trace(spark, sf_dir, tmp_path_factory):
    """The four trace tables, stored."""
    folder, tables = tmp_path_factory.mktemp("trace"), {}
    for name, view in entry_module._TABLES.items():
        view(spark, sf_dir).write.parquet(f"{folder}/{name}.parquet")
        tables[name] = spark.read.parquet(f"{folder}/{name}.parquet")
    return tables


@pytest.mark.parametrize("name", sorted(SCANS))
def test_filters_and_columns_reach_the_scan(trace, name):
    tables, plan = entry_module.PLANS[name]
    explained = executed(plan(*(trace[t] for t in tables.split())))
    scans = [line for line in explained.splitlines() if "FileScan parquet" in line]
    for table, (filters, columns) in SCANS[name].items():
        own = [line for line in scans if f"/{table}.parquet" in line]
        assert own
        read = set()
        for line in own:
            assert all(f in line for f in filters)
            read |= set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>", line)[1]))
        assert read == set(columns.split())


#: Scans of the final plans, where it isn't one per table.
MORE_SCANS = {
    "maintenance_loss_pct": 2, "uptime_capacity": 2, "overestimation_by_eviction": 2,
    "label": 2,
}


@pytest.mark.parametrize("name", sorted(entry_module.PLANS))
def test_scans_and_sorts_of_the_final_plan(spark, sf_dir, name):
    tables, _ = entry_module.PLANS[name]
    result = entry_module.queries()[name](spark, sf_dir)
    result.collect()
    final = executed(result).split("== Initial Plan ==")[0]
    n_scans = len(re.findall(r"FileScan parquet", final))
    assert n_scans <= MORE_SCANS.get(name, len(tables.split()))
    # Only machine events, which are few, may be sorted for an aggregate.
    if "SortAggregate" in final:
        assert "machine" in tables


def final_lines(plan):
    """The lines of all final plans, those of subqueries among them."""
    out, skipped = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skipped is not None and depth >= skipped:
            continue
        skipped = depth if "== Initial Plan ==" in line else None
        out.append(line)
    return out


def test_losses_and_classes_come_from_one_pass(spark, sf_dir):
    for name in ("gap_loss_by_class", "loss_share_by_capacity"):
        result = entry_module.queries()[name](spark, sf_dir)
        result.collect()
        final = "\n".join(final_lines(executed(result)))
        assert final.count("FileScan parquet") == 1 and "Join" not in final and "SortAggregate" not in final


def test_source_is_read_once_for_the_sliced_windows(spark, sf_dir):
    """The rows that feed the slices and the slice summaries are shuffled once."""
    from clustertrace.sources import mapped

    df = plans.overcommit_by_machine(
        mapped.machine_events(spark, sf_dir), mapped.task_events(spark, sf_dir)
    )
    df.collect()
    final = executed(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet", final)) == 2
    assert "ReusedExchange" in final


def test_task_parts_are_written_unsorted_and_compressed(spark, monkeypatch):
    """A sort by folder would spill, and plain lines are four times as long."""
    key, seen, text = entry_module._OPEN_FILES, [], DataFrameWriter.text

    def spied(writer, path, *args, **kwargs):
        seen.append((path, int(spark.conf.get(key))))
        return text(writer, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "text", spied)
    before, n, job = spark.conf.get(key), 20_000, F.col("id") % 1000
    some = {"time": "id", "job_id": "job", "task_index": "id % 7", "machine_id": "id % 90", "event_type": "id % 5"}
    some |= {"scheduling_class": "id % 4", "priority": "id % 12", "cpu_request": "id / 400.5"}
    tasks = spark.range(0, n, 1, 3).withColumn("job", job).selectExpr(*(f"{v} AS {k}" for k, v in some.items()))
    rows = entry_module._task_parts(tasks).collect()
    assert spark.conf.get(key) == before
    [(path, open_files)] = seen
    assert open_files >= 5
    files = spark.read.text(path).inputFiles()
    assert len(files) == 15 and all(f.endswith(".snappy") for f in files)
    assert {w: sum(r["n"] for r in rows if r["way"] == w) for w in ("glob", "list")} == {"glob": n * 3 // 5, "list": n * 2 // 5}
    assert sum(r["sum_time"] for r in rows) == n * (n - 1) // 2


def test_folders_beyond_the_open_files_are_written_whole(spark):
    lines = spark.range(0, 6000, 1, 2).selectExpr("CAST(id AS STRING) AS line", "id % (2 * 16 + 3) AS part")
    back = spark.read.text(entry_module._written(lines, "parts", "part")).selectExpr("CAST(value AS BIGINT) AS id", "part")
    assert back.count() == 6000 and back.filter("id % 35 = part").distinct().count() == 6000


def test_one_machine_with_most_of_the_events(spark):
    """A hot machine and a hot instant, against the same plan without any slices."""
    hot = F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 40)
    start = F.when(F.col("id") % 5 == 0, 7 * HOUR).otherwise(F.col("id") * 104_729 % (30 * HOUR))
    ids = spark.range(0, 30_000, 1, 8).select("id", hot.alias("machine_id"), start.alias("start"))
    steps = ids.withColumn("event_type", F.explode(F.array(F.lit(1), F.lit(4))))
    tasks = steps.select(
        "machine_id",
        (F.col("start") + F.when(F.col("event_type") == 4, HOUR // 7).otherwise(0)).alias("time"),
        "event_type",
        (F.lit(0.001) + F.col("id") % 7 / 10_000.0).alias("cpu_request"),
    )
    machines = spark.range(40).select(
        (F.col("id") * (HOUR // 3)).alias("time"),
        F.col("id").alias("machine_id"),
        F.lit(0).alias("event_type"),
        F.when(F.col("id") == 0, 0.6).otherwise(0.01).alias("cpus"),
    )
    whole = pairs(plans.overcommit_by_machine(machines, tasks, widths=()))
    sliced = pairs(plans.overcommit_by_machine(machines, tasks))
    assert sliced == whole
    assert len(whole) > 10 and 0 < whole[0] < 1
