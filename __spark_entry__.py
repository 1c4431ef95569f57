"""

Every query reads the whole tables under ``sf_dir`` through the trace views of
``clustertrace.sources.mapped``. Doubles are rounded here, not in the library, so
that the order in which an engine adds rows up does not show.
"""

from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clustertrace import operators as op  # noqa: E402
from clustertrace import plans  # noqa: E402
from clustertrace.functions import cpu_delta, label, percent_text, present  # noqa: E402
from clustertrace.operators.sliced import HOUR  # noqa: E402
from clustertrace.sources import (  # noqa: E402
    JOB_EVENTS,
    MACHINE_EVENTS,
    TASK_EVENTS,
    TASK_USAGE,
    count_issues,
    mapped,
    new_path,
    parse_lines,
    read_job_events,
    read_machine_events,
    read_task_events,
    read_task_usage,
    rounded,
    validate_trace,
    with_log_count,
)
from clustertrace.sources.schemas import EVICT, MACHINE_KEY, SCHEDULE, TASK_KEY  # noqa: E402
from oracle_queries import ORACLES  # noqa: E402

# The training-data operators are an optional part.
LLM: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}
try:
    import corpus_pipeline
    from clustertrace.llm.queries import ORACLES as LLM_ORACLES
    from clustertrace.llm.queries import QUERIES

    LLM = {**QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL is not None:
        LLM_ORACLES = {**LLM_ORACLES, "pipeline": corpus_pipeline.ORACLE_SQL}
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "clustertrace.llm", "clustertrace.llm.queries"):
        # A package that only they need isn't installed.
        warnings.warn(f"the training-data queries are left out: {missing}", stacklevel=1)

PLACES = 8
CELL = 0.0007071067811865476
OPEN_FILES, _OPEN_FILES = 16, "spark.sql.maxConcurrentOutputFileWriters"


def _task_changes(task: DataFrame) -> DataFrame:
    delta = cpu_delta(F.col("event_type"), F.col("cpu_request"))
    return present(task, "machine_id").select("machine_id", "time", delta.alias("delta"))


def _over_limit(machine: DataFrame, task: DataFrame) -> DataFrame:
    # The plain operator: without a tie column the biggest limit of an instant counts.
    # Limits of a machine in the same thirty days are set at one instant here.
    month = F.col("time") - F.pmod("time", F.lit(30 * 24 * HOUR))
    limits = machine.withColumn("time", month)
    return op.over_limit_fraction(_task_changes(task), limits, "machine_id", limit="cpus")


def _units(value: Column) -> Column:
    """A value of ten decimal places as a whole number, which no engine rounds."""
    return F.rint(value * F.lit(1e10)).cast("bigint")


def _net_change(task: DataFrame) -> DataFrame:
    return (
        present(_task_changes(task), "delta")
        .groupBy("machine_id")
        .agg(
            F.count("*").alias("n_changes"),
            F.sum(_units(F.col("delta"))).alias("net_e10"),
        )
    )


def _running_level(task: DataFrame) -> DataFrame:
    levels = op.running_level(_task_changes(task), "machine_id", "time", "delta")
    return levels.select("machine_id", "time", _units(F.col("level")).alias("level_e10"))


def _uptime(machine: DataFrame) -> DataFrame:
    rows = present(machine, "cpus")
    return op.uptime_capacity(rows, MACHINE_KEY, op.trace_end(rows))


def _trace_end(machine: DataFrame) -> DataFrame:
    end = op.trace_end(present(machine, "cpus"))
    return machine.sparkSession.range(1).select(end.alias("trace_end"))


def _biggest_request(task: DataFrame) -> DataFrame:
    return op.max_with(present(task, "scheduling_class"), TASK_KEY, "cpu_request", "scheduling_class")


def _mean_use(usage: DataFrame) -> DataFrame:
    return op.mean_by(usage, TASK_KEY, "cpu_rate", "used")


def _ratios(task: DataFrame, usage: DataFrame) -> DataFrame:
    ratios = op.request_ratio(op.max_request(task, TASK_KEY), _mean_use(usage), TASK_KEY)
    return ratios.select(*TASK_KEY, "ratio")


def _task_grid(task: DataFrame, usage: DataFrame) -> DataFrame:
    # No mean rate is a multiple of an irrational width, so none falls on a cell border.
    return op.density_grid(plans.request_vs_usage(task, usage), "requested", "used", 0.01, CELL)


def _line(fields: list) -> Column:
    """Fields as a line of text with blanks around them: columns, their names, or None for no value."""
    columns = [F.lit(None) if c is None else F.col(c) if isinstance(c, str) else c for c in fields]
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.concat(F.lit(" "), F.concat_ws(" , ", *texts))


def _as_lines(rows: DataFrame, fields: list) -> DataFrame:
    return rows.select(_line(fields).alias("line"))


def _sums(rows: DataFrame, by: str, *columns: str) -> DataFrame:
    """Rows, known values and sums of whole numbers per group."""
    return rows.groupBy(by).agg(
        F.count("*").alias("n"),
        *(F.count(c).alias(f"n_{c}") for c in columns),
        *(F.sum(F.col(c).cast("bigint") % 1000003).alias(f"sum_{c}") for c in columns),
    )


def _written(lines: DataFrame, name: str, by: str | None = None, **options: str) -> str:
    """Lines stored as trace files by Spark's own writer: a folder, with one inside per value of ``by``.

    A task keeps a file open per value, up to ``OPEN_FILES``; it sorts its rows by the value, and spills, only beyond that.
    """
    spark = lines.sparkSession
    path, before = new_path(spark, name), spark.conf.get(_OPEN_FILES)
    writer = lines.write.options(**options)
    spark.conf.set(_OPEN_FILES, str(OPEN_FILES))
    try:
        (writer.partitionBy(by) if by else writer).text(path)
    finally:
        spark.conf.set(_OPEN_FILES, before)
    return path


def _machine_text(machine: DataFrame) -> DataFrame:
    return _as_lines(machine, ["time", "machine_id", "event_type", F.lit("p"), "cpus", None])


def _lines(machine: DataFrame) -> DataFrame:
    """Machine events as lines of text, then parsed back."""
    return _machine_sums(parse_lines(_machine_text(machine), "line", MACHINE_EVENTS))


def _machine_files(machine: DataFrame) -> DataFrame:
    """Machine events written as files, then read back."""
    path = _written(_machine_text(machine), "machine_events")
    return _machine_sums(read_machine_events(machine.sparkSession, path))


def _machine_sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.count("cpus").alias("n_cpus"),
        F.sum(F.col("time") % 1000003).alias("time_sum"),
        F.sum("machine_id").alias("machine_sum"),
        F.sum("cpus").alias("cpus_sum"),
    )


def _job_text(job: DataFrame) -> DataFrame:
    return _as_lines(job, ["time", None, "job_id", "event_type", F.lit("u"), "scheduling_class", F.lit('"n'), None])


def _job_lines(job: DataFrame) -> DataFrame:
    return _job_sums(parse_lines(_job_text(job), "line", JOB_EVENTS))


def _job_files(job: DataFrame) -> DataFrame:
    return _job_sums(read_job_events(job.sparkSession, _written(_job_text(job), "job_events")))


def _job_sums(rows: DataFrame) -> DataFrame:
    quoted = rows.where(F.col("job_name") == '"n')
    return _sums(quoted, "event_type", "time", "job_id", "scheduling_class")


def _different(key: str) -> Column:
    """A flag with all its values: 0, 1 and none."""
    return F.when(F.col(key) % 3 < 2, F.col(key) % 3)


def _task_line() -> Column:
    fields = ["time", None, "job_id", "task_index", "machine_id", "event_type", None]
    fields += ["scheduling_class", "priority", "cpu_request", None, None, _different("job_id")]
    return _line(fields)


def _task_lines(task: DataFrame) -> DataFrame:
    return _task_sums(parse_lines(task.select(_task_line().alias("line")), "line", TASK_EVENTS))


def _task_files(task: DataFrame) -> DataFrame:
    path = _written(task.select(_task_line().alias("line")), "task_events")
    return _task_sums(read_task_events(task.sparkSession, path))


def _task_sums(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("flag", F.col("different_machines").cast("int"))
    return _sums(rows, "event_type", "time", "job_id", "task_index", "machine_id", "scheduling_class", "priority", "flag")


def _task_parts(task: DataFrame) -> DataFrame:
    """Task events in many folders and compressed files, some read by a glob and the others by a list.

    A compressed file can't be split, so none holds more lines than a task reads well; all are written.
    """
    spark, lines = task.sparkSession, task.select(_task_line().alias("line"), (F.col("job_id") % 5).alias("part"))
    path = _written(lines, "task_parts", "part", compression="snappy", maxRecordsPerFile="2000000")
    read = {"glob": f"{path}/part=[0-2]/part-*", "list": [f"{path}/part=3", f"{path}/part=4"]}
    sums = [
        _sums(read_task_events(spark, paths), "event_type", "time", "job_id", "machine_id", "priority").withColumn("way", F.lit(way))
        for way, paths in read.items()
    ]
    return sums[0].unionByName(sums[1])


def _usage_text(usage: DataFrame) -> DataFrame:
    fields = ["start_time", "end_time", "job_id", "task_index", "machine_id", "cpu_rate", *[None] * 12]
    return _as_lines(usage, [*fields, _different("task_index"), None])


def _usage_lines(usage: DataFrame) -> DataFrame:
    return _usage_sums(parse_lines(_usage_text(usage), "line", TASK_USAGE))


def _usage_files(usage: DataFrame) -> DataFrame:
    return _usage_sums(read_task_usage(usage.sparkSession, _written(_usage_text(usage), "task_usage")))


def _usage_gzip(usage: DataFrame) -> DataFrame:
    """Task usage in gzipped files, which can't be split, read and spread over more tasks."""
    path = _written(_usage_text(usage), "task_usage_gzip", compression="gzip")
    return _usage_sums(read_task_usage(usage.sparkSession, f"{path}/*.gz", partitions=16))


def _usage_sums(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("flag", F.col("aggregation_type").cast("int"))
    return _sums(rows, "task_index", "start_time", "end_time", "job_id", "machine_id", "flag")


def _broken_lines(task: DataFrame) -> DataFrame:
    """Issues of task lines, some of which are broken by a rule on their job."""
    job = F.col("job_id") % 7
    broken = (
        F.when(job == 0, F.concat("line", F.lit(",9")))
        .when(job == 1, F.regexp_replace("line", " , [^,]*$", ""))
        .when(job == 2, F.concat(F.lit("x"), "line"))
        .when(job == 3, F.lit(None).cast("string"))
        .when(job == 4, F.lit("\t "))
        .when(job == 5, F.regexp_replace("line", "^[^,]*", " "))
        .otherwise(F.col("line"))
    )
    whole = task.withColumn("line", _task_line())
    rows = parse_lines(whole.select(broken.alias("line")), "line", TASK_EVENTS, malformed="bad")
    return count_issues(rows, TASK_EVENTS, "bad")


def _broken_files(task: DataFrame) -> DataFrame:
    """Issues of task files, some lines of which are broken by a rule on their job; blank lines are no rows."""
    job = F.col("job_id") % 7
    broken = (
        F.when(job == 0, F.concat("line", F.lit(",9")))
        .when(job == 1, F.regexp_replace("line", " , [^,]*$", ""))
        .when(job == 2, F.concat(F.lit("x"), "line"))
        .when(job == 3, F.concat("line", F.lit("x")))
        .when(job == 4, F.lit("\t "))
        .when(job == 5, F.regexp_replace("line", "^[^,]*", " "))
        .otherwise(F.col("line"))
    )
    path = _written(task.withColumn("line", _task_line()).select(broken.alias("line")), "broken_events")
    return validate_trace(task.sparkSession, path, TASK_EVENTS)


def _report(job: DataFrame, task: DataFrame) -> DataFrame:
    """Evicted or killed jobs and tasks as lines of a report."""
    hits = plans.evicted_or_killed(job, task)
    return hits.select("entity", "n_hit", percent_text(F.col("pct")).alias("share"))


def _labelled(task: DataFrame, usage: DataFrame) -> DataFrame:
    ratios = plans.overestimation_by_eviction(task, usage)
    names = {0: "Non-evicted tasks", 1: "Evicted tasks"}
    return ratios.select(label(F.col("evicted"), names).alias("tasks"), "avg_ratio")


def _issues(task: DataFrame) -> DataFrame:
    """Missing mandatory fields of task events, asking for the machine as well."""
    strict = type(TASK_EVENTS)(
        [f for f in TASK_EVENTS.fields if not f.nullable]
        + [type(f)(f.name, f.dataType, False) for f in TASK_EVENTS.fields if f.name == "machine_id"]
    )
    return count_issues(task, strict)


# Name -> (tables it reads, plan over those tables).
PLANS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    # The thirteen analytics.
    "capacity_distribution": ("machine", plans.capacity_distribution),
    "maintenance_loss_pct": ("machine", plans.maintenance_loss_pct),
    "loss_share_by_capacity": ("machine", plans.loss_share_by_capacity),
    "class_share_jobs_tasks": ("job task", plans.class_share_jobs_tasks),
    "evicted_or_killed": ("job task", plans.evicted_or_killed),
    "eviction_rate_by_class": ("task", plans.eviction_rate_by_class),
    "machines_per_job": ("task", plans.machines_per_job),
    "request_vs_usage": ("task usage", plans.request_vs_usage),
    "usage_vs_evictions": ("task usage", plans.usage_vs_evictions),
    "overcommit_fraction": ("machine task", plans.overcommit_fraction),
    "overestimation_by_class": ("task usage", plans.overestimation_by_class),
    "overestimation_by_eviction": ("task usage", plans.overestimation_by_eviction),
    "eviction_rate_by_priority": ("task", plans.eviction_rate_by_priority),
    # The operators on their own.
    "overcommit_by_machine": ("machine task", plans.overcommit_by_machine),
    "over_limit_fraction": ("machine task", _over_limit),
    "cpu_delta": ("task", _net_change),
    "running_level": ("task", _running_level),
    "carry_forward": (
        "machine",
        lambda m: op.carry_forward(m, "machine_id", "time", "cpus", "event_type"),
    ),
    "gap_loss": ("machine", lambda m: op.gap_loss(m, MACHINE_KEY)),
    "uptime_capacity": ("machine", _uptime),
    "gap_loss_by_class": ("machine", lambda m: op.gap_loss_by_class(m, MACHINE_KEY)),
    "down_class": ("machine", lambda m: op.down_class(m, MACHINE_KEY)),
    "trace_end": ("machine", _trace_end),
    "latest_by_key": (
        "machine",
        lambda m: op.latest_by_key(present(m, "cpus"), MACHINE_KEY, ["time", "event_type"], "cpus"),
    ),
    "first_by_key": (
        "machine",
        lambda m: op.first_by_key(present(m, "cpus"), MACHINE_KEY, ["time", "event_type"], "cpus"),
    ),
    "max_with": ("task", _biggest_request),
    "max_request": ("task", lambda t: op.max_request(t, TASK_KEY)),
    "mean_by": ("usage", _mean_use),
    "any_event": ("task", lambda t: op.any_event(t, TASK_KEY, [EVICT], name="evicted")),
    "count_by": ("task", lambda t: op.count_by(t, "machine_id")),
    "share_by": ("task", lambda t: op.share_by(t, "event_type")),
    "event_rate": ("task", lambda t: op.event_rate(t, TASK_KEY, "priority", [EVICT])),
    "event_rate_keep_zero": (
        "task",
        lambda t: op.event_rate(t, TASK_KEY, "priority", [EVICT], keep_zero=True),
    ),
    "eviction_rate_by_class_keep_zero": (
        "task",
        lambda t: plans.eviction_rate_by_class(t, keep_zero=True),
    ),
    "fanout_histogram": (
        "task",
        lambda t: op.fanout_histogram(t, "machine_id", "job_id", "n_jobs", "n_machines"),
    ),
    "request_ratio": ("task usage", _ratios),
    "density_grid": ("task usage", _task_grid),
    "machine_density_grid": (
        "task usage",
        lambda t, u: op.density_grid(
            plans.usage_vs_evictions(t, u), "mean_cpu", "evictions", 0.0005, 10.0
        ),
    ),
    "log_count": ("task", lambda t: with_log_count(plans.machines_per_job(t), "n_jobs")),
    "count_issues": ("task", _issues),
    "percent_text": ("job task", _report),
    "label": ("task usage", _labelled),
    "parse_lines": ("machine", _lines),
    "parse_job_lines": ("job", _job_lines),
    "parse_task_lines": ("task", _task_lines),
    "parse_usage_lines": ("usage", _usage_lines),
    "count_line_issues": ("task", _broken_lines),
    # Files that Spark wrote into the shared folder, read back.
    "read_machine_events": ("machine", _machine_files),
    "read_job_events": ("job", _job_files),
    "read_task_events": ("task", _task_files),
    "read_task_usage": ("usage", _usage_files),
    "read_task_parts": ("task", _task_parts),
    "read_gzip_usage": ("usage", _usage_gzip),
    "validate_trace": ("task", _broken_files),
}

_TABLES = {
    "machine": mapped.machine_events,
    "job": mapped.job_events,
    "task": mapped.task_events,
    "usage": mapped.task_usage,
}


def _query(tables: str, plan: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(plan(*(_TABLES[t](spark, sf_dir) for t in tables.split())), PLACES)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(tables, plan) for name, (tables, plan) in PLANS.items()} | LLM


def oracle_sql() -> dict[str, str]:
    return ORACLES | LLM_ORACLES


def entry(spark: SparkSession) -> DataFrame:
    """Fraction of time every machine is overcommitted."""
    return queries()["overcommit_by_machine"](spark, "/root/testdata/sf0.001")
