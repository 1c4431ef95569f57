"""Analytics over job and task events."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clustertrace.functions import present
from clustertrace.operators import event_rate, fanout_histogram, hit_summary, share_by
from clustertrace.sources.schemas import EVICT, KILL, SCHEDULE, TASK_KEY


def class_share_jobs_tasks(job_events: DataFrame, task_events: DataFrame) -> DataFrame:
    """Share of jobs and of tasks per class, ``(scheduling_class, job_pct, task_pct)``.

    A job or task seen in two classes counts in both. A class that only jobs or
    only tasks have is kept, with NULL on the other side.
    """

    def shares(events: DataFrame, entity: list[str], name: str) -> DataFrame:
        classed = present(events, "scheduling_class")
        members = classed.select(*entity, "scheduling_class").distinct()
        return share_by(members, "scheduling_class", name=name).drop("n")

    jobs = shares(job_events, ["job_id"], "job_pct")
    tasks = shares(task_events, TASK_KEY, "task_pct")
    return jobs.join(tasks, "scheduling_class", "full").orderBy("scheduling_class")


def evicted_or_killed(job_events: DataFrame, task_events: DataFrame) -> DataFrame:
    """Jobs and tasks evicted or killed at least once, ``(entity, n_total, n_hit, pct)``."""

    def summary(events: DataFrame, label: str, entity: list[str]) -> DataFrame:
        hits = hit_summary(events, entity, [EVICT, KILL])
        return hits.select(F.lit(label).alias("entity"), "n_total", "n_hit", "pct")

    return summary(job_events, "jobs", ["job_id"]).unionByName(
        summary(task_events, "tasks", TASK_KEY)
    )


def eviction_rate_by_class(task_events: DataFrame, keep_zero: bool = False) -> DataFrame:
    """Percentage of tasks evicted per class, ``(scheduling_class, pct)``, by class."""
    classed = present(task_events, "scheduling_class")
    rates = event_rate(classed, TASK_KEY, "scheduling_class", [EVICT], keep_zero)
    return rates.select("scheduling_class", "pct").orderBy("scheduling_class")


def eviction_rate_by_priority(task_events: DataFrame, keep_zero: bool = False) -> DataFrame:
    """Percentage of tasks evicted per priority, ``(priority, pct)``, by priority."""
    rates = event_rate(task_events, TASK_KEY, "priority", [EVICT], keep_zero)
    return rates.select("priority", "pct").orderBy("priority")


def machines_per_job(task_events: DataFrame) -> DataFrame:
    """Jobs per number of machines used, ``(n_machines, n_jobs)``, by number of machines."""
    placed = task_events.where(F.col("event_type") == SCHEDULE)
    return fanout_histogram(placed, "job_id", "machine_id", "n_machines", "n_jobs").orderBy(
        "n_machines"
    )
