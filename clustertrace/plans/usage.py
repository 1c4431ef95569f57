"""Analytics that set task requests and evictions against measured usage."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clustertrace.functions import flag, present
from clustertrace.operators import count_by, max_request, max_with, mean_by, request_ratio
from clustertrace.sources.schemas import EVICT, MACHINE_KEY, TASK_KEY


def _mean_use(task_usage: DataFrame) -> DataFrame:
    return mean_by(task_usage, TASK_KEY, "cpu_rate", "used")


def request_vs_usage(task_events: DataFrame, task_usage: DataFrame) -> DataFrame:
    """Largest request and mean use per task, ``(job_id, task_index, requested, used)``."""
    return max_request(task_events, TASK_KEY).join(_mean_use(task_usage), TASK_KEY)


def usage_vs_evictions(task_events: DataFrame, task_usage: DataFrame) -> DataFrame:
    """Mean use and eviction events per machine, ``(machine_id, mean_cpu, evictions)``.

    Machines without an eviction or without a usage record are left out.
    """
    evicted = present(task_events, "machine_id").where(F.col("event_type") == EVICT)
    return mean_by(task_usage, MACHINE_KEY, "cpu_rate", "mean_cpu").join(
        count_by(evicted, MACHINE_KEY, "evictions"), MACHINE_KEY
    )


def overestimation_by_class(
    task_events: DataFrame, task_usage: DataFrame, max_ratio: float = 50.0
) -> DataFrame:
    """Mean request over use per class, ``(scheduling_class, avg_ratio)``, by class.

    A task belongs to the class its largest request was made in, the highest
    such class if there are several.
    """
    classed = present(task_events, "scheduling_class", "cpu_request")
    requests = max_with(classed, TASK_KEY, "cpu_request", "scheduling_class")
    ratios = request_ratio(
        requests, _mean_use(task_usage), TASK_KEY, "cpu_request", max_ratio=max_ratio
    )
    return mean_by(ratios, "scheduling_class", "ratio", "avg_ratio").orderBy("scheduling_class")


def overestimation_by_eviction(
    task_events: DataFrame, task_usage: DataFrame, max_ratio: float = 50.0
) -> DataFrame:
    """Mean request over use of tasks never and ever evicted, ``(evicted, avg_ratio)``.

    Rows without a request do not count, not even as an eviction.
    """
    requests = present(task_events, "cpu_request").groupBy(*TASK_KEY).agg(
        F.max("cpu_request").alias("requested"),
        F.max(flag(F.col("event_type") == EVICT)).alias("evicted"),
    )
    ratios = request_ratio(requests, _mean_use(task_usage), TASK_KEY, max_ratio=max_ratio)
    return mean_by(ratios, "evicted", "ratio", "avg_ratio").orderBy("evicted")
