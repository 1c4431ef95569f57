"""Time machines spend with more CPU requested than they have."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clustertrace.functions import cpu_delta, present
from clustertrace.operators import SLICE, over_limit_fraction
from clustertrace.sources.schemas import ENDINGS, MACHINE_KEY, SCHEDULE


def overcommit_by_machine(
    machine_events: DataFrame, task_events: DataFrame, widths: Sequence[int] = (SLICE,)
) -> DataFrame:
    """Fraction of time each machine is overcommitted, ``(machine_id, fraction)``.

    Every machine row with a capacity sets the capacity, removals too. Demand
    starts at 0 for the first event seen.
    """
    starts_or_ends = F.col("event_type").isin(SCHEDULE, *ENDINGS)
    demand = (
        present(task_events, "machine_id", "cpu_request")
        .where(starts_or_ends)
        .select(
            "machine_id",
            "time",
            cpu_delta(F.col("event_type"), F.col("cpu_request")).alias("delta"),
        )
    )
    return over_limit_fraction(
        demand, machine_events, MACHINE_KEY, limit="cpus", tie="event_type", widths=widths
    )


def overcommit_fraction(
    machine_events: DataFrame, task_events: DataFrame, widths: Sequence[int] = (SLICE,)
) -> DataFrame:
    """Mean over machines of the overcommitted fraction: one row ``(avg_fraction)``."""
    machines = overcommit_by_machine(machine_events, task_events, widths)
    return machines.agg(F.avg("fraction").alias("avg_fraction"))
