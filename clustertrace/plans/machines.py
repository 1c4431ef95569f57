"""Analytics over machine events."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clustertrace.functions import pct, present
from clustertrace.operators import (
    SLICE,
    count_by,
    gap_loss,
    gap_loss_by_class,
    latest_by_key,
    share_by,
    uptime_capacity,
)
from clustertrace.sources.schemas import MACHINE_KEY, REMOVE


def capacity_distribution(machine_events: DataFrame) -> DataFrame:
    """Machines per CPU capacity, ``(cpus, n_machines)``, by capacity.

    A machine counts at the capacity of its latest row that is not a removal, so
    a machine that was removed in the end still counts.
    """
    rows = present(machine_events, "cpus").where(F.col("event_type") != REMOVE)
    latest = latest_by_key(rows, MACHINE_KEY, ["time", "event_type"], "cpus")
    return count_by(latest, "cpus", "n_machines").orderBy("cpus")


def maintenance_loss_pct(
    machine_events: DataFrame, widths: Sequence[int] = (SLICE,)
) -> DataFrame:
    """Compute lost to maintenance, in percent of all compute: one row ``(pct_lost)``.

    The trace ends with the last machine row that has a capacity.
    """
    rows = present(machine_events, "cpus")
    lost = gap_loss(rows, MACHINE_KEY, widths=widths).agg(F.sum("lost").alias("lost"))
    available = uptime_capacity(rows, MACHINE_KEY).agg(F.sum("available").alias("available"))
    return available.select(pct(lost.scalar(), F.col("available")).alias("pct_lost"))


def loss_share_by_capacity(
    machine_events: DataFrame, widths: Sequence[int] = (SLICE,)
) -> DataFrame:
    """Share of the lost compute per machine capacity, ``(cpus, pct)``, by capacity.

    A machine's whole loss goes to the class of its last removal. Classes that
    lost nothing are listed with 0.
    """
    rows = present(machine_events, "cpus")
    losses = gap_loss_by_class(rows, MACHINE_KEY, widths=widths)
    return share_by(losses, "cpus", "lost").select("cpus", "pct").orderBy("cpus")
