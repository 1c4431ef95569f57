"""Down and up times of keys that carry a weight, such as machines with a capacity.

Rows are ordered by ``(time, event, weight)`` everywhere, so events of one
instant have a fixed order. Rows without a weight are ignored.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clustertrace.functions import flag, names, present
from clustertrace.operators.sliced import SLICE, check_widths
from clustertrace.sources.schemas import ADD, REMOVE


def gap_loss(
    df: DataFrame,
    keys: str | Sequence[str],
    time: str = "time",
    event: str = "event_type",
    weight: str = "cpus",
    down: int = REMOVE,
    up: int = ADD,
    name: str = "lost",
    widths: Sequence[int] = (SLICE,),
) -> DataFrame:
    """Weight lost while down, as ``(keys, lost)``: sum of weight at down x gap to up.

    A repeated down replaces the open one, an up without an open down and a down
    that is never followed by an up add nothing, other events are ignored. Keys
    with a down or up event but no gap are there with 0. ``widths`` are the time
    slices that long series are cut into, in the unit of ``time``, as in ``running``.
    """
    check_widths(widths)
    keys = names(keys)
    is_down, is_up = F.col(event) == down, F.col(event) == up
    # Within an instant the smaller code comes first. Ups first: they end the open
    # gap, then the last down, the heaviest one, opens the next. Downs first: they
    # replace the open gap, and an up ends the new one at no length.
    instants = (
        present(df, *keys, time, weight)
        .where(is_down | is_up)
        .groupBy(*keys, time)
        .agg(F.max(flag(is_up)).alias("_up"), F.max(F.when(is_down, F.col(weight))).alias("_down"))
    )
    ends, opens = _border(up < down)
    spans = instants.select(
        *keys,
        F.col(time).alias("_from"),
        F.col(time).alias("_to"),
        ends.alias("_ends"),
        F.coalesce(opens, F.lit(0.0)).alias("_open"),
        F.lit(0.0).alias("_lost"),
    )
    for width in widths:
        start = f"_slice_{width}"
        spans = _joined(
            spans.withColumn(start, F.col("_from") - F.pmod("_from", F.lit(width))), [*keys, start]
        )
    return _joined(spans, keys).select(*keys, F.col("_lost").alias(name))


def _border(ups_first: bool) -> tuple[Column, Column]:
    """Whether an instant ends a gap, and the weight it leaves open."""
    if ups_first:
        return F.col("_up") == 1, F.col("_down")
    return (F.col("_up") == 1) & F.col("_down").isNull(), F.when(F.col("_up") == 0, F.col("_down"))


def _joined(spans: DataFrame, group: Sequence[str], classed: bool = False) -> DataFrame:
    """Join the spans of every group, in order of time, into one.

    A span reaches from its first instant to its last. It is known by whether the
    first ends a gap, the weight that the last leaves open (0 for none), and what
    was lost inside. Between two neighbours, a gap left open by the one and ended
    by the other is lost as well. Spans of instants make spans of slices, and these
    make the span of a key, so that no window holds more than a slice's instants.

    ``classed`` spans carry ``_down``, the weight of their last down event, and ``_first``, that of the first
    event, and begin at ``_begin``; where nothing goes down or up they have no ``_from``, and are skipped.
    """
    order = "_begin" if classed else "_from"
    window = Window.partitionBy(*group).orderBy(order)

    def before(column: str) -> Column:
        return (F.expr(f"lag({column}) IGNORE NULLS") if classed else F.lag(column)).over(window)

    between = before("_open") * (F.col("_from") - before("_to"))
    carried = []
    if classed:
        last = F.when(F.col("_down").isNotNull(), F.col("_begin"))
        carried = [
            F.max_by("_down", last).alias("_down"),
            F.min_by("_first", "_begin").alias("_first"),
            F.min("_begin").alias("_begin"),
        ]
    lost = F.col("_lost") + F.when(F.col("_ends"), F.coalesce(between, F.lit(0.0))).otherwise(0.0)
    return (
        spans.withColumn("_lost", lost)
        .groupBy(*group)
        .agg(
            F.min_by("_ends", "_from").alias("_ends"),
            F.max_by("_open", "_from").alias("_open"),
            F.sum("_lost").alias("_lost"),
            F.min("_from").alias("_from"),
            F.max("_to").alias("_to"),
            *carried,
        )
    )


def gap_loss_by_class(
    df: DataFrame,
    keys: str | Sequence[str],
    time: str = "time",
    event: str = "event_type",
    weight: str = "cpus",
    down: int = REMOVE,
    up: int = ADD,
    name: str = "lost",
    widths: Sequence[int] = (SLICE,),
) -> DataFrame:
    """``down_class`` and ``gap_loss`` of every key in one pass, as ``(keys, weight, lost)``.

    A key without a gap has 0 lost. Rows are grouped by instant and event with a map-side part, and then
    shuffled by key and slice once: instants, slices' spans and their windows are made from that. A span
    carries the weight of its last down event and that of its first event of any kind.
    """
    check_widths(widths)
    keys = names(keys)
    events = (
        present(df, *keys, time, weight)
        .groupBy(*keys, time, event)
        .agg(F.min(weight).alias("_least"), F.max(weight).alias("_most"))
    )
    slices = [f"_slice_{w}" for w in widths[:1]]
    if slices:
        start = F.col(time) - F.pmod(time, F.lit(widths[0]))
        events = events.withColumn(slices[0], start).repartition(*keys, *slices)
    is_down, is_up = F.col(event) == down, F.col(event) == up
    instants = events.groupBy(*keys, *slices, time).agg(
        F.max(flag(is_up)).alias("_up"),
        F.max(F.when(is_down, F.col("_most"))).alias("_down"),
        F.min_by("_least", event).alias("_first"),
    )
    ends, opens = _border(up < down)
    # An instant with other events only neither ends nor opens a gap, and is no end of a span.
    touched = (F.col("_up") == 1) | F.col("_down").isNotNull()
    spans = instants.select(
        *keys,
        *slices,
        F.col(time).alias("_begin"),
        F.when(touched, F.col(time)).alias("_from"),
        F.when(touched, F.col(time)).alias("_to"),
        F.when(touched, ends).alias("_ends"),
        F.when(touched, F.coalesce(opens, F.lit(0.0))).alias("_open"),
        F.lit(0.0).alias("_lost"),
        "_down",
        "_first",
    )
    for width in widths:
        start = f"_slice_{width}"
        if start not in slices:
            spans = spans.withColumn(start, F.col("_begin") - F.pmod("_begin", F.lit(width)))
        spans = _joined(spans, [*keys, start], classed=True)
    whole = _joined(spans, keys, classed=True)
    return whole.select(*keys, F.coalesce("_down", "_first").alias(weight), F.col("_lost").alias(name))


def trace_end(df: DataFrame, time: str = "time") -> Column:
    """Last time of the rows, as a scalar subquery to use in an expression."""
    return df.agg(F.max(time).alias("trace_end")).scalar()


def uptime_capacity(
    df: DataFrame,
    keys: str | Sequence[str],
    end: Column | None = None,
    time: str = "time",
    event: str = "event_type",
    weight: str = "cpus",
    up: int = ADD,
    name: str = "available",
) -> DataFrame:
    """Weight available from a key's first up event to ``end``, as ``(keys, available)``.

    Later down times are not taken off. A key that never comes up has 0. Without an
    ``end`` it is the last time of any row used here, taken from the grouped rows, so
    that the source is read once.
    """
    keys = names(keys)
    first_up = F.min(F.when(F.col(event) == up, F.struct(time, weight)))
    firsts = (
        present(df, *keys, time, weight)
        .groupBy(*keys)
        .agg(first_up.alias("_first"), F.max(time).alias("_last"))
    )
    if end is None:
        end = firsts.agg(F.max("_last")).scalar()
    available = F.col(f"_first.{weight}") * (end - F.col(f"_first.{time}"))
    return firsts.select(*keys, F.coalesce(available, F.lit(0.0)).alias(name))


def down_class(
    df: DataFrame,
    keys: str | Sequence[str],
    time: str = "time",
    event: str = "event_type",
    weight: str = "cpus",
    down: int = REMOVE,
) -> DataFrame:
    """The weight a key is classed by, as ``(keys, weight)``.

    That of its last down event, or of its first event of any kind if it was
    never down.
    """
    keys = names(keys)
    rows = present(df, *keys, time, weight)
    classed = rows.groupBy(*keys).agg(
        F.max(F.when(F.col(event) == down, F.struct(time, weight))).alias("_down"),
        F.min(F.struct(time, event, weight)).alias("_first"),
    )
    return classed.select(*keys, F.coalesce(f"_down.{weight}", f"_first.{weight}").alias(weight))
