"""Running values over a time series per key, for keys of any size.

A window partitioned by key alone puts a key's whole series in one task, and one
machine may hold a third of all events. Here the series is cut into time slices
and no window is wider than a slice:

1. the points are shuffled by (key, slice), and every slice is reduced to one row;
2. the same running values are computed over those rows, one per slice, which
   says what every slice starts from and what comes after it;
3. these values enter the slice as a border row before its first point, and a
   window over (key, slice) gives the exact result.

Steps 1 and 3 use one shuffle of the points.

The points must be unique in (key, time). A slice of width w then holds at most
w rows of one key, whatever the size of the input, and the window of step 2 has
one row per non-empty slice. Several widths, each wider than the one before,
repeat step 1 so that step 2 stays small for very long series as well.

Slices depend on the time alone, so a recomputed task gives the same rows.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Slice widths for times in microseconds.
MINUTE = 60_000_000
HOUR = 60 * MINUTE

# A good width leaves the busiest key with less than 100 million points per slice,
# and the other keys with several. Ten minutes does so for a third of 10^12 events
# on one machine of a month-long trace; for a small or sparse trace an hour is better.
SLICE = 10 * MINUTE

_SIDE = "_side"
_BORDER, _POINT = 0, 1


def check_widths(widths: Sequence[int]) -> None:
    """Slices must have a length, and each level must be wider than the one before."""
    if any(wide <= narrow for narrow, wide in zip((0, *widths), widths)):
        raise ValueError(f"slice widths must be positive and increase: {tuple(widths)}")


def running(
    points: DataFrame,
    keys: Sequence[str],
    time: str,
    sums: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    widths: Sequence[int] = (SLICE,),
) -> DataFrame:
    """Add running values to points that are unique in ``(keys, time)``.

    Each mapping goes from the name of a new column to the column it is made of,
    looking at the other points of the key only, never at the point itself. ``widths``
    are in the unit of ``time``; the default is meant for microseconds, and times in
    another unit need widths of their own. Further columns of any type are kept.

    ``sums``       sum over all earlier points, 0 before the first
    ``previous``   last non-null value among the earlier points
    ``following``  first non-null value among the later points
    """
    check_widths(widths)
    parts = (dict(sums or {}), dict(previous or {}), dict(following or {}))
    return _running(points, list(keys), time, *parts, widths, ())


def _running(points, keys, time, sums, previous, following, widths, counts) -> DataFrame:
    """``running``; ``counts`` are columns of counts, kept up for the slices of the next level."""
    if not widths:
        return points.select("*", *_windows(keys, [time], sums, previous, following))

    start = f"_slice_{widths[0]}"
    group = [*keys, start]
    slice_start = F.col(time) - F.pmod(time, F.lit(widths[0]))
    rows = points.select("*", slice_start.alias(start)).repartition(*group)
    around, counted = _around(rows, points.columns, keys, time, start, sums, previous, following, widths[1:], counts)

    # A working column per result: the border row has another value for each of them.
    sources = {**sums, **previous, **following}
    work = {name: f"_{name}" for name in sources}
    inside = rows.select(
        "*", F.lit(_POINT).alias(_SIDE), *(F.col(c).alias(work[name]) for name, c in sources.items())
    )
    # Counts are never below the mark, so this is the mark; but it reads all columns.
    columns = [F.col(c) for c in counted]
    borders = around.select(
        *group,
        (F.least(F.lit(_BORDER), *columns).cast("int") if columns else F.lit(_BORDER)).alias(_SIDE),
        *(F.col(name).alias(work[name]) for name in sources),
    )
    # Both sides are partitioned alike, so the union needs no further shuffle.
    both = inside.unionByName(borders.repartition(*group), allowMissingColumns=True)
    parts = ({name: work[name] for name in part} for part in (sums, previous, following))
    valued = both.select("*", *_windows(group, [_SIDE, time], *parts, bordered=True))
    return valued.where(F.col(_SIDE) == _POINT).select(*points.columns, *sources)


def _around(rows, columns, keys, time, start, sums, previous, following, widths, counts) -> tuple[DataFrame, list[str]]:
    """One row per slice: its running values, seen from the slice as a whole; and its columns of counts."""

    def if_present(value: str) -> Column:
        return F.when(F.col(value).isNotNull(), F.col(time))

    sources = {**sums, **previous, **following}
    of_slice = {name: f"{name}_of_slice" for name in sources}
    # Columns that no running value is made of are counted, so that this reads the same
    # shuffled columns as the windows and Spark shuffles them once. A count is there
    # for every type, and can be hashed.
    others = [c for c in columns if c not in {*keys, *sources.values()}]
    mark = "_count_of_"
    while any(c.startswith(mark) for c in columns):
        mark = f"_{mark}"
    counted = [mark + c for c in others]
    slices = rows.groupBy(*keys, start).agg(
        *(F.sum(c).alias(of_slice[name]) for name, c in sums.items()),
        *(F.max_by(c, if_present(c)).alias(of_slice[name]) for name, c in previous.items()),
        *(F.min_by(c, if_present(c)).alias(of_slice[name]) for name, c in following.items()),
        *((F.sum(c) if c in counts else F.count(c)).alias(mark + c) for c in others),
    )
    parts = ({name: of_slice[name] for name in part} for part in (sums, previous, following))
    return _running(slices, keys, start, *parts, widths, counted), counted


def _windows(group, order, sums, previous, following, bordered=False) -> list[Column]:
    """The running values inside one window partition.

    A border row comes before all points, so sums and previous values take it in
    like an earlier point. Its following values hold where no later point has one.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)

    def next_value(c: str) -> Column:
        # A frame that reaches forward to the end would be rebuilt for every row.
        inside = F.expr(f"lead(`{c}`) IGNORE NULLS").over(window)
        return F.coalesce(inside, F.first(c).over(earlier)) if bordered else inside

    return [
        *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(name) for name, c in sums.items()),
        *(F.last(c, ignorenulls=True).over(earlier).alias(name) for name, c in previous.items()),
        *(next_value(c).alias(name) for name, c in following.items()),
    ]
