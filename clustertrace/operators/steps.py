"""Step functions over event series: levels, carried values, time over a limit."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clustertrace.functions import flag, names, present, ratio
from clustertrace.operators.sliced import SLICE, running

# Levels and limits are kept as whole units of this many decimal places, in a BIGINT.
# A sum of fractions depends on the order of the rows, which matters where a level
# meets its limit exactly; whole units add up exactly in any order.
SCALE = 10


def _units(value: Column, scale: int) -> Column:
    """A value in whole units. One that isn't a number, is too large, or vanishes raises."""
    scaled = F.rint(value.cast("double") * F.lit(10.0**scale))

    def fail(what: str) -> Column:
        text = F.concat(F.lit(f"{what} at a scale of {scale} decimal places: "), value.cast("string"))
        return F.raise_error(text).cast("bigint")

    return (
        F.when(~(F.abs(scaled) < F.lit(2.0**63)), fail("value out of range"))
        .when((scaled == 0) & (value != 0), fail("value too small"))
        .otherwise(scaled.cast("bigint"))
    )


def _instant_sum(change: str) -> Column:
    """Sum of the changes of a group, NULL without any; an overflow raises in every mode."""
    overflow = F.raise_error(F.lit("the changes of one instant are out of range")).cast("bigint")
    return F.when(F.count(change) > 0, F.coalesce(F.try_sum(change), overflow))


def _level(before: str, change: str) -> Column:
    """Level after an instant; an overflow raises in every mode.

    Where the setting lets a sum wrap around, the level before is right all the same
    as long as every earlier level was in range, and the first that isn't stops here.
    """
    overflow = F.raise_error(F.lit("a level is out of range")).cast("bigint")
    return F.coalesce(F.try_add(F.col(before), F.coalesce(change, F.lit(0))), overflow)


def _value(units: Column, scale: int) -> Column:
    """The value of whole units. The whole part is taken off first, as a DOUBLE may not hold all units."""
    unit = F.lit(10**scale)
    return F.call_function("div", units, unit) + (units % unit) / F.lit(10.0**scale)


def running_level(
    df: DataFrame,
    keys: str | Sequence[str],
    time: str,
    delta: str,
    name: str = "level",
    widths: Sequence[int] = (SLICE,),
    scale: int = SCALE,
) -> DataFrame:
    """Running sum of changes per key, as ``(keys, time, level)``.

    One row per instant, with all changes up to and including it applied. The
    level before the first change is 0. Changes count to ``scale`` decimal places
    and add up exactly, in any order, to levels of 9.2e18 units (9.2e8 at ten
    places). A level beyond that raises, and so does a change that is not 0 but
    less than half a unit. ``widths`` are in the unit of ``time``, as in ``running``.
    """
    keys = names(keys)
    instants = (
        present(df, *keys, time, delta)
        .select(*keys, time, _units(F.col(delta), scale).alias("_change"))
        .groupBy(*keys, time)
        .agg(_instant_sum("_change").alias("_change"))
    )
    levels = running(instants, keys, time, sums={"_level": "_change"}, widths=widths)
    return levels.select(*keys, time, _value(_level("_level", "_change"), scale).alias(name))


def _at_instants(df: DataFrame, keys: list[str], time: str, value: str, tie: list[str]) -> DataFrame:
    """First and last value of every instant in ``(tie, value)`` order, NULL if it has none."""
    order = F.struct(*tie, value) if tie else F.col(value)
    known = F.when(F.col(value).isNotNull(), order)
    field = f".{value}" if tie else ""
    return (
        df.groupBy(*keys, time)
        .agg(F.min(known).alias("_first"), F.max(known).alias("_last"))
        .select(
            *keys,
            time,
            F.col(f"_first{field}").alias("_first"),
            F.col(f"_last{field}").alias("_last"),
        )
    )


def carry_forward(
    df: DataFrame,
    keys: str | Sequence[str],
    time: str,
    value: str,
    tie: str | Sequence[str] = (),
    widths: Sequence[int] = (SLICE,),
) -> DataFrame:
    """The value in force at every instant of a key, as ``(keys, time, value)``.

    An instant without a value takes the latest earlier one, and before the
    first value that first one holds. Values of one instant are ordered by
    ``(tie, value)``; the last of them is the one in force from there on. A key
    that has no value keeps NULL. ``widths`` are in the unit of ``time``.
    """
    keys, tie = names(keys), names(tie)
    instants = _at_instants(present(df, *keys, time), keys, time, value, tie)
    filled = running(
        instants,
        keys,
        time,
        previous={"_earlier": "_last"},
        following={"_later": "_first"},
        widths=widths,
    )
    return filled.select(*keys, time, F.coalesce("_last", "_earlier", "_later").alias(value))


def over_limit_fraction(
    levels: DataFrame,
    limits: DataFrame,
    keys: str | Sequence[str],
    time: str = "time",
    delta: str = "delta",
    limit: str = "limit",
    tie: str | Sequence[str] = (),
    name: str = "fraction",
    widths: Sequence[int] = (SLICE,),
    scale: int = SCALE,
) -> DataFrame:
    """Fraction of time a key's level is above its limit, as ``(keys, fraction)``.

    ``levels`` holds changes of the level, which starts at 0; ``limits`` holds
    values of the limit, the first of which also holds before its time. Limits
    of one instant are ordered by ``(tie, limit)``; the last of them is the one
    in force from there on. Only keys found in both inputs are returned. Time
    runs from the first to the last instant of either series; where that is no
    time at all, the fraction is 0. Levels and limits are exact to ``scale`` decimal
    places, as in ``running_level``. ``widths`` are in the unit of ``time``.
    """
    keys, tie = names(keys), names(tie)
    changes = present(levels, *keys, time, delta).select(
        *keys, time, _units(F.col(delta), scale).alias("_change")
    )
    known = _at_instants(present(limits, *keys, time, limit), keys, time, limit, tie)
    # Both series in one shuffle: a row per instant, whichever series it is from.
    instants = (
        changes.unionByName(
            known.select(
                *keys,
                time,
                _units(F.col("_first"), scale).alias("_first"),
                _units(F.col("_last"), scale).alias("_last"),
            ),
            allowMissingColumns=True,
        )
        .groupBy(*keys, time)
        .agg(
            _instant_sum("_change").alias("_change"),
            F.max("_first").alias("_first"),
            F.max("_last").alias("_last"),
        )
    )
    merged = running(
        instants,
        keys,
        time,
        sums={"_level": "_change"},
        previous={"_earlier": "_last"},
        following={"_later": "_first", "_until": time},
        widths=widths,
    )
    level = _level("_level", "_change")
    in_force = F.coalesce("_last", "_earlier", "_later")
    lasting = F.col("_until") - F.col(time)
    totals = merged.groupBy(*keys).agg(
        F.max(flag(F.col("_change").isNotNull())).alias("_has_level"),
        F.max(flag(F.col("_last").isNotNull())).alias("_has_limit"),
        F.sum(F.when(level > in_force, lasting)).alias("_over"),
        F.sum(lasting).alias("_total"),
    )
    both = totals.where((F.col("_has_level") == 1) & (F.col("_has_limit") == 1))
    fraction = ratio(F.col("_over").cast("double"), F.col("_total").cast("double"))
    return both.select(*keys, F.coalesce(fraction, F.lit(0.0)).alias(name))
