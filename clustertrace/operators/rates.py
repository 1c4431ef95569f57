"""Counts, shares and event rates over groups.

All are grouped aggregates with a map-side part, so a hot group costs one
partial row per map task. An entity is flagged and counted in one pass instead
of two distinct sets that are joined.
"""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clustertrace.functions import flag, names, pct, present


def count_by(df: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*names(keys)).agg(F.count("*").alias(name))


def any_event(
    df: DataFrame,
    keys: str | Sequence[str],
    codes: Iterable[int],
    event: str = "event_type",
    name: str = "hit",
) -> DataFrame:
    """1 for every key with at least one event of the given codes, else 0."""
    return df.groupBy(*names(keys)).agg(F.max(flag(F.col(event).isin(*codes))).alias(name))


def share_by(
    df: DataFrame, key: str | Sequence[str], weight: str | None = None, name: str = "pct"
) -> DataFrame:
    """Each group's share of the total, in percent, as ``(key, n, pct)``.

    ``n`` is the number of rows, or the sum of ``weight`` where one is given.
    The total is a scalar subquery over the grouped rows: the groups stay
    distributed, and the shuffled groups are reused rather than computed again.
    """
    size = F.count("*") if weight is None else F.sum(weight)
    groups = df.groupBy(*names(key)).agg(size.alias("n"))
    total = groups.agg(F.sum("n").alias("total")).scalar()
    return groups.select(*names(key), "n", pct(F.col("n"), total).alias(name))


def event_rate(
    df: DataFrame,
    entity: str | Sequence[str],
    group: str,
    codes: Iterable[int],
    keep_zero: bool = False,
    event: str = "event_type",
) -> DataFrame:
    """Percentage of the entities of a group that had one of the events.

    Result ``(group, n_entities, n_hit, pct)``. An entity seen with two groups
    counts in both, and is hit only in those where the event was recorded. A
    group without any hit is left out unless ``keep_zero`` is set.
    """
    entities = any_event(df, [*names(entity), group], codes, event)
    rates = entities.groupBy(group).agg(
        F.count("*").alias("n_entities"), F.sum("hit").alias("n_hit")
    )
    if not keep_zero:
        rates = rates.where(F.col("n_hit") > 0)
    return rates.withColumn("pct", pct(F.col("n_hit"), F.col("n_entities")))


def hit_summary(
    df: DataFrame, entity: str | Sequence[str], codes: Iterable[int], event: str = "event_type"
) -> DataFrame:
    """One row ``(n_total, n_hit, pct)``: distinct entities, and those with an event."""
    return (
        any_event(df, entity, codes, event)
        .agg(F.count("*").alias("n_total"), F.count_if(F.col("hit") == 1).alias("n_hit"))
        .withColumn("pct", pct(F.col("n_hit"), F.col("n_total")))
    )


def fanout_histogram(
    df: DataFrame, key: str | Sequence[str], member: str, fanout: str = "fanout", name: str = "n_keys"
) -> DataFrame:
    """How many keys have 1, 2, 3 ... distinct members.

    Rows without a key or a member are ignored. The pairs are made distinct first, spread over key and member, so that a key
    with very many members is never gathered in one place.
    """
    keys = names(key)
    pairs = present(df, *keys, member).select(*keys, member).distinct()
    return count_by(count_by(pairs, keys, fanout), fanout, name)
