"""One row per key, chosen by a total order.

The order is always closed with the returned columns themselves, so that rows
equal in ``order`` still have one winner, however the input is partitioned.
Each is one aggregate with a map-side part; no row list is built.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clustertrace.functions import names, present


def latest_by_key(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], cols: str | Sequence[str]
) -> DataFrame:
    """The last row of every key in ``(order, cols)``, as ``(keys, order, cols)``."""
    keys, fields = names(keys), [*names(order), *names(cols)]
    return df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_row")).select(*keys, "_row.*")


def first_by_key(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], cols: str | Sequence[str]
) -> DataFrame:
    """The first row of every key in ``(order, cols)``, as ``(keys, order, cols)``."""
    keys, fields = names(keys), [*names(order), *names(cols)]
    return df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_row")).select(*keys, "_row.*")


def max_with(
    df: DataFrame, keys: str | Sequence[str], order: str, payload: str | Sequence[str]
) -> DataFrame:
    """The largest ``order`` per key and the payload that came with it.

    Rows without ``order`` are ignored; among equals the largest payload wins. With
    one payload column, ties are settled first, per key and ``order``. Two plain
    maxima can be hashed, where the maximum of a struct sorts all rows twice.
    """
    rows, keys, payload = present(df, order), names(keys), names(payload)
    if len(payload) > 1:
        return latest_by_key(rows, keys, order, payload)
    [value] = payload
    ties = rows.groupBy(*keys, order).agg(F.max(value).alias("_value"))
    return ties.groupBy(*keys).agg(F.max(order).alias(order), F.max_by("_value", order).alias(value))
