"""What entities ask for and what they use."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clustertrace.functions import names, present, ratio


def max_request(
    df: DataFrame, keys: str | Sequence[str], request: str = "cpu_request", name: str = "requested"
) -> DataFrame:
    """Largest request per key; rows without a request are ignored."""
    return present(df, request).groupBy(*names(keys)).agg(F.max(request).alias(name))


def mean_by(df: DataFrame, keys: str | Sequence[str], value: str, name: str = "mean") -> DataFrame:
    """Unweighted mean per key; rows without a value are ignored."""
    return present(df, value).groupBy(*names(keys)).agg(F.avg(value).alias(name))


def request_ratio(
    requests: DataFrame,
    usage: DataFrame,
    keys: str | Sequence[str],
    requested: str = "requested",
    used: str = "used",
    max_ratio: float = 50.0,
) -> DataFrame:
    """Request over use for every key on both sides, as ``requests`` plus ``ratio``.

    Both inputs have one row per key. Keys that use nothing are left out, and so
    are ratios of ``max_ratio`` and above.
    """
    return (
        requests.join(usage.where(F.col(used) > 0), names(keys))
        .withColumn("ratio", ratio(F.col(requested), F.col(used)))
        .where(F.col("ratio") < max_ratio)
    )


def density_grid(
    df: DataFrame, x: str, y: str, dx: float, dy: float, xb: str = "xb", yb: str = "yb"
) -> DataFrame:
    """Points per grid cell, as ``(xb, yb, n)`` with cell numbers ``floor(x / dx)``.

    A scatter chart of any number of points; the result has a row per cell that
    holds a point, which is bounded where the values are.
    """
    cells = df.select(
        F.floor(F.col(x) / F.lit(dx)).alias(xb), F.floor(F.col(y) / F.lit(dy)).alias(yb)
    )
    return cells.groupBy(xb, yb).agg(F.count("*").alias("n"))
