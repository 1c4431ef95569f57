"""Column expressions shared by the operators and the analytics."""

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clustertrace.sources.schemas import ENDINGS, SCHEDULE


def names(columns: str | Sequence[str]) -> list[str]:
    """One column name or several, as a list."""
    return [columns] if isinstance(columns, str) else list(columns)


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is NULL.

    Written as plain null tests, which reach the scan as pushed filters.
    """
    return df.where(reduce(and_, (F.col(c).isNotNull() for c in columns)))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0; an unknown condition counts as 0."""
    return F.when(condition, 1).otherwise(0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient; NULL where the denominator is zero."""
    return F.try_divide(numerator, denominator)


def pct(part: Column, total: Column) -> Column:
    """Share of a total in percent; NULL where the total is zero."""
    return ratio(part, total) * F.lit(100.0)


def cpu_delta(event_type: Column, cpu_request: Column) -> Column:
    """Change in CPU demand on a machine caused by one task event.

    Starting a task adds its request and any way of ending it takes the request
    away. Submissions and updates change nothing and give NULL, so that callers
    can drop those rows.
    """
    return F.when(event_type == SCHEDULE, cpu_request).when(
        event_type.isin(*ENDINGS), -cpu_request
    )


def label(code: Column, labels: Mapping[int, str]) -> Column:
    """Text for a code; NULL for a code without one."""
    texts = F.create_map(*(F.lit(part) for pair in labels.items() for part in pair))
    return F.element_at(texts, code)


def percent_text(value: Column, places: int = 2) -> Column:
    """A percentage as printed in a report, such as ``41.35%``; NULL for no value."""
    return F.when(value.isNotNull(), F.format_string(f"%.{places}f%%", value))
