"""Row checks: which rows would break a strict read, and why."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clustertrace.sources.readers import parse_lines
from clustertrace.sources.schemas import mandatory

_BAD = "_malformed"


def count_issues(df: DataFrame, schema: StructType, malformed: str | None = None) -> DataFrame:
    """Number of faulty rows per kind of fault, as ``(issue, n_rows)``.

    One row per mandatory column, ``missing <column>``, and one called
    ``malformed`` when ``malformed`` names the column with unparsable lines. A
    malformed row is not also counted as missing a column. Kinds without a
    faulty row are listed with 0.
    """
    sound = F.lit(True) if malformed is None else F.col(malformed).isNull()
    checks = {f"missing {c}": sound & F.col(c).isNull() for c in mandatory(schema)}
    if malformed is not None:
        checks = {"malformed": ~sound, **checks}
    counts = df.agg(
        *(F.count(F.when(check, 1)).alias(f"n{i}") for i, check in enumerate(checks.values()))
    )
    issues = F.array(
        *(
            F.struct(F.lit(issue).alias("issue"), F.col(f"n{i}").alias("n_rows"))
            for i, issue in enumerate(checks)
        )
    )
    return counts.select(F.inline(issues))


def validate_trace(spark: SparkSession, path: str | Sequence[str], schema: StructType) -> DataFrame:
    """Check every field of trace files, counting faulty rows instead of failing.

    A row is malformed when it has too few or too many fields or a number does
    not parse.
    """
    paths = path if isinstance(path, str) else list(path)
    # As lines of text, since the CSV reader neither parses nor checks a field that a plan doesn't use.
    rows = parse_lines(spark.read.text(paths), "value", schema, malformed=_BAD)
    return count_issues(rows, schema, _BAD)
