"""Readers for the headerless trace files.

``path`` is one path, a glob or a list. Gzipped parts are read as they are, but
a gzipped file cannot be split, so one file is one task: pass ``partitions`` to
spread its rows before a heavy plan.

``mode`` is Spark's CSV mode. FAILFAST, the default, raises on a bad number or a
row with too few or too many fields. Spark parses only the columns a plan needs,
so a field that no one reads is not checked; ``validate_trace`` checks them all.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from clustertrace.sources.schemas import (
    JOB_EVENTS,
    MACHINE_EVENTS,
    TASK_EVENTS,
    TASK_USAGE,
    file_schema,
    flags,
)

# Fields are split on commas alone, without quoting, and trimmed.
CSV_OPTIONS = {
    "sep": ",",
    "quote": "",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}


def _with_flags(df: DataFrame, schema: StructType) -> DataFrame:
    casts = {name: F.col(name).cast("boolean") for name in flags(schema)}
    return df.withColumns(casts) if casts else df


def read_trace(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    mode: str = "FAILFAST",
    partitions: int | None = None,
) -> DataFrame:
    """Read trace files of the given schema."""
    paths = path if isinstance(path, str) else list(path)
    df = spark.read.schema(file_schema(schema)).options(**CSV_OPTIONS, mode=mode).csv(paths)
    if partitions is not None:
        df = df.repartition(partitions)
    return _with_flags(df, schema)


def read_machine_events(spark, path, mode="FAILFAST", partitions=None) -> DataFrame:
    return read_trace(spark, path, MACHINE_EVENTS, mode, partitions)


def read_job_events(spark, path, mode="FAILFAST", partitions=None) -> DataFrame:
    return read_trace(spark, path, JOB_EVENTS, mode, partitions)


def read_task_events(spark, path, mode="FAILFAST", partitions=None) -> DataFrame:
    return read_trace(spark, path, TASK_EVENTS, mode, partitions)


def read_task_usage(spark, path, mode="FAILFAST", partitions=None) -> DataFrame:
    return read_trace(spark, path, TASK_USAGE, mode, partitions)


def parse_lines(
    lines: DataFrame,
    line: str,
    schema: StructType,
    mode: str = "FAILFAST",
    malformed: str | None = None,
) -> DataFrame:
    """Parse a text column of trace lines, wherever the lines come from.

    The rules are those of the file readers. Blank lines, of white space of any
    kind, are skipped as the readers do. ``malformed`` names a column that keeps the
    text of each line that can't be parsed (too few or too many fields, a bad
    number) and of each NULL line, as an empty text; it is NULL for sound lines.
    Nothing raises then, and the other columns of such a line are NULL or what could
    be read. Without it, NULL lines are skipped as well.
    """
    text = F.col(line)
    fields = file_schema(schema)
    options = {**CSV_OPTIONS, "mode": mode}
    if malformed is not None:
        fields = fields.add(malformed, StringType())
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": malformed}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.fields)
    # The CSV reader takes every character up to the space for blank.
    sound = text.rlike(r"[^\x00-\x20]")
    wanted = sound if malformed is None else sound | text.isNull()
    rows = lines.where(wanted).select(text.alias("_line"), F.from_csv(text, ddl, options).alias("row"))
    if malformed is None:
        return _with_flags(rows.select("row.*"), schema)
    bad = F.when(F.col("_line").isNull(), F.lit("")).otherwise(F.col(f"row.`{malformed}`"))
    known = [F.col(f"row.`{f.name}`").alias(f.name) for f in file_schema(schema).fields]
    return _with_flags(rows.select(*known, bad.alias(malformed)), schema)
