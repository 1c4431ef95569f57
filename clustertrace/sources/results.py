"""Result tables: rounding, log axis, writing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def rounded(df: DataFrame, places: int = 2) -> DataFrame:
    """Round every DOUBLE column, as a printed report does."""
    return df.select(
        *(
            F.round(f.name, places).alias(f.name) if f.dataType == DoubleType() else f.name
            for f in df.schema.fields
        )
    )


def with_log_count(df: DataFrame, count: str, name: str = "log10_n") -> DataFrame:
    """Add the base-10 logarithm of a count, for heavy-tailed histograms."""
    return df.withColumn(name, F.log10(count))


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write a result table in parallel, as Parquet or CSV with a header."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)
