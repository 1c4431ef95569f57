"""The four trace tables as views over the order and line-item test tables.

The trace itself is not available, so each table is derived row by row from
columns that spread well over machines, classes and event codes. No row of the
base tables is left out.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A request is the quantity over this number. It keeps sums of requests from
# ever equalling a machine capacity and request ratios from landing on 50.
REQUEST_SCALE = 400.5

_SECOND = 1_000_000
_DAY = 86_400 * _SECOND


def _seconds(timestamp: str) -> Column:
    return F.expr(
        f"timestampdiff(SECOND, TIMESTAMP_NTZ '1995-01-01 00:00:00', CAST({timestamp} AS TIMESTAMP_NTZ))"
    )


def _steps(df: DataFrame, n: int) -> DataFrame:
    """Repeat every row once per step k = 0 .. n-1."""
    return df.withColumn("k", F.explode(F.array(*(F.lit(k) for k in range(n)))))


def _line_base() -> Column:
    return (_seconds("l_shipdate") + F.col("l_partkey") % 86_400) * _SECOND


def machine_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return orders.select(
        (_seconds("o_orderdate") * _SECOND + F.col("o_orderkey")).alias("time"),
        F.floor(F.col("o_custkey") / F.lit(15.0)).alias("machine_id"),
        F.when(status == "F", 0).when(status == "O", 1).otherwise(2).alias("event_type"),
        F.when(F.col("o_custkey") % 23 == 0, None)
        .when(priority == "1-URGENT", 0.25)
        .when(priority == "2-HIGH", 1.0)
        .otherwise(0.5)
        .alias("cpus"),
    )


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _steps(spark.read.parquet(f"{sf_dir}/orders.parquet"), 3)
    last, priority = F.col("o_custkey") % 10, F.col("o_orderpriority")
    return orders.select(
        (_seconds("o_orderdate") * _SECOND + F.col("k") * (60 * _SECOND)).alias("time"),
        F.col("o_orderkey").alias("job_id"),
        F.when(F.col("k") < 2, F.col("k"))
        .when(last == 0, 2)
        .when(last == 1, 3)
        .when(last.isin(2, 3, 4), 5)
        .otherwise(4)
        .alias("event_type"),
        F.when(F.col("o_custkey") % 41 == 0, None)
        .when(priority == "1-URGENT", 3)
        .when(priority == "2-HIGH", 2)
        .when(priority == "3-MEDIUM", 1)
        .otherwise(0)
        .alias("scheduling_class"),
    )


def task_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _steps(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), 3)
    k, part, supplier = F.col("k"), F.col("l_partkey"), F.col("l_suppkey")
    quantity = F.col("l_quantity").cast("bigint")
    start = _line_base() + 30 * _SECOND
    evicted = (part % 10).isin(0, 1) & (supplier % 4 != 3) & (quantity % 12 != 7)
    return lines.select(
        F.when(k == 0, _line_base())
        .when(k == 1, start)
        .otherwise(start + quantity * _DAY)
        .alias("time"),
        F.col("l_orderkey").alias("job_id"),
        F.col("l_linenumber").cast("bigint").alias("task_index"),
        F.when(k > 0, supplier).alias("machine_id"),
        F.when(k < 2, k)
        .when(evicted, 2)
        .when(part % 10 == 2, 3)
        .when(part % 10 == 3, 5)
        .when(part % 10 == 4, 6)
        .otherwise(4)
        .alias("event_type"),
        F.when(part % 29 != 0, (supplier % 4).cast("int")).alias("scheduling_class"),
        (quantity % 12).cast("int").alias("priority"),
        F.when(part % 31 != 0, F.col("l_quantity") / REQUEST_SCALE).alias("cpu_request"),
    )


def task_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _steps(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), 2)
    k, window = F.col("k"), 300 * _SECOND
    start = _line_base() + 30 * _SECOND + k * window
    return lines.select(
        start.alias("start_time"),
        (start + window).alias("end_time"),
        F.col("l_orderkey").alias("job_id"),
        F.col("l_linenumber").cast("bigint").alias("task_index"),
        F.col("l_suppkey").alias("machine_id"),
        F.when(F.col("l_partkey") % 37 != 0, F.col("l_discount") * (k + 1) / 20).alias("cpu_rate"),
    )
