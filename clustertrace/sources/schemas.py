"""The four trace tables and their event codes.

Column order is the order of the fields in the headerless CSV files. A column
that is not nullable here is mandatory in the trace; Spark's CSV reader does not
enforce that, ``quality`` checks it. Times are whole microseconds and stay
BIGINT: they are only compared and subtracted.
"""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Machine event codes.
ADD, REMOVE, UPDATE = 0, 1, 2

# Job and task event codes.
SUBMIT, SCHEDULE, EVICT, FAIL, FINISH, KILL, LOST = 0, 1, 2, 3, 4, 5, 6
UPDATE_PENDING, UPDATE_RUNNING = 7, 8

ENDINGS = (EVICT, FAIL, FINISH, KILL, LOST)

MACHINE_KEY = ["machine_id"]
TASK_KEY = ["job_id", "task_index"]


def _table(*columns: tuple) -> StructType:
    return StructType(
        [StructField(name, kind, "required" not in rest) for name, kind, *rest in columns]
    )


_BIGINT, _INT, _DOUBLE = LongType(), IntegerType(), DoubleType()
_STRING, _BOOLEAN = StringType(), BooleanType()

# The fields of the four files, in the order in which they stand there.
MACHINE_EVENTS = _table(
    ("time", _BIGINT, "required"),
    ("machine_id", _BIGINT, "required"),
    ("event_type", _INT, "required"),
    ("platform_id", _STRING),
    ("cpus", _DOUBLE),
    ("memory", _DOUBLE),
)

JOB_EVENTS = _table(
    ("time", _BIGINT, "required"),
    ("missing_info", _INT),
    ("job_id", _BIGINT, "required"),
    ("event_type", _INT, "required"),
    ("user", _STRING),
    ("scheduling_class", _INT),
    ("job_name", _STRING),
    ("logical_job_name", _STRING),
)

TASK_EVENTS = _table(
    ("time", _BIGINT, "required"),
    ("missing_info", _INT),
    ("job_id", _BIGINT, "required"),
    ("task_index", _BIGINT, "required"),
    ("machine_id", _BIGINT),
    ("event_type", _INT, "required"),
    ("user", _STRING),
    ("scheduling_class", _INT),
    ("priority", _INT, "required"),
    ("cpu_request", _DOUBLE),
    ("memory_request", _DOUBLE),
    ("disk_space_request", _DOUBLE),
    ("different_machines", _BOOLEAN),
)

TASK_USAGE = _table(
    ("start_time", _BIGINT, "required"),
    ("end_time", _BIGINT, "required"),
    ("job_id", _BIGINT, "required"),
    ("task_index", _BIGINT, "required"),
    ("machine_id", _BIGINT, "required"),
    ("cpu_rate", _DOUBLE),
    ("canonical_memory", _DOUBLE),
    ("assigned_memory", _DOUBLE),
    ("unmapped_page_cache", _DOUBLE),
    ("total_page_cache", _DOUBLE),
    ("max_memory_usage", _DOUBLE),
    ("disk_io_time", _DOUBLE),
    ("local_disk_space", _DOUBLE),
    ("max_cpu_rate", _DOUBLE),
    ("max_disk_io_time", _DOUBLE),
    ("cycles_per_instruction", _DOUBLE),
    ("memory_accesses_per_instruction", _DOUBLE),
    ("sample_portion", _DOUBLE),
    ("aggregation_type", _BOOLEAN),
    ("sampled_cpu_usage", _DOUBLE),
)


def file_schema(schema: StructType) -> StructType:
    """The schema as written in the files: every field may be empty, flags are 0/1."""
    return StructType(
        [
            StructField(f.name, _INT if f.dataType == _BOOLEAN else f.dataType, True)
            for f in schema.fields
        ]
    )


def flags(schema: StructType) -> list[str]:
    """Columns the files hold as 0/1 and the tables expose as BOOLEAN."""
    return [f.name for f in schema.fields if f.dataType == _BOOLEAN]


def mandatory(schema: StructType) -> list[str]:
    """Columns that must not be empty."""
    return [f.name for f in schema.fields if not f.nullable]
