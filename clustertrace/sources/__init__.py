"""Trace schemas, readers, row checks and result writers."""

from clustertrace.sources.quality import count_issues, validate_trace
from clustertrace.sources.readers import (
    parse_lines,
    read_job_events,
    read_machine_events,
    read_task_events,
    read_task_usage,
)
from clustertrace.sources.results import rounded, with_log_count, write_result
from clustertrace.sources.schemas import (
    JOB_EVENTS,
    MACHINE_EVENTS,
    TASK_EVENTS,
    TASK_USAGE,
)
from clustertrace.sources.staging import new_path, shared_dir

__all__ = [
    "JOB_EVENTS",
    "MACHINE_EVENTS",
    "TASK_EVENTS",
    "TASK_USAGE",
    "count_issues",
    "new_path",
    "parse_lines",
    "read_job_events",
    "read_machine_events",
    "read_task_events",
    "read_task_usage",
    "rounded",
    "shared_dir",
    "validate_trace",
    "with_log_count",
    "write_result",
]
