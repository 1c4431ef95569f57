"""Reusable operators: DataFrame in, DataFrame out, column names as parameters."""

from clustertrace.operators.gaps import down_class, gap_loss, gap_loss_by_class, trace_end, uptime_capacity
from clustertrace.operators.latest import first_by_key, latest_by_key, max_with
from clustertrace.operators.profile import density_grid, max_request, mean_by, request_ratio
from clustertrace.operators.rates import (
    any_event,
    count_by,
    event_rate,
    fanout_histogram,
    hit_summary,
    share_by,
)
from clustertrace.operators.sliced import HOUR, MINUTE, SLICE, running
from clustertrace.operators.steps import carry_forward, over_limit_fraction, running_level

__all__ = [
    "HOUR",
    "MINUTE",
    "SLICE",
    "any_event",
    "carry_forward",
    "count_by",
    "density_grid",
    "down_class",
    "event_rate",
    "fanout_histogram",
    "first_by_key",
    "gap_loss",
    "gap_loss_by_class",
    "hit_summary",
    "latest_by_key",
    "max_request",
    "max_with",
    "mean_by",
    "over_limit_fraction",
    "request_ratio",
    "running",
    "running_level",
    "share_by",
    "trace_end",
    "uptime_capacity",
]
