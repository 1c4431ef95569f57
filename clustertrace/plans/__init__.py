"""The thirteen analytics."""

from clustertrace.plans.machines import (
    capacity_distribution,
    loss_share_by_capacity,
    maintenance_loss_pct,
)
from clustertrace.plans.overcommit import overcommit_by_machine, overcommit_fraction
from clustertrace.plans.usage import (
    overestimation_by_class,
    overestimation_by_eviction,
    request_vs_usage,
    usage_vs_evictions,
)
from clustertrace.plans.workload import (
    class_share_jobs_tasks,
    evicted_or_killed,
    eviction_rate_by_class,
    eviction_rate_by_priority,
    machines_per_job,
)

__all__ = [
    "capacity_distribution",
    "class_share_jobs_tasks",
    "evicted_or_killed",
    "eviction_rate_by_class",
    "eviction_rate_by_priority",
    "loss_share_by_capacity",
    "machines_per_job",
    "maintenance_loss_pct",
    "overcommit_by_machine",
    "overcommit_fraction",
    "overestimation_by_class",
    "overestimation_by_eviction",
    "request_vs_usage",
    "usage_vs_evictions",
]
