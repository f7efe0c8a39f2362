"""Queries over the driver tables, one or more per operator."""

from tallyloom.workload import fees, grouping, ingestion, joining, ranking, reports, scalars, snapshots  # noqa: F401
from tallyloom.workload.registry import REGISTRY  # noqa: F401
