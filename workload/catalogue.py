"""Imports every query module, so that the registry is complete."""

from workload import shared_sql  # noqa: F401
from workload import cleaning_queries  # noqa: F401
from workload import source_queries  # noqa: F401
from workload import window_queries  # noqa: F401
from workload import current_queries  # noqa: F401
from workload import feature_queries  # noqa: F401
from workload import scoring_queries  # noqa: F401
from workload import cluster_queries  # noqa: F401
from workload import tensor_queries  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
