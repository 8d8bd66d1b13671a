"""The registered queries over the catalogue operators, each with its SQL."""

from skeinwork.plans import analysis, batching, dedup, identity, incremental, pages, projections, sync
from skeinwork.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "analysis", "batching", "dedup", "identity", "incremental", "pages", "projections", "sync"]
