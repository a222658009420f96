"""Loads every query module, so that the registry is complete."""

from ledgerloom.plans import (  # noqa: F401
    cleaning_queries,
    contract_queries,
    landing_queries,
    lineage_queries,
    medallion,
    observer_queries,
    star_queries,
    stream_queries,
)
from ledgerloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
