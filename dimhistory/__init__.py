"""Type-2 history tables on Spark."""

from dimhistory.plans.merge import (
    accept_snapshot,
    initial_load,
    merge_history,
    merge_with_rejects,
)
from dimhistory.sources.staging import Staging
from dimhistory.spec import HistorySpec

__all__ = [
    "HistorySpec",
    "Staging",
    "accept_snapshot",
    "initial_load",
    "merge_history",
    "merge_with_rejects",
]
