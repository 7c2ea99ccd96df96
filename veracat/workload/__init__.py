"""The operators bound to the benchmark tables, each with its SQL restatement where SQL has one."""

from veracat.workload import (  # noqa: F401
    accepting, annotating, cells, deriving, figuring, identifying, quality, quantities, readers, sampling, searching, siting, snapshots,
)
from veracat.workload.registry import REGISTRY

__all__ = ["REGISTRY"]
