"""Every operator run over the test tables, with its SQL twin."""

from tierkit.workload import checking, layering, nearness, profiling, reshaping, star  # noqa: F401  (they register)
from tierkit.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
