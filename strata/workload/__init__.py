"""Every operator and job as a query over the test tables, with the SQL it must equal."""

from strata.workload import dimensions, facts, ingest, jobs, shaping, versions  # noqa: F401  (they register)
from strata.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
