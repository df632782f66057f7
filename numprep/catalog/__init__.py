"""Registered queries over the supplied tables, each with its DuckDB counterpart where SQL can say it."""

from numprep.catalog import comparison, preparation, tables, telemetry
from numprep.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "comparison", "preparation", "tables", "telemetry"]
