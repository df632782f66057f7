"""Numeric column preparation on Spark: fit ranges, scale to [0, 1], and restore units, type and text."""

from numprep.plans import ColumnSpec, FittedColumn, FittedModel, fit, load_specs

__all__ = ["ColumnSpec", "FittedColumn", "FittedModel", "fit", "load_specs"]
