"""Column specifications and fitted models."""

from numprep.plans.model import PARAMS_SCHEMA, FittedColumn, FittedModel, fit
from numprep.plans.spec import ColumnSpec, load_specs

__all__ = ["PARAMS_SCHEMA", "ColumnSpec", "FittedColumn", "FittedModel", "fit", "load_specs"]
