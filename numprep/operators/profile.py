"""What is in the configured columns, before fitting them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from numprep.functions import parse_number
from numprep.operators.shape import one_row_per
from numprep.plans.model import FittedModel, column_types, quoted
from numprep.plans.spec import ColumnSpec, load_specs


def profile(
    df: DataFrame, config: FittedModel | Mapping[str, Mapping] | Iterable[ColumnSpec] | str | Path
) -> DataFrame:
    """One row per column: rows, missing values, unreadable texts, values beyond the bounds, and the range.

    One aggregate over one scan serves all columns. Bounds are the fixed ones, or a fitted model's.
    """
    fitted = isinstance(config, FittedModel)
    specs = list(config.columns) if fitted else load_specs(config)
    types = column_types(df, specs)
    prepared, measures, rows = [], [F.count("*").alias("rows")], []
    for i, spec in enumerate(specs):
        name = spec.column_name if fitted else spec.column
        low, high = (spec.min_val, spec.max_val) if fitted else (spec.fixed_min, spec.fixed_max)
        source, number = quoted(name), F.col(f"v{i}")
        parsed = parse_number(source, types[name], spec.prefix, spec.suffix, spec.strict_affix)
        prepared += [parsed.alias(f"v{i}"), source.isNull().alias(f"n{i}")]
        is_text = isinstance(types[name], T.StringType)
        missing = F.col(f"n{i}") if is_text else number.isNull()
        measures += [
            F.count_if(missing).alias(f"missing{i}"),
            F.count_if(~missing & number.isNull()).alias(f"unreadable{i}"),
            (F.lit(0) if low is None else F.count_if(number < low)).cast("bigint").alias(f"below{i}"),
            (F.lit(0) if high is None else F.count_if(number > high)).cast("bigint").alias(f"above{i}"),
            F.min(number).alias(f"min{i}"),
            F.max(number).alias(f"max{i}"),
        ]
        rows.append(
            {
                "column_name": F.lit(name),
                "source_type": F.lit(types[name].simpleString()),
                "rows": F.col("rows"),
                "missing": F.col(f"missing{i}"),
                "unparsable": F.col(f"unreadable{i}"),
                "below_min": F.col(f"below{i}"),
                "above_max": F.col(f"above{i}"),
                "min": F.col(f"min{i}"),
                "max": F.col(f"max{i}"),
            }
        )
    return one_row_per(rows, df.select(*prepared).agg(*measures))
