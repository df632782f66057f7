"""Column lists and types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from numprep.plans.model import quoted
from numprep.plans.spec import ColumnSpec


def conform(df: DataFrame) -> DataFrame:
    """Text stays text, whole numbers become bigint, and everything else becomes double."""
    selected = []
    for field in df.schema.fields:
        column = quoted(field.name)
        if isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.BooleanType) or isinstance(field.dataType, T.NumericType):
            column = column.cast("double")
        elif not isinstance(field.dataType, T.StringType):
            raise ValueError(f"column {field.name!r} is {field.dataType.simpleString()}, neither text nor a number")
        selected.append(column.alias(field.name))
    return df.select(*selected)


def align(df: DataFrame, other: DataFrame) -> DataFrame:
    """The columns of ``other``, in its order."""
    return df.select(*[quoted(name) for name in other.columns])


def restrict(df: DataFrame, specs: Iterable[ColumnSpec]) -> DataFrame:
    """The configured columns, in configuration order."""
    return df.select(*[quoted(spec.column) for spec in specs])


def one_row_per(rows: list[dict], df: DataFrame) -> DataFrame:
    """Turn a table of one wide row into one row for each of ``rows``, which map names to its columns."""
    structs = [F.struct(*[column.alias(name) for name, column in row.items()]) for row in rows]
    return df.select(F.inline(F.array(*structs)))
