"""Metric files: one row per run with parallel lists, a list per metric."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpack_samples(
    runs: DataFrame, keep: Sequence[str], lists: Mapping[str, str], position: str | None = None
) -> DataFrame:
    """One row per sample of each run: the columns to keep, and the n-th element of every list under its new name.

    ``lists`` maps names to columns, or to fields of lists of structs as in ``process_metrics.cpu_percent``. Lists of a run
    may differ in length; the shorter ones, and missing ones, are filled with NULL, and a run without any sample gives no
    row. ``position`` names a column for the sample's number, from 0.
    """
    zipped = F.arrays_zip(*[F.coalesce(F.col(path), F.array()).alias(name) for name, path in lists.items()])
    exploded = runs.select(*keep, F.posexplode(zipped).alias("__at", "__sample"))
    fields = [F.col("__sample").getField(name).alias(name) for name in lists]
    number = [F.col("__at").alias(position)] if position else []
    return exploded.select(*keep, *number, *fields)
