"""Time columns as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ticks(time: Column, data_type: T.DataType) -> tuple[Column, float]:
    """Time as a sortable number, and how many of its units make a second.

    Timestamps become microseconds since 1970; those without a zone do so without regard to the session's, where
    ``timestamp_diff`` would be an hour off around a change of the clocks. Numbers are seconds already.
    """
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(time), 1e6
    if isinstance(data_type, T.TimestampNTZType):
        since = time - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return (since.cast("interval second").cast("decimal(18,6)") * F.lit(1_000_000)).cast("bigint"), 1e6
    return time.cast("double"), 1.0


def seconds(tick: Column, per_second: float) -> Column:
    """Ticks in seconds."""
    return tick if per_second == 1.0 else tick / F.lit(per_second)
