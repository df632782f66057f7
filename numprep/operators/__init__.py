"""Table-level operators: shaping, profiling, comparison and resource telemetry."""

from numprep.operators.compare import diff_rows, diff_summary, round_trip
from numprep.operators.intervals import interval_join, total_before
from numprep.operators.multiset import diff_repeated, pair_repeated
from numprep.operators.profile import profile
from numprep.operators.shape import align, conform, restrict
from numprep.operators.telemetry import (
    advise,
    analyze,
    counter_rate,
    level,
    phase_bounds,
    phase_durations,
    phase_seconds,
    rescale_time,
    share,
    speed_up,
    split_by_phase,
    summarize,
    timing_cells,
    timing_table,
)

__all__ = [
    "advise",
    "align",
    "analyze",
    "conform",
    "counter_rate",
    "diff_repeated",
    "diff_rows",
    "diff_summary",
    "interval_join",
    "level",
    "pair_repeated",
    "phase_bounds",
    "phase_durations",
    "phase_seconds",
    "profile",
    "rescale_time",
    "restrict",
    "round_trip",
    "share",
    "speed_up",
    "split_by_phase",
    "summarize",
    "timing_cells",
    "timing_table",
    "total_before",
]
