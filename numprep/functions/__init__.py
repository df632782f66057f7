"""Column expressions: reading, rounding, writing and range-checking numbers."""

from numprep.functions.numbers import (
    bare_text,
    compiled_apart,
    is_number_text,
    number_text,
    parse_number,
    round_places,
    write_number,
)
from numprep.functions.ranges import clip, outside
from numprep.functions.times import seconds, ticks

__all__ = [
    "bare_text",
    "clip",
    "compiled_apart",
    "is_number_text",
    "number_text",
    "outside",
    "parse_number",
    "round_places",
    "seconds",
    "ticks",
    "write_number",
]
