"""Reading and writing tables, stored sizes, synthetic tables and the shared scratch folder."""

from numprep.sources.generate import dataset_gib, generate, generate_columns, rows_for_bytes
from numprep.sources.samples import unpack_samples
from numprep.sources.scratch import scratch_path
from numprep.sources.tables import read_table, stored_bytes, write_table

__all__ = [
    "dataset_gib",
    "generate",
    "generate_columns",
    "read_table",
    "rows_for_bytes",
    "scratch_path",
    "stored_bytes",
    "unpack_samples",
    "write_table",
]
