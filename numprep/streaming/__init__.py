"""Applying a fitted model to tables that keep growing."""

from numprep.streaming.scale import scale_new_files

__all__ = ["scale_new_files"]
