"""CSV output and stored series."""

from tsnorm.sinks.csv import write_files, write_run, write_wide
from tsnorm.sinks.store import SeriesStore

__all__ = ["SeriesStore", "write_files", "write_run", "write_wide"]
