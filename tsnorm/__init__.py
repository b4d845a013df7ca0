"""Alignment of instrument time series on Spark."""

from tsnorm.plans import Aligned, Report, normalize, normalize_files
from tsnorm.session import SETTINGS, configure
from tsnorm.sinks import SeriesStore, write_files, write_run, write_wide
from tsnorm.sources import CsvOptions, DuplicateColumns, NoData, Readings, read

__all__ = [
    "SETTINGS", "Aligned", "CsvOptions", "DuplicateColumns", "NoData", "Readings", "Report", "SeriesStore", "configure",
    "normalize", "normalize_files", "read", "write_files", "write_run", "write_wide",
]
