"""Readers of the four logger layouts. Each gives one long table of readings."""

from tsnorm.sources.read import LAYOUTS, read
from tsnorm.sources.scan import CsvOptions, DuplicateColumns, NoData, Readings

__all__ = ["LAYOUTS", "CsvOptions", "DuplicateColumns", "NoData", "Readings", "read"]
