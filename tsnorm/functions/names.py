"""Instrument-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header names of the time-normalized layout that hold no instrument.
BIAS_NAMES = ["Bias", "Time Bias"]


def sanitize_name(name: Column) -> Column:
    """Blanks, hyphens and dots become underscores."""
    return F.translate(name, " -.", "___")


def trend_name(header: Column) -> Column:
    """Header text before its last blank, or all of it when there is nothing before one."""
    before = F.regexp_replace(header, " [^ ]*$", "")
    return F.when(before == "", F.ltrim(header)).otherwise(before)


def value_name(name: Column) -> Column:
    """Output column name: prefixed with ``value_`` unless it starts with ``value`` already."""
    return F.when(name.startswith("value"), name).otherwise(F.concat(F.lit("value_"), name))


def value_column(name: str) -> str:
    """:func:`value_name` for a name already on the driver."""
    return name if name.startswith("value") else "value_" + name


def unit_label(tag: Column, unit: Column) -> Column:
    """``tag (unit)``; strain is given in microstrain; no unit, no suffix."""
    shown = F.when(F.lower(unit) == "strain", F.lit("uStrain")).otherwise(unit)
    return F.when(unit.isNull() | (unit == ""), tag).otherwise(F.concat(tag, F.lit(" ("), shown, F.lit(")")))
