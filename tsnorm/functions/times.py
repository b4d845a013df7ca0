"""Time expressions: parsing, rounding, flooring, formatting, period and bound arguments."""

from __future__ import annotations

import calendar
import re
import warnings
from datetime import datetime, time, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from tsnorm.functions.values import lenient_double

# The %-codes accepted in time formats and their Spark letters.
# Reading uses single letters, which accept padded and unpadded numbers.
READ_CODES = {
    "%Y": "yyyy", "%y": "yy", "%m": "M", "%b": "MMM", "%B": "MMMM", "%d": "d",
    "%H": "H", "%I": "h", "%M": "m", "%S": "s", "%f": "SSSSSSSSS", "%p": "a",
}
WRITE_CODES = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%b": "MMM", "%B": "MMMM", "%d": "dd",
    "%H": "HH", "%I": "hh", "%M": "mm", "%S": "ss", "%f": "SSSSSS", "%p": "a",
}

# The time format of each layout when the caller names none.
DEFAULT_FORMATS = {
    "trend": "%m/%d/%Y %H:%M:%S.%f",
    "archive": "%Y-%m-%d %H:%M:%S.%f",
    "normalized": "%Y-%m-%d %H:%M:%S.%f",
    "strain": "%m/%d/%Y %I:%M:%S %p",
}

# Patterns tried, in this order, on a cell the declared format rejects.
DASH_PATTERNS = [
    "yyyy-M-d H:m:s[.SSSSSSSSS]",
    "yyyy-M-d'T'H:m:s[.SSSSSSSSS]",
    "yyyy-M-d H:m",
    "yyyy-M-d",
]
SLASH_PATTERNS = [
    "M/d/yyyy h:m:s[.SSSSSSSSS] a",
    "M/d/yyyy H:m:s[.SSSSSSSSS]",
    "M/d/yyyy h:m a",
    "M/d/yyyy H:m",
    "M/d/yyyy",
]

# A date and a time, as the cast to a timestamp reads them.
ISO_SHAPE = r"^\s*\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d*)?)?\s*(Z|UTC|[+-]\d{1,2}(:?\d{2})?)?\s*$"

# Microseconds in each sampling-period unit.
PERIOD_UNITS = {
    "D": 86_400_000_000, "H": 3_600_000_000, "T": 60_000_000, "MIN": 60_000_000,
    "S": 1_000_000, "L": 1_000, "MS": 1_000,
}
ONE_SECOND_US = 1_000_000
# About 3,000 years: more cannot be an elapsed time.
MOST_ELAPSED_US = 10**17


def _translate(fmt: str, codes: dict[str, str], fraction: str | None) -> str:
    out = []
    for token in re.findall(r"\.%f|%.|[A-Za-z]+|[^A-Za-z%.]+|.", fmt):
        if token == ".%f" and fraction:
            out.append(fraction)
        elif token == ".%f":
            out.append("." + codes["%f"])
        elif token in codes:
            out.append(codes[token])
        elif token == "%%":
            out.append("%")
        elif token.startswith("%"):
            raise ValueError(f"time format code {token} is not supported")
        elif token[0].isalpha() or token in ("[", "]", "{", "}", "#"):
            out.append(f"'{token}'")
        else:
            out.append(token)
    return "".join(out)


def read_pattern(fmt: str) -> str:
    """Spark pattern that reads ``fmt``; a fraction of any length, or none, is accepted."""
    return _translate(fmt, READ_CODES, "[.SSSSSSSSS]")


def write_pattern(fmt: str) -> str:
    return _translate(fmt, WRITE_CODES, None)


def infer_ts(text: Column) -> Column:
    """Timestamp of a cell in one of the usual layouts, else NULL.

    A failed pattern costs an exception in the JVM, so text that cannot be a date is told
    apart first and only the patterns with its separator are tried.
    """
    def first_of(patterns: list[str]) -> Column:
        return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns])

    return F.when(text.rlike(r"^\d{4}-\d"), first_of(DASH_PATTERNS)).when(
        text.rlike(r"^\d{1,2}/\d"), first_of(SLASH_PATTERNS))


def parse_ts(text: Column, fmt: str) -> Column:
    """Timestamp of a text cell; NULL when neither ``fmt`` nor a usual layout fits.

    The ISO layout goes through the cast, about six times faster than a pattern. The cast also takes
    years or times alone, so the text must have the shape of a date with a time.
    """
    if fmt == "%Y-%m-%d %H:%M:%S.%f":
        first = F.when(text.rlike(ISO_SHAPE), text.try_cast("timestamp"))
    else:
        first = F.try_to_timestamp(text, F.lit(read_pattern(fmt)))
    return F.coalesce(first, infer_ts(text))


def round_ms(ts: Column, text: Column | None = None) -> Column:
    """Nearest millisecond, ties to even.

    Timestamps hold microseconds. When the source ``text`` is given, digits beyond the sixth
    decide what only looks like a tie. ``ts`` is used once: it is often a long expression.
    """
    us = F.unix_micros(ts).cast("double")
    if text is not None:
        finer = text.rlike(r"\.\d{6}\d*[1-9]")
        us = us + F.when(finer, 0.5).otherwise(0.0)
    return F.timestamp_millis(F.rint(us / 1000).cast("bigint"))


def floor_us(us: Column, period_us: Column | int) -> Column:
    """Start of the period that holds ``us`` (microseconds), counted from the epoch."""
    period = F.lit(period_us) if isinstance(period_us, int) else period_us
    return us - F.pmod(us, period)


def ceil_us(us: Column, period_us: Column | int) -> Column:
    period = F.lit(period_us) if isinstance(period_us, int) else period_us
    return us + F.pmod(-us, period)


def floor_period(ts: Column, period_us: Column | int) -> Column:
    return F.timestamp_micros(floor_us(F.unix_micros(ts), period_us))


def format_ts(ts: Column, fmt: str) -> Column:
    return F.date_format(ts, write_pattern(fmt))


def parse_period(text: str | None) -> int | None:
    """Sampling period in microseconds: unit letters D H T S L, each with an optional count.

    Text that is not a period gives one second, with a warning.
    """
    if text is None:
        return None
    parts = re.findall(r"(\d*)(MIN|MS|[DHTSL])", text.strip().upper())
    total = sum(int(count or 1) * PERIOD_UNITS[unit] for count, unit in parts)
    if "".join(count + unit for count, unit in parts) != text.strip().upper() or total <= 0:
        warnings.warn(f"invalid sampling period {text!r}; using 1 second", stacklevel=2)
        return ONE_SECOND_US
    return total


def _bound_us(value: str | datetime | None, is_end: bool) -> int | None:
    if value is None:
        return None
    if isinstance(value, str):
        text = value.strip()
        moment = None
        for fmt in (None, "%m/%d/%Y %I:%M:%S %p", "%m/%d/%Y %H:%M:%S", "%m/%d/%Y %H:%M", "%m/%d/%Y"):
            try:
                moment = datetime.fromisoformat(text) if fmt is None else datetime.strptime(text, fmt)
                break
            except ValueError:
                continue
        if moment is None:
            try:
                moment = datetime.combine(datetime.now().date(), time.fromisoformat(text))
            except ValueError:
                warnings.warn(f"invalid time bound {value!r}; ignored", stacklevel=3)
                return None
    else:
        moment = value
    if moment.tzinfo is not None:  # readings are on UTC wall clocks
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    if is_end and moment.time() == time(0, 0, 0, 0):
        moment = moment.replace(hour=23, minute=59, second=59, microsecond=999_999)
    return calendar.timegm(moment.timetuple()) * 1_000_000 + moment.microsecond


def start_bound(value: str | datetime | None) -> int | None:
    """Microseconds of an inclusive start; a date alone means its midnight."""
    return _bound_us(value, is_end=False)


def end_bound(value: str | datetime | None) -> int | None:
    """Microseconds of an inclusive end; midnight means the last microsecond of that day."""
    return _bound_us(value, is_end=True)


def end_of_day(ts: Column) -> Column:
    """The end rule as an expression: a time at midnight becomes the end of its day."""
    us = F.unix_micros(ts)
    day = PERIOD_UNITS["D"]
    return F.timestamp_micros(F.when(F.pmod(us, F.lit(day)) == 0, us + (day - 1)).otherwise(us))


def elapsed_unit_us(label: Column) -> Column:
    """Microseconds per unit of an elapsed-time label; NULL when no unit is named in it."""
    low = F.lower(label)
    return (
        F.when(low.contains("milli"), F.lit(1_000))
        .when(low.contains("sec"), F.lit(1_000_000))
        .when(low.contains("min"), F.lit(60_000_000))
        .when(low.contains("hour"), F.lit(3_600_000_000))
        .cast("bigint")
    )


def elapsed_to_ts(start: Column, elapsed: Column, unit_us: Column) -> Column:
    """``start`` plus a number of units; NULL when the elapsed cell is not a number or is beyond all calendars."""
    offset = F.round(lenient_double(elapsed) * unit_us).try_cast("bigint")
    return F.timestamp_micros(F.unix_micros(start) + F.when(F.abs(offset) < MOST_ELAPSED_US, offset))
