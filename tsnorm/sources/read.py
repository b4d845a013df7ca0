"""Layout dispatch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Observation, SparkSession

from tsnorm.session import Scratch, require_utc
from tsnorm.sources.archive import read_archive
from tsnorm.sources.normalized import read_normalized
from tsnorm.sources.scan import CsvOptions, Readings
from tsnorm.sources.strain import read_strain
from tsnorm.sources.trend import read_trend

LAYOUTS = {
    "archive": read_archive,
    "trend": read_trend,
    "normalized": read_normalized,
    "strain": read_strain,
}


def read(
    spark: SparkSession,
    layout: str,
    paths: str | Sequence[str],
    opts: CsvOptions | None = None,
    *,
    per_file: bool = False,
    scratch: Scratch | None = None,
    parsed: Observation | None = None,
) -> Readings:
    """Readings of files in one of the four layouts.

    ``paths`` are merged in the order given (later files win), or, with ``per_file``, every
    file is a data set of its own, keyed by ``source_file``, and paths that do not exist are left out.
    ``parsed`` observes what is read, see :class:`Source`.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {sorted(LAYOUTS)}, not {layout!r}")
    require_utc(spark)
    entries = [paths] if isinstance(paths, str) else list(paths)
    return LAYOUTS[layout](spark, entries, opts or CsvOptions(), per_file, scratch or Scratch(spark), parsed)
