"""Long to wide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsnorm.functions.names import value_column


def order_names(names: Sequence[str]) -> list[str]:
    """Instrument order of the output: by name without regard to case."""
    return sorted(names, key=lambda n: (n.lower(), n))


def check_case(df: DataFrame, names: Sequence[str]) -> None:
    """Instruments that differ only in case need case-sensitive column names."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    if not sensitive and len({n.lower() for n in names}) < len(names):
        raise ValueError("instrument names differ only in case: set spark.sql.caseSensitive to true")


def wide_columns(names: Sequence[str], stats: Sequence[str], single: set[str] = frozenset()) -> list[tuple[str, str, str]]:
    """(output column, instrument, statistic) in output order.

    One statistic: ``value_X``. Several: ``value_X_<stat>``; an upsampled instrument, in
    ``single``, has no statistics and keeps ``value_X``.
    """
    out = []
    for name in order_names(names):
        if len(stats) == 1 or name in single:
            out.append((value_column(name), name, stats[0]))
        else:
            out.extend((f"{value_column(name)}_{s}", name, s) for s in stats)
    return out


def wide_pivot(
    long: DataFrame,
    columns: Sequence[tuple[str, str, str]],
    ids: Sequence[str] = ("timestamp",),
    clustered: Sequence[str] = (),
) -> DataFrame:
    """One row per time and one column per (instrument, statistic); missing becomes 0.0.

    ``long`` has one row per (ids, instrument). The column list is given, so no job looks for
    it. ``clustered`` names columns the rows are partitioned by already.
    """
    check_case(long, [c for c, _, _ in columns])
    names = list(dict.fromkeys(n for _, n, _ in columns))
    stats = list(dict.fromkeys(s for _, _, s in columns))
    pivoted = long.groupBy(*clustered, *ids).pivot("instrument", names).agg(*[F.first(s).alias(s) for s in stats])
    made = {(n, s): n if len(stats) == 1 else f"{n}_{s}" for n in names for s in stats}

    def quoted(name: str):
        return F.col("`" + name.replace("`", "``") + "`")

    return pivoted.select(*ids, *[
        F.coalesce(quoted(made[n, s]), F.lit(0.0)).alias(out) for out, n, s in columns
    ])
