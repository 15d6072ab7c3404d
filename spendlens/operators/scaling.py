"""Column scaling by whole-table statistics. One row of statistics reaches the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _statistics(df: DataFrame, columns: list[str], first, second) -> dict[str, tuple]:
    row = df.agg(
        *[first(F.col(c).cast("double")) for c in columns], *[second(F.col(c).cast("double")) for c in columns]
    ).first()
    return {c: (row[i], row[len(columns) + i]) for i, c in enumerate(columns)}


def _shifted(name: str, origin: float | None, width: float | None) -> Column:
    if origin is None or not width:
        return F.lit(0.0)
    return (F.col(name).cast("double") - F.lit(origin)) / F.lit(width)


def minmax_scale(df: DataFrame, columns: list[str], suffix: str = "_scaled") -> DataFrame:
    """(x - min) / (max - min); 0 where the column is constant."""
    stats = _statistics(df, columns, F.min, F.max)
    return df.withColumns({
        f"{c}{suffix}": _shifted(c, low, None if low is None else high - low) for c, (low, high) in stats.items()
    })


def zscore(df: DataFrame, columns: list[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / population standard deviation; a zero deviation counts as 1, NULL becomes 0."""
    stats = _statistics(df, columns, F.avg, F.stddev_pop)
    return df.withColumns({
        f"{c}{suffix}": F.coalesce(_shifted(c, mean, deviation or 1.0), F.lit(0.0)) for c, (mean, deviation) in stats.items()
    })
