"""Row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def drop_null_key(df: DataFrame, key: str = "entity_id") -> DataFrame:
    return df.where(F.col(key).isNotNull())


def drop_null_value(df: DataFrame, value: str = "amount") -> DataFrame:
    return df.where(F.col(value).isNotNull())


def year_range(df: DataFrame, after: int = 2022, before: int = 2026, col: str = "yr") -> DataFrame:
    """Rows with ``after < year < before``; reaches the scan as a pushed filter."""
    return df.where((F.col(col) > after) & (F.col(col) < before))


def in_top_groups(df: DataFrame, top: DataFrame, key: str = "grp") -> DataFrame:
    """Rows whose group is in a top-N frame. The frame ends in ``limit(N)``, which bounds the broadcast."""
    return df.join(F.broadcast(top.select(key)), key, "left_semi")


def active_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("activity") > 0)


def nonnegative_spend(df: DataFrame) -> DataFrame:
    return df.where(F.col("spend_total") >= 0)


def drop_zero_rows(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Rows whose metrics sum to more than 0 (NULL counts as 0)."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(m).cast("double"), F.lit(0.0)) for m in metrics])
    return df.where(total > 0)
