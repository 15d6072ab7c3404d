"""Deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct full rows; copies collapse before the shuffle."""
    return df.dropDuplicates()


def dedup_first(df: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """First row per key under ``order`` (default: all other columns, so the pick is repeatable).

    Spark keeps only the first row per key in each map task before it shuffles
    (``WindowGroupLimit``), so a key with very many copies does not load one task.
    """
    order = order or [c for c in df.columns if c not in keys] or keys
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")
