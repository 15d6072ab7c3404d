"""Part-of-whole hierarchies from a rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import sum_money
from .ranking import top_entities


def _hierarchy(df: DataFrame, path: list[str], size: str, colour: str) -> DataFrame:
    """``depth, path..., size, colour`` for root, inner nodes and leaves.

    Size is the sum; colour is the mean of ``colour`` weighted by size (NULL where all sizes are 0).
    """
    total = sum_money(F.col(size))
    weighted = F.sum(F.col(colour).cast("double") * F.col(size).cast("double"))
    grouped = df.rollup(*path).agg(
        total.alias("size"), (weighted / F.nullif(total, F.lit(0.0))).alias("colour"),
        sum((F.lit(1) - F.grouping(c) for c in path), F.lit(0)).cast("int").alias("depth"),
    )
    return grouped.select("depth", *path, "size", "colour")


def spend_hierarchy(df: DataFrame, n: int = 120) -> DataFrame:
    """Root > group > region > entity over the top-N spenders, coloured by cost per activity."""
    colour = "cost_per_activity" if "cost_per_activity" in df.columns else "activity"
    return _hierarchy(top_entities(df, n), ["grp", "region", "name"], "spend_total", colour)


def category_hierarchy(grid: DataFrame) -> DataFrame:
    """Root > group > category > entity over the dense grid, coloured by its own value."""
    return _hierarchy(grid, ["grp", "category", "name"], "spend", "spend")
