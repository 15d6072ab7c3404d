"""Group marts: matrices, series, dense grids, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.numbers import coerce_whole, replace_values, sum_money
from ..functions.text import DEFAULT_CATEGORY, categories_of, fill_unknown
from ..session import materialize
from .filters import drop_null_key, drop_zero_rows, in_top_groups, year_range
from .order_stats import quantiles
from .ranking import group_totals
from .scaling import minmax_scale, zscore
from .stats import METRICS
from .totals import entity_spend, listed, pivot_sum

PROFILE = ["spend_total", "spend_net", "expense_count", "refund_count", "cost_per_activity"]
# Fixed value: the group renamed after a merger, and its new name.
GROUP_RENAMES = {"PSL": "UNIÃO"}


def group_cells(expenses: DataFrame, entities: DataFrame, dims: list[str],
                columns: tuple[str, ...] = ("grp",)) -> DataFrame:
    """Spend by group (and name) and the given dimensions, over all groups; stored.

    Facts are summed per entity before the join (``entities`` has one row per key). Rankings and
    matrices both branch from this small result, so the facts are scanned and shuffled once.
    """
    per_entity = entity_spend(expenses, *dims)
    meta = entities.select("entity_id", *columns)
    joined = per_entity.join(meta, "entity_id", "left").withColumn("grp", fill_unknown(F.col("grp")))
    return materialize(joined.groupBy(*columns, *dims).agg(sum_money(F.col("spend")).alias("spend")), "cells")


def group_category_matrix(expenses: DataFrame, entities: DataFrame, categories: list[str] | None = None,
                          n: int = 10, default: str = DEFAULT_CATEGORY) -> DataFrame:
    """Top-N groups by category spend, wide, gaps 0; spend outside the category list counts as ``default``."""
    cells = drop_null_key(group_cells(expenses, entities, ["category"]), "category")
    top = group_totals(cells, n, "spend")
    return pivot_sum(in_top_groups(cells, top), ["grp"], "category", categories or categories_of(), "spend", default)


def stack_dense(wide: DataFrame, keys: list[str], columns: list[str], name: str = "category",
                value: str = "spend") -> DataFrame:
    """Wide to long, zeros kept."""
    return wide.unpivot(keys, columns, name, value)


def group_category_log(matrix: DataFrame, key: str = "grp") -> DataFrame:
    """Long cells with the raw value and ln(1 + value)."""
    columns = [c for c in matrix.columns if c != key]
    return stack_dense(matrix, [key], columns).withColumn("log_spend", F.log1p("spend"))


def entity_category_grid(expenses: DataFrame, entities: DataFrame, categories: list[str] | None = None,
                         n: int = 10, default: str = DEFAULT_CATEGORY) -> DataFrame:
    """Every (group, name) of the top-N groups with every category seen there, zeros kept.

    Rows without a name count toward the ranking and then leave the grid. The closed category list
    makes the dense form a pivot and unpivot, where spend outside it counts as ``default``; categories
    seen nowhere are dropped at the end.
    """
    names = categories or categories_of()
    cells = group_cells(expenses, entities, ["category"], ("grp", "name"))
    top = group_totals(cells, n, "spend")
    kept = drop_null_key(drop_null_key(in_top_groups(cells, top), "name"), "category")
    kept = kept.withColumn("category", listed("category", names, default))
    dense = stack_dense(pivot_sum(kept, ["grp", "name"], "category", names, "spend", default), ["grp", "name"], names)
    seen = kept.select("category").distinct()
    return dense.join(F.broadcast(seen), "category", "left_semi").select("grp", "name", "category", "spend")


def year_group_series(expenses: DataFrame, entities: DataFrame, n: int = 6, after: int = 2022,
                      before: int = 2026, col: str = "yr") -> DataFrame:
    """Spend by year for the top-N groups of the year range, by year."""
    if not isinstance(expenses.schema[col].dataType, T.IntegralType):
        expenses = expenses.withColumn(col, coerce_whole(expenses, col, "int"))
    rows = year_range(drop_null_key(expenses, col), after, before, col)
    cells = group_cells(rows, entities, [col])
    return in_top_groups(cells, group_totals(cells, n, "spend")).orderBy(col, "grp")


def _aggregate(name: str) -> Column | None:
    return {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}.get(name)


def group_profile(df: DataFrame, n: int = 10, agg: str = "median", metrics: list[str] = PROFILE,
                  renames: dict[str, str] | None = None) -> DataFrame:
    """One aggregated row per top-N group, in ranking order, all-zero rows dropped.

    Groups are renamed after the ranking, and the result follows the list from before: a renamed
    group shows only if its new name was on that list.
    """
    if len(metrics) < 4:
        raise ValueError("a profile needs at least four metrics")
    top = group_totals(df, n).select("grp", "pos")
    base = in_top_groups(df, top).withColumn(
        "grp", replace_values(F.col("grp"), GROUP_RENAMES if renames is None else renames)
    )
    if agg == "median":
        long = quantiles(base, metrics, {"v": 0.5}, ["grp"])
        rows = long.groupBy("grp").agg(*[F.max(F.when(F.col("metric") == m, F.col("v"))).alias(m) for m in metrics])
    else:
        rows = base.groupBy("grp").agg(*[_aggregate(agg)(F.col(m).cast("double")).alias(m) for m in metrics])
    listed = top.join(rows, "grp", "left")
    return drop_zero_rows(listed, metrics).orderBy("pos")


def group_profile_scaled(df: DataFrame, n: int = 10, agg: str = "median",
                         metrics: list[str] = PROFILE) -> DataFrame:
    """The profile with each metric scaled to 0..1 over its rows."""
    return minmax_scale(materialize(group_profile(df, n, agg, metrics), "profile"), metrics)


def group_profile_mean(df: DataFrame, n: int = 12, metrics: list[str] = METRICS) -> DataFrame:
    """Mean of each metric per top-N group, NULL as 0."""
    present = [m for m in metrics if m in df.columns]
    if len(present) < 4:
        raise ValueError("a mean profile needs at least four metrics")
    return in_top_groups(df, group_totals(df, n)).groupBy("grp").agg(
        *[F.coalesce(F.avg(F.col(m).cast("double")), F.lit(0.0)).alias(m) for m in present]
    )


def group_zscores(df: DataFrame, n: int = 12, metrics: list[str] = METRICS) -> DataFrame:
    """Mean profiles with ``<metric>_z`` columns."""
    profile = materialize(group_profile_mean(df, n, metrics), "profile")
    return zscore(profile, [c for c in profile.columns if c != "grp"])


def group_distance(df: DataFrame, n: int = 12, metrics: list[str] = METRICS) -> DataFrame:
    """Euclidean distance between the z-scored profiles of the top-N groups, each pair once.

    Joined metric by metric on N rows per metric; N is the size of the report.
    """
    scored = group_zscores(df, n, metrics)
    z = [c for c in scored.columns if c.endswith("_z")]
    long = scored.select("grp", *z).unpivot(["grp"], z, "metric", "z")
    other = long.select(F.col("grp").alias("other"), "metric", F.col("z").alias("other_z"))
    gap = F.col("z") - F.col("other_z")
    return long.join(other, "metric").where(F.col("grp") < F.col("other")).groupBy("grp", "other").agg(
        F.sqrt(F.sum(gap * gap)).alias("distance")
    )


def scatter_mart(df: DataFrame, raw: bool = False) -> DataFrame:
    """One point per entity with its hover columns."""
    rows = df.where(F.col("spend_total") >= 0) if raw else df
    lead = [] if raw else ["log_spend"]
    return rows.select("entity_id", *lead, "activity", "name", "grp", "region", "spend_total", "cost_per_activity")


def strip_mart(df: DataFrame, n: int = 10) -> DataFrame:
    """Activity per entity in the top-N groups."""
    return in_top_groups(df, group_totals(df, n)).select(
        "grp", "activity", "entity_id", "name", "region", "spend_total", "cost_per_activity"
    )
