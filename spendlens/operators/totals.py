"""Per-entity and per-dimension totals. All aggregate map-side before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import sum_limbs, with_limbs
from ..functions.text import DEFAULT_CATEGORY, category_column, categories_of
from .filters import drop_null_key


def listed(column: str, values: list[str], default: str | None) -> Column:
    """``column`` with every value outside ``values`` as ``default``; an error where the list lacks it. NULL stays NULL."""
    other = F.lit(default) if default in values else F.raise_error(
        F.concat(F.lit(f"{column} outside the closed list: "), F.col(column).cast("string")))
    return F.when(F.col(column).isNull() | F.col(column).isin(values), F.col(column)).otherwise(other)


def category_sum(value: str, column: str, amount: str) -> Column:
    """Sum of ``amount`` (see ``with_limbs``) over the rows where ``column`` is ``value``; 0 for none."""
    return F.coalesce(sum_limbs(amount, F.col(column) == value), F.lit(0.0))


def expense_totals(expenses: DataFrame, categories: list[str] | None = None,
                   count_rows: bool = False, default: str = DEFAULT_CATEGORY) -> DataFrame:
    """Per entity: positive spend, net spend, expense count, refund count.

    ``count_rows`` counts every row instead of those with a value. ``categories`` adds one spend
    column per category in the same pass, so category columns cost no second shuffle; spend in any
    other category counts as ``default``.
    """
    if categories:
        expenses = expenses.withColumn("category", listed("category", categories, default))
    counted = F.lit(1) if count_rows else F.col("amount_pos")
    aggregates = [
        F.coalesce(sum_limbs("amount_pos"), F.lit(0.0)).alias("spend_total"),
        F.coalesce(sum_limbs("amount"), F.lit(0.0)).alias("spend_net"),
        F.count(counted).alias("expense_count"),
        F.count_if(F.col("is_refund")).alias("refund_count"),
    ]
    aggregates += [
        category_sum(c, "category", "amount_pos").alias(category_column(c)) for c in categories or []
    ]
    return with_limbs(drop_null_key(expenses), "amount_pos", "amount").groupBy("entity_id").agg(*aggregates)


def count_refunds(expenses: DataFrame) -> DataFrame:
    return expenses.agg(F.count_if(F.col("amount") < 0).alias("refunds"))


def item_counts(items: DataFrame) -> DataFrame:
    return drop_null_key(items).groupBy("entity_id").agg(F.count(F.lit(1)).alias("item_total"))


def event_counts(events: DataFrame) -> DataFrame:
    return drop_null_key(events).groupBy("entity_id").agg(F.count(F.lit(1)).alias("event_total"))


def pivot_sum(df: DataFrame, keys: list[str], column: str, values: list[str], amount: str,
              default: str | None = None) -> DataFrame:
    """Long to wide with a closed value list; gaps are 0. Other values count as ``default``, which the list must
    hold; else they raise an error.

    One conditional sum per value: a single shuffle by ``keys``, where ``pivot`` would first group by
    (keys, column) and then again by keys.
    """
    df = with_limbs(df.withColumn(column, listed(column, values, default)), amount)
    return df.groupBy(*keys).agg(*[category_sum(v, column, amount).alias(v) for v in values])


def category_pivot(expenses: DataFrame, categories: list[str] | None = None,
                   default: str = DEFAULT_CATEGORY) -> DataFrame:
    """Per entity one spend column per category; spend in any other category counts as ``default``."""
    names = categories or categories_of()
    wide = pivot_sum(drop_null_key(expenses), ["entity_id"], "category", names, "amount_pos", default)
    return wide.withColumnsRenamed({c: category_column(c) for c in names})


def category_totals(expenses: DataFrame) -> DataFrame:
    """Spend per category, smallest first."""
    totals = with_limbs(drop_null_key(expenses, "category"), "amount_pos").groupBy("category").agg(
        F.coalesce(sum_limbs("amount_pos"), F.lit(0.0)).alias("spend")
    )
    return totals.orderBy("spend", "category")


def entity_spend(expenses: DataFrame, *dims: str) -> DataFrame:
    """Positive spend per entity and the given dimensions.

    The marts start here: facts shrink to at most one row per entity and dimension value before any
    join, so a hot entity is gone by then.
    """
    return with_limbs(drop_null_key(expenses), "amount_pos").groupBy("entity_id", *dims).agg(
        F.coalesce(sum_limbs("amount_pos"), F.lit(0.0)).alias("spend")
    )
