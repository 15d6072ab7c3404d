"""Modelling table, master table and prepared master."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.measures import (
    activity_score, cost_per_activity, flag_no_expense, spend_per_distance,
)
from ..functions.numbers import clip_floor, coerce_number, log1p_spend, null_nonfinite
from ..functions.text import DEFAULT_CATEGORY, categories_of, category_column, fill_unknown
from ..operators.clean import fill_zero
from ..operators.counts import Counts
from ..operators.dedup import dedup_first
from ..operators.joins import attach_distance, attach_metrics
from ..operators.order_stats import spend_band
from ..operators.totals import event_counts, expense_totals, item_counts

TOTALS = ["spend_total", "spend_net", "expense_count", "refund_count", "item_total", "event_total"]
PREPARED = [*TOTALS, "activity", "spend_adjusted", "cost_per_activity"]


def modelling_table(entities: DataFrame, expenses: DataFrame, items: DataFrame, events: DataFrame,
                    distances: DataFrame | None = None) -> DataFrame:
    """One row per entity: distance, spend and activity totals, score, distance-adjusted spend."""
    if distances is None:
        base = entities.withColumn("distance_km", F.lit(0.0))
    else:
        base = attach_distance(entities, distances)
    joined = attach_metrics(base, expense_totals(expenses), item_counts(items), event_counts(events))
    return fill_zero(joined, TOTALS).withColumns({
        "activity": activity_score(F.col("item_total"), F.col("event_total")),
        "spend_per_km": spend_per_distance(F.col("spend_total"), F.col("distance_km")),
    })


def counted_model(model: DataFrame, counts: Counts) -> DataFrame:
    """The modelling table, whose entities, those without expenses and those without a distance are counted."""
    return counts.watch(
        model, "entities", without_expense=F.col("expense_count") == 0, without_distance=F.col("distance_km") == 0)


def master_table(entities: DataFrame, expenses: DataFrame, items: DataFrame, events: DataFrame,
                 categories: list[str] | None = None, default: str = DEFAULT_CATEGORY) -> DataFrame:
    """One row per entity: totals, one spend column per category, activity, cost, no-expense flag.

    Takes categorised expenses. Totals and category columns come out of one aggregation; spend
    outside the category list counts as ``default``.
    """
    names = categories or categories_of()
    base = dedup_first(entities, ["entity_id"])
    joined = attach_metrics(
        base, expense_totals(expenses, names, count_rows=True, default=default), event_counts(events), item_counts(items)
    )
    filled = fill_zero(joined, [*TOTALS, *[category_column(c) for c in names]])
    scored = filled.withColumns({
        "activity": activity_score(F.col("item_total"), F.col("event_total")),
        "spend_adjusted": clip_floor(F.col("spend_total")),
        "no_expense": flag_no_expense(F.col("spend_total"), F.col("expense_count")),
    })
    return scored.withColumn("cost_per_activity", cost_per_activity(F.col("spend_adjusted"), F.col("activity")))


def prepared_columns(master: DataFrame) -> DataFrame:
    """Numbers coerced, activity recreated if absent, log spend added, missing labels filled."""
    df = master.withColumns({
        c: F.coalesce(coerce_number(master, c), F.lit(0.0)) for c in PREPARED if c in master.columns
    })
    if "activity" not in df.columns:
        parts = [F.col(c) if c in df.columns else F.lit(0.0) for c in ("item_total", "event_total")]
        df = df.withColumn("activity", activity_score(*parts))
    spend = log1p_spend(F.col("spend_total")) if "spend_total" in df.columns else F.lit(0.0)
    df = df.withColumn("log_spend", spend)
    if "cost_per_activity" in df.columns:
        df = df.withColumn("cost_per_activity", F.coalesce(null_nonfinite(F.col("cost_per_activity")), F.lit(0.0)))
    return df.withColumns({c: fill_unknown(F.col(c)) for c in ("name", "grp", "region") if c in df.columns})


def prepared_master(master: DataFrame) -> DataFrame:
    """``prepared_columns`` with the spend band."""
    df = prepared_columns(master)
    return spend_band(df) if "spend_total" in df.columns else df
