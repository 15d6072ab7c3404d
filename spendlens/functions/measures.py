"""Per-entity scores and ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EVENT_WEIGHT = 0.3


def activity_score(items: Column, events: Column, weight: float = EVENT_WEIGHT) -> Column:
    return items + events * F.lit(weight)


def cost_per_activity(spend: Column, activity: Column) -> Column:
    """Spend per unit of activity; 0 where there is no activity."""
    return F.coalesce(spend / F.nullif(activity, F.lit(0.0)), F.lit(0.0))


def flag_no_expense(spend: Column, count: Column) -> Column:
    return (F.coalesce(spend, F.lit(0.0)) == 0) & (F.coalesce(count, F.lit(0)) == 0)


def spend_per_distance(spend: Column, km: Column) -> Column:
    return spend / (km + F.lit(1))


def cost_per_item_norm(spend_per_km: Column, items: Column) -> Column:
    return spend_per_km / (items + F.lit(1))
