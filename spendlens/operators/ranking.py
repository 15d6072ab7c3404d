"""Top-k reports. Each is ``orderBy`` + ``limit``, which Spark runs as one bounded top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.measures import cost_per_item_norm
from ..functions.numbers import mean_money, sum_money
from ..functions.text import label_entity
from .filters import active_only, drop_null_key, nonnegative_spend

CORE = ["entity_id", "name", "grp", "region"]


def top_k(df: DataFrame, by: str, n: int, key: str = "entity_id") -> DataFrame:
    """The ``n`` largest by ``by``, ties by key, NULL last."""
    return df.orderBy(F.desc_nulls_last(by), key).limit(n)


def _pick(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[c for c in [*CORE, *columns] if c in df.columns])


def top_spenders(df: DataFrame, n: int = 15) -> DataFrame:
    return top_k(_pick(df, ["spend_total", "activity", "cost_per_activity"]), "spend_total", n)


def top_cost(df: DataFrame, n: int = 15) -> DataFrame:
    return top_k(_pick(active_only(df), ["cost_per_activity", "spend_total", "activity"]), "cost_per_activity", n)


def top_refunds(df: DataFrame, n: int = 15) -> DataFrame:
    return top_k(_pick(df, ["refund_count", "spend_net", "spend_total"]), "refund_count", n)


def label_candidates(df: DataFrame, n: int = 8, raw: bool = False) -> DataFrame:
    """Entities to name on the scatter: highest cost per activity among the active."""
    rows = active_only(nonnegative_spend(df) if raw else df)
    x = "spend_total" if raw else "log_spend"
    return top_k(rows.select("entity_id", "name", x, "activity", "cost_per_activity"), "cost_per_activity", n)


def top_entities(df: DataFrame, n: int = 120) -> DataFrame:
    return top_k(df, "spend_total", n)


def top_cost_per_item(df: DataFrame, n: int = 10) -> DataFrame:
    rows = df.select(
        "entity_id", label_entity(F.col("name"), F.col("grp")).alias("label"),
        cost_per_item_norm(F.col("spend_per_km"), F.col("item_total")).alias("cost_per_item"),
    )
    return top_k(rows, "cost_per_item", n)


def _numbered(top: DataFrame, by: str, key: str) -> DataFrame:
    # ``top`` holds at most N rows, so the unpartitioned window stays tiny.
    return top.withColumn("pos", F.row_number().over(Window.orderBy(F.desc_nulls_last(by), key)))


def group_totals(df: DataFrame, n: int = 10, value: str = "spend_total", key: str = "grp") -> DataFrame:
    """Top-N groups by summed spend, with their place ``pos``."""
    sums = drop_null_key(df, key).groupBy(key).agg(F.coalesce(sum_money(F.col(value)), F.lit(0.0)).alias("spend"))
    return _numbered(top_k(sums, "spend", n, key), "spend", key)


def region_means(df: DataFrame, n: int = 15) -> DataFrame:
    """Top-N regions by mean spend per entity."""
    means = drop_null_key(df, "region").groupBy("region").agg(mean_money(F.col("spend_total")).alias("mean_spend"))
    return top_k(means, "mean_spend", n, "region")


def region_totals(df: DataFrame) -> DataFrame:
    return drop_null_key(df, "region").groupBy("region").agg(
        F.coalesce(sum_money(F.col("spend_total")), F.lit(0.0)).alias("spend")
    )


def reorder_to_list(df: DataFrame, ranked: DataFrame, key: str = "grp") -> DataFrame:
    """Rows of the listed keys in list order. The list is a top-N frame carrying ``pos``."""
    return df.join(F.broadcast(ranked.select(key, "pos")), key).orderBy("pos")
