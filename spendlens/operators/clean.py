"""Cleaning of the four raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.numbers import (
    INFINITY, clip_floor, coerce_number, coerce_whole, coerce_year_value, flag_refund, parse_money,
)
from ..functions.text import DEFAULT_CATEGORY, EXPENSE_RULES, Rules, classify_text
from .counts import Counts
from .dedup import dedup_first, dedup_rows
from .filters import drop_null_key

CORE = ["entity_id", "name", "grp", "region"]


def resolve_key(df: DataFrame, key: str = "entity_id", alias: str = "id") -> DataFrame:
    """``id`` becomes the entity key where the key is absent, and is dropped where both exist."""
    if alias not in df.columns:
        return df
    return df.drop(alias) if key in df.columns else df.withColumnRenamed(alias, key)


def coerce_key(df: DataFrame, key: str = "entity_id") -> DataFrame:
    """Integer key; rows without a usable key are dropped."""
    if key not in df.columns:
        raise ValueError(f"column {key!r} not found")
    return drop_null_key(df.withColumn(key, coerce_whole(df, key)), key)


def coerce_year(df: DataFrame, col: str = "yr") -> DataFrame:
    return df.withColumn(col, coerce_year_value(df, col)) if col in df.columns else df


def coerce_value(df: DataFrame, col: str = "amount") -> DataFrame:
    """Numeric amount; text that is no number becomes NULL."""
    return df.withColumn(col, coerce_number(df, col))


def select_core(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in CORE if c in df.columns])


def fill_zero(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Numeric and boolean NULLs to 0 / false, in all such columns or the listed ones."""
    names = columns or df.columns
    flags = [f.name for f in df.schema if f.name in names and f.dataType.typeName() == "boolean"]
    out = df.na.fill(0, [c for c in names if c not in flags])
    return out.na.fill(False, flags) if flags else out


def pick_value_column(df: DataFrame) -> Column | None:
    """Positive spend per row: the cleaned column, else the floored raw one, else none."""
    if "amount_pos" in df.columns:
        return F.coalesce(coerce_number(df, "amount_pos"), F.lit(0.0))
    if "amount" in df.columns:
        return clip_floor(F.coalesce(coerce_number(df, "amount"), F.lit(0.0)))
    return None


def pick_time_column(df: DataFrame) -> str | None:
    """First of query year, document year, plain year that the frame has."""
    return next((c for c in ("yr", "document_yr", "plain_yr") if c in df.columns), None)


def clean_entities(raw: DataFrame, order: list | None = None) -> DataFrame:
    """One row per entity with the core columns that exist."""
    keyed = coerce_key(resolve_key(raw))
    return dedup_first(select_core(keyed), ["entity_id"], order)


def clean_expenses(raw: DataFrame, money_text: bool = False, counts: Counts | None = None) -> DataFrame:
    """Distinct rows, integer key, year, numeric amount, floored amount and refund flag.

    ``money_text`` reads text amounts written as ``R$ 1.234,56``; numeric amounts pass through. ``counts`` counts the
    rows read, the distinct ones, those with a key, and those kept.
    """
    watch = counts.watch if counts else lambda df, _: df
    keyed = coerce_key(resolve_key(watch(dedup_rows(watch(raw, "read")), "distinct")))
    rows = coerce_year(watch(keyed, "keyed"))
    if money_text and isinstance(rows.schema["amount"].dataType, T.StringType):
        rows = rows.withColumn("amount", F.when(F.col("amount").isNotNull(), parse_money(F.col("amount"))))
    # One test drops NULL, NaN and infinity; it is pushed below the shuffle, so it reads the amount once.
    rows = coerce_value(rows).where(F.abs("amount") < F.lit(INFINITY))
    return watch(rows, "kept").withColumns({
        "amount_pos": clip_floor(F.col("amount")),
        "is_refund": flag_refund(F.col("amount")),
    })


def _clean_works(raw: DataFrame, specific: str, collapse_to_entity: bool) -> DataFrame:
    if specific not in raw.columns and "id" in raw.columns and "entity_id" in raw.columns:
        raw = raw.withColumnRenamed("id", specific)
    rows = resolve_key(raw)
    if "entity_id" not in rows.columns:
        return dedup_rows(coerce_year(rows))
    rows = coerce_year(coerce_key(rows))
    keys = ["entity_id"]
    if specific in rows.columns and not collapse_to_entity:
        keys.append(specific)
    return dedup_first(rows, keys)


def clean_items(raw: DataFrame, collapse_to_entity: bool = False) -> DataFrame:
    """One row per (entity, item).

    With ``collapse_to_entity`` only the entity is the key, as happens in the source pipeline when a
    row carries both a generic id and the entity key.
    """
    return _clean_works(raw, "item_id", collapse_to_entity)


def clean_events(raw: DataFrame, collapse_to_entity: bool = False) -> DataFrame:
    """One row per (entity, event); see ``clean_items``."""
    return _clean_works(raw, "event_id", collapse_to_entity)


def categorise_expenses(expenses: DataFrame, rules: Rules = EXPENSE_RULES,
                        default: str = DEFAULT_CATEGORY) -> DataFrame:
    """Adds ``category``; ``kind`` is lower-cased. Without a ``kind`` all rows get the default."""
    if "kind" not in expenses.columns:
        return expenses.withColumn("category", F.lit(default))
    return expenses.withColumns({
        "kind": F.lower("kind"), "category": classify_text(F.col("kind"), rules, default),
    })
