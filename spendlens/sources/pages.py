"""Page envelopes of a paged API: stop rule, row cap, flattening, tagging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import lookup_join
from ..session import materialize

REQUEST = ("request_entity", "request_year")
SALTS = 64


def is_empty_page(data: str = "dados") -> Column:
    return F.coalesce(F.size(data), F.lit(0)) <= 0


def has_next(links: str = "links") -> Column:
    return F.coalesce(F.exists(links, lambda link: link["rel"] == "next"), F.lit(False))


def first_stops(pages: DataFrame, rule: str = "empty", keys=REQUEST) -> DataFrame:
    """Per request: the first page that ends it (NULL while no such page has been seen).

    ``empty``: the first page without rows. ``next``: that, or the first page without a next link.
    """
    if rule not in ("empty", "next"):
        raise ValueError(f"unknown stop rule: {rule}")
    stop = is_empty_page() if rule == "empty" else is_empty_page() | ~has_next()
    return pages.groupBy(*keys).agg(
        F.min(F.when(stop, F.col("page"))).alias("stop_page"), F.max("page").alias("last_page"),
        F.count(F.lit(1)).alias("pages"),
    )


def page_stop(pages: DataFrame, rule: str = "empty", keys=REQUEST, stops: DataFrame | None = None) -> DataFrame:
    """Pages up to and including the first stop page of their request.

    A minimum per request joined back, not a window: a request with a third of all pages is reduced
    map-side first. Only requests that have pages after their stop page are joined; they are few, so the
    payloads usually stay where they are. ``stops`` is a stored ``first_stops``, where there is one.
    """
    stops = materialize(first_stops(pages, rule, keys), "stops") if stops is None else stops
    overrun = stops.where(F.col("last_page") > F.col("stop_page")).select(*keys, "stop_page")
    joined = lookup_join(pages, overrun, list(keys))
    return joined.where(F.col("stop_page").isNull() | (F.col("page") <= F.col("stop_page"))).drop("stop_page")


def complete_requests(pages: DataFrame, rule: str = "empty", keys=REQUEST, stops: DataFrame | None = None) -> DataFrame:
    """Requests whose pages 1 to the stop page were all seen; only these may be marked done.

    A page that comes late leaves a gap until it is there, and its request stays pending.
    """
    stops = first_stops(pages, rule, keys) if stops is None else stops
    ended = stops.where(F.col("stop_page").isNotNull()).select(*keys, "stop_page")
    seen = pages.select(*keys, "page").join(ended, list(keys)).where(F.col("page").between(1, F.col("stop_page")))
    counted = seen.groupBy(*keys, "stop_page").agg(F.countDistinct("page").alias("seen"))
    return counted.where(F.col("seen") == F.col("stop_page")).select(
        F.col(keys[0]).alias("entity_id"), F.col(keys[1]).alias("yr")
    )


def flatten_pages(pages: DataFrame, data: str = "dados", keys=REQUEST) -> DataFrame:
    """One row per record, with its request, page and position in the page."""
    lead = [*keys, "page"]
    rows = pages.select(*lead, F.posexplode(data).alias("pos", "record"))
    fields = [f for f in pages.schema[data].dataType.elementType.names if f not in (*lead, "pos")]
    return rows.select(*lead, "pos", *[F.col("record")[f].alias(f) for f in fields])


def tag_rows(rows: DataFrame, keys=REQUEST) -> DataFrame:
    """Stamp entity id and query year of the request on every row (replacing the row's own).

    Where a record stood is dropped, so that one delivered on two pages is the same row twice.
    """
    return rows.withColumns({"entity_id": F.col(keys[0]), "yr": F.col(keys[1])}).drop(*keys, "page", "pos")


def cap_rows(rows: DataFrame, n: int, keys=REQUEST, order=("page", "pos")) -> DataFrame:
    """At most ``n`` rows per request, in page order; 0 means no cap.

    Ranked within salted slices first, so that no task orders a whole large request.
    """
    if not n:
        return rows
    salt = F.pmod(F.xxhash64(*order), F.lit(SALTS))
    slice_rank = F.row_number().over(Window.partitionBy(*keys, "__salt").orderBy(*order))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        rows.withColumn("__salt", salt)
        .withColumn("__rank", slice_rank).where(F.col("__rank") <= n).drop("__salt")
        .withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")
    )
