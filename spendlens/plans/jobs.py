"""The pipeline as five jobs that talk through stored tables, as the stages of the source pipeline do.

Folder ``raw`` holds entities, expenses, items and events (Parquet, else CSV), under either the source's
column names or the engine's. Folder ``out`` receives everything else.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.numbers import coerce_number
from ..functions.text import DEFAULT_CATEGORY, EXPENSE_RULES, Rules, categories_of
from ..operators import cluster, groups, hierarchy, ranking, stats
from ..operators.clean import (
    categorise_expenses, clean_entities, clean_events, clean_expenses, clean_items, fill_zero, pick_time_column, resolve_key,
)
from ..operators.counts import Counts
from ..operators.order_stats import melt_metrics
from ..operators.totals import category_totals
from ..sources.files import read_optional, read_preferred, read_table, write_report, write_table
from ..sources.regions import read_regions, region_centroids, region_distances
from ..sources.schemas import to_canonical, to_source_names
from ..sources.worklist import build_worklist, mark_done, merge_batches, pending_work, union_entities
from ..streaming.ingest import ingest_dataset
from .tables import counted_model, master_table, modelling_table, prepared_master

CLEANERS = {
    "entities": clean_entities, "expenses": clean_expenses, "items": clean_items, "events": clean_events,
}
BOX_METRICS = ["spend_total", "activity", "cost_per_activity"]


def _store(df: DataFrame, path: str, csv: bool = False, partition_by: tuple[str, ...] = ()) -> None:
    write_table(df, f"{path}.parquet", partition_by=partition_by)
    if csv:
        write_table(df, f"{path}.csv", "csv")


def ingest_job(spark: SparkSession, landing: str, out: str, name: str, row: T.StructType | None = None,
               entities: list[str] = (), years: list[int] = (), rule: str = "empty") -> None:
    """New page files of a dataset to its raw table, its done keys, its failures and what is still to be asked for.

    ``row`` is the type of a record; without it, it is taken from the pages that have landed and kept for later runs.
    ``entities`` are tables of entities, the earliest term first; with ``years`` they make the worklist. Records of an
    earlier raw table that was not ingested (``raw/name_before``) come first.
    """
    base = f"{out}/ingest/{name}"
    if row is None:
        stored = read_optional(spark, f"{base}_row.csv")
        if stored is None:
            row = spark.read.json(landing).schema["dados"].dataType.elementType
            write_table(spark.createDataFrame([(row.json(),)], "row string"), f"{base}_row.csv", "csv")
        else:
            row = T.StructType.fromJson(json.loads(stored.first()["row"]))
    store = ingest_dataset(spark, landing, base, row, rule)
    rows = store.read("rows").drop("batch")
    before = read_optional(spark, f"{out}/raw/{name}_before.parquet")
    write_table(rows if before is None else merge_batches(before, rows), f"{out}/raw/{name}.parquet")
    write_table(store.read("failures"), f"{base}_failures.parquet")
    write_report(store.ledger().orderBy("batch"), f"{base}_ledger.json")
    earlier = read_optional(spark, f"{base}_done_before.parquet")
    done = store.done() if earlier is None else mark_done(earlier, store.done())
    write_table(done, f"{base}_done.parquet")
    if entities and years:
        listed = union_entities(*[to_canonical(resolve_key(read_table(spark, path))) for path in entities])
        todo = pending_work(build_worklist(listed, list(years)), read_table(spark, f"{base}_done.parquet"))
        write_table(todo, f"{base}_pending.parquet")


def clean_job(spark: SparkSession, raw: str, out: str, regions: str | None = None,
              source_names: bool = False) -> None:
    """Raw tables to clean tables and the modelling table.

    Expenses are stored by year. ``regions`` is a GeoJSON file; without it every distance is 0.
    ``source_names`` writes the modelling table under the source's column names. ``clean_counts.json`` tells how many
    expense rows were read, distinct, keyed and kept, and how many entities have no expense or no distance.
    """
    counts = Counts()
    for name, clean in CLEANERS.items():
        extra = {"counts": counts} if name == "expenses" else {}
        rows = clean(to_canonical(read_preferred(spark, f"{raw}/{name}")), **extra)
        by_year = ("yr",) if name == "expenses" and "yr" in rows.columns else ()
        _store(rows, f"{out}/{name}_clean", partition_by=by_year)
    stored = [read_table(spark, f"{out}/{name}_clean.parquet") for name in CLEANERS]
    distances = region_distances(region_centroids(read_regions(spark, regions))) if regions else None
    model = modelling_table(*stored, distances)
    write_table(counted_model(model, counts), f"{out}/modelling.parquet")
    write_report(counts.table(spark), f"{out}/clean_counts.json")
    model = read_table(spark, f"{out}/modelling.parquet")
    write_table(to_source_names(model) if source_names else model, f"{out}/modelling.csv", "csv")


def master_job(spark: SparkSession, out: str, rules: Rules = EXPENSE_RULES,
               default: str = DEFAULT_CATEGORY, source_names: bool = False) -> None:
    """Clean tables to categorised expenses, category totals and the master table."""
    tables = {name: read_table(spark, f"{out}/{name}_clean.parquet") for name in CLEANERS}
    by_year = ("yr",) if "yr" in tables["expenses"].columns else ()
    _store(categorise_expenses(tables["expenses"], rules, default), f"{out}/expenses_categorised", partition_by=by_year)
    categorised = read_table(spark, f"{out}/expenses_categorised.parquet")
    _store(category_totals(categorised), f"{out}/category_totals")
    master = master_table(
        tables["entities"], categorised, tables["items"], tables["events"], categories_of(rules, default), default
    )
    write_table(master, f"{out}/master.parquet")
    master = read_table(spark, f"{out}/master.parquet")
    write_table(to_source_names(master) if source_names else master, f"{out}/master.csv", "csv")


def entity_marts() -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Tables behind the figures, from the prepared master."""
    return {
        "histogram": stats.spend_histogram,
        "box_stats": lambda df: stats.box_stats(df, BOX_METRICS),
        "box_outliers": lambda df: stats.box_outliers(df, BOX_METRICS),
        "box_values": lambda df: melt_metrics(df, BOX_METRICS, ["entity_id"]),
        "group_totals": ranking.group_totals,
        "group_box_stats": lambda df: stats.box_stats(groups.strip_mart(df), ["spend_total"], ["grp"]),
        "region_means": ranking.region_means,
        "region_totals": ranking.region_totals,
        "scatter": groups.scatter_mart,
        "scatter_trend": stats.linear_trend,
        "scatter_labels": ranking.label_candidates,
        "scatter_raw": lambda df: groups.scatter_mart(df, raw=True),
        "scatter_raw_trend": stats.log_trend,
        "scatter_raw_labels": lambda df: ranking.label_candidates(df, raw=True),
        "correlations": stats.correlation_matrix,
        "spend_hierarchy": hierarchy.spend_hierarchy,
        "strip": groups.strip_mart,
        "group_profiles": groups.group_profile_scaled,
        "group_zscores": groups.group_zscores,
        "group_distances": groups.group_distance,
        "group_similarity": cluster.group_hierarchy,
    }


def expense_marts(categories: list[str], default: str = DEFAULT_CATEGORY) -> dict[str, Callable[[DataFrame, DataFrame], DataFrame]]:
    """Tables behind the figures that also need the categorised expenses."""
    return {
        "group_categories": lambda spent, master: groups.group_category_log(
            groups.group_category_matrix(spent, master, categories, default=default)),
        "category_hierarchy": lambda spent, master: hierarchy.category_hierarchy(
            groups.entity_category_grid(spent, master, categories, default=default)),
    }


def marts_job(spark: SparkSession, out: str, rules: Rules = EXPENSE_RULES, default: str = DEFAULT_CATEGORY,
              after: int = 2022, before: int = 2026) -> list[str]:
    """Master table to the figure tables, three rankings and a summary; returns what was written.

    Without categorised expenses the tables that need them are skipped.
    """
    master = to_canonical(read_preferred(spark, f"{out}/master"))
    write_table(prepared_master(master), f"{out}/marts/prepared.parquet")
    prepared = read_table(spark, f"{out}/marts/prepared.parquet")
    written = []

    def keep(name: str, df: DataFrame) -> None:
        write_table(df, f"{out}/marts/{name}.parquet")
        written.append(name)

    for name, build in entity_marts().items():
        keep(name, build(prepared))
    spent = read_optional(spark, f"{out}/expenses_categorised.parquet")
    if spent is not None:
        for name, build in expense_marts(categories_of(rules, default), default).items():
            keep(name, build(spent, prepared))
        year = pick_time_column(spent)
        if year:
            keep("group_years", groups.year_group_series(spent, prepared, after=after, before=before, col=year))
    for name, build in (("top_spenders", ranking.top_spenders), ("top_cost", ranking.top_cost),
                        ("top_refunds", ranking.top_refunds)):
        write_table(build(prepared), f"{out}/marts/{name}.csv", "csv")
        written.append(name)
    write_report(stats.summary_stats(prepared), f"{out}/marts/summary.json")
    return [*written, "summary"]


def analysis_job(spark: SparkSession, out: str) -> None:
    """Modelling table to the correlation, the labelled entities and the cluster summary."""
    model = to_canonical(read_preferred(spark, f"{out}/modelling"))
    numeric = ["spend_total", "spend_per_km", "activity", "distance_km"]
    model = fill_zero(model.withColumns({c: coerce_number(model, c) for c in numeric}), numeric)
    write_report(stats.pearson(model), f"{out}/analysis/pearson.json")
    labelled, costs = cluster.kmeans_sweep(model)
    write_table(labelled, f"{out}/analysis/clusters.parquet")
    stored = read_table(spark, f"{out}/analysis/clusters.parquet")
    ranked = ranking.top_cost_per_item(stored)
    write_table(ranked, f"{out}/analysis/top_cost_per_item.parquet")
    best = costs.where("chosen").first()["k"]
    write_report(cluster.cluster_summary(stored).withColumn("best_k", F.lit(best)), f"{out}/analysis/clusters.json")
