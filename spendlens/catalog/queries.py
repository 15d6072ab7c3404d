"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import geo, measures, numbers, text
from ..operators import (
    clean, cluster, dedup, filters, groups, hierarchy, joins, order_stats, ranking, scaling, stats, totals,
)
from ..operators.counts import Counts
from ..plans import tables
from ..session import materialize, scratch_path
from ..sources import files, pages, regions, worklist
from ..streaming import ingest
from .tables import CATEGORIES, DEFAULT, RULES, Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

YEARS = {"after": 1995, "before": 2000}
RENAMES = {"HOUSEHOLD-EUROPE": "MACHINERY-EUROPE"}
DIGITS = 6


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Ratios, logs and fits rounded so both engines print the same digits."""
    return df.withColumns({n: F.round(n, DIGITS) for n in names})


# Sources and sinks


@query
def read_table(t: Tables) -> DataFrame:
    schema = T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_acctbal", T.DoubleType()),
    ])
    return files.read_table(t.spark, f"{t.folder}/customer.parquet", schema)


@query
def read_preferred(t: Tables) -> DataFrame:
    """The Parquet table, the CSV that is read where there is no Parquet, and the error where there is neither."""
    names = ["o_orderkey", "o_custkey", "o_orderstatus"]
    rows, base = t.raw("orders").select(*names), scratch_path(t.spark, "orders")
    files.write_table(rows, f"{base}.csv", "csv")
    try:
        files.read_preferred(t.spark, f"{base}-absent")
        refused = False
    except FileNotFoundError:
        refused = True
    found = files.read_preferred(t.spark, f"{t.folder}/orders").select(*names, F.lit("parquet").alias("kind"))
    other = files.read_preferred(t.spark, base, rows.schema).select(*names, F.lit("csv").alias("kind"))
    return found.unionAll(other).withColumn("absent_is_refused", F.lit(refused))


def _order_lines(t: Tables) -> DataFrame:
    return t.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query
def read_csv(t: Tables) -> DataFrame:
    rows, path = _order_lines(t), scratch_path(t.spark, "orders-csv")
    files.write_table(rows, path, "csv")
    return files.read_csv(t.spark, path, rows.schema)


@query
def read_optional(t: Tables) -> DataFrame:
    rows, path = t.raw("documents").select("doc_id", "text", "lang"), f"{scratch_path(t.spark, 'documents')}.csv"
    missing = files.read_optional(t.spark, f"{path}-absent.csv")
    files.write_table(rows, path, "csv")
    found = files.read_optional(t.spark, path, rows.schema)
    return found.select(
        "doc_id", F.md5("text").alias("text_md5"), "lang", F.lit(missing is None).alias("absent_is_none")
    )


@query
def write_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "expenses")
    files.write_table(t.raw_expenses(), path, partition_by=("yr",))
    return files.read_table(t.spark, path).select("l_orderkey", "l_linenumber", "l_suppkey", "yr", "amount")


@query
def write_report(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "report")
    summary = stats.summary_stats(t.stored_master())
    files.write_report(summary, path)
    return rounded(t.spark.read.schema(summary.schema).json(path), *[c for c in summary.columns if c != "entities"])


@query
def flatten_pages(t: Tables) -> DataFrame:
    return pages.flatten_pages(t.pages()).select(
        "request_entity", "request_year", "page", F.col("pos").cast("int").alias("pos"), "id", "total", "status"
    )


def _page_parts(df: DataFrame) -> DataFrame:
    """Pages with their whole payload."""
    return df.select(
        "request_entity", "request_year", "page", F.size("dados").alias("records"),
        F.get("dados", F.lit(0)).alias("record"), F.array_join("links.rel", ",").alias("rels"), F.array_join("links.href", ",").alias("hrefs"),
    ).select("*", "record.*").drop("record")


@query
def page_stop(t: Tables) -> DataFrame:
    return _page_parts(pages.page_stop(t.pages(), "empty"))


@query
def page_stop_next(t: Tables) -> DataFrame:
    return _page_parts(pages.page_stop(t.pages(), "next"))


@query
def cap_rows(t: Tables) -> DataFrame:
    return pages.cap_rows(pages.flatten_pages(t.pages()), 2).select("request_entity", "request_year", "id")


@query
def tag_rows(t: Tables) -> DataFrame:
    return pages.tag_rows(pages.flatten_pages(t.pages())).select("entity_id", "yr", "id", "total", "status")


@query
def build_worklist(t: Tables) -> DataFrame:
    return worklist.build_worklist(t.entities(), list(range(1995, 2002)))


@query
def pending_work(t: Tables) -> DataFrame:
    open_pairs = worklist.build_worklist(t.entities(), list(range(1995, 2002)))
    return worklist.pending_work(open_pairs, t.items().select("entity_id", "yr"))


@query
def merge_batches(t: Tables) -> DataFrame:
    rows = _order_lines(t)
    old = rows.where("o_orderstatus = 'O'").drop("o_orderpriority")
    return worklist.merge_batches(old, rows.where("o_orderstatus <> 'O'").drop("o_totalprice"))


@query
def mark_done(t: Tables) -> DataFrame:
    return worklist.mark_done(t.items(), t.events())


@query
def union_entities(t: Tables) -> DataFrame:
    first = t.raw("supplier").select(F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("name"))
    second = t.raw("customer").select(F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("name"))
    return worklist.union_entities(first, second)


@query
def ingest_pages(t: Tables) -> DataFrame:
    landing = scratch_path(t.spark, "landing")
    t.pages().write.json(landing)
    row = t.pages().schema["dados"].dataType.elementType
    stored = ingest.ingest_pages(
        t.spark, landing, scratch_path(t.spark, "pages"), scratch_path(t.spark, "progress"), row
    )
    rows, _ = ingest.settle_pages(stored)
    return rows.select("entity_id", "yr", "id", "total", "status")


def _landed(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Pages of two landings. Page 2 of every third entity comes late, page 1 of every
    eleventh entity with more pages never comes, every fifth entity's pages land twice, some requests are given up."""
    entity, page = F.col("request_entity"), F.col("page")
    sent = t.pages().withColumn("error", F.lit(None).cast("string"))
    given_up = t.entities().where("entity_id % 13 = 1").select(
        F.col("entity_id").alias("request_entity"), F.lit(2050).alias("request_year"), F.lit("timeout").alias("error"))
    late = (entity % 3 == 0) & (page == 2)
    first = sent.where(~late & ~((entity % 11 == 0) & (page == 1)))
    again = sent.where((entity % 5 == 0) & (entity % 11 != 0))
    return first.unionAll(first.where(entity % 5 == 0)).unionByName(given_up, True), sent.where(late).unionAll(again)


def _ingested(t: Tables) -> ingest.PageStore:
    """Both landings taken by a run each, then a run that finds nothing new."""
    landing, store = scratch_path(t.spark, "landing"), scratch_path(t.spark, "store")
    row = t.pages().schema["dados"].dataType.elementType
    for pages_ in _landed(t):
        pages_.write.mode("append").json(landing)
        ingest.ingest_dataset(t.spark, landing, store, row)
    return ingest.ingest_dataset(t.spark, landing, store, row)


@query
def ingest_resumed(t: Tables) -> DataFrame:
    return _ingested(t).read("rows").select("entity_id", "yr", "id", "total", "status", F.col("batch").alias("run"))


@query
def ingest_done(t: Tables) -> DataFrame:
    return _ingested(t).read("done").select("entity_id", "yr", "rows", "failed", F.col("batch").alias("run"))


@query
def ingest_ledger(t: Tables) -> DataFrame:
    return _ingested(t).ledger()


@query
def merge_drifting(t: Tables) -> DataFrame:
    """Columns that change their type between batches: integer and long, number and text, date and text, long and double."""
    rows = t.raw("orders")
    old = rows.where("o_orderstatus = 'O'").select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), F.col("o_orderkey").alias("code"),
        F.to_date("o_orderdate").alias("day"), F.col("o_custkey").alias("measure"), F.col("o_custkey").alias("only_old"),
    )
    new = rows.where("o_orderstatus <> 'O'").select(
        "o_orderkey", "o_custkey", F.concat(F.lit("N/"), F.col("o_orderkey")).alias("code"),
        F.date_format("o_orderdate", "dd.MM.yyyy").alias("day"), F.col("o_totalprice").alias("measure"),
    )
    return worklist.merge_batches(old, new)


@query
def complete_requests(t: Tables) -> DataFrame:
    return pages.complete_requests(t.pages())


# Scalar functions


def _dirty(t: Tables) -> DataFrame:
    """Event values as untidy text, one kind of untidiness per event type."""
    kind, value = F.col("event_type"), F.col("value").cast("string")
    return t.raw("events").select(
        "event_id", "user_id", "event_type",
        F.when(kind == "click", value).when(kind == "error", "abc")
        .when(kind == "signup", F.concat(F.lit("  "), value, F.lit(" ")))
        .when(kind == "view", F.concat(value, F.lit("d")))
        .otherwise(F.concat(F.col("event_id").cast("string"), F.lit("e2"))).alias("amount"),
        F.when(kind == "error", "x").when(kind == "view", F.concat(F.col("user_id").cast("string"), F.lit(".7")))
        .otherwise(F.col("user_id").cast("string")).alias("entity_id"),
        F.when(kind == "error", F.lit(None)).when(kind == "view", F.lit("2024.5"))
        .when(kind == "click", F.lit("2024.0")).otherwise(F.year("ts").cast("string")).alias("yr"),
    )


@query
def resolve_key(t: Tables) -> DataFrame:
    renamed = clean.resolve_key(t.raw("customer").select(F.col("c_custkey").alias("id"), "c_name"))
    both = clean.resolve_key(t.raw("supplier").select(
        F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("id")
    ))
    return renamed.unionByName(both)


@query
def coerce_number(t: Tables) -> DataFrame:
    return clean.coerce_value(_dirty(t)).select("event_id", "amount")


@query
def coerce_key(t: Tables) -> DataFrame:
    return clean.coerce_key(_dirty(t)).select("event_id", "entity_id")


@query
def coerce_year(t: Tables) -> DataFrame:
    return clean.coerce_year(_dirty(t)).select("event_id", "yr")


@query
def select_core(t: Tables) -> DataFrame:
    return clean.select_core(t.entities().withColumn("extra", F.lit(1)))


LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query
def clip_floor(t: Tables) -> DataFrame:
    return t.signed_lines().select(*LINE, numbers.clip_floor(F.col("amount")).alias("amount_pos"))


@query
def flag_refund(t: Tables) -> DataFrame:
    return t.signed_lines().select(*LINE, numbers.flag_refund(F.col("amount")).alias("is_refund"))


@query
def classify_text(t: Tables) -> DataFrame:
    kind = F.concat_ws(" ", "p_type", "p_name")
    return t.raw("part").select("p_partkey", text.classify_text(kind, RULES, DEFAULT).alias("category"))


@query
def classify_long_text(t: Tables) -> DataFrame:
    """The shipped keyword rules over whole documents (accents, two alphabets, long text)."""
    return t.raw("documents").select("doc_id", text.classify_text(F.col("text")).alias("category"))


@query
def slug(t: Tables) -> DataFrame:
    return t.raw("documents").select("doc_id", F.md5(text.slug(F.col("text"))).alias("slug_md5"))


@query
def parse_money(t: Tables) -> DataFrame:
    written = F.concat(
        F.lit("R$ "), F.translate(F.format_number("l_extendedprice", 2), ",.", ".,"), F.lit(" ")
    )
    shown = F.when(F.col("l_returnflag") == "R", F.lit("x")).otherwise(written)
    return t.raw("lineitem").select(*LINE, numbers.parse_money(shown).alias("amount"))


@query
def log1p_spend(t: Tables) -> DataFrame:
    return t.signed_lines().select(*LINE, F.round(numbers.log1p_spend(F.col("amount")), DIGITS).alias("log_spend"))


@query
def null_nonfinite(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    value = F.when(status == "F", F.lit(float("inf"))).when(status == "P", F.lit(float("nan"))).otherwise(
        F.col("o_totalprice")
    )
    return t.raw("orders").select("o_orderkey", F.coalesce(numbers.null_nonfinite(value), F.lit(0.0)).alias("value"))


@query
def fill_unknown(t: Tables) -> DataFrame:
    label = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return t.raw("orders").select("o_orderkey", text.fill_unknown(label).alias("label"))


@query
def fill_zero(t: Tables) -> DataFrame:
    joined = t.entities().join(totals.event_counts(t.events()), "entity_id", "left").withColumn(
        "has_events", F.when(F.col("event_total") > 0, F.lit(True))
    )
    return clean.fill_zero(joined).select("entity_id", "event_total", "has_events")


@query
def activity_score(t: Tables) -> DataFrame:
    return rounded(t.model().select("entity_id", "activity"), "activity")


@query
def cost_per_activity(t: Tables) -> DataFrame:
    return rounded(t.master().select("entity_id", "cost_per_activity"), "cost_per_activity")


@query
def flag_no_expense(t: Tables) -> DataFrame:
    entities = t.entities().select("entity_id")
    idle = entities.select((-F.col("entity_id") - 1).alias("entity_id"))  # as many that spend nothing
    joined = entities.unionAll(idle).join(totals.expense_totals(t.amounts()), "entity_id", "left")
    return joined.select(
        "entity_id", measures.flag_no_expense(F.col("spend_total"), F.col("expense_count")).alias("no_expense")
    )


@query
def spend_per_distance(t: Tables) -> DataFrame:
    return rounded(t.model().select("entity_id", "spend_per_km"), "spend_per_km")


def _places(t: Tables) -> DataFrame:
    """One point per customer."""
    key = F.col("c_nationkey").cast("double")
    return t.raw("customer").select(
        "c_custkey", "c_acctbal",
        (F.lit(-30.0) + key * F.lit(1.3) + F.col("c_acctbal") / F.lit(1e4)).alias("lat"),
        (F.lit(-70.0) + key * F.lit(1.2)).alias("lon"),
    )


@query
def distance_km(t: Tables) -> DataFrame:
    """The iteration is long work on short rows, and a whole table may lie in one row group: rows are dealt first."""
    km = geo.distance_to_reference(F.col("lat"), F.col("lon"))
    parts = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return _places(t).repartition(parts).select("c_custkey", F.round(km, DIGITS).alias("km"))


@query
def polygon_centroid(t: Tables) -> DataFrame:
    """Per customer: a rectangle with a rectangular hole, and a second clockwise rectangle."""
    lon, lat = F.col("lon"), F.col("lat")
    width = F.lit(2.0) + F.abs(F.col("c_acctbal")) / F.lit(1e4)

    def box(x, y, w, h, clockwise=False):
        corners = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
        return F.array(*[F.array(a, b) for a, b in (corners[::-1] if clockwise else corners)])

    first = F.array(box(lon, lat, width, F.lit(2.0)), box(lon + 0.5, lat + 0.5, F.lit(1.0), F.lit(0.5)))
    second = F.array(box(lon + 10, lat + 1, F.lit(2.0), F.lit(1.0), clockwise=True))
    shapes = _places(t).select(F.col("c_custkey").alias("region"), F.array(first, second).alias("parts"))
    return rounded(regions.region_centroids(shapes), "lat", "lon")


@query
def read_regions(t: Tables) -> DataFrame:
    """Centroids of shapes read back from GeoJSON: one feature collection per customer, a polygon for
    those with a positive balance and a two-part polygon for the others."""
    lon, lat = F.col("lon"), F.col("lat")

    def box(x, w):
        return F.array(*[F.array(a, b) for a, b in ((x, lat), (x + w, lat), (x + w, lat + 1), (x, lat + 1), (x, lat))])

    def collection(kind, coordinates):
        shape = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
        names = F.struct(F.col("c_custkey").cast("string").alias("sigla"))
        return F.to_json(F.struct(F.array(F.struct(names.alias("properties"), shape.alias("geometry"))).alias("features")))

    polygon = collection("Polygon", F.array(box(lon, F.lit(2.0))))
    parts = collection("MultiPolygon", F.array(F.array(box(lon, F.lit(2.0))), F.array(box(lon + 4, F.lit(1.0)))))
    path = scratch_path(t.spark, "regions")
    _places(t).select(F.when(F.col("c_acctbal") > 0, polygon).otherwise(parts).alias("value")).write.text(path)
    found = regions.region_centroids(regions.read_regions(t.spark, path, multi_line=False))
    return rounded(found, "lat", "lon")


@query
def replace_values(t: Tables) -> DataFrame:
    return t.raw("orders").select(
        "o_orderkey", numbers.replace_values(F.col("o_orderstatus"), {"P": "PENDING"}).alias("status")
    )


@query
def pick_value_column(t: Tables) -> DataFrame:
    return t.signed_lines().select(*LINE, "amount").transform(
        lambda df: df.withColumn("spend", clean.pick_value_column(df)).drop("amount")
    )


@query
def pick_time_column(t: Tables) -> DataFrame:
    rows = t.raw("orders").select("o_orderkey", F.year("o_orderdate").alias("document_yr"), F.lit(1).alias("plain_yr"))
    return rows.select("o_orderkey", F.col(clean.pick_time_column(rows)).alias("picked"))


@query
def format_amount(t: Tables) -> DataFrame:
    scaled = F.col("o_totalprice") * F.when(F.col("o_orderstatus") == "O", 100.0).when(
        F.col("o_orderstatus") == "P", 0.001).otherwise(1.0)
    return t.raw("orders").select("o_orderkey", numbers.format_amount(scaled).alias("shown"))


@query
def label_entity(t: Tables) -> DataFrame:
    return t.entities().select("entity_id", text.label_entity(F.col("name"), F.col("grp")).alias("label"))


@query
def cost_per_item_norm(t: Tables) -> DataFrame:
    cost = measures.cost_per_item_norm(F.col("spend_per_km"), F.col("item_total"))
    return t.model().select("entity_id", F.round(cost, DIGITS).alias("cost_per_item"))


# Filters


@query
def drop_null_key(t: Tables) -> DataFrame:
    keyed = t.raw("events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("user_id")).alias("entity_id")
    )
    return filters.drop_null_key(keyed)


@query
def drop_null_value(t: Tables) -> DataFrame:
    valued = t.raw("events").select("event_id", F.when(F.col("event_type") != "view", F.col("value")).alias("amount"))
    return filters.drop_null_value(valued)


@query
def year_range(t: Tables) -> DataFrame:
    return filters.year_range(t.items(), **YEARS)


@query
def in_top_groups(t: Tables) -> DataFrame:
    master = t.stored_master()
    return filters.in_top_groups(master, ranking.group_totals(master, 5)).select("entity_id", "grp")


@query
def active_only(t: Tables) -> DataFrame:
    return filters.active_only(t.master()).select("entity_id")


@query
def nonnegative_spend(t: Tables) -> DataFrame:
    net = t.master().select("entity_id", F.col("spend_net").alias("spend_total"))
    return filters.nonnegative_spend(net)


@query
def drop_zero_rows(t: Tables) -> DataFrame:
    return filters.drop_zero_rows(t.master(), ["event_total", "refund_count"]).select("entity_id")


# Joins


@query
def attach_metrics(t: Tables) -> DataFrame:
    return joins.attach_metrics(
        t.entities(), totals.expense_totals(t.amounts()), totals.item_counts(t.items()),
        totals.event_counts(t.events()),
    )


@query
def attach_category_columns(t: Tables) -> DataFrame:
    spent = t.expenses()
    return joins.attach_category_columns(totals.expense_totals(spent), totals.category_pivot(spent, CATEGORIES))


def _with_strays(facts: DataFrame) -> DataFrame:
    """The facts, and those of every tenth entity once more under an id that no entity has."""
    key = F.col("entity_id")
    return facts.withColumn("entity_id", F.explode(F.when(key % 10 == 3, F.array(key, -key - 1)).otherwise(F.array(key))))


@query
def attach_group(t: Tables) -> DataFrame:
    rows = t.entity_lines().select("l_orderkey", "l_linenumber", "l_suppkey", "entity_id", "amount")
    return joins.attach_group(_with_strays(rows), t.entities(), ("grp", "name"))


@query
def attach_distance(t: Tables) -> DataFrame:
    """All entities, every tenth once more in a region that the lookup lacks."""
    region = F.when(F.col("entity_id") < 0, F.lit("NOWHERE")).otherwise(F.col("region"))
    everyone = _with_strays(t.entities()).withColumn("region", region)
    return rounded(joins.attach_distance(everyone, t.distances()).select("entity_id", "distance_km"), "distance_km")


# Deduplication and totals


@query
def dedup_rows(t: Tables) -> DataFrame:
    return dedup.dedup_rows(t.raw("lineitem").select("l_partkey", "l_returnflag", "l_linestatus"))


@query
def dedup_first(t: Tables) -> DataFrame:
    rows = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    return dedup.dedup_first(rows, ["l_orderkey", "l_linenumber"], ["l_suppkey", "l_extendedprice"])


@query
def clean_entities(t: Tables) -> DataFrame:
    """Customers and, as repeats with other names, suppliers, keyed by untidy text."""
    first = t.entities().select(F.concat(F.lit(" "), F.col("entity_id").cast("string")).alias("id"), "name", "grp", "region")
    second = t.raw("supplier").select(
        F.concat(F.col("s_suppkey").cast("string"), F.lit(".0")).alias("id"), F.col("s_name").alias("name"),
        F.lit("supplier").alias("grp"), F.lit("none").alias("region"),
    )
    bad = t.raw("region").select(
        F.col("r_name").alias("id"), F.col("r_name").alias("name"), F.lit("bad").alias("grp"), F.lit("bad").alias("region")
    )
    return clean.clean_entities(first.unionByName(second).unionByName(bad).withColumn("extra", F.lit(1)))


@query
def clean_expenses(t: Tables) -> DataFrame:
    """Expenses with every refund row delivered twice."""
    rows = t.raw_expenses().withColumnsRenamed({"entity_id": "id"}).withColumn("amount", F.col("amount").cast("string"))
    twice = rows.withColumn("copy", F.explode(F.sequence(
        F.lit(1), F.when(F.startswith("amount", F.lit("-")), F.lit(2)).otherwise(F.lit(1))
    ))).drop("copy")
    return clean.clean_expenses(twice)


@query
def clean_counts(t: Tables) -> DataFrame:
    """Refunds twice, some keys and amounts no numbers: what cleaning read and kept, counted as it ran."""
    line = F.col("l_linenumber")
    rows = t.raw_expenses().withColumns({
        "id": F.when(line == 7, "none").otherwise(F.col("entity_id").cast("string")),
        "copy": F.explode(F.sequence(F.lit(1), F.when(F.col("amount") < 0, F.lit(2)).otherwise(F.lit(1)))),
    }).withColumn("amount", F.when(line == 6, "n/a").otherwise(F.col("amount").cast("string"))).drop("entity_id", "copy")
    counts = Counts()
    spent = materialize(clean.clean_expenses(rows, counts=counts), "expenses")
    model = tables.modelling_table(t.entities(), spent, t.items(), t.events(), t.distances())
    materialize(tables.counted_model(model, counts), "model")
    return counts.table(t.spark)


@query
def stored_facts(t: Tables) -> DataFrame:
    """Totals and their join with the entities on facts stored by entity."""
    def stored(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(t.spark, label)
        return files.write_facts(df, path, path.rsplit("/", 1)[-1].replace("-", "_"), "entity_id", 8)

    return joins.attach_metrics(stored(t.entities(), "entities"), totals.expense_totals(stored(t.amounts(), "facts")))


@query
def clean_items(t: Tables) -> DataFrame:
    rows = t.entity_lines().select("entity_id", F.col("l_orderkey").alias("item_id"), "yr")
    return clean.clean_items(rows)


@query
def clean_items_collapsed(t: Tables) -> DataFrame:
    return clean.clean_items(t.items(), collapse_to_entity=True)


@query
def clean_events(t: Tables) -> DataFrame:
    rows = _dirty(t).select("entity_id", "event_id", "yr")
    return clean.clean_events(rows.unionByName(rows.where("yr is null")))


@query
def expense_totals(t: Tables) -> DataFrame:
    return totals.expense_totals(t.amounts())


@query
def expense_totals_subcent(t: Tables) -> DataFrame:
    """Amounts in ten thousands, so with six decimals."""
    part = lambda c: F.round(F.col(c) * 100).cast("bigint") / F.lit(1e6)
    rows = t.amounts().withColumns({"amount": part("amount"), "amount_pos": part("amount_pos")})
    return totals.expense_totals(rows)


@query
def expense_totals_rows(t: Tables) -> DataFrame:
    rows = t.amounts().withColumn("amount_pos", F.when(~F.col("is_refund"), F.col("amount_pos")))
    return totals.expense_totals(rows, count_rows=True)


@query
def count_refunds(t: Tables) -> DataFrame:
    return totals.count_refunds(t.signed_lines())


@query
def item_counts(t: Tables) -> DataFrame:
    return totals.item_counts(t.items())


@query
def event_counts(t: Tables) -> DataFrame:
    return totals.event_counts(t.events())


@query
def category_pivot(t: Tables) -> DataFrame:
    return totals.category_pivot(t.expenses(), CATEGORIES)


@query
def category_pivot_unlisted(t: Tables) -> DataFrame:
    """A category list without the machines, whose spend counts as the default's."""
    return totals.category_pivot(t.expenses(), [c for c in CATEGORIES if c != "machines"], DEFAULT)


@query
def modelling_table(t: Tables) -> DataFrame:
    return rounded(t.model(), "distance_km", "activity", "spend_per_km")


@query
def master_table(t: Tables) -> DataFrame:
    return rounded(t.master(), "activity", "cost_per_activity")


@query
def prepared_master(t: Tables) -> DataFrame:
    prepared = order_stats.spend_band(t.stored_master())
    return rounded(prepared, "activity", "cost_per_activity", "log_spend")


@query
def category_totals(t: Tables) -> DataFrame:
    return totals.category_totals(t.expenses())


@query
def group_totals(t: Tables) -> DataFrame:
    return ranking.group_totals(t.master(), 10)


@query
def region_means(t: Tables) -> DataFrame:
    return rounded(ranking.region_means(t.master(), 15), "mean_spend")


@query
def region_totals(t: Tables) -> DataFrame:
    return ranking.region_totals(t.master())


@query
def group_category_matrix(t: Tables) -> DataFrame:
    return groups.group_category_matrix(_with_strays(t.expenses()), t.entities(), CATEGORIES)


@query
def group_category_log(t: Tables) -> DataFrame:
    return rounded(groups.group_category_log(groups.group_category_matrix(_with_strays(t.expenses()), t.entities(), CATEGORIES)), "log_spend")


@query
def entity_category_grid(t: Tables) -> DataFrame:
    return groups.entity_category_grid(_with_strays(t.expenses()), t.entities(), CATEGORIES)


@query
def year_group_series(t: Tables) -> DataFrame:
    return groups.year_group_series(_with_strays(t.amounts()), t.entities(), 6, **YEARS)


@query
def group_profile_median(t: Tables) -> DataFrame:
    return rounded(groups.group_profile(t.stored_master(), 10, renames=RENAMES), *groups.PROFILE)


@query
def group_profile_mean(t: Tables) -> DataFrame:
    return rounded(groups.group_profile_mean(t.stored_master(), 12), *stats.METRICS)


@query
def group_profile_max(t: Tables) -> DataFrame:
    return rounded(groups.group_profile(t.stored_master(), 10, "max", renames={}), *groups.PROFILE)


@query
def summary_stats(t: Tables) -> DataFrame:
    summary = stats.summary_stats(t.stored_master())
    return rounded(summary, *[c for c in summary.columns if c != "entities"])


@query
def pearson(t: Tables) -> DataFrame:
    return rounded(stats.pearson(t.model()), "r")


@query
def correlation_matrix(t: Tables) -> DataFrame:
    return rounded(stats.correlation_matrix(t.master()), "r")


@query
def linear_trend(t: Tables) -> DataFrame:
    return rounded(stats.linear_trend(t.stored_master()), "slope", "intercept", "x", "y")


@query
def log_trend(t: Tables) -> DataFrame:
    return rounded(stats.log_trend(t.stored_master()), "slope", "intercept", "y").withColumn("x", F.round("x", 3))


@query
def spend_histogram(t: Tables) -> DataFrame:
    return rounded(stats.spend_histogram(t.stored_master()), "low", "high", "mean", "median")


BOXED = ["spend_total", "activity", "cost_per_activity"]
BOX_PARTS = ["q1", "median", "q3", "whisker_low", "whisker_high"]


@query
def box_stats(t: Tables) -> DataFrame:
    return rounded(stats.box_stats(t.stored_master(), BOXED), *BOX_PARTS)


@query
def box_stats_by_group(t: Tables) -> DataFrame:
    master = t.stored_master()
    rows = filters.in_top_groups(master, ranking.group_totals(master, 10))
    return rounded(stats.box_stats(rows, ["spend_total"], ["grp"]), *BOX_PARTS)


@query
def box_outliers(t: Tables) -> DataFrame:
    return rounded(stats.box_outliers(t.stored_master(), BOXED), "value")


@query
def line_box_stats(t: Tables) -> DataFrame:
    """Quartiles of every expense line's price per return flag: the distributed sort on the large table."""
    lines = t.raw("lineitem").select(
        "l_returnflag", F.col("l_extendedprice").alias("price"),
        F.xxhash64(*LINE, "l_extendedprice").alias("line"),
    )
    return rounded(stats.box_stats(lines, ["price"], ["l_returnflag"], key="line"), *BOX_PARTS)


@query
def spend_hierarchy(t: Tables) -> DataFrame:
    return rounded(hierarchy.spend_hierarchy(t.stored_master()), "colour")


@query
def category_hierarchy(t: Tables) -> DataFrame:
    grid = groups.entity_category_grid(_with_strays(t.expenses()), t.entities(), CATEGORIES)
    return rounded(hierarchy.category_hierarchy(grid), "colour")


# Ranks and scaling


@query
def spend_band(t: Tables) -> DataFrame:
    return order_stats.spend_band(t.stored_master()).select("entity_id", "band_no", "spend_band")


@query
def spend_band_lines(t: Tables) -> DataFrame:
    """The same bands over all expense lines, counted: the sort runs on the large table."""
    lines = t.signed_lines().select(F.xxhash64(*LINE, "l_extendedprice").alias("entity_id"), F.col("amount").alias("spend_total"))
    return order_stats.spend_band(lines).groupBy("band_no", "spend_band").agg(
        F.count(F.lit(1)).alias("rows"), F.min("spend_total").alias("low"), F.max("spend_total").alias("high")
    )


@query
def minmax_scale(t: Tables) -> DataFrame:
    profile = groups.group_profile_scaled(t.stored_master())
    scaled = [f"{m}_scaled" for m in groups.PROFILE]
    return rounded(profile.select("grp", *scaled), *scaled)


@query
def zscore(t: Tables) -> DataFrame:
    scored = scaling.zscore(t.stored_model(), ["spend_per_km", "activity"])
    return rounded(scored.select("entity_id", "spend_per_km_z", "activity_z"), "spend_per_km_z", "activity_z")


@query
def group_zscores(t: Tables) -> DataFrame:
    scored = [f"{m}_z" for m in stats.METRICS]
    return rounded(groups.group_zscores(t.stored_master()).select("grp", *scored), *scored)


# Rankings


@query
def top_spenders(t: Tables) -> DataFrame:
    return rounded(ranking.top_spenders(t.master()), "activity", "cost_per_activity")


@query
def top_cost(t: Tables) -> DataFrame:
    return rounded(ranking.top_cost(t.master()), "activity", "cost_per_activity")


@query
def top_refunds(t: Tables) -> DataFrame:
    return ranking.top_refunds(t.master())


@query
def label_candidates(t: Tables) -> DataFrame:
    return rounded(ranking.label_candidates(t.stored_master()), "log_spend", "activity", "cost_per_activity")


@query
def label_candidates_raw(t: Tables) -> DataFrame:
    return rounded(ranking.label_candidates(t.master(), raw=True), "activity", "cost_per_activity")


@query
def top_entities(t: Tables) -> DataFrame:
    return ranking.top_entities(t.master().select("entity_id", "spend_total"))


@query
def reorder_to_list(t: Tables) -> DataFrame:
    master = t.stored_master()
    per_group = master.groupBy("grp").agg(F.count(F.lit(1)).alias("entities"))
    return ranking.reorder_to_list(per_group, ranking.group_totals(master, 7))


@query
def top_cost_per_item(t: Tables) -> DataFrame:
    return rounded(ranking.top_cost_per_item(t.model()), "cost_per_item")


# Reshape


@query
def melt_metrics(t: Tables) -> DataFrame:
    rows = t.master().withColumn("event_total", F.nullif("event_total", F.lit(0)))
    return rounded(order_stats.melt_metrics(rows, ["spend_total", "activity", "event_total"], ["entity_id"]), "value")


@query
def pivot_sum(t: Tables) -> DataFrame:
    return totals.pivot_sum(t.raw("orders"), ["o_custkey"], "o_orderstatus", ["F", "O", "P"], "o_totalprice")


@query
def stack_dense(t: Tables) -> DataFrame:
    wide = totals.category_pivot(t.expenses(), CATEGORIES)
    return groups.stack_dense(wide, ["entity_id"], [text.category_column(c) for c in CATEGORIES])


# Clustering and similarity


@query
def kmeans_sweep(t: Tables) -> DataFrame:
    labelled, _ = cluster.kmeans_sweep(t.stored_model())
    return labelled.select("entity_id", "cluster")


@query
def kmeans_choice(t: Tables) -> DataFrame:
    """The k values tried and the one chosen: the lowest cost, which the largest k has."""
    _, costs = cluster.kmeans_sweep(t.stored_model())
    return costs.select("k", "chosen")


@query
def cluster_summary(t: Tables) -> DataFrame:
    labelled, _ = cluster.kmeans_sweep(t.stored_model())
    return rounded(
        cluster.cluster_summary(labelled), "mean_spend_per_km", "mean_activity", "mean_distance_km"
    )


@query
def group_distance(t: Tables) -> DataFrame:
    return rounded(groups.group_distance(t.stored_master()), "distance")


@query
def group_hierarchy(t: Tables) -> DataFrame:
    return rounded(cluster.group_hierarchy(t.stored_master()).select("grp", "cluster", "to_centre"), "to_centre")


@query
def scatter_mart(t: Tables) -> DataFrame:
    return rounded(groups.scatter_mart(t.stored_master()), "log_spend", "activity", "cost_per_activity")


@query
def scatter_mart_raw(t: Tables) -> DataFrame:
    return rounded(groups.scatter_mart(t.master(), raw=True), "activity", "cost_per_activity")


@query
def strip_mart(t: Tables) -> DataFrame:
    return rounded(groups.strip_mart(t.stored_master()), "activity", "cost_per_activity")
