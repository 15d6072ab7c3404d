"""Logical tables over the driver's star schema (see FIXTURES.md section 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.text import Rules
from ..operators.clean import categorise_expenses
from ..plans.tables import master_table, modelling_table, prepared_columns
from ..session import materialize
from ..functions.numbers import clip_floor, flag_refund
from ..sources.regions import region_distances

RULES: Rules = {
    "fasteners": ["bolt", "rod", "ring"],
    "machines": ["gear", "gizmo", "widget"],
    "finish": ["plate", "anvil"],
}
DEFAULT = "other"
CATEGORIES = [*RULES, DEFAULT]


class Tables:
    """One data folder seen as entities, expenses, items, events and distances."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def entities(self) -> DataFrame:
        places = self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return self.raw("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("name"),
            F.concat_ws("-", "c_mktsegment", "r_name").alias("grp"), F.col("n_name").alias("region"),
        )

    def signed_lines(self) -> DataFrame:
        price = F.col("l_extendedprice")
        return self.raw("lineitem").withColumn(
            "amount", F.when(F.col("l_returnflag") == "R", -price).otherwise(price)
        )

    def kinds(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("l_partkey"), F.concat_ws(" ", "p_type", "p_name").alias("kind")
        )

    def entity_lines(self) -> DataFrame:
        """Lines with their entity. Large joins carry no hint: Spark broadcasts by size and splits skewed
        partitions at run time."""
        lines = self.signed_lines().select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "amount", F.year("l_shipdate").alias("yr")
        )
        orders = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("entity_id"))
        return lines.join(orders, "l_orderkey")

    def raw_expenses(self, kinds: DataFrame | None = None) -> DataFrame:
        """Expense rows as they arrive, with the line's own keys and the expense text."""
        return self.entity_lines().join(self.kinds() if kinds is None else kinds, "l_partkey")

    def expenses(self) -> DataFrame:
        """Clean, categorised expenses. The text is an attribute of the part, so it is classified there,
        once per part, and only the category travels with the lines."""
        kinds = categorise_expenses(self.kinds(), RULES, DEFAULT)
        return self._cleaned(self.raw_expenses(kinds).select("entity_id", "yr", "amount", "kind", "category"))

    def amounts(self) -> DataFrame:
        """Clean expenses without their text, for totals that do not ask for it: no join with the parts."""
        return self._cleaned(self.entity_lines().select("entity_id", "yr", "amount"))

    def _cleaned(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({
            "amount_pos": clip_floor(F.col("amount")), "is_refund": flag_refund(F.col("amount")),
        })

    def items(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_custkey").alias("entity_id"), F.col("o_orderkey").alias("item_id"),
            F.year("o_orderdate").alias("yr"),
        )

    def events(self) -> DataFrame:
        return self.raw("events").select(
            F.col("user_id").alias("entity_id"), "event_id", F.year("ts").alias("yr")
        )

    def centroids(self) -> DataFrame:
        key = F.col("n_nationkey").cast("double")
        return self.raw("nation").select(
            F.col("n_name").alias("region"),
            (F.lit(-30.0) + key * F.lit(1.3)).alias("lat"), (F.lit(-70.0) + key * F.lit(1.2)).alias("lon"),
        )

    def distances(self) -> DataFrame:
        return region_distances(self.centroids())

    def model(self) -> DataFrame:
        return modelling_table(self.entities(), self.amounts(), self.items(), self.events(), self.distances())

    def master(self) -> DataFrame:
        return master_table(self.entities(), self.expenses(), self.items(), self.events(), CATEGORIES)

    def stored_master(self) -> DataFrame:
        """The prepared master as a stored table, the way the marts use it: written once, read often."""
        return materialize(prepared_columns(self.master()), "master")

    def stored_model(self) -> DataFrame:
        return materialize(self.model(), "model")

    def pages(self) -> DataFrame:
        """Orders as page payloads: one order per page, empty pages for urgent orders, and a next link
        except on finished orders."""
        record = F.struct(
            F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total"),
            F.col("o_orderstatus").alias("status"),
        )
        empty = F.col("o_orderpriority") == "1-URGENT"
        link = lambda rel: F.struct(F.lit(rel).alias("rel"), F.lit("/page").alias("href"))
        return self.raw("orders").select(
            F.col("o_custkey").alias("request_entity"), F.year("o_orderdate").alias("request_year"),
            F.row_number().over(
                Window.partitionBy("o_custkey", F.year("o_orderdate")).orderBy("o_orderkey")
            ).cast("long").alias("page"),
            F.filter(F.array(record), lambda _: ~empty).alias("dados"),
            F.when(F.col("o_orderstatus") == "F", F.array(link("self")))
            .otherwise(F.array(link("self"), link("next"))).alias("links"),
        )
