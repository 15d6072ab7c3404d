"""Joins, written so that a hot key cannot overload one task."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Row, functions as F, types as T

from ..functions.text import fill_unknown
from ..session import materialize


def hot_keys(counts: DataFrame, keys: list[str], rows: str) -> list[Row]:
    """Keys holding more rows than a shuffle partition does on average, from row counts per key.

    There are fewer of them than shuffle partitions, whatever the data, so they may come to the driver.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum(rows)).scalar()
    return counts.where(F.col(rows) * partitions > total).select(*keys).collect()


def key_counts(facts: DataFrame, keys: list[str]) -> DataFrame:
    return facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))


def skew_safe_join(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left",
                   hot: list[Row] | None = None) -> DataFrame:
    """Join ``facts`` to a ``lookup`` that is unique per key, salting the hot keys only.

    A hot key's fact rows are spread over as many slices as there are shuffle partitions and its one
    lookup row is repeated for each slice; all other rows keep salt 0. Adaptive skew handling cannot
    do this when the lookup is an aggregate already partitioned by the key. Rows with a NULL key match
    nothing and are spread as well.
    The salt is a hash of the row and of its input partition: copies of one row part ways, and a re-run
    task still sends each row to the same place. Without ``hot`` the keys are counted first, in one
    pass over the key columns.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    if hot is None:
        hot = hot_keys(key_counts(facts, keys), keys, "__n")
    if not hot:
        return facts.join(lookup, keys, how)
    slices = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([facts.schema[k] for k in keys])
    marked = F.broadcast(facts.sparkSession.createDataFrame(hot, schema).withColumn("__hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*facts.columns, F.spark_partition_id()), F.lit(slices)).cast("int")
    scattered = reduce(or_, [F.col(k).isNull() for k in keys], F.col("__hot"))
    salted_facts = facts.join(marked, keys, "left").withColumn(
        "__salt", F.when(scattered, spread).otherwise(F.lit(0))
    ).drop("__hot")
    salted_lookup = lookup.join(marked, keys, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.when(F.col("__hot"), F.lit(slices - 1)).otherwise(F.lit(0))))
    ).drop("__hot")
    return salted_facts.join(salted_lookup, [*keys, "__salt"], how).drop("__salt")


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join to a lookup unique per key, stored first: Spark then knows its bytes, broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold`` and else splits skewed partitions of the facts at run time, which it
    cannot do next to an aggregate."""
    return facts.join(materialize(lookup, "lookup"), keys, how)


def attach_metrics(entities: DataFrame, *metrics: DataFrame, key: str = "entity_id") -> DataFrame:
    """Entities with each metric frame on the left; both sides have one row per key.

    The metric frames come out of ``groupBy(key)``, so only ``entities`` is shuffled here.
    """
    out = entities
    for metric in metrics:
        out = out.join(metric, key, "left")
    return out


def attach_category_columns(totals: DataFrame, wide: DataFrame, key: str = "entity_id") -> DataFrame:
    spend = [c for c in wide.columns if c != key]
    return totals.join(wide, key, "left").na.fill(0.0, spend)


def attach_group(facts: DataFrame, entities: DataFrame, columns: tuple[str, ...] = ("grp",),
                 key: str = "entity_id") -> DataFrame:
    """Fact rows with their entity's group (and name); a missing group gets the unknown label.

    ``entities`` has one row per key. One entity may own very many rows, so hot ones are salted unless
    the entities are few enough to broadcast. The marts sum per entity first and need neither.
    """
    joined = lookup_join(facts, entities.select(key, *columns), [key])
    return joined.withColumn("grp", fill_unknown(F.col("grp"))) if "grp" in columns else joined


def attach_distance(entities: DataFrame, distances: DataFrame) -> DataFrame:
    """Distance of the entity's region; 0 km where the region is not in the lookup. A region that the lookup lists
    several times has the largest of its distances."""
    lookup = distances.groupBy("region").agg(F.max("distance_km").alias("distance_km"))
    joined = lookup_join(entities, lookup, ["region"])
    return joined.withColumn("distance_km", F.coalesce("distance_km", F.lit(0.0)))
