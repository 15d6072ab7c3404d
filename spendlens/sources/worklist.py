"""Which (entity, year) requests exist, are done, and are still open."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.dedup import dedup_first

PAIR = ["entity_id", "yr"]


def build_worklist(entities: DataFrame, years: list[int]) -> DataFrame:
    """Every entity with every year of a short list; expands each row in place, no shuffle."""
    listed = F.array(*[F.lit(int(y)) for y in years])
    return entities.select("entity_id", F.explode(listed).alias("yr"))


def pending_work(worklist: DataFrame, done: DataFrame) -> DataFrame:
    return worklist.join(done.select(*PAIR), PAIR, "left_anti")


def common_type(one: T.DataType, two: T.DataType) -> T.DataType:
    """A type that holds the values of both: the wider integer, else double for numbers, else text."""
    if one == two or isinstance(two, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return two
    if isinstance(one, T.IntegralType) and isinstance(two, T.IntegralType):
        order = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
        return order[max(order.index(one), order.index(two))]
    if isinstance(one, T.NumericType) and isinstance(two, T.NumericType):
        return T.DoubleType()
    if isinstance(one, (T.DateType, T.TimestampType)) and isinstance(two, (T.DateType, T.TimestampType)):
        return T.TimestampType()
    return T.StringType()


def merge_batches(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old records followed by new ones; a column missing on one side is NULL there.

    A column whose type differs takes one that holds both (``common_type``): what came as a number once and as text
    later becomes text, nested values become their JSON. Nothing raises and no value is lost.
    """
    kinds = {f.name: f.dataType for f in new.schema}
    shared = {f.name: common_type(f.dataType, kinds[f.name]) for f in old.schema if f.name in kinds}

    def fitted(df: DataFrame) -> DataFrame:
        nested = (T.StructType, T.ArrayType, T.MapType)
        changed = {n: k for n, k in shared.items() if df.schema[n].dataType != k}
        return df.withColumns({
            n: F.to_json(F.col(f"`{n}`")) if isinstance(df.schema[n].dataType, nested) else F.col(f"`{n}`").cast(k)
            for n, k in changed.items()
        })

    return fitted(old).unionByName(fitted(new), allowMissingColumns=True)


def mark_done(done: DataFrame, batch: DataFrame) -> DataFrame:
    """Finished pairs, distinct. Sorting is left to the writer (``sortWithinPartitions``)."""
    return done.select(*PAIR).unionByName(batch.select(*PAIR)).distinct()


def union_entities(*terms: DataFrame, key: str = "entity_id") -> DataFrame:
    """Entities of several terms, one row per id; the earliest term wins."""
    tagged = [term.withColumn("__term", F.lit(i)) for i, term in enumerate(terms)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    rest = [c for c in merged.columns if c not in (key, "__term")]
    return dedup_first(merged, [key], ["__term", *rest]).drop("__term")
