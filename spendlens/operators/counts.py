"""Row counts taken in the pass that makes a table, so that reporting them costs no scan."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


class Counts:
    """Counts of the rows that pass given points of a plan; known once an action has run the plan to its end.

    A plan that runs twice keeps the counts of its first run. Filters do not move across a counted point. Tasks of a
    stage that is run again after a lost executor may count twice: the counts are a report, nothing is decided by them.
    """

    def __init__(self):
        self._held: list[Observation] = []

    def watch(self, df: DataFrame, name: str, **conditions: Column) -> DataFrame:
        """``df``, whose rows are counted as ``name``, and those that meet a condition as its name."""
        held = Observation(f"{name}-{uuid.uuid4().hex}")
        self._held.append(held)
        return df.observe(held, F.count(F.lit(1)).alias(name), *[F.count_if(c).alias(n) for n, c in conditions.items()])

    def table(self, spark: SparkSession) -> DataFrame:
        """counted, rows: one row for each count. Waits for actions that still run."""
        found = [(name, rows) for held in self._held for name, rows in held.get.items()]
        return spark.createDataFrame(found, "counted string, rows long")
