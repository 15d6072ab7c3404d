"""Joins under skew, group marts, hierarchies, rankings."""

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from spendlens.operators import groups, hierarchy, joins, ranking


def test_skew_safe_join_spreads_the_hot_key(spark, spread):
    facts = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    lookup = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.skew_safe_join(facts, lookup, ["k"])
        want = facts.join(lookup, "k", "left")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        hot = joins.hot_keys(joins.key_counts(facts, ["k"]), ["k"], "__n")
        assert [r.k for r in hot] == [7]
        parts = got.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 1 and max(r["count"] for r in parts) < 2001
        inner = joins.skew_safe_join(facts, lookup, ["k"], "inner")
        assert inner.count() == facts.join(lookup, "k").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        joins.skew_safe_join(facts, lookup, ["k"], "right")


def test_skew_safe_join_spreads_copies_and_missing_keys(spark, spread):
    facts = spark.range(3000).repartition(6).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k"))
    lookup = spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.skew_safe_join(facts, lookup, ["k"]).withColumn("p", F.spark_partition_id())
        assert got.count() == 3000 and got.where("w is null").count() == 1000
        for wanted in ("k = 7", "k is null"):
            assert got.where(wanted).select("p").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_join_beyond_the_broadcast_bound(spark):
    facts, lookup = spark.range(50).withColumnRenamed("id", "k"), spark.range(20).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    small = joins.lookup_join(facts, lookup, ["k"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.lookup_join(facts, lookup, ["k"])
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert rows(small, "k") == rows(large, "k")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_attach_group_and_distance(spark):
    facts = spark.createDataFrame([(1, 5.0), (2, 6.0), (9, 7.0)], "entity_id long, amount double")
    entities = spark.createDataFrame([(1, "A"), (2, None)], "entity_id long, grp string")
    assert rows(joins.attach_group(facts, entities), "entity_id") == [(1, 5.0, "A"), (2, 6.0, "Desconhecido"), (9, 7.0, "Desconhecido")]
    places = spark.createDataFrame([(1, "X"), (2, "Q")], "entity_id long, region string")
    known = spark.createDataFrame([("X", 3.0), ("X", 3.0)], "region string, distance_km double")
    assert rows(joins.attach_distance(places, known).select("entity_id", "distance_km"), "entity_id") == [(1, 3.0), (2, 0.0)]


@pytest.fixture
def spent(spark):
    expenses = spark.createDataFrame([
        (1, "Transporte", 2023, 10.0), (1, "Outros", 2024, 5.0), (2, "Transporte", 2024, 4.0),
        (3, "Outros", 2021, 100.0), (4, "Outros", 2024, 50.0), (None, "Outros", 2024, 9.0),
    ], "entity_id long, category string, yr int, amount_pos double")
    entities = spark.createDataFrame([(1, "A", "Ana"), (2, "A", None), (3, "B", "Cy")], "entity_id long, grp string, name string")
    return expenses, entities


def test_matrix(spent):
    got = groups.group_category_matrix(*spent, n=2)
    assert rows(got.select("grp", "Transporte", "Outros", "Alimentação"), "grp") == [("B", 0.0, 100.0, 0.0), ("Desconhecido", 0.0, 50.0, 0.0)]
    logged = rows(groups.group_category_log(got).where("category = 'Outros'"), "grp")
    assert logged[0][2:] == (100.0, pytest.approx(np.log1p(100)))


def test_grid_drops_missing_names_after_ranking(spent):
    got = rows(groups.entity_category_grid(*spent, n=2), "grp", "name", "category")
    assert got == [("B", "Cy", "Outros", 100.0)]
    full = rows(groups.entity_category_grid(*spent, n=3), "grp", "name", "category")
    assert full == [("A", "Ana", "Outros", 5.0), ("A", "Ana", "Transporte", 10.0),
                    ("B", "Cy", "Outros", 100.0), ("B", "Cy", "Transporte", 0.0)]


def test_year_series_ranks_inside_the_range(spent):
    assert rows(groups.year_group_series(*spent, n=1)) == [("Desconhecido", 2024, 50.0)]
    assert rows(groups.year_group_series(*spent, n=9).select("yr", "grp", "spend")) == [
        (2023, "A", 10.0), (2024, "A", 9.0), (2024, "Desconhecido", 50.0)]


def master(spark, table):
    pdf = pd.DataFrame(table, columns=["entity_id", "grp", "spend_total"])
    for name in ("spend_net", "expense_count", "refund_count", "cost_per_activity"):
        pdf[name] = pdf.spend_total / 2
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("names,want", [
    (["PSL", "B"], [("B", 2, 3.0)]),                              # only the old name is listed: it drops out
    (["PSL", "UNIÃO"], [("UNIÃO", 2, 6.5)]),                      # both: rows merge under the new name
    (["UNIÃO", "B"], [("UNIÃO", 1, 10.0), ("B", 2, 3.0)]),        # new name only
])
def test_profile_renames_after_ranking(spark, names, want):
    df = master(spark, [(1, names[0], 10.0), (2, names[1], 3.0), (3, "Z", 0.0)])
    got = groups.group_profile(df, 3).select("grp", "pos", "spend_total")
    assert rows(got) == want


def test_profile_aggregates(spark):
    df = master(spark, [(1, "A", 1.0), (2, "A", 2.0), (3, "A", 9.0), (4, "B", 1.0)])
    median = groups.group_profile(df, 2)
    assert rows(median.select("grp", "spend_total")) == [("A", 2.0), ("B", 1.0)]
    assert rows(groups.group_profile(df, 2, "mean").select("grp", "spend_total")) == [("A", 4.0), ("B", 1.0)]
    scaled = groups.group_profile_scaled(df, 2).select("grp", "spend_total_scaled")
    assert rows(scaled, "grp") == [("A", 1.0), ("B", 0.0)]
    with pytest.raises(ValueError):
        groups.group_profile(df, 2, metrics=["spend_total"])


def test_group_distance(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({m: rng.uniform(0, 9, 20) for m in groups.METRICS}).assign(entity_id=range(20), grp=list("ABCD") * 5)
    got = groups.group_distance(spark.createDataFrame(pdf), 4).toPandas().set_index(["grp", "other"])["distance"]
    means = pdf.groupby("grp")[groups.METRICS].mean()
    z = (means - means.mean()) / means.std(ddof=0)
    assert len(got) == 6
    for (a, b), d in got.items():
        assert d == pytest.approx(np.linalg.norm(z.loc[a] - z.loc[b]))


def test_rankings_break_ties_by_key(spark):
    df = spark.createDataFrame([(3, 5.0), (1, 5.0), (2, 9.0), (4, None)], "entity_id long, spend_total double")
    assert [r.entity_id for r in ranking.top_k(df, "spend_total", 3).collect()] == [2, 1, 3]
    named = spark.createDataFrame([(1, "B", 5.0), (2, "A", 5.0), (3, None, 99.0)], "entity_id long, grp string, spend_total double")
    top = ranking.group_totals(named, 5)
    assert rows(top, "pos") == [("A", 5.0, 1), ("B", 5.0, 2)]
    assert [r.grp for r in ranking.reorder_to_list(named, top).collect()] == ["A", "B"]


def test_top_k_stays_a_bounded_top_k(spark):
    df = ranking.top_entities(spark.range(1000).select(F.col("id").alias("entity_id"), F.col("id").alias("spend_total")), 5)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_hierarchies(spark, spent):
    df = spark.createDataFrame(
        [(1, "A", "X", "a", 10.0, 1.0), (2, "A", "Y", "b", 30.0, 3.0), (3, "B", "X", "c", 0.0, 9.0)],
        "entity_id long, grp string, region string, name string, spend_total double, cost_per_activity double")
    got = hierarchy.spend_hierarchy(df)
    assert got.where("depth = 3").agg(F.sum("size")).first()[0] == got.where("depth = 0").first().size == 40.0
    assert got.where("depth = 0").first().colour == 2.5
    assert got.where("depth = 1 and grp = 'B'").first().colour is None
    assert hierarchy.spend_hierarchy(df, 1).where("depth = 3").count() == 1
    grid = groups.entity_category_grid(*spent, n=3)
    tree = hierarchy.category_hierarchy(grid)
    for depth in range(4):
        assert tree.where(F.col("depth") == depth).agg(F.sum("size")).first()[0] == 115.0


def test_missing_label_is_not_a_subtotal(spark):
    df = spark.createDataFrame([(1, None, "X", "a", 4.0, 1.0), (2, "A", "X", "b", 6.0, 1.0)],
                               "entity_id long, grp string, region string, name string, spend_total double, cost_per_activity double")
    got = hierarchy.spend_hierarchy(df)
    assert got.where("depth = 0").count() == 1 and got.where("depth = 1").count() == 2
