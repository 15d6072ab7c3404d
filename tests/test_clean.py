"""Key resolution, deduplication and cleaning of the four tables."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spendlens.operators import clean, filters, groups, joins, totals
from spendlens.operators.counts import Counts
from spendlens.operators.dedup import dedup_first, dedup_rows
from spendlens.plans.tables import master_table, modelling_table, prepared_columns, prepared_master
from spendlens.sources.files import write_facts
from spendlens.sources.schemas import to_canonical, to_source_names


def test_resolve_key(spark):
    only = clean.resolve_key(spark.createDataFrame([(1, "a")], "id long, name string"))
    both = clean.resolve_key(spark.createDataFrame([(1, 2)], "id long, entity_id long"))
    assert only.columns == ["entity_id", "name"] and rows(both) == [(2,)]


def test_coerce_key_needs_the_column(spark):
    with pytest.raises(ValueError):
        clean.coerce_key(spark.createDataFrame([(1,)], "x long"))


def test_dedup_first_takes_the_first(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, "z", 1), (None, "q", 1), (None, "p", 1)], "k long, v string, o int")
    assert rows(dedup_first(df, ["k"], ["o"]).select("k", "o"), "k") == [(None, 1), (1, 2), (2, 1)]
    assert rows(dedup_first(df.drop("o"), ["k"]), "k") == [(None, "p"), (1, "a"), (2, "z")]


def test_dedup_limits_each_task_before_the_shuffle(spark):
    df = dedup_first(spark.range(100).withColumn("k", F.col("id") % 3), ["k"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_clean_entities(spark):
    raw = spark.createDataFrame(
        [("7", "Ana", "A", "X", 1), ("7.0", "Zoe", "B", "Y", 2), ("x", "Bad", "A", "X", 3)],
        "id string, name string, grp string, region string, extra int")
    assert rows(clean.clean_entities(raw)) == [(7, "Ana", "A", "X")]


def test_clean_expenses(spark):
    raw = spark.createDataFrame(
        [("1", "10.5", "2023"), ("1", "10.5", "2023"), ("1", "-4", "2023.5"), ("2", "abc", "2024"), ("", "1", "2024"),
         ("3", "1e999", "2024"), ("3", "NaN", "2024"), ("3", None, "2024")],
        "entity_id string, amount string, yr string")
    assert rows(clean.clean_expenses(raw), "amount") == [(1, -4.0, None, 0.0, True), (1, 10.5, 2023, 10.5, False)]


def test_clean_expenses_money_text(spark):
    raw = spark.createDataFrame([(1, "R$ 1.000,50"), (1, None)], "entity_id long, amount string")
    assert rows(clean.clean_expenses(raw, money_text=True)) == [(1, 1000.5, 1000.5, False)]


def test_clean_items_pair_key_and_literal_key(spark):
    raw = spark.createDataFrame([(1, 10, 2023), (1, 10, 2024), (1, 11, 2023), (2, 10, 2023)], "entity_id long, id long, yr int")
    assert rows(clean.clean_items(raw).select("entity_id", "item_id"), "entity_id", "item_id") == [(1, 10), (1, 11), (2, 10)]
    assert rows(clean.clean_items(raw, collapse_to_entity=True).select("entity_id"), "entity_id") == [(1,), (2,)]
    named = raw.withColumnRenamed("id", "event_id")
    assert clean.clean_events(named).count() == 3


def test_clean_works_without_keys(spark):
    bare = spark.createDataFrame([(1,), (1,), (2,)], "yr int")
    assert clean.clean_items(bare).count() == 2
    only = spark.createDataFrame([(1, 5), (1, 6)], "entity_id long, yr int")
    assert clean.clean_items(only).count() == 1


def test_null_groups_leave_totals(spark):
    df = spark.createDataFrame([(1, 5.0, 5.0, False), (None, 7.0, 7.0, False)], "entity_id long, amount double, amount_pos double, is_refund boolean")
    assert rows(totals.expense_totals(df)) == [(1, 5.0, 5.0, 1, 0)]


def test_expense_count_variants(spark):
    df = spark.createDataFrame([(1, -2.0, None, True), (1, 3.0, 3.0, False)], "entity_id long, amount double, amount_pos double, is_refund boolean")
    assert rows(totals.expense_totals(df)) == [(1, 3.0, 1.0, 1, 1)]
    assert rows(totals.expense_totals(df, count_rows=True)) == [(1, 3.0, 1.0, 2, 1)]


def test_category_pivot_is_closed_and_filled(spark):
    df = spark.createDataFrame([(1, "Transporte", 5.0), (2, "Outros", 2.0)], "entity_id long, category string, amount_pos double")
    wide = totals.category_pivot(df)
    assert wide.columns == ["entity_id", "spend_transporte", "spend_alimentacao", "spend_escritorio_e_funcionamento",
                            "spend_cursos_e_capacitacao", "spend_divulgacao_do_mandato", "spend_outros"]
    assert rows(wide, "entity_id") == [(1, 5.0, 0.0, 0.0, 0.0, 0.0, 0.0), (2, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0)]


def test_spend_outside_the_category_list_counts_as_the_default(spark):
    df = spark.createDataFrame(
        [(1, "Transporte", 10.0), (1, "Barcos", 90.0), (2, "Aviões", 7.0)], "entity_id long, category string, amount_pos double"
    )
    who = spark.createDataFrame([(1, "A", "a"), (2, "B", "b")], "entity_id long, grp string, name string")
    pivot = totals.category_pivot(df).select("entity_id", "spend_transporte", "spend_outros")
    assert rows(pivot, "entity_id") == [(1, 10.0, 90.0), (2, 0.0, 7.0)]
    matrix = groups.group_category_matrix(df, who).select("grp", "Transporte", "Outros")
    assert rows(matrix, "grp") == [("A", 10.0, 90.0), ("B", 0.0, 7.0)]
    grid = groups.entity_category_grid(df, who).where("spend > 0")
    assert rows(grid, "grp", "category") == [("A", "a", "Outros", 90.0), ("A", "a", "Transporte", 10.0), ("B", "b", "Outros", 7.0)]
    full = df.selectExpr("*", "amount_pos as amount", "false as is_refund")
    wide = totals.expense_totals(full, ["Transporte", "Outros"]).select("entity_id", "spend_total", "spend_transporte", "spend_outros")
    assert rows(wide, "entity_id") == [(1, 100.0, 10.0, 90.0), (2, 7.0, 0.0, 7.0)]
    with pytest.raises(Exception, match="outside the closed list: (Barcos|Aviões)"):
        totals.pivot_sum(df, ["entity_id"], "category", ["Transporte"], "amount_pos").collect()


def test_filters(spark):
    df = spark.createDataFrame([(2022,), (2023,), (2025,), (2026,), (None,)], "yr int")
    assert rows(filters.year_range(df), "yr") == [(2023,), (2025,)]
    metrics = spark.createDataFrame([(0.0, None), (1.0, None), (-1.0, 1.0)], "a double, b double")
    assert filters.drop_zero_rows(metrics, ["a", "b"]).count() == 1
    assert dedup_rows(spark.createDataFrame([(1, None), (1, None)], "a int, b int")).count() == 1


@pytest.fixture
def world(spark):
    entities = spark.createDataFrame(
        [(1, "Ana", "A", "X"), (2, "Bo", None, "Y"), (3, "Cy", "B", "Z")], "entity_id long, name string, grp string, region string")
    expenses = spark.createDataFrame(
        [(1, 2023, 100.0, "Passagem aérea"), (1, 2024, -30.0, "telefone"), (2, 2024, 50.0, None)],
        "entity_id long, yr int, amount double, kind string")
    expenses = clean.categorise_expenses(clean.clean_expenses(expenses))
    items = spark.createDataFrame([(1, 10, 2023), (1, 11, 2023)], "entity_id long, item_id long, yr int")
    events = spark.createDataFrame([(1, 5, 2023), (3, 6, 2023)], "entity_id long, event_id long, yr int")
    return entities, expenses, items, events


def test_modelling_table(spark, world):
    distances = spark.createDataFrame([("X", 99.0)], "region string, distance_km double")
    got = modelling_table(*world, distances).orderBy("entity_id").collect()
    assert [r.distance_km for r in got] == [99.0, 0.0, 0.0]
    assert [r.spend_total for r in got] == [100.0, 50.0, 0.0]
    assert [r.spend_net for r in got] == [70.0, 50.0, 0.0]
    assert [r.refund_count for r in got] == [1, 0, 0]
    assert [r.activity for r in got] == pytest.approx([2.3, 0.0, 0.3])
    assert [r.spend_per_km for r in got] == [1.0, 50.0, 0.0]
    assert {r.distance_km for r in modelling_table(*world).collect()} == {0.0}


def test_master_table(world):
    got = master_table(*world).orderBy("entity_id").collect()
    assert [r.spend_transporte for r in got] == [100.0, 0.0, 0.0]
    assert [r.spend_outros for r in got] == [0.0, 50.0, 0.0]
    assert [r.no_expense for r in got] == [False, False, True]
    assert [r.cost_per_activity for r in got] == pytest.approx([100 / 2.3, 0.0, 0.0])


def test_prepared_master(spark, world):
    got = prepared_master(master_table(*world)).orderBy("entity_id").collect()
    assert [r.grp for r in got] == ["A", "Desconhecido", "B"]
    assert [r.spend_band for r in got] == ["Alto", "Médio-baixo", "Baixo"]
    text = spark.createDataFrame([("x", "2", "10", "inf")], "spend_total string, item_total string, event_total string, cost_per_activity string")
    row = prepared_columns(text).first()
    assert (row.spend_total, row.activity, row.log_spend, row.cost_per_activity) == (0.0, 5.0, 0.0, 0.0)


def test_source_names_round_trip(spark):
    df = spark.createDataFrame([(1, 2.0)], "idDeputado long, valorLiquido double")
    assert to_canonical(df).columns == ["entity_id", "amount"]
    assert to_source_names(to_canonical(df)).columns == df.columns


def test_counts_are_taken_in_the_same_pass(spark):
    raw = spark.createDataFrame(
        [("1", "5"), ("1", "5"), ("x", "6"), ("2", "n/a"), ("3", "-1")], "id string, amount string")
    counts = Counts()
    assert clean.clean_expenses(raw, counts=counts).count() == 2
    assert {r.counted: r.rows for r in counts.table(spark).collect()} == {"read": 5, "distinct": 4, "keyed": 3, "kept": 2}


def test_facts_stored_by_entity_need_no_exchange(spark, tmp_path):
    spent = spark.range(1000).select((F.col("id") % 50).alias("entity_id"), F.col("id").cast("double").alias("amount_pos"),
                                     F.col("id").cast("double").alias("amount"), (F.col("id") < 0).alias("is_refund"))
    people = spark.range(50).select(F.col("id").alias("entity_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        facts = write_facts(spent, str(tmp_path / "facts"), "facts_by_entity", "entity_id", 4)
        known = write_facts(people, str(tmp_path / "people"), "people_by_entity", "entity_id", 4)
        joined = joins.attach_metrics(known, totals.expense_totals(facts))
        assert joined.count() == 50 and joined.agg(F.sum("spend_total")).first()[0] == 499500.0
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        plain = joins.attach_metrics(people, totals.expense_totals(spent))
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table if exists facts_by_entity")
        spark.sql("drop table if exists people_by_entity")
