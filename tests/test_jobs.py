"""The four jobs end to end, on source-named raw files."""

import json

import pandas as pd
import pytest
from conftest import rows

from spendlens.operators.filters import year_range
from spendlens.operators.totals import expense_totals
from spendlens.plans import jobs
from spendlens.functions.text import categories_of
from spendlens.operators.stats import summary_stats
from spendlens.plans.tables import master_table, prepared_master


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    raw, out = base / "raw", base / "out"
    raw.mkdir()
    ids = list(range(1, 31))
    pd.DataFrame({
        "id": [str(i) for i in ids] + ["x"], "nome": [f"N{i}" for i in ids] + ["bad"],
        "siglaPartido": [list("ABCD")[i % 4] for i in ids] + ["A"], "siglaUf": [["AA", "ZZ"][i % 2] for i in ids] + ["AA"],
        "uri": "u",
    }).to_parquet(raw / "entities.parquet")
    lines = [(i, 2021 + k, f"{(i * 7 + k * 3) % 50 - 5}.25", ["Passagem", "Telefone", "Outra"][k % 3]) for i in ids for k in range(6)]
    pd.DataFrame(lines + lines[:9], columns=["idDeputado", "anoConsulta", "valorLiquido", "tipoDespesa"]).to_csv(raw / "expenses.csv", index=False)
    pd.DataFrame([(i, k, 2023) for i in ids for k in range(i % 5)], columns=["idDeputado", "idProposicao", "anoConsulta"]).to_parquet(raw / "items.parquet")
    pd.DataFrame([(i, k, 2023) for i in ids for k in range(i % 3)], columns=["idDeputado", "idEvento", "anoConsulta"]).to_parquet(raw / "events.parquet")
    square = [[-50, -10], [-48, -10], [-48, -8], [-50, -8], [-50, -10]]
    (base / "r.json").write_text(json.dumps({"features": [{"properties": {"sigla": "AA"}, "geometry": {"type": "Polygon", "coordinates": [square]}}]}))
    jobs.clean_job(spark, str(raw), str(out), str(base / "r.json"), source_names=True)
    jobs.master_job(spark, str(out))
    return out


def test_clean_and_master(spark, out):
    assert spark.read.parquet(f"{out}/expenses_clean.parquet").count() == 180
    model = spark.read.parquet(f"{out}/modelling.parquet")
    assert model.count() == 30
    assert {r.distance_km > 0 for r in model.where("region = 'AA'").collect()} == {True}
    assert "gasto_normalizado_dist" in spark.read.csv(f"{out}/modelling.csv", header=True).columns
    master = spark.read.parquet(f"{out}/master.parquet")
    got = master.selectExpr("sum(spend_transporte + spend_outros + spend_escritorio_e_funcionamento) - sum(spend_total) as gap")
    assert abs(got.first().gap) < 1e-6
    assert [c for c, _ in rows(spark.read.parquet(f"{out}/category_totals.parquet"), "category")] == [
        "Escritório e Funcionamento", "Outros", "Transporte"]


def test_marts(spark, out):
    written = jobs.marts_job(spark, str(out))
    assert set(jobs.entity_marts()) | {"group_categories", "category_hierarchy", "group_years", "summary"} <= set(written)
    summary = spark.read.json(f"{out}/marts/summary.json").first()
    assert summary.entities == 30
    years = spark.read.parquet(f"{out}/marts/group_years.parquet")
    assert {r.yr for r in years.collect()} == {2023, 2024, 2025}
    assert spark.read.csv(f"{out}/marts/top_spenders.csv", header=True).count() == 15


def test_marts_without_categorised_expenses(spark, out, tmp_path):
    spark.read.parquet(f"{out}/master.parquet").write.parquet(f"{tmp_path}/master.parquet")
    written = jobs.marts_job(spark, str(tmp_path))
    assert "group_years" not in written and "group_totals" in written


def test_analysis(spark, out):
    jobs.analysis_job(spark, str(out))
    report = spark.read.json(f"{out}/analysis/clusters.json")
    assert report.agg({"entities": "sum"}).first()[0] == 30 and report.first().best_k == 5
    assert spark.read.json(f"{out}/analysis/pearson.json").count() == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_range_reads_only_its_folders(spark, out):
    stored = spark.read.parquet(f"{out}/expenses_clean.parquet")
    text = plan(year_range(stored))
    assert "PartitionFilters: [isnotnull(yr" in text and "(yr#" in text.split("PartitionFilters")[1]


def test_totals_read_only_their_columns(spark, out):
    stored = spark.read.parquet(f"{out}/expenses_categorised.parquet")
    text = plan(expense_totals(stored))
    schema = text.split("ReadSchema: ")[1].split(">")[0]
    assert "kind" not in schema and "amount_pos" in schema
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_master_shuffles_each_table_once(spark, out):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = [spark.read.parquet(f"{out}/{n}.parquet") for n in ("entities_clean", "expenses_categorised", "items_clean", "events_clean")]
        text = plan(master_table(*tables))
        assert text.count("Exchange hashpartitioning(entity_id") == 4 and text.count("Exchange") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_tables_give_empty_marts(spark, out):
    prepared = spark.read.parquet(f"{out}/master.parquet").limit(0)
    prepared = prepared_master(prepared)
    for name, build in jobs.entity_marts().items():
        found = build(prepared)
        if name == "correlations":
            assert found.where("r is not null").count() == 0
        else:
            assert found.where("depth > 0" if name == "spend_hierarchy" else "true").count() == 0, name
    assert summary_stats(prepared).first().entities == 0
    spent = spark.read.parquet(f"{out}/expenses_categorised.parquet").limit(0)
    for build in jobs.expense_marts(categories_of()).values():
        found = build(spent, prepared)
        assert found.where("depth > 0" if "depth" in found.columns else "true").count() == 0
