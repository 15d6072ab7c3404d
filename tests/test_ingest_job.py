"""Ingest as a job: resumed runs, broken batches, failures, the command line."""

import json
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from spendlens.plans import jobs
from spendlens.sources import worklist
from spendlens.streaming import ingest

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("valorLiquido", T.DoubleType())])


def page(entity, year, number, ids, **more):
    return {"request_entity": entity, "request_year": year, "page": number, "dados": [{"id": i, "valorLiquido": float(i)} for i in ids],
            "links": [], **more}


def land(folder, name, *items):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(i if isinstance(i, str) else json.dumps(i) for i in items))


def taken(store):
    return rows(store.read("rows").select("entity_id", "yr", "id"), "id"), rows(store.done(), "entity_id", "yr")


def test_gaps_repeats_late_pages_and_failures(spark, tmp_path):
    landing, path = tmp_path / "landing", str(tmp_path / "store")
    run = lambda: ingest.ingest_dataset(spark, str(landing), path, ROW)
    land(landing, "a", page(1, 2020, 1, [1, 2]), page(1, 2020, 3, []), page(2, 2020, 1, [3]), page(2, 2020, 1, [3]), page(2, 2020, 2, []))
    store = run()
    assert taken(store) == ([(2, 2020, 3)], [(2, 2020)])
    land(landing, "b", page(1, 2020, 2, [4]), page(2, 2020, 1, [99]), {"request_entity": 5, "request_year": 2020, "error": "timeout"}, "{broken")
    store = run()
    assert taken(store) == ([(1, 2020, 1), (1, 2020, 2), (2, 2020, 3), (1, 2020, 4)], [(1, 2020), (2, 2020), (5, 2020)])
    assert rows(store.read("failures").select("entity_id", "reason"), "entity_id") == [(None, "{broken"), (5, "timeout")]
    assert rows(store.ledger(), "batch") == [(5, 0, 1, 1, 0, 0, 0), (2, 1, 3, 2, 1, 1, 1)]
    assert taken(run()) == taken(store) and run().ledger().count() == 2


def test_a_batch_that_broke_off_counts_once(spark, tmp_path, monkeypatch):
    landing, path = tmp_path / "landing", str(tmp_path / "store")
    land(landing, "a", page(1, 2020, 1, [1, 2]), page(1, 2020, 2, []))
    write = ingest.PageStore.write

    def fail_late(self, name, df, batch):
        if name == "ledger":
            raise RuntimeError("lost")
        write(self, name, df, batch)

    monkeypatch.setattr(ingest.PageStore, "write", fail_late)
    with pytest.raises(Exception, match="lost"):
        ingest.ingest_dataset(spark, str(landing), path, ROW)
    broken = ingest.PageStore(spark, path, ROW)
    assert taken(broken) == ([], []) and (Path(path) / "rows").exists()
    monkeypatch.setattr(ingest.PageStore, "write", write)
    land(landing, "b", page(2, 2020, 1, [3]), page(2, 2020, 2, []))
    again = ingest.ingest_dataset(spark, str(landing), path, ROW)
    assert taken(again) == ([(1, 2020, 1), (1, 2020, 2), (2, 2020, 3)], [(1, 2020), (2, 2020)])
    assert again.batches() == [0, 1] or sorted(again.batches()) == [0, 1]


def test_two_payloads_of_a_page_do_not_depend_on_order(spark):
    pages = [page(1, 2020, 1, [k]) for k in range(6)]
    kind = ingest.page_schema(ROW)
    found = {tuple(ingest.one_payload(spark.createDataFrame(order, kind).repartition(3)).first()["dados"]) for order in (pages, pages[::-1])}
    assert len(found) == 1


def test_one_key_with_a_third_of_all_pages(spark, tmp_path):
    landing = tmp_path / "landing"
    many = [page(1, 2020, k, [k]) for k in range(1, 400)] + [page(1, 2020, 400, [])]
    for k in range(4):
        land(landing, str(k), *many[k::4], *[page(10 + k, 2020, 1, [1000 + k]), page(10 + k, 2020, 2, [])])
    store = ingest.ingest_dataset(spark, str(landing), str(tmp_path / "store"), ROW, files_per_batch=1)
    assert store.read("rows").count() == 403 and store.done().count() == 5 and store.ledger().count() == 4


def test_job(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    land(landing, "a", page(1, 2020, 1, [1, 2]), page(1, 2020, 2, []), page(2, 2020, 1, [3]))
    for name, ids in (("new", [(1, "n")]), ("old", [(1, "o"), (2, "o")])):
        spark.createDataFrame(ids, "idDeputado long, nome string").write.parquet(str(tmp_path / name))
    spark.createDataFrame([("7", "x")], "id string, extra string").write.parquet(f"{out}/raw/expenses_before.parquet")
    run = lambda: jobs.ingest_job(spark, str(landing), out, "expenses", entities=[str(tmp_path / "new"), str(tmp_path / "old")], years=[2020, 2021])
    run()
    raw = spark.read.parquet(f"{out}/raw/expenses.parquet")
    assert rows(raw.select("id", "entity_id", "extra"), "id") == [("1", 1, None), ("2", 1, None), ("7", None, "x")]
    pending = lambda: rows(spark.read.parquet(f"{out}/ingest/expenses_pending.parquet"), "entity_id", "yr")
    assert pending() == [(1, 2021), (2, 2020), (2, 2021)]
    land(landing, "b", page(2, 2020, 2, []))
    run()
    assert pending() == [(1, 2021), (2, 2021)] and spark.read.json(f"{out}/ingest/expenses_ledger.json").count() == 2
    assert spark.read.parquet(f"{out}/raw/expenses.parquet").count() == 4


def test_command_line_needs_a_landing(tmp_path):
    got = subprocess.run([sys.executable, "-m", "spendlens", "ingest", "--out", str(tmp_path)], capture_output=True, text=True, cwd=Path(__file__).parents[1])
    assert got.returncode == 2 and "--landing" in got.stderr


@pytest.mark.parametrize("old, new, want", [
    ("1", "'x'", "string"), ("1", "2L", "bigint"), ("1", "2.5D", "double"), ("1.50", "2L", "double"), ("date'2020-01-02'", "'x'", "string"),
    ("date'2020-01-02'", "timestamp'2020-01-02 03:04:05'", "timestamp"), ("array(1)", "'x'", "string"), ("true", "1", "string"), ("null", "1", "int"),
])
def test_batches_with_drifting_types(spark, old, new, want):
    one, two = (spark.range(1).selectExpr(f"{e} as v", f"{k} as k") for k, e in enumerate((old, new)))
    merged = worklist.merge_batches(one, two)
    assert merged.schema["v"].dataType.simpleString() == want and merged.count() == 2
    assert merged.where("v is null").count() == (1 if old == "null" else 0)
    assert merged.where("k = 1").select(F.col("v").cast("string")).first()[0] == two.select(F.col("v").cast(want).cast("string")).first()[0]
