"""Files, pages, worklists, regions and resumable ingest."""

import json

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from spendlens import session
from spendlens.operators import cluster
from spendlens.sources import files, pages, regions, worklist
from spendlens.sources.schemas import page_schema
from spendlens.streaming.ingest import ingest_pages, settle_pages

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("valorLiquido", T.DoubleType())])
NEXT, LAST = [{"rel": "self"}, {"rel": "next"}], [{"rel": "self"}]


def page(entity, year, number, ids, links=LAST):
    return {"request_entity": entity, "request_year": year, "page": number,
            "dados": [{"id": i, "valorLiquido": float(i)} for i in ids], "links": links}


def frame(spark, *items):
    return spark.createDataFrame([json.dumps(p) for p in items], "string").select(
        F.from_json("value", page_schema(ROW)).alias("p")).select("p.*")


def test_stop_rules(spark):
    df = frame(spark, page(1, 2023, 1, [1], NEXT), page(1, 2023, 2, []), page(1, 2023, 3, [3]),
               page(2, 2023, 1, [4], NEXT), page(2, 2023, 2, [5], LAST), page(2, 2023, 3, [6]), page(3, 2023, 1, [7], None))
    ids = lambda rule: sorted(r.id for r in pages.flatten_pages(pages.page_stop(df, rule)).collect())
    assert ids("empty") == [1, 4, 5, 6, 7]
    assert ids("next") == [1, 4, 5, 7]
    assert rows(pages.complete_requests(df)) == [(1, 2023)]
    assert rows(pages.complete_requests(df, "next"), "entity_id") == [(1, 2023), (2, 2023), (3, 2023)]
    with pytest.raises(ValueError):
        pages.page_stop(df, "other")


def test_a_gap_keeps_a_request_pending(spark):
    df = frame(spark, page(1, 2023, 1, [1], NEXT), page(1, 2023, 3, []))
    assert rows(pages.complete_requests(df)) == []
    late = df.unionAll(frame(spark, page(1, 2023, 2, [2], NEXT)))
    assert rows(pages.complete_requests(late)) == [(1, 2023)]
    kept, done = settle_pages(late.unionAll(late))
    assert rows(kept.select("entity_id", "id"), "id") == [(1, 1), (1, 2)] and rows(done) == [(1, 2023)]


def test_pages_stay_in_place_or_are_sorted(spark):
    df = spark.range(900).select(
        F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 40).cast("long").alias("request_entity"), F.lit(2023).alias("request_year"),
        F.col("id").alias("page"), F.expr("filter(array(named_struct('id', id, 'valorLiquido', 1D)), x -> id % 200 <> 199)").alias("dados"),
        F.expr("array(named_struct('rel', 'next', 'href', ''))").alias("links"))
    stops = session.materialize(pages.first_stops(df))
    kept = pages.page_stop(df, stops=stops)
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = pages.page_stop(df, stops=stops)
        assert rows(kept.select("page"), "page") == rows(large.select("page"), "page")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = df.toPandas()
    first = want[want.dados.str.len() == 0].groupby("request_entity").page.min()
    limit = want.request_entity.map(first).fillna(10**9)
    assert [r[0] for r in rows(kept.select("page"), "page")] == list(want.page[want.page <= limit])


def test_missing_payload_parts(spark):
    df = frame(spark, {"request_entity": 1, "request_year": 2023, "page": 1})
    assert pages.flatten_pages(df).count() == 0
    assert rows(pages.complete_requests(df)) == [(1, 2023)]


def test_flatten_tag_and_cap(spark):
    df = pages.flatten_pages(frame(spark, page(1, 2023, 2, [3, 4]), page(1, 2023, 1, [9, 8]), page(2, 2023, 1, [5])))
    assert rows(pages.cap_rows(df, 3).select("request_entity", "id"), "request_entity", "id") == [(1, 3), (1, 8), (1, 9), (2, 5)]
    assert pages.cap_rows(df, 0).count() == 5
    assert set(pages.tag_rows(df).columns) == {"entity_id", "yr", "id", "valorLiquido"}


def test_cap_beyond_the_group_limit(spark):
    df = spark.range(5000).select(F.lit(1).alias("request_entity"), F.lit(1).alias("request_year"), F.col("id").alias("page"), F.lit(0).alias("pos"))
    kept = pages.cap_rows(df, 2000)
    assert kept.count() == 2000 and kept.agg(F.max("page")).first()[0] == 1999


def test_worklist(spark):
    todo = worklist.build_worklist(spark.createDataFrame([(1,), (2,)], "entity_id long"), [2023, 2024])
    done = spark.createDataFrame([(1, 2023)], "entity_id long, yr int")
    assert rows(worklist.pending_work(todo, done), "entity_id", "yr") == [(1, 2024), (2, 2023), (2, 2024)]
    assert worklist.mark_done(done, todo).count() == 4
    merged = worklist.merge_batches(done, spark.createDataFrame([(2, "x")], "entity_id long, extra string"))
    assert rows(merged, "entity_id") == [(1, 2023, None), (2, None, "x")]
    terms = worklist.union_entities(spark.createDataFrame([(1, "new")], "entity_id long, name string"),
                                    spark.createDataFrame([(1, "a"), (2, "b")], "entity_id long, name string"))
    assert rows(terms, "entity_id") == [(1, "new"), (2, "b")]


def write_page(folder, number, *items):
    folder.mkdir(exist_ok=True)
    (folder / f"{number}.json").write_text("\n".join(json.dumps(p) for p in items))


def test_ingest_resumes(spark, tmp_path):
    landing, out, progress = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "progress")
    write_page(landing, 1, page(1, 2023, 1, [1, 2]))
    assert ingest_pages(spark, str(landing), out, progress, ROW).count() == 1
    write_page(landing, 2, page(1, 2023, 2, [3]), page(1, 2023, 3, []))
    assert ingest_pages(spark, str(landing), out, progress, ROW).count() == 3
    twice = ingest_pages(spark, str(landing), out, progress, ROW)
    assert twice.count() == 3
    at_once = ingest_pages(spark, str(landing), str(tmp_path / "o2"), str(tmp_path / "p2"), ROW)
    (a, done), (b, _) = settle_pages(twice), settle_pages(at_once)
    assert rows(a, "id") == rows(b, "id") and a.count() == 3
    assert rows(done) == [(1, 2023)]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, 'quote " and, comma\nline'), (2, None)], "a int, b string")
    base = str(tmp_path / "t")
    files.write_table(df, f"{base}.csv", "csv")
    assert rows(files.read_preferred(spark, base, df.schema), "a") == rows(df, "a")
    files.write_table(df.limit(1), f"{base}.parquet")
    assert files.read_preferred(spark, base).count() == 1
    with pytest.raises(FileNotFoundError):
        files.read_preferred(spark, f"{base}-none")
    assert files.read_optional(spark, f"{base}-none.csv") is None
    with pytest.raises(ValueError):
        files.write_table(df, base, "orc")
    files.write_report(df, f"{base}.json")
    assert spark.read.json(f"{base}.json").count() == 2
    (tmp_path / "bom.csv").write_bytes("﻿a,b\n1,x\n".encode("utf-8"))
    assert files.read_csv(spark, str(tmp_path / "bom.csv")).columns == ["a", "b"]


def test_scratch_follows_the_session(spark, monkeypatch):
    assert session.scratch_path(spark, "x").startswith(session.scratch_root(spark))

    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None), "applicationId": "other", "master": "yarn"})

    with pytest.raises(RuntimeError):
        session.scratch_root(Cluster)
    Cluster.conf = type("C", (), {"get": staticmethod(lambda key, default=None: "hdfs:///shared/")})
    assert session.scratch_root(Cluster) == "hdfs:///shared"


def test_regions(spark, tmp_path):
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    shape = lambda code, kind, coordinates: {"type": "Feature", "properties": {"sigla": code}, "geometry": {"type": kind, "coordinates": coordinates}}
    data = {"type": "FeatureCollection", "features": [
        shape("AA", "Polygon", [square]), shape("BB", "MultiPolygon", [[square], [[[x + 4, y] for x, y in square]]])]}
    path = tmp_path / "regions.geojson"
    path.write_text(json.dumps(data, indent=1))
    found = regions.region_centroids(regions.read_regions(spark, str(path)))
    assert rows(found.select("region", "lon", "lat"), "region") == [("AA", 1.0, 1.0), ("BB", 3.0, 1.0)]
    assert regions.region_distances(found).where("distance_km > 5000").count() == 2


def test_kmeans(spark):
    df = spark.createDataFrame(
        [(i, float(i % 5) * 10 + i * 0.001, float(i % 5), float(i)) for i in range(100)] + [(100, float("inf"), None, 1.0)],
        "entity_id long, spend_per_km double, activity double, distance_km double")
    labelled, costs = cluster.kmeans_sweep(df, restarts=3)
    table = {r.k: (r.cost, r.chosen) for r in costs.collect()}
    assert [table[k][0] for k in (2, 3, 4, 5)] == sorted((table[k][0] for k in table), reverse=True)
    assert [k for k in table if table[k][1]] == [5]
    assert labelled.count() == 101 and labelled.where("cluster is null").count() == 0
    assert labelled.where("entity_id < 100").groupBy(F.col("entity_id") % 5).agg(F.countDistinct("cluster").alias("n")).where("n > 1").count() == 0
    summary = cluster.cluster_summary(labelled)
    assert summary.agg(F.sum("entities")).first()[0] == 101


def test_kmeans_fewer_rows_than_clusters(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, 0.0), (2, 1.0, 1.0, 0.0)], "entity_id long, spend_per_km double, activity double, distance_km double")
    labelled, _ = cluster.kmeans_sweep(df, restarts=1)
    assert labelled.select("cluster").distinct().count() == 1


def test_group_hierarchy(spark):
    data = [(i, g, *[float(v + i % 2) for _ in range(8)]) for i, (g, v) in enumerate([("A", 1), ("B", 2), ("C", 50), ("D", 51)] * 3)]
    df = spark.createDataFrame(data, ["entity_id", "grp", *cluster.METRICS])
    got = {r.grp: r.cluster for r in cluster.group_hierarchy(df, leaves=2).collect()}
    assert got["A"] == got["B"] != got["C"] == got["D"]
    assert cluster.group_hierarchy(df.where("grp = 'A'")).count() == 0


def test_group_hierarchy_like_plain_joins(spark):
    """Against the unions chosen one by one in plain Python."""
    random = np.random.default_rng(5)
    data = [(i, f"g{i:02}", *random.normal(size=len(cluster.METRICS)).round(3).tolist()) for i in range(9)]
    df = spark.createDataFrame(data, ["entity_id", "grp", *cluster.METRICS])
    points = np.array([r[2:] for r in data])
    points = (points - points.mean(axis=0)) / points.std(axis=0)
    parts = [[i] for i in range(9)]

    def rise(a, b):
        spread = lambda m: ((points[m] - points[m].mean(axis=0)) ** 2).sum()
        return spread(a + b) - spread(a) - spread(b)

    while len(parts) > 3:
        _, i, j = min((rise(parts[i], parts[j]), i, j) for j in range(len(parts)) for i in range(j))
        parts[i] = parts[i] + parts.pop(j)
    got = {}
    for r in cluster.group_hierarchy(df, n=9, leaves=3).collect():
        got.setdefault(r.cluster, []).append(int(r.grp[1:]))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, parts))
