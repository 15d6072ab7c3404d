"""Positions, quantiles, bands, scaling and statistics against pandas and NumPy."""

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from spendlens.operators import order_stats, scaling, stats

PROBS = {"q1": 0.25, "median": 0.5, "p90": 0.9}


def frame(spark, values, **extra):
    data = {"entity_id": range(len(values)), "v": [float(x) for x in values], **extra}
    return spark.createDataFrame(pd.DataFrame(data))


def test_positions_over_many_partitions(spark, spread):
    values = np.random.default_rng(1).integers(0, 50, 5000)
    got = order_stats.with_positions(frame(spark, values).repartition(7), ["v", "entity_id"])
    assert got.select(F.spark_partition_id()).distinct().count() > 1
    pdf = got.toPandas().sort_values("__pos")
    assert list(pdf["__pos"]) == list(range(5000))
    assert list(pdf["entity_id"]) == list(np.lexsort((np.arange(5000), values)))


def test_quantiles_match_pandas(spark, spread):
    rng = np.random.default_rng(2)
    values, group = rng.lognormal(5, 2, 3001), rng.choice(["a", "a", "a", "b", "c"], 3001)
    df = frame(spark, values, grp=group, w=np.round(values))
    got = order_stats.quantiles(df, ["v", "w"], PROBS, ["grp"]).toPandas().set_index(["grp", "metric"])
    pdf = df.toPandas()
    for (grp, metric), row in got.iterrows():
        want = pdf.loc[pdf.grp == grp, metric]
        assert row.n == len(want)
        for name, p in PROBS.items():
            assert row[name] == pytest.approx(want.quantile(p), rel=1e-12)
    assert len(got) == 6


def test_quantiles_one_value_holding_a_third(spark, spread):
    values = [0.0] * 2000 + list(np.linspace(1, 9, 4000))
    got = order_stats.quantiles(frame(spark, values), ["v"], PROBS).first()
    assert [got[p] for p in PROBS] == pytest.approx(list(np.quantile(values, list(PROBS.values()))))


@pytest.fixture
def large(monkeypatch):
    """Treat all but a few values as too many to read, and sketch coarsely."""
    monkeypatch.setattr(order_stats, "READ", 30)
    monkeypatch.setattr(order_stats, "ACCURACY", 200)
    monkeypatch.setattr(order_stats, "STEPS", 20)


@pytest.mark.parametrize("shape", ["smooth", "ties", "third", "constant"])
def test_bracketed_quantiles_match_pandas(spark, spread, large, shape):
    rng = np.random.default_rng(8)
    values = {"smooth": rng.lognormal(3, 1, 4000), "ties": rng.integers(0, 9, 4000),
              "third": np.where(rng.uniform(size=4000) < 0.34, 0, rng.normal(0, 5, 4000)), "constant": np.full(4000, 7)}[shape]
    df = frame(spark, values, grp=rng.choice(["a", "a", "a", "b", "c"], 4000), w=rng.uniform(size=4000))
    probs = {**PROBS, "min": 0.0, "max": 1.0}
    got = order_stats.quantiles(df, ["v", "w"], probs, ["grp"]).toPandas().set_index(["grp", "metric"])
    pdf = df.toPandas()
    assert len(got) == 6
    for (grp, metric), row in got.iterrows():
        want = pdf.loc[pdf.grp == grp, metric]
        assert row.n == len(want)
        for name, p in probs.items():
            assert row[name] == pytest.approx(want.quantile(p), rel=1e-12, abs=1e-12)


def test_brackets_read_only_a_few_values(spark, large, monkeypatch):
    held = []
    plain = order_stats.materialize

    def looking(df, label):
        out = plain(df, label)
        if label == "counts" and "array" in str(out.schema["m_held"].dataType).lower():
            held.append(out.agg(F.max(F.size("m_held"))).first()[0])
        return out

    monkeypatch.setattr(order_stats, "materialize", looking)
    values = np.append(np.zeros(2000), np.random.default_rng(9).uniform(1, 9, 4000))
    got = order_stats.quantiles(frame(spark, values), ["v"], {"q": 0.2, "m": 0.5}).first()
    assert (got.q, got.m) == (0.0, pytest.approx(np.quantile(values, 0.5)))
    assert len(held) == 1 and held[0] <= 60


def test_a_missed_bracket_starts_again(spark, large, monkeypatch):
    values = np.random.default_rng(10).uniform(size=3000)
    monkeypatch.setattr(order_stats, "MARGIN", -3)  # ends on the wrong sides: no position is between them
    got = order_stats.quantiles(frame(spark, values[:25]), ["v"], {"m": 0.5}).first()
    assert got.m == pytest.approx(np.quantile(values[:25], 0.5))


def test_whole_keys_beyond_doubles(spark, large):
    """Ties are cut between keys that no double tells apart."""
    keys = [2**60 + k for k in range(400)]
    df = spark.createDataFrame([(k, 1.0) for k in keys], "entity_id long, v double").repartition(5)
    got = order_stats.spend_band(df, "v").groupBy("band_no").agg(F.min("entity_id"), F.max("entity_id"), F.count("*")).orderBy("band_no").collect()
    want = pd.qcut(pd.Series(range(400)), 4, labels=False)
    assert [(r[1], r[2], r[3]) for r in got] == [(keys[i.min()], keys[i.max()], len(i)) for i in (np.flatnonzero(want == b) for b in range(4))]


def test_text_keys(spark):
    df = spark.createDataFrame([(f"k{k:03}", float(k % 2)) for k in range(100)], "entity_id string, v double")
    got = order_stats.spend_band(df, "v").groupBy("band_no").count().orderBy("band_no").collect()
    assert [r["count"] for r in got] == [25, 25, 25, 25]


@pytest.mark.parametrize("n", [2, 7, 997])
def test_bracketed_bands_match_qcut(spark, large, n):
    values = np.random.default_rng(n).integers(0, max(2, n // 100), n)
    got = order_stats.spend_band(frame(spark, values), "v").orderBy("entity_id").toPandas()
    want = pd.qcut(pd.Series(values).rank(method="first"), 4, labels=order_stats.BAND_LABELS)
    assert list(got["spend_band"]) == list(want)


def test_quantiles_small_and_null(spark):
    df = spark.createDataFrame([(1, 4.0, "a"), (2, None, "a"), (3, float("nan"), "b"), (4, 9.0, None)], "entity_id long, v double, grp string")
    assert rows(order_stats.quantiles(df, ["v"], {"m": 0.5}, ["grp"])) == [("a", "v", 1, 4.0)]
    assert order_stats.quantiles(df.where("v < 0"), ["v"], {"m": 0.5}).count() == 0


@pytest.mark.parametrize("n", [2, 3, 6, 7, 10, 997])
def test_spend_band_matches_qcut(spark, n):
    values = np.random.default_rng(n).integers(0, max(2, n // 3), n)
    got = order_stats.spend_band(frame(spark, values), "v").orderBy("entity_id").toPandas()
    want = pd.qcut(pd.Series(values).rank(method="first"), 4, labels=order_stats.BAND_LABELS)
    assert list(got["spend_band"]) == list(want)


def test_spend_band_lone_and_empty(spark):
    assert rows(order_stats.spend_band(frame(spark, [5]), "v").select("band_no", "spend_band")) == [(1, "Única")]
    assert order_stats.spend_band(frame(spark, [5]).where("v < 0"), "v").count() == 0


def test_spend_band_seven(spark):
    got = order_stats.spend_band(frame(spark, range(7)), "v").orderBy("entity_id")
    assert [r.band_no - 1 for r in got.collect()] == [0, 0, 1, 1, 2, 3, 3]


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0), (None, 5.0)], "a double, b double")
    z = rows(scaling.zscore(df, ["a", "b"]).select("a_z", "b_z").where("a is not null"), "a_z")
    assert [r[0] for r in z] == pytest.approx([(x - 7 / 3) / 1.247219128924647 for x in (1, 2, 4)])
    assert {r[1] for r in z} == {0.0}
    m = rows(scaling.minmax_scale(df.where("a is not null"), ["a", "b"]).select("a_scaled", "b_scaled"), "a_scaled")
    assert m == [(0.0, 0.0), (1 / 3, 0.0), (1.0, 0.0)]


@pytest.mark.parametrize("pairs,want", [
    ([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1]),
    ([(1.0, 2.0), (1.0, 4.0)], None), ([(1.0, 2.0)], None), ([], None), ([(1.0, None), (2.0, 1.0)], None),
])
def test_pearson(spark, pairs, want):
    got = stats.pearson(spark.createDataFrame(pairs, "x double, y double"), "x", "y").first().r
    assert got is None if want is None else got == pytest.approx(want)


def test_correlation_matrix(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=50), "b": rng.normal(size=50)}).assign(c=lambda d: d.a * 2 + d.b, k=1.0)
    got = stats.correlation_matrix(spark.createDataFrame(pdf), list(pdf)).toPandas().pivot(index="metric_a", columns="metric_b", values="r")
    want = pdf.corr().loc[list(got.index), list(got.columns)]
    np.testing.assert_allclose(got.to_numpy(dtype=float), want.to_numpy(), atol=1e-12)


def test_trends(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"log_spend": rng.uniform(0, 9, 60), "spend_total": np.append(rng.uniform(1, 1e5, 59), 0.0), "activity": rng.uniform(0, 5, 60)})
    df = spark.createDataFrame(pdf)
    a, b = np.polyfit(pdf.log_spend, pdf.activity, 1)
    line = stats.linear_trend(df).orderBy("point").toPandas()
    np.testing.assert_allclose(line.y, a * np.linspace(pdf.log_spend.min(), pdf.log_spend.max(), 100) + b)
    raw = pdf.spend_total.replace(0, 1e-3)
    a, b = np.polyfit(np.log(raw), pdf.activity, 1)
    grid = np.logspace(np.log10(raw.min()), np.log10(raw.max()), 100)
    curve = stats.log_trend(df).orderBy("point").toPandas()
    np.testing.assert_allclose(curve.x, grid)
    np.testing.assert_allclose(curve.y, a * np.log(grid) + b)
    assert stats.linear_trend(df.limit(1)).count() == 0
    assert stats.linear_trend(df.withColumn("log_spend", F.lit(2.0))).count() == 0


def test_histogram(spark):
    values = np.random.default_rng(5).uniform(-10, 1000, 400)
    got = stats.spend_histogram(frame(spark, values), "v", 30).orderBy("bin").toPandas()
    counts, edges = np.histogram(np.clip(values, 0, None), 30)
    assert list(got.entities) == list(counts)
    np.testing.assert_allclose(got.low, edges[:-1])
    assert got["median"][0] == pytest.approx(np.median(np.clip(values, 0, None)))
    flat = stats.spend_histogram(frame(spark, [3, 3]), "v", 5).orderBy("bin").toPandas()
    assert list(flat.entities) == [2, 0, 0, 0, 0]
    assert stats.spend_histogram(frame(spark, [3]).where("v < 0"), "v", 5).count() == 0


def test_box_stats(spark):
    df = frame(spark, [1, 2, 3, 4, 100])
    box = stats.box_stats(df, ["v"]).first()
    assert (box.q1, box.median, box.q3, box.whisker_low, box.whisker_high, box.outliers) == (2, 3, 4, 1, 4, 1)
    assert rows(stats.box_outliers(df, ["v"])) == [(4, "v", 100.0)]


def test_summary(spark):
    pdf = pd.DataFrame({"entity_id": range(4), "spend_total": [1.0, 2, 3, 7], "activity": [0.0, 1, 2, 5]})
    got = stats.summary_stats(spark.createDataFrame(pdf)).first()
    assert (got.entities, got.spend_q1, got.spend_median, got.spend_q3) == (4, 1.75, 2.5, 4.0)
    assert (got.activity_mean, got.cost_mean, got.cost_q3) == (2.0, 0.0, 0.0)
