"""Column expressions on literal edge cases."""

import math

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from spendlens.functions import geo, measures, numbers, text
from spendlens.operators import clean


def one(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[1] for r in rows(df.select("i", build(df).alias("y")), "i")]


def test_coerce_number_text(spark):
    got = one(spark, ["abc", "", " 12 ", "1e3", "1.5d", "NaN", "inf", "2F", None, ".5", "5.", "0x10", "-7"],
              "string", lambda df: numbers.coerce_number(df, "x"))
    assert got == [None, None, 12.0, 1000.0, None, None, None, None, None, 0.5, 5.0, None, -7.0]


def test_coerce_number_matches_pandas(spark):
    texts = ["1", "1.5f", "3d", " 4", "+5", "1e-2", "1,5", "--1", "1 2", "e5", "1e", "٣"]
    got = one(spark, texts, "string", lambda df: numbers.coerce_number(df, "x"))
    want = pd.to_numeric(pd.Series(texts), errors="coerce")
    assert [None if pd.isna(w) else float(w) for w in want] == got


def test_coerce_number_types(spark):
    assert one(spark, [1.5, float("nan"), None], "double", lambda df: numbers.coerce_number(df, "x")) == [1.5, None, None]
    assert one(spark, [3, None], "int", lambda df: numbers.coerce_number(df, "x")) == [3.0, None]
    assert one(spark, [True, False], "boolean", lambda df: numbers.coerce_number(df, "x")) == [1.0, 0.0]


def test_coerce_whole_keeps_large_keys(spark):
    texts = ["9007199254740993", "12.9", "-3.9", "x", "inf", None]
    assert one(spark, texts, "string", lambda df: numbers.coerce_whole(df, "x")) == [9007199254740993, 12, -3, None, None, None]


def test_coerce_year(spark):
    assert one(spark, ["2024", "2024.0", "2024.5", "", None], "string",
               lambda df: numbers.coerce_year_value(df, "x")) == [2024, 2024, None, None, None]


def test_clip_and_flag(spark):
    assert one(spark, [-5.0, 0.0, 7.0, None], "double", lambda df: numbers.clip_floor(F.col("x"))) == [0.0, 0.0, 7.0, None]
    assert one(spark, [-5.0, 0.0, None], "double", lambda df: numbers.flag_refund(F.col("x"))) == [True, False, None]


def test_parse_money(spark):
    texts = ["R$ 1.234,56", "R$ 10,00", "-5,00", "1234.56", "x", None, " R$  7,5 \t", "", "1_0"]
    want = [1234.56, 10.0, -5.0, 123456.0, 0.0, 0.0, 7.5, 0.0, 0.0]
    assert one(spark, texts, "string", lambda df: numbers.parse_money(F.col("x"))) == want


def test_null_nonfinite(spark):
    assert one(spark, [1.0, math.inf, -math.inf, float("nan"), None], "double",
               lambda df: numbers.null_nonfinite(F.col("x"))) == [1.0, None, None, None, None]


def test_log1p_replace(spark):
    assert one(spark, [-3.0, 0.0, math.e - 1], "double", lambda df: numbers.log1p_spend(F.col("x"))) == [0.0, 0.0, 1.0]
    assert one(spark, ["A", "B", None], "string",
               lambda df: numbers.replace_values(F.col("x"), {"A": "Z"})) == ["Z", "B", None]


def test_format_amount(spark):
    values = [2_500_000.0, 1_234_567_890.0, 1234.0, 999_999.0, 12.34, 0.0]
    assert one(spark, values, "double", lambda df: numbers.format_amount(F.col("x"))) == [
        "R$ 2.50M", "R$ 1234.57M", "1,234", "999,999", "12.3", "0.0"]


def test_classify_text(spark):
    texts = ["RECURSOS", "TÁXI", "taxi", None, "curso de marketing", "ALIMENTAÇÃO", "MARKETING", "passagem aérea e curso"]
    assert one(spark, texts, "string", lambda df: text.classify_text(F.col("x"))) == [
        "Cursos e Capacitação", "Outros", "Transporte", "Outros", "Cursos e Capacitação", "Alimentação",
        "Divulgação do Mandato", "Transporte"]


def test_categories_and_slugs(spark):
    assert len(text.categories_of()) == 6
    names = text.categories_of()
    assert one(spark, names, "string", lambda df: text.slug(F.col("x"))) == [text.slug_name(n) for n in names]
    assert text.category_column("Escritório e Funcionamento") == "spend_escritorio_e_funcionamento"
    assert text.slug_name("Ção-Í/ú") == "cao_i_u"


def test_ratios(spark):
    df = spark.createDataFrame([(10.0, 0.0), (0.0, 2.0), (9.0, 3.0)], "s double, a double")
    assert rows(df.select(measures.cost_per_activity(F.col("s"), F.col("a")))) == [(0.0,), (0.0,), (3.0,)]
    flags = spark.createDataFrame([(0.0, 0), (0.0, 1), (None, None)], "s double, c long")
    assert rows(flags.select(measures.flag_no_expense(F.col("s"), F.col("c")))) == [(True,), (False,), (True,)]


def test_pick_columns(spark):
    raw = spark.createDataFrame([(-1.0, 2020)], "amount double, plain_yr int")
    assert rows(raw.select(clean.pick_value_column(raw))) == [(0.0,)]
    assert clean.pick_time_column(raw) == "plain_yr"
    bare = raw.select(F.lit(1).alias("z"))
    assert clean.pick_value_column(bare) is None and clean.pick_time_column(bare) is None


def walked(lat, lon, azimuth, km, steps=4000):
    """End of a geodesic by stepping its differential equations (fourth-order Runge-Kutta)."""
    a, f = 6378.137, 1 / 298.257223563
    e2 = f * (2 - f)

    def slope(phi, _, alpha):
        w = math.sqrt(1 - e2 * math.sin(phi) ** 2)
        across, along = a / w, a * (1 - e2) / w**3
        turn = math.sin(alpha) / (across * math.cos(phi))
        return math.cos(alpha) / along, turn, math.sin(phi) * turn

    at, h = [math.radians(v) for v in (lat, lon, azimuth)], km / steps
    for _ in range(steps):
        k1 = slope(*at)
        k2 = slope(*[v + h / 2 * k for v, k in zip(at, k1)])
        k3 = slope(*[v + h / 2 * k for v, k in zip(at, k2)])
        k4 = slope(*[v + h * k for v, k in zip(at, k3)])
        at = [v + h / 6 * (p + 2 * q + 2 * r + s) for v, p, q, r, s in zip(at, k1, k2, k3, k4)]
    return math.degrees(at[0]), math.degrees(at[1])


def test_distance_to_the_end_of_a_walk(spark):
    """Against geodesics walked step by step, which share no formula with the distance."""
    walks = [(lat, lon, azimuth, km) for lat, lon in ((-15.8, -47.9), (0.0, 10.0), (62.0, 179.0))
             for azimuth in (20.0, 47.0, 90.0, 200.0) for km in (0.5, 320.0, 4100.0, 9000.0)]
    ends = [(i, *w[:2], *walked(*w), w[3]) for i, w in enumerate(walks)]
    df = spark.createDataFrame(ends, "i int, lat double, lon double, lat2 double, lon2 double, km double")
    found = df.select("i", "km", geo.distance_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")).alias("got"))
    for _, km, got in rows(found, "i"):
        assert got == pytest.approx(km, abs=1e-6)


def test_distance(spark):
    """A published line (on an ellipsoid that differs by less than a tenth of a millimetre), a degree of the equator."""
    dms = lambda d, m, s: d + m / 60 + s / 3600
    lines = [(-dms(37, 57, 3.7203), dms(144, 25, 29.5244), -dms(37, 39, 10.1561), dms(143, 55, 35.3839), 54.972271),
             (0.0, 0.0, 0.0, 1.0, 6378.137 * math.pi / 180), (0.0, 179.5, 0.0, -179.5, 6378.137 * math.pi / 180)]
    df = spark.createDataFrame(lines, "a double, b double, c double, d double, km double")
    for km, got in rows(df.select("km", geo.distance_km(*[F.col(c) for c in "abcd"]))):
        assert got == pytest.approx(km, abs=1e-6)
    one = df.limit(1)
    assert rows(one.select(geo.distance_to_reference(F.lit(-15.7975), F.lit(-47.8919)))) == [(0.0,)]
    assert rows(one.select(geo.distance_to_reference(F.lit(None).cast("double"), F.lit(1.0)))) == [(None,)]


def test_polygon_centroid(spark):
    square = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
    hole = [[2.0, 1.0], [3.0, 1.0], [3.0, 3.0], [2.0, 3.0], [2.0, 1.0]]
    far = [[10.0, 0.0], [10.0, 2.0], [12.0, 2.0], [12.0, 0.0], [10.0, 0.0]]
    shapes = [[[square]], [[square, hole]], [[square, hole[::-1]]], [[square], [far]]]
    kind = T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("p", kind)])
    df = spark.createDataFrame(list(enumerate(shapes)), schema)
    got = [(r["c"]["lon"], r["c"]["lat"]) for r in df.select("i", geo.polygon_centroid(F.col("p")).alias("c")).orderBy("i").collect()]
    holed = ((16 * 2 - 2 * 2.5) / 14, 2.0)
    assert got[0] == (2.0, 2.0)
    assert got[1] == pytest.approx(holed) and got[2] == pytest.approx(holed)
    assert got[3] == pytest.approx(((16 * 2 + 4 * 11) / 20, (16 * 2 + 4 * 1) / 20))


def test_money_sums_keep_parts_of_a_cent(spark, spread):
    small = spark.range(0, 1000, 1, 7).select(F.lit(1).alias("k"), F.lit(0.004).alias("v"))
    more = spark.createDataFrame([(2, 0.1), (2, 0.2), (2, 1234567.895), (2, -0.0000001), (3, 9e18), (4, None)], "k int, v double")
    sums = small.unionByName(more).groupBy("k").agg(numbers.sum_money(F.col("v")), numbers.mean_money(F.col("v")))
    assert rows(sums, "k") == [(1, 4.0, 0.004), (2, 1234568.1949999, 308642.048749975), (3, 9e18, 9e18), (4, None, None)]


def test_money_sums_are_exact_in_any_order(spark):
    from decimal import Decimal
    import random

    draw = random.Random(4)
    amounts = [draw.choice([round(draw.uniform(-9e5, 9e5), 2), draw.uniform(-1, 1), draw.uniform(-1e8, 1e8), 0.1, 0.004, 1e-9, -0.3, 8.5e9, 123456789012.25, 1e-18, 0.0])
               for _ in range(3000)]
    df = spark.createDataFrame([(k % 7, x) for k, x in enumerate(amounts)], "k int, x double").repartition(5)
    want = {g: float(sum(Decimal(repr(x)) for x in amounts[g::7])) for g in range(7)}
    assert dict(df.groupBy("k").agg(numbers.sum_money(F.col("x"))).collect()) == want
    limbs = numbers.with_limbs(df, "x").groupBy("k").agg(numbers.sum_limbs("x"))
    assert dict(limbs.collect()) == want
    part = numbers.with_limbs(df, "x").groupBy("k").agg(numbers.sum_limbs("x", F.col("x") > 0))
    assert dict(part.collect()) == {g: float(sum(Decimal(repr(x)) for x in amounts[g::7] if x > 0)) for g in range(7)}


def test_one_huge_amount_ends_no_job(spark):
    df = spark.createDataFrame([(1e20,), (2.5,), (-3e300,), (None,)], "x double")
    assert df.agg(numbers.sum_money(F.col("x"))).first()[0] == -3e300
    assert df.where("x is null").agg(numbers.sum_money(F.col("x"))).first()[0] is None
    assert df.where("x = 2.5").agg(numbers.sum_money(F.col("x"))).first()[0] == 2.5
