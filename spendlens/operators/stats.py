"""Correlation, trend lines, histogram, box statistics, summary."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import clip_floor, mean_money, replace_values
from ..session import materialize
from .filters import nonnegative_spend
from .joins import lookup_join
from .order_stats import melt_metrics, quantiles

METRICS = [
    "spend_total", "spend_net", "expense_count", "refund_count",
    "item_total", "event_total", "activity", "cost_per_activity",
]
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
GRID_POINTS = 100


def correlation(x: Column, y: Column) -> Column:
    """Pearson r over rows where both are present; NULL for a constant or fewer than two rows.

    ``corr`` itself divides by zero on a constant column under ANSI mode.
    """
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.covar_pop(a, b) / F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))


def pearson(df: DataFrame, x: str = "spend_per_km", y: str = "activity") -> DataFrame:
    return df.agg(correlation(F.col(x), F.col(y)).alias("r"))


def correlation_matrix(df: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    """``metric_a, metric_b, r`` for every ordered pair, from one pass over the table.

    A missing value counts as 0, as in the prepared table; so each metric needs one deviation and each
    pair one covariance. A constant metric gives NULL.
    """
    if len(metrics) < 2:
        raise ValueError("at least two metrics are needed")
    filled = df.select(*[F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m) for m in metrics])
    pairs = list(combinations(metrics, 2))
    one = filled.agg(
        *[F.nullif(F.stddev_pop(m), F.lit(0.0)).alias(f"sd_{m}") for m in metrics],
        *[F.covar_pop(a, b).alias(f"cov_{i}") for i, (a, b) in enumerate(pairs)],
    )
    cells = [(m, m, F.when(F.col(f"sd_{m}").isNotNull(), F.lit(1.0))) for m in metrics]
    for i, (a, b) in enumerate(pairs):
        r = F.col(f"cov_{i}") / (F.col(f"sd_{a}") * F.col(f"sd_{b}"))
        cells += [(a, b, r), (b, a, r)]
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"), r.alias("r")) for a, b, r in cells
    ])).alias("cell")).select("cell.*")


def _fit(df: DataFrame, x: Column, y: Column) -> DataFrame:
    x, y = x.cast("double"), y.cast("double")
    fit = df.agg(
        F.count(F.lit(1)).alias("n"), F.min(x).alias("low"), F.max(x).alias("high"),
        (F.covar_pop(x, y) / F.nullif(F.var_pop(x), F.lit(0.0))).alias("slope"),
        F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"),
    )
    return fit.where((F.col("n") >= 2) & (F.col("high") > F.col("low"))).select(
        "low", "high", "slope", (F.col("mean_y") - F.col("slope") * F.col("mean_x")).alias("intercept")
    )


def _grid(fit: DataFrame, points: int) -> DataFrame:
    step = F.col("point") / F.lit(float(points - 1))
    return fit.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn(
        "at", F.col("low") + (F.col("high") - F.col("low")) * step
    )


def linear_trend(df: DataFrame, x: str = "log_spend", y: str = "activity",
                 points: int = GRID_POINTS) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` at evenly spaced points; no rows for a constant ``x``."""
    return _grid(_fit(df, F.col(x), F.col(y)), points).select(
        "point", "slope", "intercept", F.col("at").alias("x"),
        (F.col("slope") * F.col("at") + F.col("intercept")).alias("y"),
    )


def log_trend(df: DataFrame, x: str = "spend_total", y: str = "activity",
              points: int = GRID_POINTS, zero_as: float = 1e-3) -> DataFrame:
    """Least-squares line of ``y`` on ln ``x`` at log-spaced points; spend 0 counts as ``zero_as``."""
    rows = nonnegative_spend(df) if x == "spend_total" else df
    logged = F.ln(replace_values(F.col(x).cast("double"), {0.0: zero_as}))
    return _grid(_fit(rows, logged, F.col(y)), points).select(
        "point", "slope", "intercept", F.exp("at").alias("x"),
        (F.col("slope") * F.col("at") + F.col("intercept")).alias("y"),
    )


def spend_histogram(df: DataFrame, value: str = "spend_total", bins: int = 30,
                    key: str = "entity_id") -> DataFrame:
    """``bins`` equal-width bins of the floored value (empty ones too), with overall mean and median."""
    floored = df.select(key, clip_floor(F.col(value).cast("double")).alias("v")).where(F.col("v").isNotNull())
    low, high, mean = floored.agg(F.min("v"), F.max("v"), mean_money(F.col("v"))).first()
    if low is None:
        low, bins = 0.0, 0
        high = mean = median = 0.0
    else:
        median = quantiles(floored, ["v"], {"median": 0.5}, key=key).first()["median"]
    width = (high - low) / max(bins, 1)
    place = F.floor((F.col("v") - F.lit(low)) / F.lit(width)) + 1 if width else F.lit(1)
    counts = floored.groupBy(F.least(place, F.lit(bins)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("entities")
    )
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(low) + F.lit(width) * (F.col("bin") - 1)).alias("low"),
        (F.lit(low) + F.lit(width) * F.col("bin")).alias("high"),
        F.coalesce("entities", F.lit(0)).alias("entities"),
        F.lit(mean).alias("mean"), F.lit(median).alias("median"),
    )


def _fenced(df: DataFrame, metrics: list[str], by: list[str], key: str) -> DataFrame:
    quartiles = materialize(quantiles(df, metrics, QUARTILES, by, key), "quartiles")
    reach = (F.col("q3") - F.col("q1")) * F.lit(1.5)
    fences = quartiles.withColumns({"fence_low": F.col("q1") - reach, "fence_high": F.col("q3") + reach})
    return lookup_join(melt_metrics(df, metrics, [*by, key]), fences, [*by, "metric"], "inner")


def box_stats(df: DataFrame, metrics: list[str], by: list[str] = (), key: str = "entity_id") -> DataFrame:
    """Quartiles, whisker ends at 1.5 IQR and outlier count per metric (and group)."""
    by = list(by)
    inside = F.col("value").between(F.col("fence_low"), F.col("fence_high"))
    whisker = F.when(inside, F.col("value"))
    return _fenced(df, metrics, by, key).groupBy(*by, "metric", "n", *QUARTILES).agg(
        F.min(whisker).alias("whisker_low"), F.max(whisker).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(df: DataFrame, metrics: list[str], by: list[str] = (), key: str = "entity_id") -> DataFrame:
    """The rows beyond the whiskers."""
    by = list(by)
    inside = F.col("value").between(F.col("fence_low"), F.col("fence_high"))
    return _fenced(df, metrics, by, key).where(~inside).select(*by, key, "metric", "value")


def summary_stats(df: DataFrame, key: str = "entity_id") -> DataFrame:
    """One row: entity count, and mean, quartiles and maximum of spend, activity and cost."""
    shown = {
        "spend_total": ("spend", ["mean", "median", "q1", "q3", "max"]),
        "activity": ("activity", ["mean", "median", "max"]),
        "cost_per_activity": ("cost", ["mean", "median", "q3", "max"]),
    }
    present = [c for c in shown if c in df.columns]
    basic = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(F.col(c).cast("double")).alias(f"{c}_{tag}") for c in present for tag, f in (("mean", F.avg), ("max", F.max))],
    ).first()
    table = quantiles(df, present, QUARTILES, key=key)
    columns = []
    for metric, (short, parts) in shown.items():
        for part in parts:
            if metric not in present:
                cell = F.lit(0.0)
            elif part in ("mean", "max"):
                cell = F.lit(basic[f"{metric}_{part}"]).cast("double")
            else:
                cell = F.max(F.when(F.col("metric") == metric, F.col(part)))
            columns.append(cell.alias(f"{short}_{part}"))
    return table.agg(F.lit(basic["n"]).cast("bigint").alias("entities"), *columns)
