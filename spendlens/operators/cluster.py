"""k-means over entities by Spark ML, and a hierarchy of group profiles."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geo import let
from ..functions.numbers import null_nonfinite
from ..session import materialize
from .groups import group_zscores
from .scaling import zscore
from .stats import METRICS

FEATURES = ["spend_per_km", "activity"]
SWEEP = (2, 3, 4, 5)
RESTARTS = 10
SEED = 42
MAX_ITERATIONS = 300
TOLERANCE = 1e-4  # a fit stops once the squared moves of its centres sum to at most this (unit variance)


def scaled_features(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Non-finite and missing features as 0, then z-scored with the population deviation."""
    clean = df.withColumns({
        c: F.coalesce(null_nonfinite(F.col(c).cast("double")), F.lit(0.0)) for c in features
    })
    return zscore(clean, features)


def kmeans_sweep(df: DataFrame, features: list[str] = FEATURES, ks=SWEEP, restarts: int = RESTARTS,
                 seed: int = SEED, parallel: int = 8) -> tuple[DataFrame, DataFrame]:
    """``(labelled, costs)``: rows with ``cluster``, and the lowest cost per k.

    Each k is fitted with ``restarts`` seeds; the k with the lowest cost wins. The vectors are written
    once and the fits share the cluster (Spark schedules their jobs side by side); each keeps them as
    dense blocks, so that its iterations do not unpack the stored rows again. Only centres and costs
    reach the driver. Clusters are numbered by their centre so labels do not depend on seeds.
    """
    scored = materialize(scaled_features(df, features), "features")
    z = [f"{c}_z" for c in features]
    assembler = VectorAssembler(inputCols=z, outputCol="__x")
    vectors = assembler.transform(scored.select(*z)).select("__x").persist()

    def fit(task):
        k, turn = task
        means = KMeans(
            k=k, seed=seed + turn, maxIter=MAX_ITERATIONS, tol=(TOLERANCE / k) ** 0.5,
            featuresCol="__x", predictionCol="cluster", solver="block",
        )
        try:
            return means.fit(vectors)
        except Py4JJavaError as error:  # Spark's blocks fail where fewer than k first centres are found; rows do not
            if "ArrayIndexOutOfBoundsException" not in str(error.java_exception):
                raise
            return means.setSolver("row").fit(vectors)

    tasks = [(k, turn) for k in ks for turn in range(restarts)]
    try:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            models = list(pool.map(fit, tasks))
    finally:
        vectors.unpersist()
    best = {}
    for (k, _), model in zip(tasks, models):
        if k not in best or model.summary.trainingCost < best[k].summary.trainingCost:
            best[k] = model
    lowest = min(best, key=lambda k: best[k].summary.trainingCost)
    model = best[lowest]
    order = sorted(range(len(model.clusterCenters())), key=lambda i: tuple(model.clusterCenters()[i]))
    place = F.element_at(F.array(*[F.lit(order.index(i)) for i in range(len(order))]), F.col("cluster") + 1)
    labelled = model.transform(assembler.transform(scored)).withColumn("cluster", place).drop("__x", *z)
    costs = df.sparkSession.createDataFrame(
        [(k, float(best[k].summary.trainingCost), k == lowest) for k in ks], "k int, cost double, chosen boolean"
    )
    return labelled, costs


def cluster_summary(labelled: DataFrame) -> DataFrame:
    """Entities, mean normalised spend, mean activity and mean distance per cluster."""
    return labelled.groupBy("cluster").agg(
        F.count("entity_id").alias("entities"), F.avg("spend_per_km").alias("mean_spend_per_km"),
        F.avg("activity").alias("mean_activity"), F.avg("distance_km").alias("mean_distance_km"),
    )


def agglomerated(points: Column, leaves: int) -> Column:
    """Clusters of few points (structs of name and place): the two whose union raises the squared distances to the
    centres least become one, until ``leaves`` are left. Structs of name (the smallest), n, centre and members.

    A fold inside one row, for points whose number is the size of a report.
    """
    start = F.transform(F.array_sort(points), lambda p: F.struct(
        p["name"].alias("name"), F.lit(1.0).alias("n"), p["place"].alias("centre"), F.array(p["name"]).alias("members")))

    def cost(a: Column, b: Column) -> Column:
        gaps = F.zip_with(a["centre"], b["centre"], lambda x, y: (x - y) * (x - y))
        return a["n"] * b["n"] / (a["n"] + b["n"]) * F.aggregate(gaps, F.lit(0.0), lambda t, v: t + v)

    def united(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        centre = F.zip_with(a["centre"], b["centre"], lambda x, y: (x * a["n"] + y * b["n"]) / n)
        return F.struct(a["name"].alias("name"), n.alias("n"), centre.alias("centre"),
                        F.concat(a["members"], b["members"]).alias("members"))

    def step(state: Column, _: Column) -> Column:
        pairs = F.flatten(F.transform(state, lambda a: F.transform(
            F.filter(state, lambda b: b["name"] > a["name"]),
            lambda b: F.struct(cost(a, b).alias("cost"), a["name"].alias("a"), b["name"].alias("b")))))

        def merged(best: Column) -> Column:
            gone = F.filter(state, lambda c: c["name"] == best["b"])
            rest = F.filter(state, lambda c: c["name"] != best["b"])
            return F.transform(rest, lambda c: F.when(c["name"] == best["a"], united(c, F.get(gone, F.lit(0)))).otherwise(c))

        return let(F.array_min(pairs), merged)

    steps = F.array_repeat(F.lit(0), F.greatest(F.size(points) - leaves, F.lit(0)))
    return F.aggregate(steps, start, step)


def group_hierarchy(df: DataFrame, n: int = 12, metrics: list[str] = METRICS, leaves: int = 4) -> DataFrame:
    """Group profiles ordered by similarity: joined bottom-up into ``leaves`` clusters, then by distance to centre.

    Clusters are numbered by their smallest group name. Fewer than three groups give no rows.
    """
    scored = materialize(group_zscores(df, n, metrics), "profiles")
    z = [c for c in scored.columns if c.endswith("_z")]
    point = F.struct(F.col("grp").alias("name"), F.array(*z).alias("place"))
    found = scored.agg(F.collect_list(point).alias("points")).where(F.size("points") >= 3)  # at most n
    clusters = found.select(F.posexplode(agglomerated(F.col("points"), leaves)).alias("cluster", "c"))
    members = clusters.select("cluster", "c.centre", F.explode("c.members").alias("grp"))
    gaps = F.zip_with(F.array(*z), "centre", lambda a, b: (a - b) * (a - b))
    return scored.join(members, "grp").withColumn(
        "to_centre", F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda a, b: a + b))
    ).select(*scored.columns, "cluster", "to_centre").orderBy("cluster", "to_centre", "grp")
