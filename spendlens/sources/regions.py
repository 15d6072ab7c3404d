"""Region polygons from a GeoJSON file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.geo import REFERENCE_POINT, distance_to_reference, polygon_centroid


def read_regions(spark: SparkSession, path: str, code: str = "sigla", multi_line: bool = True) -> DataFrame:
    """``region, parts``: parts > rings > vertices. A Polygon becomes one part.

    One feature collection per file, or one per line without ``multi_line``.

    The two geometry kinds nest to different depths in one file, so coordinates are read as
    VARIANT under an explicit schema and cast per kind.
    """
    geometry = T.StructType([
        T.StructField("type", T.StringType()), T.StructField("coordinates", T.VariantType()),
    ])
    feature = T.StructType([
        T.StructField("properties", T.StructType([T.StructField(code, T.StringType())])),
        T.StructField("geometry", geometry),
    ])
    schema = T.StructType([T.StructField("features", T.ArrayType(feature))])
    features = spark.read.schema(schema).option("multiLine", multi_line).json(path).select(
        F.explode("features").alias("f")
    )
    shape = F.col("f.geometry.coordinates")
    polygon = F.try_variant_get(shape, "$", "array<array<array<double>>>")
    multi = F.try_variant_get(shape, "$", "array<array<array<array<double>>>>")
    parts = F.when(F.col("f.geometry.type") == "Polygon", F.array(polygon)).when(
        F.col("f.geometry.type") == "MultiPolygon", multi
    )
    return features.select(F.col(f"f.properties.{code}").alias("region"), parts.alias("parts"))


def region_centroids(regions: DataFrame) -> DataFrame:
    """``region, lat, lon`` of each region's planar centroid."""
    return regions.withColumn("c", polygon_centroid(F.col("parts"))).select(
        "region", F.col("c.lat").alias("lat"), F.col("c.lon").alias("lon")
    )


def region_distances(centroids: DataFrame, point: tuple[float, float] = REFERENCE_POINT) -> DataFrame:
    """``region, distance_km`` from each centroid to the reference point."""
    return centroids.select(
        "region", distance_to_reference(F.col("lat"), F.col("lon"), point).alias("distance_km")
    )
