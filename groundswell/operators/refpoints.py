"""Choice of a stable reference point from a coherence raster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundswell.functions.geodesy import Grid, pixel_to_lonlat

# Area of interest (west, south, east, north) and stable features (lat, lon).
AOI = (114.304, -2.611, 114.404, -2.511)
STABLE_FEATURES = {
    "Teluk_Bayur_village_center": (-2.545, 114.355),
    "Road_junction_north_AOI": (-2.520, 114.350),
    "Kapuas_River_bridge_east": (-2.540, 114.390),
    "Road_along_northern_edge": (-2.515, 114.340),
    "Settlement_NE_corner": (-2.518, 114.380),
}


def top_reference_points(
    coherence: DataFrame, grid: Grid, candidates: int = 100, keep: int = 20
) -> DataFrame:
    """Most coherent pixels, one per 0.001 degree cell.

    Both limits are the feature: the report lists the best 20 of the best 100.
    """
    v = F.col("value")
    lon, lat = pixel_to_lonlat(F.col("row"), F.col("col"), grid)
    best = (
        coherence.where((v >= 0) & (v <= 1))
        .orderBy(F.desc("value"), "row", "col").limit(candidates)
        .select("row", "col", v.alias("coherence"), lon.alias("lon"), lat.alias("lat"))
    )
    cell = Window.partitionBy(F.round("lat", 3), F.round("lon", 3)).orderBy(
        F.desc("coherence"), "row", "col"
    )
    return (
        best.withColumn("_k", F.row_number().over(cell)).where(F.col("_k") == 1).drop("_k")
        .orderBy(F.desc("coherence"), "row", "col").limit(keep)
    )


def nearest_feature(
    lat: Column, lon: Column, features: dict[str, tuple[float, float]] = STABLE_FEATURES
) -> Column:
    """(distance in degrees, name) of the nearest of a short list of named points."""
    choices = [
        F.struct(
            F.sqrt(F.pow(lat - F.lit(a), 2) + F.pow(lon - F.lit(b), 2)).alias("distance"),
            F.lit(i).alias("place"), F.lit(name).alias("name"),
        )
        for i, (name, (a, b)) in enumerate(features.items())
    ]
    return F.array_min(F.array(*choices))


def score_reference_points(
    points: DataFrame, aoi: Sequence[float] = AOI,
    features: dict[str, tuple[float, float]] = STABLE_FEATURES,
) -> DataFrame:
    """Coherence plus bonuses: inside the AOI, near a stable feature, near the AOI's edge."""
    west, south, east, north = aoi
    lat, lon = F.col("lat"), F.col("lon")
    inside = lon.between(west, east) & lat.between(south, north)
    edge = F.least(F.abs(lat - south), F.abs(lat - north), F.abs(lon - west), F.abs(lon - east))
    near = F.greatest(F.lit(0.0), (1 - F.col("_near.distance") / 0.05) * 0.1)
    return (
        points.withColumn("_near", nearest_feature(lat, lon, features))
        .withColumn("in_aoi", inside)
        .withColumn(
            "score",
            F.col("coherence") + F.when(inside, 0.1).otherwise(0.0) + near
            + F.when(inside & (edge < 0.02), 0.05).otherwise(0.0),
        )
        .withColumn("nearest_feature", F.col("_near.name")).drop("_near")
    )


def best_reference_point(scored: DataFrame) -> DataFrame:
    """Best point overall and best inside the AOI, labelled ``scope``."""
    order = F.struct("score", "coherence", -F.col("row"), -F.col("col"))
    cols = ["row", "col", "lat", "lon", "coherence", "score", "nearest_feature"]
    scopes = F.when(F.col("in_aoi"), F.array(F.lit("overall"), F.lit("aoi"))).otherwise(
        F.array(F.lit("overall"))
    )
    return scored.withColumn("scope", F.explode(scopes)).groupBy("scope").agg(
        F.max_by(F.struct(*cols), order).alias("_b")
    ).select("scope", "_b.*")
