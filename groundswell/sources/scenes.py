"""Scene metadata: search filters, acquisition stacks, elevation tile lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundswell.functions.geodesy import dem_tile_name
from groundswell.operators.acquisitions import best_orbit, min_gap_scenes


def search_scenes(
    scenes: DataFrame, start: str, end: str, processing_level: str | None = None,
    bbox: Sequence[float] | None = None, platform: str | None = None,
    beam_mode: str | None = None, max_results: int | None = None,
) -> DataFrame:
    """Scenes over a box in a date range, by start time; ``max_results`` is the caller's cap."""
    t = F.col("start_time").cast("timestamp")
    out = scenes.where(
        t.isNotNull() & (t >= F.lit(start).cast("timestamp")) & (t <= F.lit(end).cast("timestamp"))
    )
    for name, wanted in (
        ("processing_level", processing_level), ("platform", platform), ("beam_mode", beam_mode),
    ):
        if wanted is not None:
            out = out.where(F.col(name) == wanted)
    if bbox is not None:
        west, south, east, north = bbox
        out = out.where(
            (F.col("fp_east") >= west) & (F.col("fp_west") <= east)
            & (F.col("fp_north") >= south) & (F.col("fp_south") <= north)
        )
    out = out.orderBy("start_time", "scene_id")
    return out if max_results is None else out.limit(max_results)


def acquisition_stack(
    scenes: DataFrame, start: str, end: str, processing_level: str | None = None,
    bbox: Sequence[float] | None = None, min_gap_days: int = 14, max_scenes: int | None = None,
) -> DataFrame:
    """Search, keep the busiest orbit, thin it to the minimum gap.  Empty in, empty out."""
    found = search_scenes(scenes, start, end, processing_level, bbox)
    on_orbit = found.join(
        F.broadcast(best_orbit(found).select("path_number")), "path_number", "left_semi"
    )
    return min_gap_scenes(on_orbit, min_gap_days, max_scenes)


def tile_cover(areas: DataFrame, margin: float = 0.15) -> DataFrame:
    """1-degree elevation tiles of each area ``(area_id, west, south, east, north)``."""
    lats = F.sequence(F.floor(F.col("south") - margin), F.ceil(F.col("north") + margin) - 1)
    lons = F.sequence(F.floor(F.col("west") - margin), F.ceil(F.col("east") + margin) - 1)
    return (
        areas.select("area_id", F.explode(lats).alias("lat"), lons.alias("_lons"))
        .select("area_id", "lat", F.explode("_lons").alias("lon"))
        .withColumn("tile_name", dem_tile_name(F.col("lat"), F.col("lon")))
    )
