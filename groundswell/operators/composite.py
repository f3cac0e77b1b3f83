"""Stacks over time and over blocks: composites, overviews, multilooking, mosaics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundswell.frames import with_size
from groundswell.functions.scalar import scaled_ndvi

_METHODS = {"median": F.median, "mean": F.avg, "max": F.max, "min": F.min}


def temporal_composite(
    stack: DataFrame, method: str = "median", by: Sequence[str] = ()
) -> DataFrame:
    """One value per pixel over its scenes, NULLs ignored.

    A pixel's group is its acquisitions, at most one per scene, so the exact
    built-in median is safe here; partial aggregation runs before the shuffle.
    """
    if method not in _METHODS:
        raise ValueError(f"unknown method {method!r}, expected one of {sorted(_METHODS)}")
    return stack.groupBy(*by, "row", "col").agg(_METHODS[method]("value").alias("value"))


def observation_counts(stack: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return stack.groupBy(*by, "row", "col").agg(F.count("value").alias("observations"))


def composite_coverage(stack: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Fewest, most and mean observations per pixel."""
    return observation_counts(stack, by).groupBy(*by).agg(
        F.min("observations").alias("min_observations"),
        F.max("observations").alias("max_observations"),
        F.avg("observations").alias("mean_observations"),
    )


def ndvi_composite(
    scenes: DataFrame, bands: DataFrame, max_cloud: float = 30.0, max_scenes: int = 20,
    order: Sequence[str] = ("cloud_cover", "scene_id"),
) -> DataFrame:
    """Per-pixel median NDVI over the clearest scenes.

    The scene list is capped because the feature is "the best N scenes"; it
    reaches the pixel table as a semi-join on ``scene_id``.
    """
    chosen = scenes.where(F.col("cloud_cover") < max_cloud).orderBy(*order).limit(max_scenes)
    per_scene = bands.join(F.broadcast(chosen.select("scene_id")), "scene_id", "left_semi").withColumn(
        "value", scaled_ndvi(F.col("nir"), F.col("red"))
    )
    return temporal_composite(per_scene, "median")


def overview_pyramid(
    df: DataFrame, levels: Sequence[int] = (2, 4, 8, 16), by: Sequence[str] = ()
) -> DataFrame:
    """Averaged overviews.  Each level is folded from the sums of the level before it, so
    the base pixels are read and shuffled once however many levels there are."""
    out, previous = None, 1
    base = df.select(
        *by, "row", "col", F.coalesce("value", F.lit(0.0)).alias("_s"),
        F.when(F.col("value").isNotNull(), 1).otherwise(0).cast("bigint").alias("_n"),
    )
    for level in sorted(levels):
        if level % previous:
            raise ValueError("each overview level must be a multiple of the one before")
        step, previous = level // previous, level
        base = base.groupBy(
            *by, F.floor(F.col("row") / step).cast("int").alias("row"),
            F.floor(F.col("col") / step).cast("int").alias("col"),
        ).agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
        one = base.select(
            *by, F.lit(level).alias("level"), "row", "col",
            F.when(F.col("_n") > 0, F.col("_s") / F.col("_n")).alias("value"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def multilook(
    df: DataFrame, az_looks: int = 3, rg_looks: int = 9, by: Sequence[str] = (),
    size: tuple[int, int] | DataFrame | None = None,
) -> DataFrame:
    """Block means; incomplete blocks at the far edges are dropped."""
    sized = with_size(df, by, size)
    block_row = F.floor(F.col("row") / az_looks).cast("int")
    block_col = F.floor(F.col("col") / rg_looks).cast("int")
    whole = (block_row < F.floor(F.col("_h") / az_looks)) & (
        block_col < F.floor(F.col("_w") / rg_looks)
    )
    return sized.where(whole).groupBy(
        *by, block_row.alias("row"), block_col.alias("col")
    ).agg(F.avg("value").alias("value"))


def mosaic_clip(
    tiles: DataFrame, bounds: tuple[int, int, int, int], order: str = "tile_order",
    by: Sequence[str] = (),
) -> DataFrame:
    """Merge overlapping tiles inside [row0, row1) x [col0, col1); first valid tile wins."""
    row0, row1, col0, col1 = bounds
    inside = (
        (F.col("row") >= row0) & (F.col("row") < row1)
        & (F.col("col") >= col0) & (F.col("col") < col1) & F.col("value").isNotNull()
    )
    return tiles.where(inside).groupBy(*by, "row", "col").agg(
        F.min_by("value", order).alias("value")
    )
