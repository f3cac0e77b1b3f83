"""Map products composed from operators: masks, risk, carbon, peat, forest, fusion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundswell.config import (
    CanalSettings, FusionSettings, PeatSettings, RiskSettings, Sensor, WaterSettings,
)
from groundswell.frames import attach, extent, val
from groundswell.functions import scalar as S
from groundswell.functions.geodesy import Grid, pixel_size_m
from groundswell.operators import algebra as A
from groundswell.operators import geometry as G
from groundswell.operators import morphology as M
from groundswell.operators.components import remove_small_runs
from groundswell.operators.distance import distance_map
from groundswell.operators.focal import median_filter
from groundswell.operators.quantiles import exact_percentiles


def displacement_products(
    phase: DataFrame, days: float, sensor: Sensor = Sensor(), incidence: DataFrame | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """``los`` and ``vertical`` displacement (m) and ``velocity`` (mm/yr) of an unwrapped phase over ``days``.

    ``incidence`` gives each pixel's angle in degrees; without it the sensor's mean angle counts.  A
    pixel without phase or angle, or seen at 90 degrees or more, has no vertical value.
    """
    los = phase.select(*by, "row", "col", S.phase_to_los(val(), sensor.wavelength_m).alias("los"))
    if incidence is None:
        up = los.withColumn("vertical", S.los_to_vertical(F.col("los"), sensor.incidence_deg))
    else:
        angle = incidence.select(*by, "row", "col", val().alias("_angle"))
        up = los.join(angle, [*by, "row", "col"], "left").withColumn(
            "vertical", S.los_to_vertical_by_angle(F.col("los"), F.col("_angle"))).drop("_angle")
    return up.withColumn("velocity", S.displacement_to_velocity(F.col("vertical"), days))


def threshold_canals(vv: DataFrame, percentile: float = 10.0, by: Sequence[str] = ()) -> DataFrame:
    """Pixels darker than the percentile of positive backscatter."""
    positive = vv.where(val() > 0)
    cut = exact_percentiles(positive, val(), [percentile / 100], by, ["_cut"])
    return attach(positive, cut, by).where(val() < F.col("_cut")).select(*by, "row", "col")


def canal_cleanup(
    mask: DataFrame, settings: CanalSettings = CanalSettings(), by: Sequence[str] = (),
    size=None, tile: int = 512,
) -> DataFrame:
    """Close gaps, drop small components, widen again."""
    runs = M.close_runs(M.to_runs(mask, by), M.disk(settings.closing_radius), by, size)
    runs = remove_small_runs(runs, settings.min_size, by, tile)
    if settings.dilation_size > 0:
        runs = M.dilate_runs(runs, M.disk(settings.dilation_size // 2), by, size)
    return M.to_pixels(runs, by)


def water_cleanup(
    mask: DataFrame, min_size: int = 50, closing_radius: int = 3, by: Sequence[str] = (),
    size=None, tile: int = 512,
) -> DataFrame:
    runs = M.to_runs(mask, by)
    if closing_radius > 0:
        runs = M.close_runs(runs, M.disk(closing_radius), by, size)
    return M.to_pixels(remove_small_runs(runs, min_size, by, tile), by)


def detect_canals(
    vv: DataFrame, settings: CanalSettings = CanalSettings(), by: Sequence[str] = (), size=None,
    tile: int = 512,
) -> DataFrame:
    size = extent(vv, by) if size is None else size
    raw = threshold_canals(vv, settings.percentile, by)
    return canal_cleanup(raw, settings, by, size, tile)


def canal_distance(vv: DataFrame, canals: DataFrame, grid: Grid | None = None,
                   by: Sequence[str] = ()) -> DataFrame:
    """Distance to the nearest canal; the pixel size is the grid's column step."""
    return distance_map(vv, canals, abs(grid.a) if grid else 1.0, by=by)


def water_mask(
    vv: DataFrame, settings: WaterSettings = WaterSettings(), vv_db: DataFrame | None = None,
    canals: DataFrame | None = None, by: Sequence[str] = (), size=None, tile: int = 512,
) -> DataFrame:
    """Open water: dark pixels (dB raster preferred), cleaned, canals left out."""
    size = extent(vv, by) if size is None else size
    raw = (
        A.water_mask_db(vv_db, settings.threshold_db) if vv_db is not None
        else A.water_mask_linear(vv, settings.threshold_db)
    )
    out = water_cleanup(raw, settings.min_size, settings.closing_radius, by, size, tile)
    if settings.exclude_canals and canals is not None:
        out = A.exclude_canals(out, canals, by)
    return out


def risk_map(
    velocity: DataFrame, distance: DataFrame, water: DataFrame | None = None,
    settings: RiskSettings = RiskSettings(), by: Sequence[str] = (), size=None, tile: int = 256,
) -> DataFrame:
    """Canal-proximity and subsidence risk of median-smoothed velocity."""
    smooth = median_filter(velocity, settings.median_size, by, tile, size)
    joined = A.aligned(smooth, distance, "_dist", by, value="distance")
    flag = None
    if water is not None:
        joined, flag = A.with_mask(joined, water, "_water", by), F.col("_water")
    return joined.select(
        *by, "row", "col", A.risk_score(val(), F.col("_dist"), flag, settings).alias("value")
    )


def carbon_loss(
    velocity: DataFrame, coherence: DataFrame | None = None, water: DataFrame | None = None,
    min_coherence: float = 0.7, water_buffer: int = 3, by: Sequence[str] = (), size=None,
    tile: int = 256,
) -> DataFrame:
    """Carbon loss rate of coherent, smoothed velocity away from buffered water."""
    src = velocity if coherence is None else A.coherence_mask(velocity, coherence, min_coherence, by)
    rate = median_filter(src, 9, by, tile, size).withColumn("value", S.carbon_rate(val()))
    if water is None:
        return rate
    size = extent(velocity, by) if size is None else size
    wet = M.dilate(water, M.disk(water_buffer), by, size)
    return (
        A.with_mask(rate, wet, "_wet", by).withColumn("value", F.when(~F.col("_wet"), val()))
        .drop("_wet")
    )


def peat_depth(
    pixels: DataFrame, peat: DataFrame, size_x: float, size_y: float | None = None,
    settings: PeatSettings = PeatSettings(), by: Sequence[str] = (),
) -> DataFrame:
    """Depth class from the distance to the nearest pixel that is not peat."""
    keys = [*by, "row", "col"]
    outside = pixels.select(*keys).join(peat.select(*keys), keys, "left_anti")
    edge = distance_map(pixels, outside, size_x, size_y, by)
    return A.with_mask(edge, peat, "_peat", by).select(
        *keys,
        S.peat_depth_class(
            F.col("_peat"), F.col("distance"), settings.shallow_edge_m, settings.moderate_edge_m
        ).alias("depth_class"),
    )


def peat_products(
    velocity: DataFrame, vertices: DataFrame, grid: Grid,
    settings: PeatSettings = PeatSettings(), pixel_m: tuple[float, float] | None = None,
    epsg: int | None = None,
) -> dict[str, DataFrame]:
    """Peat extent from polygons (the whole area when there are none), depth and masked velocity.

    Vertices are in pixel units, or in the coordinates ``epsg`` names.
    """
    if epsg is not None:
        vertices = G.to_pixel_units(vertices, grid, epsg)
    shapes = G.polygons_or_box(vertices, (0.0, 0.0, grid.width, grid.height))
    extent = G.rasterize_polygons(shapes, grid.height, grid.width)
    sx, sy = pixel_m or pixel_size_m(grid)
    return {
        "peat_extent_binary": extent,
        "peat_extent": peat_depth(velocity, extent, sx, sy, settings),
        "peat_velocity": A.apply_peat_mask(velocity, extent),
    }


def forest_products(
    forest: DataFrame, reference_year: int = 2024, source: Grid | None = None,
    target: Grid | None = None,
) -> DataFrame:
    """Clearing year, years since clearing and risk factor, on the target grid if given."""
    if source is not None and target is not None and source != target:
        bands = [
            G.resample(
                forest.select("row", "col", F.col(b).cast("double").alias("value")),
                source, target, "nearest",
            ).withColumnRenamed("value", b)
            for b in ("lossyear", "treecover")
        ]
        forest = bands[0].join(bands[1], ["row", "col"]).fillna(0, ["lossyear", "treecover"])
    years = S.time_since_clearing(F.col("lossyear"), reference_year)
    return forest.withColumn("years_since_clearing", years).withColumn(
        "value", S.clearing_risk_factor(F.col("years_since_clearing"), F.col("treecover"))
    )


def fusion_products(
    c_vel: DataFrame, c_coh: DataFrame, l_vel: DataFrame, l_coh: DataFrame,
    c_grid: Grid | None = None, l_grid: Grid | None = None, distance: DataFrame | None = None,
    water: DataFrame | None = None, settings: FusionSettings = FusionSettings(),
    risk: RiskSettings = RiskSettings(), size=None,
) -> dict[str, DataFrame]:
    """Fused velocity, coherence, coverage, class, and risk when a canal distance is given."""
    if c_grid is not None and l_grid is not None:
        l_vel = G.align_to(l_vel, l_grid, c_grid)
        l_coh = G.align_to(l_coh, l_grid, c_grid)
    fused = A.fuse(c_vel, c_coh, l_vel, l_coh, settings.min_coherence, settings.c_boost)
    velocity = fused.select("row", "col", "value")
    out = {
        "fused_velocity": velocity,
        "fused_coherence": fused.select("row", "col", F.col("coherence").alias("value")),
        "sensor_coverage": fused.select("row", "col", "coverage"),
        "fused_class": A.classify(velocity, water),
    }
    if distance is not None:
        out["fused_risk"] = risk_map(velocity, distance, water, risk, size=size)
    return out
