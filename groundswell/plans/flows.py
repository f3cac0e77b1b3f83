"""End-to-end flows.  Each is one chain of DataFrames; nothing is written between steps
unless the caller writes it."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundswell.config import Settings
from groundswell.frames import materialized, val
from groundswell.functions import scalar as S
from groundswell.functions.geodesy import Grid, to_crs
from groundswell.operators import acquisitions as Q
from groundswell.operators import algebra as A
from groundswell.operators import catalog as C
from groundswell.operators import geometry as G
from groundswell.operators import morphology as M
from groundswell.operators import stats
from groundswell.operators import timeseries as TS
from groundswell.operators.composite import temporal_composite
from groundswell.operators.focal import lee_sigma
from groundswell.plans import products as P
from groundswell.plans import reports as R
from groundswell.sources import objects
from groundswell.sources import stack as SK
from groundswell.sources.scenes import acquisition_stack


def backscatter_flow(
    dn: DataFrame, lut: DataFrame, source: Grid | None = None, target: Grid | None = None,
    method: str = "median", speckle_window: int = 7, by: Sequence[str] = ("scene_id",),
) -> dict[str, DataFrame]:
    """Calibrate, despeckle and geocode all scenes at once, then composite over time.

    A scene without a calibration table drops out of the calibration join.
    """
    by = list(by)
    sigma0 = G.calibrate(dn, lut, by)
    clean = lee_sigma(sigma0, speckle_window, by=by)
    if source is not None and target is not None:
        clean = G.align_to(clean, source, target, "bilinear", by)
    composite = temporal_composite(clean, method)
    db = composite.withColumn("value", S.to_decibels(val()))
    return {"scenes": clean, "vv": composite, "vv_db": db}


def timeseries_flow(
    stack: DataFrame, dates: DataFrame, settings: Settings = Settings(),
    delay: DataFrame | None = None, grid: Grid | None = None,
    aoi: Sequence[float] | None = None, reference: tuple[int, int] | None = None,
    reference_lonlat: tuple[float, float] | None = None,
) -> dict[str, DataFrame]:
    """Network, delay, deramp, reference, inversion, velocity and export.

    The reference pixel (row and column, longitude and latitude on ``grid``, or the most coherent
    one) is chosen first, on the phases as observed.  Delay and ramp are taken off next, and the phase
    there last: it stays zero in every pair, so the pixel does not move.
    """
    ts = settings.timeseries
    net = materialized(TS.modify_network(stack, ts.min_pair_coherence))
    at: tuple[int, int] | DataFrame | None = reference
    if reference is None and reference_lonlat is not None:
        if grid is None:
            raise ValueError("a reference in degrees needs the grid")
        x, y = to_crs(*map(F.lit, map(float, reference_lonlat)), 4326, grid.epsg)
        row, col = grid.rowcol(x, y)
        at = stack.sparkSession.range(1).select(
            F.floor(row).cast("int").alias("row"), F.floor(col).cast("int").alias("col"))
    elif reference is None:
        at = materialized(TS.reference_pixel(net, ts.reference_min_coherence))
    net = TS.deramp_stack(TS.apply_delay(net, delay))
    net = materialized(TS.reference_phase(net, at))
    series = materialized(TS.invert_network(net))
    metres = settings.sensor.wavelength_m / (4 * math.pi)
    velocity = TS.timeseries_velocity(series, dates, metres)
    coherence = TS.temporal_coherence(net, series)
    return {"series": series, **export_velocity(velocity, coherence, settings, grid, aoi)}


def timeseries_from_listing(
    listing: DataFrame, phase: DataFrame, coherence: DataFrame, **options
) -> dict[str, DataFrame]:
    """From object names and layers ``(pair_id, row, col, value)`` to velocity, in one chain."""
    pairs = SK.discover_pairs(listing)
    dates = SK.stack_dates(pairs)
    stack = materialized(SK.load_stack(SK.indexed_pairs(pairs, dates), phase, coherence).where("row IS NOT NULL"))
    return timeseries_flow(stack, dates, **options)


def export_velocity(
    velocity: DataFrame, coherence: DataFrame, settings: Settings = Settings(),
    grid: Grid | None = None, aoi: Sequence[float] | None = None,
    target: Grid | None = None, incidence: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Vertical velocity in mm/yr: clamp, clip to the area, mask by coherence, in that order.

    ``incidence`` gives each pixel's angle in degrees; without it the sensor's mean angle counts.  The
    standard error is scaled to mm/yr only.
    """
    ts = settings.timeseries
    if incidence is None:
        vertical = S.los_to_vertical(F.col("velocity"), settings.sensor.incidence_deg)
    else:
        velocity = velocity.join(incidence.select("row", "col", val().alias("_angle")), ["row", "col"], "left")
        vertical = S.los_to_vertical_by_angle(F.col("velocity"), F.col("_angle"))
    out = velocity.select(
        "row", "col", S.clamp_velocity(vertical, ts.export_limit).alias("value"),
        (F.col("velocity_std") * 1000.0).alias("std"),
    )
    if grid is not None and aoi is not None:
        window, grid = A.aoi_window(grid, aoi, ts.aoi_buffer_deg, ts.aoi_west_buffer_deg)
        out, coherence = A.window_clip(out, *window), A.window_clip(coherence, *window)
    out = A.coherence_mask(out, coherence, ts.export_coherence, columns=("value", "std"))
    layers = {
        "subsidence_velocity": out.select("row", "col", "value"),
        "velocity_uncertainty": out.select("row", "col", F.col("std").alias("value")),
        "coherence": coherence,
    }
    if target is not None and grid is not None:
        layers.update({f"{k}_utm": G.align_to(v, grid, target) for k, v in list(layers.items())})
    return layers


def analysis_flow(
    velocity: DataFrame, coherence: DataFrame | None = None, vv: DataFrame | None = None,
    vv_db: DataFrame | None = None, forest: DataFrame | None = None,
    peat_polygons: DataFrame | None = None, waterways: DataFrame | None = None,
    ndvi: DataFrame | None = None, grid: Grid | None = None, settings: Settings = Settings(),
    size: tuple[int, int] | None = None, second: tuple[DataFrame, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """All analysis products of one area on one grid.

    ``second`` is velocity and coherence of another sensor on the same grid, for the fused products.

    Inputs left out skip the products that need them; velocity is calibrated and
    classified in every case.  Layers that several products read are materialized, so
    each is computed once.
    """
    spark = velocity.sparkSession
    out: dict[str, DataFrame] = {}
    canals = distance = water = None
    if vv is not None:
        canals = materialized(P.detect_canals(vv, settings.canals, size=size, tile=settings.tile))
        distance = materialized(P.canal_distance(vv, canals, grid))
        out["canal_mask"], out["canal_distance"] = canals, distance
        water = materialized(
            P.water_mask(vv, settings.water, vv_db, canals, size=size, tile=settings.tile)
        )
        out["water_mask"] = water

    velocity = materialized(A.calibrate_velocity(velocity, coherence))
    out["calibrated_velocity"] = velocity
    out["subsidence_class"] = A.classify(velocity, water, edges=settings.classes)

    peat = None
    if peat_polygons is not None and grid is not None:
        made = P.peat_products(velocity, peat_polygons, grid, settings.peat)
        made["peat_extent_binary"] = materialized(made["peat_extent_binary"])
        out.update(made)
        peat = made["peat_extent_binary"]
    if forest is not None:
        out["clearing_risk_factor"] = P.forest_products(forest, settings.reference_year)
    out["degraded_peatland"] = A.degraded_mask(velocity, water, peat)

    risk = None
    if distance is not None:
        risk = materialized(P.risk_map(velocity, distance, water, settings.risk, size=size))
        out["canal_risk"] = risk
        if peat is not None:
            out["peat_risk"] = A.peat_weighted_risk(risk, out["peat_extent"])
        if forest is not None:
            out["time_adjusted_risk"] = A.time_adjusted_risk(risk, out["clearing_risk_factor"])
    out["carbon_loss"] = P.carbon_loss(velocity, coherence, water, size=size)
    if grid is not None:
        out["carbon_total"] = stats.carbon_total(out["carbon_loss"], grid)
    if second is not None and coherence is not None:
        out.update(P.fusion_products(
            velocity, coherence, *second, distance=distance, water=water, size=size))

    dist_value = None if distance is None else distance.withColumnRenamed("distance", "value")
    if any(x is not None for x in (vv, coherence, distance, ndvi)):
        checks = R.correlations(velocity, vv, coherence, dist_value, ndvi)
        agreement = None
        if waterways is not None and canals is not None and grid is not None:
            lines = G.rasterize_lines(G.waterway_filter(waterways), grid.height, grid.width)
            truth = M.dilate(lines, M.square(2), size=(grid.height, grid.width))
            agreement = stats.mask_agreement(canals, truth)
        profile = None
        if distance is not None:
            profile = stats.distance_profile(
                A.aligned(velocity, distance, "distance", value="distance"))
        zones = R.zone_tests(velocity, coherence, ndvi)
        out["validation_report"] = R.validation_report(spark, checks, agreement, profile, zones)
    if forest is not None:
        joined = A.aligned(velocity, forest, "lossyear", value="lossyear")
        out["validation_clearing"] = stats.cohort_stats(joined)
        out["clearing_assessment"] = stats.cohort_verdict(out["validation_clearing"])
    out["pipeline_report"] = R.quality_report(
        spark, velocity, coherence, canals, out["subsidence_class"], risk, sorted(out), settings
    )
    return out


def fuse_flow(*args, **kwargs) -> dict[str, DataFrame]:
    """Two-sensor fusion on its own; see ``products.fusion_products``."""
    return P.fusion_products(*args, **kwargs)


def acquisition_flow(
    scenes: DataFrame, catalog: DataFrame, pair_catalog: DataFrame, orbits: DataFrame,
    done: DataFrame, start: str, end: str, processing_level: str | None = None,
    settings: Settings = Settings(),
) -> dict[str, DataFrame]:
    """Search and space scenes, register them, pair them, find orbits, list what is left."""
    s = settings.sensor
    stack = materialized(
        acquisition_stack(scenes, start, end, processing_level, min_gap_days=s.min_gap_days)
    )
    rows = stack.select(
        F.col("scene_id").cast("string").alias("scene_id"), (
            F.coalesce("platform", F.lit(s.platform)) if "platform" in stack.columns else F.lit(s.platform)).alias("platform"),
        F.to_date("start_time").alias("acquisition_date"), "processing_level",
        F.col("path_number").cast("int").alias("relative_orbit"),
    )
    catalog = C.register_scenes(catalog, C.conform(rows, C.SCENES))
    dated = stack.select(
        F.col("path_number").alias("track"), F.to_date("start_time").alias("acq_date"),
        F.col("scene_id").cast("string").alias("scene_id"),
    )
    pairs = Q.sbas_pairs(dated, s.max_baseline_days, s.max_connections)
    by_date = dated.groupBy("track", "acq_date").agg(F.min("scene_id").alias("scene_id"))
    named = pairs.join(
        by_date.select("track", F.col("acq_date").alias("ref_date"),
                       F.col("scene_id").alias("reference_scene_id")), ["track", "ref_date"]
    ).join(
        by_date.select("track", F.col("acq_date").alias("sec_date"),
                       F.col("scene_id").alias("secondary_scene_id")), ["track", "sec_date"]
    ).withColumn("temporal_baseline_days", F.col("baseline_days"))
    pair_catalog = C.register_pairs(pair_catalog, C.conform(
        named.withColumn("pair_id", F.lit(None)), C.PAIRS).drop("pair_id", "processing_status"),
        catalog)
    todo = named.withColumn(
        "pair_id", F.concat_ws("_", F.date_format("ref_date", "yyyyMMdd"),
                               F.date_format("sec_date", "yyyyMMdd"))
    )
    return {
        "stack": stack, "scenes": catalog, "pairs": pair_catalog,
        "orbits": Q.orbit_cover(stack, orbits, [k for k in ("platform",) if k in orbits.columns and k in stack.columns]),
        "todo": objects.remaining_pairs(todo, done),
    }


