"""Validation and quality reports: one row of JSON from one-row aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundswell.config import Settings
from groundswell.frames import percent, val
from groundswell.operators import algebra as A
from groundswell.operators import stats


def _one(df: DataFrame) -> Column:
    """A one-row frame as a struct value."""
    return df.select(F.struct(*df.columns)).scalar()


def _list(df: DataFrame, *order: str) -> Column:
    """A short frame as a sorted array of structs."""
    return df.agg(F.array_sort(F.collect_list(F.struct(*order, *[
        c for c in df.columns if c not in order])))).scalar()


def correlations(
    velocity: DataFrame, vv: DataFrame | None = None, coherence: DataFrame | None = None,
    distance: DataFrame | None = None, ndvi: DataFrame | None = None,
) -> DataFrame:
    """One row per check run: label, r, p, n, status."""
    rows = []
    if vv is not None:
        rows.append(stats.velocity_vs_backscatter(A.valid_pairs(velocity, vv)))
    for other, label in (
        (coherence, "velocity_vs_coherence"), (distance, "velocity_vs_canal_distance"),
        (ndvi, "velocity_vs_ndvi"),
    ):
        if other is not None:
            pairs = A.valid_pairs(velocity, other)
            rows.append(stats.correlation(pairs, val(), F.col("other"), label))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def validation_summary(checks: DataFrame) -> DataFrame:
    """Checks run and checks significant; the dB variant counts with its linear check."""
    main = checks.where(~F.col("label").endswith("_dB"))
    return main.agg(
        F.count("*").alias("n_correlations"),
        F.count(F.when(F.col("status") == "significant", 1)).alias("n_significant"),
    )


def zone_tests(
    velocity: DataFrame, coherence: DataFrame | None = None, ndvi: DataFrame | None = None,
    threshold: float = 0.5,
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Zone statistics and Welch's test per zoning: coherence classes, vegetation classes."""
    out = {}
    if coherence is not None:
        zoned = A.aligned(velocity, coherence, "_c").withColumn(
            "zone", stats.coherence_zone(F.col("_c"), threshold))
        out["coherence"] = (stats.zonal_stats(zoned), stats.welch_test(zoned, "cleared", "forested"))
    if ndvi is not None:
        zoned = A.aligned(velocity, ndvi, "_n").withColumn("zone", stats.ndvi_zone(F.col("_n")))
        out["ndvi"] = (stats.zonal_stats(zoned), stats.welch_test(zoned, "low", "high"))
    return out


def validation_report(
    spark, checks: DataFrame, agreement: DataFrame | None = None,
    profile: DataFrame | None = None,
    zones: dict[str, tuple[DataFrame, DataFrame]] | None = None,
) -> DataFrame:
    parts = [
        _list(checks, "label").alias("correlations"),
        _one(validation_summary(checks)).alias("summary"),
    ]
    if zones:
        parts.append(F.struct(*[
            F.struct(_list(z, "zone").alias("zones"), _one(w).alias("welch")).alias(name)
            for name, (z, w) in zones.items()
        ]).alias("zonal_analysis"))
    if profile is not None:
        parts.append(_list(profile, "bin_center_m").alias("distance_profile"))
    if agreement is not None:
        parts.append(_one(agreement).alias("waterway_validation"))
    return spark.range(1).select(F.to_json(F.struct(*parts)).alias("report"))


def quality_report(
    spark, velocity: DataFrame, coherence: DataFrame | None = None,
    canals: DataFrame | None = None, classes: DataFrame | None = None,
    risk: DataFrame | None = None, products: list[str] = (), settings: Settings = Settings(),
) -> DataFrame:
    """All product metrics in one JSON row.  Each metric is a one-row subquery."""
    v = _one(stats.raster_stats(velocity))
    parts = [
        F.lit(settings.sensor.platform).alias("sensor"),
        F.struct(
            F.lit(settings.timeseries.export_coherence).alias("coherence_threshold"),
            F.lit(settings.risk.proximity_weight).alias("proximity_weight"),
            F.lit(settings.risk.subsidence_weight).alias("subsidence_weight"),
            F.lit(settings.risk.max_influence_m).alias("max_influence_m"),
            F.lit(settings.risk.severe_velocity).alias("severe_velocity_mm_yr"),
        ).alias("parameters"),
        v.alias("velocity_stats"),
    ]
    quality = [
        F.round(v["valid_pixel_count"] / F.greatest(v["total_pixels"], F.lit(1)), 4)
        .alias("valid_pixel_fraction")
    ]
    if coherence is not None:
        c = _one(stats.coherence_stats(coherence))
        parts.append(c.alias("coherence_stats"))
        quality += [c["mean"].alias("mean_coherence"),
                    c["fraction_above_07"].alias("high_coherence_fraction")]
    if canals is not None:
        hit = A.with_mask(velocity, canals, "mask")
        parts.append(_one(stats.mask_stats(hit)).alias("canal_stats"))
    if classes is not None:
        parts.append(
            _list(stats.class_distribution(classes), "class").alias("classification_distribution")
        )
    if risk is not None:
        parts.append(_one(stats.risk_distribution(risk)).alias("risk_distribution"))
    parts += [
        F.struct(
            F.lit("5-15 mm/yr").alias("atmospheric"),
            F.lit(settings.timeseries.export_coherence).alias("coherence_threshold"),
        ).alias("error_budget"),
        F.struct(*quality).alias("data_quality"),
        F.array_sort(F.array(*[F.lit(p) for p in products])).alias("products"),
        F.lit(len(products)).alias("product_count"),
    ]
    return spark.range(1).select(F.to_json(F.struct(*parts)).alias("report"))


def degraded_summary(degraded: DataFrame) -> DataFrame:
    n = F.sum("degraded")
    ok = F.count(F.when(F.col("is_valid"), 1))
    return degraded.agg(
        n.alias("degraded_pixels"), ok.alias("valid_pixels"),
        percent(n, F.greatest(ok, F.lit(1))).alias("degraded_pct"),
    )
