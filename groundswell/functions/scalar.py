"""Per-pixel formulas as Spark columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundswell.config import ClassThresholds


def _lit(x: float) -> Column:
    return F.lit(float(x))


def clip(x: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; NULL stays NULL (greatest/least alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(F.least(x, _lit(high)), _lit(low)))


def phase_to_los(phase: Column, wavelength_m: float = 0.056) -> Column:
    return phase * _lit(wavelength_m) / _lit(4 * math.pi)


def los_to_vertical(los: Column, incidence_deg: float = 37.0) -> Column:
    cosine = math.cos(math.radians(incidence_deg))
    if abs(cosine) < 1e-12:
        raise ValueError("incidence angle of 90 degrees has no vertical component")
    return los / _lit(cosine)


def los_to_vertical_by_angle(los: Column, incidence_deg: Column) -> Column:
    cosine = F.cos(F.radians(incidence_deg))
    return F.when(cosine > 0, los / cosine)


def displacement_to_velocity(displacement_m: Column, days: float) -> Column:
    if days <= 0:
        raise ValueError("time span must be positive")
    return displacement_m * _lit(1000.0) / _lit(days / 365.25)


def clamp_velocity(velocity_m_yr: Column, limit: float = 200.0) -> Column:
    return clip(velocity_m_yr * _lit(1000.0), -limit, limit)


def to_decibels(power: Column, floor_db: float = -50.0) -> Column:
    floor = _lit(10 ** (floor_db / 10))
    return F.when(power.isNotNull(), F.lit(10.0) * F.log10(F.greatest(power, floor)))


def db_to_linear(db: Column) -> Column:
    return F.pow(_lit(10.0), db / _lit(10.0))


def normalized_difference(a: Column, b: Column, nodata: float = 0.0) -> Column:
    """(a - b) / (a + b); NULL when either band is nodata or the sum is zero."""
    ok = (a != _lit(nodata)) & (b != _lit(nodata)) & ((a + b) != _lit(0.0))
    return F.when(ok, (a - b) / (a + b))


def ndvi(nir: Column, red: Column, nodata: float = 0.0) -> Column:
    return normalized_difference(nir, red, nodata)


def mndwi(green: Column, swir: Column, nodata: float = 0.0) -> Column:
    return normalized_difference(green, swir, nodata)


def scaled_ndvi(nir: Column, red: Column, scale: float = 10000.0) -> Column:
    """NDVI of scaled reflectance, only where the band sum is positive."""
    n, r = nir / _lit(scale), red / _lit(scale)
    return F.when((n + r) > 0, (n - r) / (n + r))


def proximity_risk(distance_m: Column, max_influence_m: float = 1200.0) -> Column:
    return clip(_lit(1.0) - distance_m / _lit(max_influence_m), 0.0, 1.0)


def subsidence_risk(velocity: Column, severe: float = -40.0) -> Column:
    return F.when(
        velocity < 0, F.least(-velocity / _lit(abs(severe)), _lit(1.0))
    ).otherwise(_lit(0.0))


def combined_risk(
    proximity: Column, subsidence: Column, w_proximity: float = 0.45, w_subsidence: float = 0.55
) -> Column:
    mean = (proximity * _lit(w_proximity) + subsidence * _lit(w_subsidence)) / _lit(
        w_proximity + w_subsidence
    )
    return clip(mean, 0.0, 1.0)


def time_since_clearing(lossyear: Column, reference_year: int = 2024) -> Column:
    return F.when(lossyear > 0, (F.lit(reference_year) - (F.lit(2000) + lossyear)).cast("double"))


def clearing_risk_factor(
    years: Column, treecover: Column | None = None, forest_threshold: int = 50
) -> Column:
    """1.2 up to 5 years, 1.0 up to 15, 0.8 beyond, 0.6 intact forest, else 1.0."""
    factor = F.when(years <= 5, 1.2).when(years <= 15, 1.0).when(years > 15, 0.8)
    if treecover is not None:
        factor = factor.when(treecover >= forest_threshold, 0.6)
    return factor.otherwise(1.0)


def peat_risk_weight(depth_class: Column) -> Column:
    """Shallow 0.6, moderate 0.8, deep 1.0, anything else 0."""
    return (
        F.when(depth_class == 1, 0.6)
        .when(depth_class == 2, 0.8)
        .when(depth_class == 3, 1.0)
        .otherwise(0.0)
    )


def subsidence_class(
    velocity: Column, edges: ClassThresholds = ClassThresholds(), water: Column | None = None
) -> Column:
    """Severity code 1..5, 0 for NULL; water is 6 whatever the velocity."""
    code = (
        F.when(velocity.isNull(), 0)
        .when(velocity < edges.severe, 1)
        .when(velocity < edges.active_drying, 2)
        .when(velocity < edges.moderate_drying, 3)
        .when(velocity < edges.stable, 4)
        .otherwise(5)
    )
    return code if water is None else F.when(F.coalesce(water, F.lit(False)), 6).otherwise(code)


def peat_depth_class(
    is_peat: Column, edge_m: Column, shallow_m: float = 500.0, moderate_m: float = 1500.0
) -> Column:
    """0 off peat; 1 shallow, 2 moderate, 3 deep by distance from the peat edge.

    A NULL distance means the raster has no edge at all, hence deep.
    """
    return (
        F.when(~is_peat, 0)
        .when(edge_m <= shallow_m, 1)
        .when(edge_m <= moderate_m, 2)
        .otherwise(3)
    )


def carbon_rate(velocity: Column, factor: float = 0.5) -> Column:
    """tCO2/ha/yr from subsidence in mm/yr."""
    return F.when(velocity < 0, -velocity * _lit(factor)).when(
        velocity.isNotNull(), _lit(0.0)
    )
