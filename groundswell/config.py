"""Typed settings.  Values below are fixed values shared with the public data products."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

NODATA = -9999.0
MASK_NODATA = 255


@dataclass(frozen=True)
class Sensor:
    platform: str = "Sentinel-1"
    wavelength_m: float = 0.056
    incidence_deg: float = 37.0
    min_gap_days: int = 14
    max_baseline_days: int = 48
    max_connections: int = 4


L_BAND = Sensor("NISAR", 0.2384, 33.9, 12, 48, 4)


@dataclass(frozen=True)
class ClassThresholds:
    """Velocity class edges in mm/yr; each class is closed below and open above."""

    severe: float = -50.0
    active_drying: float = -20.0
    moderate_drying: float = -5.0
    stable: float = 5.0


@dataclass(frozen=True)
class WaterSettings:
    threshold_db: float = -20.0
    min_size: int = 50
    closing_radius: int = 3
    exclude_canals: bool = True


@dataclass(frozen=True)
class CanalSettings:
    percentile: float = 10.0
    closing_radius: int = 2
    min_size: int = 50
    dilation_size: int = 3


@dataclass(frozen=True)
class RiskSettings:
    proximity_weight: float = 0.45
    subsidence_weight: float = 0.55
    max_influence_m: float = 1200.0
    severe_velocity: float = -40.0
    median_size: int = 9


@dataclass(frozen=True)
class PeatSettings:
    shallow_edge_m: float = 500.0
    moderate_edge_m: float = 1500.0


@dataclass(frozen=True)
class FusionSettings:
    min_coherence: float = 0.3
    c_boost: float = 1.0


@dataclass(frozen=True)
class TimeseriesSettings:
    min_pair_coherence: float = 0.3
    reference_min_coherence: float = 0.7
    export_coherence: float = 0.5
    export_limit: float = 200.0
    aoi_buffer_deg: float = 0.1
    aoi_west_buffer_deg: float = 0.02


@dataclass(frozen=True)
class Settings:
    sensor: Sensor = field(default_factory=Sensor)
    classes: ClassThresholds = field(default_factory=ClassThresholds)
    water: WaterSettings = field(default_factory=WaterSettings)
    canals: CanalSettings = field(default_factory=CanalSettings)
    risk: RiskSettings = field(default_factory=RiskSettings)
    peat: PeatSettings = field(default_factory=PeatSettings)
    fusion: FusionSettings = field(default_factory=FusionSettings)
    timeseries: TimeseriesSettings = field(default_factory=TimeseriesSettings)
    reference_year: int = 2024
    tile: int = 512
    pixel_size_m: float = 10.0


PRESETS = {
    "default": Settings(),
    "shipped": replace(
        Settings(), water=WaterSettings(threshold_db=-18.0, min_size=25, exclude_canals=False)
    ),
}

# Class codes and labels.
CLASS_LABELS = {
    0: "NoData",
    1: "Severe (< -50 mm/yr)",
    2: "Active drying (-50 to -20 mm/yr)",
    3: "Moderate drying (-20 to -5 mm/yr)",
    4: "Stable (-5 to +5 mm/yr)",
    5: "Rebound/Noise (> +5 mm/yr)",
    6: "Water body",
}

# Sensor coverage codes.
COVERAGE_LABELS = {0: "none", 1: "C-band only", 2: "L-band only", 3: "both"}

# Forest clearing cohorts as (name, first code, last code).
CLEARING_COHORTS = (
    ("2001-2005", 1, 5),
    ("2006-2010", 6, 10),
    ("2011-2015", 11, 15),
    ("2016-2023", 16, 23),
    ("no_loss", 0, 0),
)
