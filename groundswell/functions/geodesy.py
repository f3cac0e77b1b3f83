"""Coordinates: affine transforms, degree sizes, tile names and UTM (Krueger series)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metres per degree of latitude, and the WGS84 ellipsoid.
METRES_PER_DEGREE = 111320.0
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563


@dataclass(frozen=True)
class Grid:
    """A north-up or general affine grid with a size and a CRS."""

    height: int
    width: int
    a: float = 1.0
    b: float = 0.0
    c: float = 0.0
    d: float = 0.0
    e: float = -1.0
    f: float = 0.0
    epsg: int = 4326

    @staticmethod
    def from_bounds(
        west: float, south: float, east: float, north: float, height: int, width: int,
        epsg: int = 4326,
    ) -> "Grid":
        return Grid(
            height, width, (east - west) / width, 0.0, west, 0.0, -(north - south) / height,
            north, epsg,
        )

    def xy(self, row: Column, col: Column) -> tuple[Column, Column]:
        return pixel_to_lonlat(row, col, self)

    def rowcol(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Fractional row and column of map coordinates."""
        det = self.a * self.e - self.b * self.d
        dx, dy = x - F.lit(self.c), y - F.lit(self.f)
        col = (dx * F.lit(self.e) - dy * F.lit(self.b)) / F.lit(det)
        row = (dy * F.lit(self.a) - dx * F.lit(self.d)) / F.lit(det)
        return row, col


def pixel_to_lonlat(row: Column, col: Column, g: Grid) -> tuple[Column, Column]:
    x = F.lit(g.c) + col * F.lit(g.a) + row * F.lit(g.b)
    y = F.lit(g.f) + col * F.lit(g.d) + row * F.lit(g.e)
    return x, y


def metres_per_degree(lat: Column) -> tuple[Column, Column]:
    """(along x, along y) metres per degree at a latitude."""
    return (
        F.lit(METRES_PER_DEGREE) * F.cos(F.radians(F.abs(lat))),
        F.lit(METRES_PER_DEGREE),
    )


def pixel_size_m(grid: Grid) -> tuple[float, float]:
    """Pixel width and height in metres; degrees are scaled at the grid's middle latitude."""
    if grid.epsg != 4326:
        return abs(grid.a), abs(grid.e)
    middle = math.radians(abs(grid.f + grid.e * grid.height / 2))
    return abs(grid.a) * METRES_PER_DEGREE * math.cos(middle), abs(grid.e) * METRES_PER_DEGREE


def pixel_area_m2(grid: Grid) -> float:
    """Pixel area; UTM grids (both hemispheres) are metric, others use the flat degree size."""
    area = abs(grid.a) * abs(grid.e)
    if 32601 <= grid.epsg <= 32660 or 32701 <= grid.epsg <= 32760:
        return area
    return area * METRES_PER_DEGREE**2


def forest_tile_name(lon: Column, lat: Column) -> Column:
    """10-degree tile named by its north-west corner, such as 00N_110E."""
    north = (F.floor(lat / 10) * 10 + 10).cast("int")
    west = (F.floor(lon / 10) * 10).cast("int")
    return F.format_string(
        "%02d%s_%03d%s",
        F.abs(north), F.when(north >= 0, "N").otherwise("S"),
        F.abs(west), F.when(west >= 0, "E").otherwise("W"),
    )


def dem_tile_name(lat: Column, lon: Column) -> Column:
    """1-degree elevation tile named by its south-west corner."""
    return F.format_string(
        "Copernicus_DSM_COG_10_%s%02d_00_%s%03d_00_DEM",
        F.when(lat >= 0, "N").otherwise("S"), F.abs(lat).cast("int"),
        F.when(lon >= 0, "E").otherwise("W"), F.abs(lon).cast("int"),
    )


# --- UTM: Krueger series to order 4 in the third flattening n (Karney 2011) -------------

_N = WGS84_F / (2 - WGS84_F)
_E = math.sqrt(WGS84_F * (2 - WGS84_F))
_SCALE = 0.9996
_RADIUS = WGS84_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def _zone(epsg: int) -> tuple[float, float]:
    """Central meridian (radians) and false northing of a UTM EPSG code."""
    if not (32601 <= epsg <= 32660 or 32701 <= epsg <= 32760):
        raise ValueError(f"EPSG:{epsg} is not a UTM zone")
    return math.radians((epsg % 100) * 6 - 183), (10_000_000.0 if epsg > 32700 else 0.0)


def _total(terms: Sequence[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def project_utm(lon: Column, lat: Column, epsg: int) -> tuple[Column, Column]:
    """Longitude and latitude in degrees to UTM easting and northing in metres."""
    lon0, north0 = _zone(epsg)
    phi, lam = F.radians(lat), F.radians(lon) - F.lit(lon0)
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(_E) * F.atanh(F.lit(_E) * F.sin(phi)))
    xi = F.atan2(t, F.cos(lam))
    eta = F.asinh(F.sin(lam) / F.sqrt(t * t + F.cos(lam) * F.cos(lam)))
    east = eta + _total(
        [F.lit(a) * F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) for j, a in enumerate(ALPHA, 1)]
    )
    north = xi + _total(
        [F.lit(a) * F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) for j, a in enumerate(ALPHA, 1)]
    )
    k = F.lit(_SCALE * _RADIUS)
    return F.lit(500000.0) + k * east, F.lit(north0) + k * north


def unproject_utm(x: Column, y: Column, epsg: int) -> tuple[Column, Column]:
    """UTM metres back to longitude and latitude in degrees."""
    lon0, north0 = _zone(epsg)
    k = F.lit(_SCALE * _RADIUS)
    xi, eta = (y - F.lit(north0)) / k, (x - F.lit(500000.0)) / k
    xi1 = xi - _total(
        [F.lit(b) * F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) for j, b in enumerate(BETA, 1)]
    )
    eta1 = eta - _total(
        [F.lit(b) * F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) for j, b in enumerate(BETA, 1)]
    )
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    phi = chi + _total([F.lit(d) * F.sin(chi * (2 * j)) for j, d in enumerate(DELTA, 1)])
    lam = F.atan2(F.sinh(eta1), F.cos(xi1))
    return F.degrees(lam + F.lit(lon0)), F.degrees(phi)


def to_crs(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    """Between longitude/latitude (4326) and UTM zones."""
    if source == target:
        return x, y
    lon, lat = (x, y) if source == 4326 else unproject_utm(x, y, source)
    return (lon, lat) if target == 4326 else project_utm(lon, lat, target)
