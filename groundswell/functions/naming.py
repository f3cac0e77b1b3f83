"""Dates and platforms out of product and object names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STAMP = "yyyyMMdd'T'HHmmss"


def platform_of(name: Column) -> Column:
    """S1B when the name starts so, otherwise S1A."""
    return F.when(F.upper(name).startswith("S1B"), "S1B").otherwise("S1A")


def _stamp(text: Column) -> Column:
    return F.try_to_timestamp(F.when(text != "", text), F.lit(_STAMP))


def acquisition_time(name: Column) -> Column:
    """First yyyyMMddTHHmmss in the name, NULL when there is none."""
    return _stamp(F.regexp_extract(name, r"(\d{8}T\d{6})", 1))


def orbit_validity(name: Column) -> tuple[Column, Column]:
    """Validity interval of an orbit file name ``..._V<start>_<end>...``."""
    pattern = r"V(\d{8}T\d{6})_(\d{8}T\d{6})"
    return _stamp(F.regexp_extract(name, pattern, 1)), _stamp(F.regexp_extract(name, pattern, 2))


def parse_date_any(text: Column) -> Column:
    """Timestamp from 20240131T101112, 2024-01-31, 20240131 or ISO with a trailing Z."""
    iso = F.regexp_replace(text, "Z$", "")
    return F.coalesce(
        F.try_to_timestamp(F.when(text.rlike(r"^\d{8}T\d{6}"), F.substring(text, 1, 15)), F.lit(_STAMP)),
        F.try_to_timestamp(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text), F.lit("yyyy-MM-dd")),
        F.try_to_timestamp(F.when(text.rlike(r"^\d{8}$"), text), F.lit("yyyyMMdd")),
        F.try_to_timestamp(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T"), iso)),
    )


def epsg_of(crs: Column) -> Column:
    """EPSG number in a CRS string, NULL when there is none."""
    return F.regexp_extract(F.upper(crs), r"EPSG:+(\d+)", 1).try_cast("int")
