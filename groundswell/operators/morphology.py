"""Binary morphology on row runs.

A sparse mask is held as runs ``(row, c0, c1)`` (inclusive).  Dilating by a disk
shifts each run to the 2r+1 rows it reaches and widens it by that row's half
width; eroding narrows it.  In both cases the answer in a row is the set of
columns covered often enough, found by a running sum over run ends.  Work grows
with runs x (2r+1) rather than pixels x disk area, and no window is wider than
one image row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundswell.frames import with_size


def disk(radius: int) -> list[tuple[int, int]]:
    """(row offset, half width) of the disk dx*dx + dy*dy <= r*r."""
    return [(dy, math.isqrt(radius * radius - dy * dy)) for dy in range(-radius, radius + 1)]


def square(radius: int) -> list[tuple[int, int]]:
    return [(dy, radius) for dy in range(-radius, radius + 1)]


def to_runs(mask: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sparse pixels to maximal runs per row."""
    in_row = Window.partitionBy(*by, "row").orderBy("col")
    return (
        mask.select(*by, "row", "col").distinct()
        .withColumn("_g", F.col("col") - F.row_number().over(in_row))
        .groupBy(*by, "row", "_g")
        .agg(F.min("col").cast("int").alias("c0"), F.max("col").cast("int").alias("c1"))
        .drop("_g")
    )


def to_pixels(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    keep = [c for c in runs.columns if c not in ("c0", "c1")]
    return runs.select(*keep, F.explode(F.sequence("c0", "c1")).alias("col"))


def _covered(pieces: DataFrame, by: Sequence[str]) -> DataFrame:
    """Columns of each row covered by at least ``_need`` pieces, as maximal runs."""
    need = [c for c in ("_need",) if c in pieces.columns]
    keys = [*by, "row"]
    ends = pieces.select(
        *keys, *need,
        F.inline(F.array(
            F.struct(F.col("c0").alias("x"), F.lit(1).alias("step")),
            F.struct((F.col("c1") + 1).alias("x"), F.lit(-1).alias("step")),
        )),
    )
    steps = ends.groupBy(*keys, *need, "x").agg(F.sum("step").alias("step"))
    in_row = Window.partitionBy(*keys).orderBy("x")
    enough = F.col("_cover") >= (F.col("_need") if need else F.lit(1))
    change = (
        steps.withColumn("_cover", F.sum("step").over(in_row))
        .withColumn("_in", enough)
        .withColumn("_was", F.coalesce(F.lag("_in").over(in_row), F.lit(False)))
        .where(F.col("_in") != F.col("_was"))
        .withColumn("_next", F.lead("x").over(in_row))
    )
    return change.where("_in").select(
        *keys, F.col("x").alias("c0"), (F.col("_next") - 1).alias("c1")
    )


def _sized(runs: DataFrame, by: Sequence[str], size) -> DataFrame:
    if size is None:
        raise ValueError("a sparse mask does not know its image size; give (height, width) or extent()")
    return with_size(runs, by, size)


def _shifted(runs: DataFrame, element: list[tuple[int, int]]) -> DataFrame:
    offsets = F.array(*[
        F.struct(F.lit(dy).alias("_dy"), F.lit(half).alias("_half")) for dy, half in element
    ])
    return runs.select("*", F.inline(offsets)).withColumn("row", F.col("row") + F.col("_dy")).where(
        (F.col("row") >= 0) & (F.col("row") < F.col("_h"))
    )


def dilate_runs(
    runs: DataFrame, element: list[tuple[int, int]], by: Sequence[str] = (), size=None
) -> DataFrame:
    """Dilation; the outside of the image is false."""
    pieces = _shifted(_sized(runs, by, size), element).select(
        *by, "row",
        F.greatest(F.col("c0") - F.col("_half"), F.lit(0)).alias("c0"),
        F.least(F.col("c1") + F.col("_half"), F.col("_w") - 1).alias("c1"),
    )
    return _covered(pieces, by)


def erode_runs(
    runs: DataFrame, element: list[tuple[int, int]], by: Sequence[str] = (), size=None
) -> DataFrame:
    """Erosion; pixels outside the image do not count against it."""
    reach = max(dy for dy, _ in element)
    need = (
        F.least(F.col("row") + reach, F.col("_h") - 1)
        - F.greatest(F.col("row") - reach, F.lit(0)) + 1
    )
    pieces = _shifted(_sized(runs, by, size), element).select(
        *by, "row", need.alias("_need"),
        F.when(F.col("c0") > 0, F.col("c0") + F.col("_half")).otherwise(0).alias("c0"),
        F.when(F.col("c1") < F.col("_w") - 1, F.col("c1") - F.col("_half"))
        .otherwise(F.col("c1")).alias("c1"),
    ).where(F.col("c0") <= F.col("c1"))
    return _covered(pieces, by)


def close_runs(
    runs: DataFrame, element: list[tuple[int, int]], by: Sequence[str] = (), size=None
) -> DataFrame:
    return erode_runs(dilate_runs(runs, element, by, size), element, by, size)


def dilate(mask: DataFrame, element: list[tuple[int, int]], by: Sequence[str] = (), size=None):
    return to_pixels(dilate_runs(to_runs(mask, by), element, by, size), by)


def erode(mask: DataFrame, element: list[tuple[int, int]], by: Sequence[str] = (), size=None):
    return to_pixels(erode_runs(to_runs(mask, by), element, by, size), by)


def close(mask: DataFrame, element: list[tuple[int, int]], by: Sequence[str] = (), size=None):
    return to_pixels(close_runs(to_runs(mask, by), element, by, size), by)
