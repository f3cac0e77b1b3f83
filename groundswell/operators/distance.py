"""Exact Euclidean distance to the nearest mask pixel.

Separable: first the nearest mask pixel above and below in each column, then along each image row the least
sum of that and a parabola, a min-plus product with a monotone matrix.  A strip of ``strip_rows`` whole image rows is
one group: it gets its own pixels, and of each column the mask rows inside it, the last
one above and the first one below.  There is no limit on the distance.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundswell.frames import attach


# Stands for no mask pixel in a column; adding a parabola does not change it.
_FAR = 1e300


def lower_envelope(f: np.ndarray, step: float) -> np.ndarray:
    """min over j of (step*(i-j))**2 + f[:, j], for every i, all rows of ``f`` at once; NaN in rows without a number.

    The place of the minimum never moves left as i grows.  So once every second column is solved, each column
    between two looks only at places between theirs: a level costs rows x (width + columns), and
    there are log2(width) levels, each a few array operations for all rows.
    """
    rows, width = f.shape
    known = np.isfinite(f).any(1)
    g = np.where(np.isfinite(f), f, _FAR)
    at = np.zeros((rows, width), np.int64)
    out = np.empty((rows, width))
    stride = 1 << max(0, (width - 1).bit_length())
    columns = np.zeros(1, np.int64)
    low, high = np.zeros((rows, 1), np.int64), np.full((rows, 1), width - 1)
    while True:
        size = (high - low + 1).ravel()
        start = np.cumsum(size) - size
        cell = np.repeat(np.arange(len(size)), size)
        j = np.arange(len(cell)) - start[cell] + low.ravel()[cell]
        row, i = cell // len(columns), columns[cell % len(columns)]
        total = ((i - j) * step) ** 2 + g[row, j]
        best = np.minimum.reduceat(total, start)
        first = np.minimum.reduceat(np.where(total == best[cell], j, width), start)
        at[:, columns] = first.reshape(rows, -1)
        out[:, columns] = best.reshape(rows, -1)
        if stride == 1:
            break
        stride //= 2
        columns = np.arange(stride, width, 2 * stride)
        if not len(columns):
            columns = np.zeros(1, np.int64)
        after = columns + stride
        low = at[:, np.maximum(columns - stride, 0)]
        high = np.where(after < width, at[:, np.minimum(after, width - 1)], width - 1)
    return np.where(known[:, None], out, np.nan)


def column_distances(m: np.ndarray, mc: np.ndarray, first: int, height: int, width: int) -> np.ndarray:
    """Rows to the nearest of the mask pixels (row m, column mc) of each column, for the rows from ``first`` on;
    inf in columns without one."""
    up, down = np.full((height, width), -np.inf), np.full((height, width), np.inf)
    over, under = m < first + height, m >= first
    np.maximum.at(up, (np.maximum(m[over] - first, 0), mc[over]), m[over].astype(float))
    np.minimum.at(down, (np.minimum(m[under] - first, height - 1), mc[under]), m[under].astype(float))
    row = (first + np.arange(height))[:, None]
    return np.minimum(row - np.maximum.accumulate(up, 0), np.minimum.accumulate(down[::-1], 0)[::-1] - row)


def _seeds(mask: DataFrame, by: list[str], strip_rows: int) -> DataFrame:
    """(strip, col, seed row): what a strip of image rows must know of each column's mask.

    Its own mask rows, and for each column the last one above and the first one below it.  A mask row
    is told to the strips up to the next mask row of its column, so the rows made are at
    most the mask's and two for each strip and column.
    """
    column = Window.partitionBy(*by, "col").orderBy("row")
    strip = F.floor(F.col("row") / strip_rows).cast("int")
    at = mask.distinct().withColumns({
        "_at": strip, "_up": F.lag(strip).over(column), "_down": F.lead(strip).over(column)})
    # From the strip of the mask row before it to the strip of the one behind it; the first and the last
    # of a column are seen from all strips above and below.
    first = F.coalesce("_up", F.lit(0))
    last = F.coalesce("_down", F.col("_strips") - 1)
    return at.withColumns({"_first": F.least(first, F.col("_at")), "_last": F.greatest(last, F.col("_at"))})


def distance_map(
    pixels: DataFrame, mask: DataFrame, size_x: float = 1.0, size_y: float | None = None,
    by: Sequence[str] = (), strip_rows: int = 32,
) -> DataFrame:
    """Distance per pixel of ``pixels`` to the sparse ``mask``; NULL when the mask is empty.

    ``size_x`` and ``size_y`` are the pixel sizes; they differ on geographic grids.  The mask counts
    whole, also where ``pixels`` has no row; absent pixels don't hide it.
    """
    by = list(by)
    keys = [*by, "row", "col"]
    size_y = size_x if size_y is None else size_y
    strips = pixels.groupBy(*by).agg(
        (F.floor(F.max("row") / strip_rows) + 1).cast("int").alias("_strips"))
    seeds = _seeds(attach(mask.select(*keys), strips, by).where("_strips IS NOT NULL"), by, strip_rows)
    seeds = seeds.where("_first < _strips").select(
        *keys, F.explode(F.sequence("_first", F.least("_last", F.col("_strips") - 1))).alias("_strip"),
        F.lit(True).alias("_seed"))
    both = pixels.select(
        *keys, F.floor(F.col("row") / strip_rows).cast("int").alias("_strip"), F.lit(False).alias("_seed")
    ).unionByName(seeds.select(*keys, "_strip", "_seed"))
    schema = T.StructType([
        *[pixels.schema[k] for k in keys], T.StructField("distance", T.DoubleType())
    ])

    def strip(pdf: pd.DataFrame) -> pd.DataFrame:
        seed = pdf["_seed"].to_numpy()
        row, col = pdf["row"].to_numpy(), pdf["col"].to_numpy()
        out = pdf.loc[~seed, keys].reset_index(drop=True)
        if not len(out):
            return out.assign(distance=np.zeros(0))
        r, c, m, mc = row[~seed], col[~seed], row[seed], col[seed]
        r0, c0 = int(r.min()), int(col.min())
        f = (column_distances(m, mc - c0, r0, int(r.max()) - r0 + 1, int(col.max()) - c0 + 1) * size_y) ** 2
        out["distance"] = np.sqrt(lower_envelope(f, size_x)[r - r0, c - c0])
        return out

    return both.groupBy(*by, "_strip").applyInPandas(strip, schema)
