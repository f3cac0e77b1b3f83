"""Neighbourhood operators.

They run on halo tiles: a pixel goes to its own tile and to every tile whose margin it
lies in, about (B+2r)^2/B^2 copies in one shuffle, and each tile is worked on alone with numpy.  A task holds one tile whatever the raster's size.

A pixel that is absent counts as one whose value is NULL; it only gets no row in the
result.  The image reaches from (0, 0) to the given size, or to the last present row and column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundswell.frames import attach, materialized, val, with_size
from groundswell.operators.quantiles import exact_median, exact_percentiles


def mirrored(position: Column, length: Column, radius: int) -> Column:
    """Positions a sample takes when the edges are reflected half a sample out
    (-1 shows 0, n shows n-1): its own, and its mirror images in the margin, again and again
    where the margin is wider than the image."""

    def images(start: Column) -> Column:
        first = F.ceil((-radius - start) / (length * 2)).cast("int")
        last = F.floor((length - 1 + radius - start) / (length * 2)).cast("int")
        found = F.transform(F.sequence(first, last), lambda k: start + k * length * 2)
        return F.when(first <= last, found).otherwise(F.array().cast("array<int>"))

    edge = (position < radius) | (position >= length - radius)
    return F.when(edge, F.concat(images(position), images(-position - 1))).otherwise(F.array(position))


def _window_sum(a: np.ndarray, size: int) -> np.ndarray:
    """k x k sums around each cell that is at least k // 2 from the edge of the array."""
    r = size // 2
    along, out = np.zeros_like(a), np.zeros_like(a)
    for i in range(size):
        along[:, r : a.shape[1] - r] += a[:, i : a.shape[1] - size + 1 + i]
    for i in range(size):
        out[r : a.shape[0] - r] += along[i : a.shape[0] - size + 1 + i]
    return out


def _moments(df: DataFrame, size: int, by, dims, square: bool) -> DataFrame:
    """The value and the window's count ``_n``, sum ``_s`` and sum of squares ``_q`` of values
    that are there; absent pixels and NULLs add nothing."""
    if size % 2 == 0:
        raise ValueError(f"window size must be odd, got {size}")

    def fn(bands, r0, c0):
        x = bands["value"]
        there = ~np.isnan(x)
        x = np.where(there, x, 0.0)
        out = {"_n": _window_sum(there.astype(float), size), "_s": _window_sum(x, size)}
        if square:
            out["_q"] = _window_sum(x * x, size)
        return {**out, "value": bands["value"]}

    out = ["value", "_n", "_s", *(["_q"] if square else [])]
    return halo_tiles(df.select(*by, "row", "col", "value"), ["value"], out, size // 2, fn, by, 256, True, dims)


def box_mean(df: DataFrame, size: int, by: Sequence[str] = (), dims=None) -> DataFrame:
    """k x k mean of non-NULL values with reflected edges."""
    return _moments(df, size, by, dims, False).select(
        *by, "row", "col", (F.col("_s") / F.when(F.col("_n") > 0, F.col("_n"))).alias("value")
    )


def lee_sigma(
    df: DataFrame, size: int = 7, sigma_factor: float = 0.9, looks: int = 1,
    by: Sequence[str] = (), dims=None,
) -> DataFrame:
    """Speckle filter: local mean, moved toward the pixel where the signal varies."""
    n = F.when(F.col("_n") > 0, F.col("_n"))
    m = F.col("_m")
    var = F.greatest(F.col("_q2") - m * m, F.lit(0.0))
    noise = m * m / max(looks, 1)
    signal = F.greatest(F.col("_var") - noise, F.lit(0.0))
    weight = F.when(signal + noise > 0, signal / (signal + noise)).otherwise(0.0)
    reach = F.sqrt("_var") * sigma_factor
    outside = (val() < m - reach) | (val() > m + reach)
    return (
        _moments(df, size, by, dims, True)
        .withColumns({"_m": F.col("_s") / n, "_q2": F.col("_q") / n})
        .withColumn("_var", var)
        .select(
            *by, "row", "col",
            F.when(val().isNotNull(), F.when(outside, m).otherwise(m + weight * (val() - m))).alias("value"),
        )
    )


# --- Halo tiles -----------------------------------------------------------------------

TileFunction = Callable[[dict[str, np.ndarray], int, int], dict[str, np.ndarray]]


def halo_tiles(
    df: DataFrame, cols: Sequence[str], out: Sequence[str], radius: int, fn: TileFunction,
    by: Sequence[str] = (), tile: int = 256, reflect: bool = True, dims=None,
    absent: dict[str, str] | None = None,
) -> DataFrame:
    """Run ``fn`` on every tile with a margin of ``radius`` and keep the cores.

    ``fn`` gets the bands as arrays and the image position of their first cell, and returns arrays
    of the same shape.  The arrays span the tile and its margin, whichever pixels are present; an
    absent pixel holds NaN, or what the column named in ``absent`` says for its raster.
    """
    absent = absent or {}
    by = list(by)
    sized = with_size(df, by, dims)

    def places(position: Column, length: Column) -> Column:
        """(position, tile) pairs of one axis."""
        last = F.floor((length - 1) / tile).cast("int")
        spots = mirrored(position, length, radius) if reflect else F.array(position)

        def tiles(p: Column) -> Column:
            a = F.greatest(F.floor((p - radius) / tile), F.lit(0)).cast("int")
            b = F.least(F.floor((p + radius) / tile), last).cast("int")
            return F.transform(F.sequence(a, b), lambda t: F.struct(p.alias("p"), t.alias("t")))

        return F.flatten(F.transform(spots, tiles))

    routed = (
        sized.select(
            *by, "row", "col", *cols, *absent.values(), "_h", "_w",
            F.explode(places(F.col("row"), F.col("_h"))).alias("_r"),
        )
        .select(
            *by, *cols, *absent.values(), "row", "col", "_h", "_w", "_r",
            F.explode(places(F.col("col"), F.col("_w"))).alias("_c"),
        )
        .select(
            *by, *cols, *absent.values(), "_h", "_w", F.col("_r.p").alias("_row"), F.col("_r.t").alias("_tr"),
            F.col("_c.p").alias("_col"), F.col("_c.t").alias("_tc"),
            ((F.col("_r.p") == F.col("row")) & (F.col("_c.p") == F.col("col"))).alias("_own"),
        )
    )
    schema = T.StructType([
        *[df.schema[k] for k in by],
        T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()),
        *[T.StructField(c, T.DoubleType()) for c in out],
    ])

    def span(t: int, n: int) -> tuple[int, int]:
        """First and last position of a tile with its margin, along one axis of the image."""
        if reflect:
            return t * tile - radius, min((t + 1) * tile, n) + radius
        return max(t * tile - radius, 0), min((t + 1) * tile + radius, n)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        tr, tc = int(pdf["_tr"].iat[0]), int(pdf["_tc"].iat[0])
        (r0, r1), (c0, c1) = (
            span(t, int(pdf[n].iat[0])) for t, n in ((tr, "_h"), (tc, "_w")))
        r, c = pdf["_row"].to_numpy() - r0, pdf["_col"].to_numpy() - c0
        bands = {}
        for name in cols:
            a = np.full((r1 - r0, c1 - c0), float(pdf[absent[name]].iat[0]) if name in absent else np.nan)
            a[r, c] = pdf[name].to_numpy(float)
            bands[name] = a
        result = fn(bands, r0, c0)
        row, col = r + r0, c + c0
        core = pdf["_own"].to_numpy() & (row // tile == tr) & (col // tile == tc)
        data = {k: pdf[k].to_numpy()[core] for k in by}
        data.update({"row": row[core], "col": col[core]})
        data.update({name: result[name][r[core], c[core]] for name in out})
        return pd.DataFrame(data)

    return routed.groupBy(*by, "_tr", "_tc").applyInPandas(one, schema)


def median_filter(
    df: DataFrame, size: int = 9, by: Sequence[str] = (), tile: int = 256, dims=None,
    fill: DataFrame | None = None,
) -> DataFrame:
    """k x k median with reflected edges.  NULLs and absent pixels take the raster's median
    while filtering; NULLs come back as NULL."""
    if size % 2 == 0:
        raise ValueError(f"window size must be odd, got {size}")
    radius = size // 2
    fill = exact_median(df, val(), by, "_fill") if fill is None else fill
    filled = attach(df, fill, by).withColumn("_fill", F.coalesce("_fill", F.lit(0.0))).select(
        *by, "row", "col", "_fill", F.coalesce(val(), F.col("_fill")).alias("_x"),
        val().isNull().cast("double").alias("_gap"),
    )

    def fn(bands, r0, c0):
        x = bands["_x"]
        out = np.full(x.shape, np.nan)
        views = np.lib.stride_tricks.sliding_window_view(x, (size, size))
        middle = size * size // 2
        for i in range(views.shape[0]):
            flat = views[i].reshape(views.shape[1], -1)
            row = np.partition(flat, middle, axis=1)[:, middle]
            out[i + radius, radius : radius + views.shape[1]] = row
        out[bands["_gap"] == 1.0] = np.nan
        return {"value": out}

    return halo_tiles(
        filled, ["_x", "_gap"], ["value"], radius, fn, by, tile, True, dims, {"_x": "_fill"})


def _derivative_kernels(sigma: float, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sampled Gaussian and its first and second derivative."""
    x = np.arange(-radius, radius + 1, dtype=float)
    g = np.exp(-x * x / (2 * sigma * sigma))
    g /= g.sum()
    second = (x * x / sigma**4 - 1 / sigma**2) * g
    return g, -x / sigma**2 * g, second - second.sum() * g


def _along(a: np.ndarray, k: np.ndarray, axis: int) -> np.ndarray:
    """Correlation along an axis; the margin of the tile absorbs the zero padding."""
    r = len(k) // 2
    out = np.zeros_like(a)
    for i, w in enumerate(k[::-1]):
        s = i - r
        src, dst = [slice(None)] * 2, [slice(None)] * 2
        src[axis] = slice(max(s, 0), a.shape[axis] + min(s, 0))
        dst[axis] = slice(max(-s, 0), a.shape[axis] + min(-s, 0))
        out[tuple(dst)] += w * a[tuple(src)]
    return out


def ridge_strength(image: np.ndarray, sigmas: Sequence[int]) -> np.ndarray:
    """Largest over sigma of sigma^2 * max(larger Hessian eigenvalue, 0): dark lines."""
    best = np.zeros_like(image)
    for sigma in sigmas:
        g, d1, d2 = _derivative_kernels(sigma, 4 * sigma + 1)
        rr = _along(_along(image, d2, 0), g, 1)
        cc = _along(_along(image, g, 0), d2, 1)
        rc = _along(_along(image, d1, 0), d1, 1)
        larger = (rr + cc) / 2 + np.sqrt(((rr - cc) / 2) ** 2 + rc * rc)
        best = np.maximum(best, sigma**2 * np.maximum(larger, 0.0))
    return best


def ridge_map(
    df: DataFrame, sigmas: Sequence[int] = (1, 2, 3), by: Sequence[str] = (), tile: int = 256,
    dims=None,
) -> DataFrame:
    """Ridge strength of dark lines; ``is_valid`` marks pixels with positive backscatter."""
    good = F.when(val() > 0, val())
    fill = exact_median(df, good, by, "_fill")
    filled = attach(df, fill, by).select(
        *by, "row", "col", F.coalesce("_fill", F.lit(0.0)).alias("_fill"),
        F.coalesce(good, F.col("_fill"), F.lit(0.0)).alias("_x"),
        (val() > 0).cast("double").alias("_ok"),
    )

    def fn(bands, r0, c0):
        # Offsets cancel in the derivatives; removing one keeps the zero padding harmless.
        x = np.nan_to_num(bands["_x"])
        return {"ridge": ridge_strength(x, sigmas), "_ok": bands["_ok"]}

    return halo_tiles(
        filled, ["_x", "_ok"], ["ridge", "_ok"], 4 * max(sigmas) + 2, fn, by, tile, True, dims,
        {"_x": "_fill"},
    ).select(*by, "row", "col", "ridge", (F.coalesce("_ok", F.lit(0.0)) == 1).alias("is_valid"))


def ridge_mask(
    df: DataFrame, sigmas: Sequence[int] = (1, 2, 3), percentile: float = 85.0,
    by: Sequence[str] = (), tile: int = 256, dims=None,
) -> DataFrame:
    """Pixels whose ridge strength reaches the percentile of the positive strengths."""
    ridge = materialized(ridge_map(df, sigmas, by, tile, dims))
    cut = exact_percentiles(
        ridge, F.when(F.col("ridge") > 0, F.col("ridge")), [percentile / 100], by, ["_cut"]
    )
    return attach(ridge, cut, by).where(
        (F.col("ridge") >= F.col("_cut")) & F.col("is_valid")
    ).select(*by, "row", "col")


def goldstein(
    df: DataFrame, alpha: float = 0.8, patch: int = 32, overlap: int = 8,
    by: Sequence[str] = (), dims=None, tile: int | None = None,
) -> DataFrame:
    """Adaptive phase filter on overlapping Fourier patches of ``re`` and ``im``.

    Tiles are a whole number of patch steps and carry a margin of one patch, so every
    patch touching a tile's core is computed there: one shuffle, no second pass.  No data counts as zero
    in a patch's spectrum and stays no data; a patch counts by the share of its pixels that are there.
    """
    if not 0.0 <= alpha <= 1.0:
        raise ValueError(f"alpha must be in [0, 1], got {alpha}")
    step = patch - overlap
    tile = tile or step * 10
    if tile % step:
        raise ValueError("tile must be a multiple of the patch step")
    hann = np.outer(np.hanning(patch), np.hanning(patch))

    def fn(bands, r0, c0):
        z = bands["re"] + 1j * bands["im"]
        there = ~np.isnan(z)
        total, weight = np.zeros(z.shape, complex), np.zeros(z.shape)
        tops = np.arange(-r0 % step, z.shape[0] - patch + 1, step)
        lefts = np.arange(-c0 % step, z.shape[1] - patch + 1, step)
        if len(tops) and len(lefts):
            spots = [(t, l) for t in tops for l in lefts]
            stack = np.stack([z[t : t + patch, l : l + patch] for t, l in spots])
            spectrum = np.fft.fft2(np.nan_to_num(stack))
            power = np.abs(spectrum)
            peak = power.max(axis=(1, 2), keepdims=True)
            shrink = np.where(peak > 0, power / np.where(peak > 0, peak, 1), 1.0) ** alpha
            share = np.stack([there[t : t + patch, l : l + patch] for t, l in spots]).mean((1, 2))
            smooth = np.fft.ifft2(np.where(peak > 0, spectrum * shrink, spectrum)) * hann
            for (t, l), part, s in zip(spots, smooth, share):
                total[t : t + patch, l : l + patch] += part * s
                weight[t : t + patch, l : l + patch] += hann * s
        done = there & (weight > 0)
        z = np.where(done, total / np.where(done, weight, 1), z)
        return {"re": z.real, "im": z.imag}

    return halo_tiles(df, ["re", "im"], ["re", "im"], patch, fn, by, tile, False, dims)
