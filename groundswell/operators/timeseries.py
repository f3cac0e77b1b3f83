"""Small-baseline time series on pair tables.

``stack(pair_id, ref_idx, sec_idx, row, col, phase, coherence)`` holds one row per
pair and pixel; ``dates(idx, day)`` gives each acquisition's day number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundswell.frames import attach, materialized, small
from groundswell.operators.geometry import deramp

PIXEL = ["row", "col"]


def modify_network(stack: DataFrame, min_coherence: float = 0.3) -> DataFrame:
    """Drop pairs whose mean coherence is below the limit."""
    good = stack.groupBy("pair_id").agg(F.avg("coherence").alias("_c")).where(
        F.col("_c") >= min_coherence
    )
    return stack.join(small(good.select("pair_id")), "pair_id", "left_semi")


def reference_pixel(stack: DataFrame, min_coherence: float = 0.7) -> DataFrame:
    """Pixel of highest mean coherence; no row when none reaches the limit."""
    return (
        stack.groupBy(*PIXEL).agg(F.avg("coherence").alias("mean_coherence"))
        .where(F.col("mean_coherence") >= min_coherence)
        .orderBy(F.desc("mean_coherence"), *PIXEL).limit(1)
    )


def reference_phase(
    stack: DataFrame, at: tuple[int, int] | DataFrame | None = None, min_coherence: float = 0.7
) -> DataFrame:
    """Subtract each pair's phase at the reference pixel.

    The pixel is given as numbers, as a one-row table chosen before, or is the most coherent one.
    A pair without a phase there can't be referenced and is dropped; without any pixel that
    reaches the limit the stack comes back as it is.
    """
    if isinstance(at, tuple):
        base = stack.where((F.col("row") == at[0]) & (F.col("col") == at[1]))
    else:
        ref = reference_pixel(stack, min_coherence) if at is None else at
        ref = materialized(ref.select(*PIXEL).limit(1))
        if ref.isEmpty():
            return stack
        base = stack.join(F.broadcast(ref), PIXEL, "left_semi")  # one row by its limit
    base = base.where(F.col("phase").isNotNull()).groupBy("pair_id").agg(F.first("phase").alias("_ref"))
    # One short row per pair, folded into a map: no shuffle of the stack by pair.
    refs = base.agg(F.map_from_entries(F.collect_list(F.struct("pair_id", "_ref"))).alias("_refs"))
    return attach(stack, refs).withColumn("_ref", F.col("_refs")[F.col("pair_id")]).where(
        F.col("_ref").isNotNull()
    ).withColumn("phase", F.col("phase") - F.col("_ref")).drop("_ref", "_refs")


def apply_delay(stack: DataFrame, delay: DataFrame | None = None) -> DataFrame:
    """Remove the delay difference of the two dates: ``delay(idx, row, col, delay)``.

    A pixel's dates become one small map, so that the stack, the largest table, is joined once.
    """
    if delay is None:
        return stack
    by_pixel = delay.where(F.col("delay").isNotNull()).groupBy(*PIXEL).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("idx").cast("int"), "delay"))).alias("_d")
    )

    def at(idx: str):
        return F.coalesce(F.element_at("_d", F.col(idx).cast("int")), F.lit(0.0))

    return stack.join(by_pixel, PIXEL, "left").withColumn(
        "phase", F.col("phase") - (at("sec_idx") - at("ref_idx"))).drop("_d")


def deramp_stack(stack: DataFrame) -> DataFrame:
    return deramp(stack, ["pair_id"], "phase")


# Numbers of a batch's stacked normal matrices that are held at once.
STACKED = 4_000_000


def solve_networks(
    pixel: np.ndarray, ref: np.ndarray, sec: np.ndarray, phase: np.ndarray, pixels: int, days: int, first: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(present, phases), pixels x days: least-squares phase per date of each pixel's own pairs.

    ``ref`` and ``sec`` are places among ``days`` dates.  Pairs are edges of a graph of the dates, so the normal
    matrix of a pixel is the graph's Laplacian without the first date: built for all pixels at once by
    counting, solved as one stack.  Which pairs a pixel lacks makes no difference to the work.
    Dates that no chain of pairs ties to the first are NaN.
    """
    at_ref, at_sec = pixel * days + ref, pixel * days + sec
    size = pixels * days
    present = np.zeros(size, bool)
    present[at_ref] = present[at_sec] = True
    tied = np.zeros(size, bool)
    if 0 <= first < days:
        tied[np.arange(pixels) * days + first] = True
    tied &= present
    while True:
        open_ends = tied[at_ref] != tied[at_sec]
        if not open_ends.any():
            break
        tied[at_ref[open_ends]] = tied[at_sec[open_ends]] = True
    free = tied.copy()
    if 0 <= first < days:
        free[np.arange(pixels) * days + first] = False
    use = tied[at_ref]
    r, s, f = at_ref[use], at_sec[use], phase[use]
    right = (np.bincount(s, f, size) - np.bincount(r, f, size)) * free
    degree = np.where(free, np.bincount(r, minlength=size) + np.bincount(s, minlength=size), 1).astype(float)
    normal = np.zeros((pixels, days, days))
    flat = normal.reshape(-1)
    inner = free[r] & free[s]
    p, i, j = r[inner] // days, r[inner] % days, s[inner] % days
    links = np.bincount((p * days + i) * days + j, minlength=flat.size)
    links = links.reshape(pixels, days, days)
    normal -= links + links.transpose(0, 2, 1)
    normal[:, np.arange(days), np.arange(days)] += degree.reshape(pixels, days)
    out = np.linalg.solve(normal, right.reshape(pixels, days, 1))[..., 0]
    return present.reshape(pixels, days), np.where(tied.reshape(pixels, days), out, np.nan)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, col, pairs' dates and phases, first date) to dates and phases of each pixel, as lists."""
    for batch in batches:
        refs, secs, phases = (batch.column(k) for k in range(2, 5))
        sizes = np.diff(refs.offsets.to_numpy())
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ref, sec, phase = (c.flatten().to_numpy() for c in (refs, secs, phases))
        dates = np.unique(np.concatenate([ref, sec]))
        first = int(batch.column(5)[0].as_py()) if batch.num_rows else 0
        place = int(np.searchsorted(dates, first))
        place = place if place < len(dates) and dates[place] == first else -1
        step = max(1, STACKED // max(1, len(dates)) ** 2)
        for a in range(0, batch.num_rows, step):
            b = min(batch.num_rows, a + step)
            i, j = ends[a], ends[b]
            present, solved = solve_networks(
                np.repeat(np.arange(b - a), sizes[a:b]), np.searchsorted(dates, ref[i:j]), np.searchsorted(dates, sec[i:j]),
                phase[i:j], b - a, len(dates), place)
            offsets = pa.array(np.concatenate([[0], np.cumsum(present.sum(1))]), pa.int32())
            idx = np.broadcast_to(dates, present.shape)[present]
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (idx.astype(np.int32), solved[present])]
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists], names=[*PIXEL, "idx", "phase"])


def invert_network(stack: DataFrame) -> DataFrame:
    """Least-squares phase per date and pixel: one shuffle by pixel, then stacked local algebra.

    A pixel's group holds its pairs, at most one row per pair of the network.  Pixels missing some
    pairs are solved on the pairs they have, whatever the number of different gaps.  The network's first date
    has phase 0; dates of a pixel that its pairs don't tie to it have no datum, and NULL.
    """
    pair = F.struct("pair_id", F.col("ref_idx").cast("int").alias("ref_idx"),
                    F.col("sec_idx").cast("int").alias("sec_idx"), F.col("phase").cast("double").alias("phase"))
    first = stack.agg(F.least(F.min("ref_idx"), F.min("sec_idx")).cast("int").alias("_first"))
    pixels = (
        stack.where(F.col("phase").isNotNull())
        .groupBy(*PIXEL).agg(F.array_sort(F.collect_list(pair)).alias("_p"))
        .select(*PIXEL, F.col("_p.ref_idx").alias("_r"), F.col("_p.sec_idx").alias("_s"),
                F.col("_p.phase").alias("_f"))
    )
    keys = ", ".join(f"{c} {stack.schema[c].dataType.simpleString()}" for c in PIXEL)
    solved = attach(pixels, first).mapInArrow(_solve, f"{keys}, idx array<int>, phase array<double>")
    return solved.select(*PIXEL, F.inline(F.arrays_zip("idx", "phase"))).withColumn(
        "phase", F.nanvl("phase", F.lit(None).cast("double")))


def _with_years(series: DataFrame, dates: DataFrame) -> DataFrame:
    years = dates.select("idx", (F.col("day") / 365.25).alias("_yr"))
    return series.join(small(years, write=False), "idx")


def timeseries_velocity(series: DataFrame, dates: DataFrame, to_value: float = 1.0) -> DataFrame:
    """Slope per year of ``phase * to_value`` per pixel, and its standard error."""
    x, y = F.col("_yr"), F.col("phase") * F.lit(float(to_value))
    n = F.count(y)
    joined = _with_years(series, dates)
    sxx, sxy, syy = F.regr_sxx(y, x), F.regr_sxy(y, x), F.regr_syy(y, x)
    rss = F.greatest(syy - sxy * sxy / sxx, F.lit(0.0))
    return joined.groupBy(*PIXEL).agg(
        F.regr_slope(y, x).alias("velocity"),
        F.when(n > 2, F.sqrt(rss / (n - 2) / sxx)).alias("velocity_std"),
    )


def residuals(stack: DataFrame, series: DataFrame) -> DataFrame:
    """Observed minus modelled phase per pair and pixel.

    A pixel's dates become one small map, so stack and series meet once, by pixel.
    """
    by_pixel = series.groupBy(*PIXEL).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("idx").cast("int"), "phase"))).alias("_m")
    )
    model = F.element_at("_m", F.col("sec_idx").cast("int")) - F.element_at(
        "_m", F.col("ref_idx").cast("int")
    )
    return stack.join(by_pixel, PIXEL).withColumn("residual", F.col("phase") - model).drop("_m")


def temporal_coherence(stack: DataFrame, series: DataFrame) -> DataFrame:
    """|mean exp(i * residual)| per pixel."""
    c, s = F.avg(F.cos("residual")), F.avg(F.sin("residual"))
    return residuals(stack, series).groupBy(*PIXEL).agg(F.sqrt(c * c + s * s).alias("value"))


def date_residual_rms(series: DataFrame, dates: DataFrame) -> DataFrame:
    """RMS over pixels of each date's departure from the pixel's straight line."""
    joined = _with_years(series, dates)
    pixel = Window.partitionBy(*PIXEL)
    fit = joined.withColumns({
        "_b": F.regr_slope("phase", "_yr").over(pixel),
        "_a": F.regr_intercept("phase", "_yr").over(pixel),
    })
    r = F.col("phase") - F.col("_a") - F.col("_b") * F.col("_yr")
    return fit.groupBy("idx").agg(F.sqrt(F.avg(r * r)).alias("rms"))


def reference_date(rms: DataFrame) -> DataFrame:
    """The date that departs least."""
    return rms.agg(F.min_by("idx", F.struct("rms", "idx")).alias("idx"), F.min("rms").alias("rms"))


def stacked_velocity(stack: DataFrame) -> DataFrame:
    """Quick look: sum(phase * dt) / sum(dt * dt) per pixel."""
    p, d = F.col("phase"), F.col("dt_days")
    return stack.where(p.isNotNull()).groupBy(*PIXEL).agg(
        (F.sum(p * d) / F.sum(d * d)).alias("value")
    )
