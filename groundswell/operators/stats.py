"""Summary statistics of rasters and comparisons between rasters.

All of them are grouped aggregates with map-side partial sums.  ``by`` names the
raster keys; with none, the whole table is one raster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundswell.config import CLASS_LABELS, CLEARING_COHORTS, COVERAGE_LABELS
from groundswell.frames import labelled, percent, val
from groundswell.functions.geodesy import Grid, pixel_area_m2
from groundswell.functions.special import t_pvalue
from groundswell.operators.quantiles import exact_median


def _beside(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Combine aggregates of the same grouping."""
    if by:
        return left.join(right, list(by), "left")
    row = right.select(F.struct(*right.columns)).scalar()
    return left.select("*", *[row.getField(n).alias(n) for n in right.columns])


def raster_stats(df: DataFrame, by: Sequence[str] = (), digits: int = 2) -> DataFrame:
    out = exact_median(df, val(), by, also=[
        F.round(F.avg(val()), digits).alias("mean"),
        F.round(F.stddev_pop(val()), digits).alias("std"),
        F.round(F.min(val()), digits).alias("min"),
        F.round(F.max(val()), digits).alias("max"),
        F.count(val()).alias("valid_pixel_count"),
        F.count("*").alias("total_pixels"),
    ])
    return out.withColumn("median", F.round("median", digits))


def coherence_stats(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    n = F.greatest(F.count(val()), F.lit(1))
    out = exact_median(df, val(), by, also=[
        F.round(F.avg(val()), 4).alias("mean"),
        F.count(F.when(val() > 0.5, 1)).alias("pixels_above_05"),
        F.round(F.count(F.when(val() > 0.5, 1)) / n, 4).alias("fraction_above_05"),
        F.count(F.when(val() > 0.7, 1)).alias("pixels_above_07"),
        F.round(F.count(F.when(val() > 0.7, 1)) / n, 4).alias("fraction_above_07"),
        F.count(val()).alias("valid_pixel_count"),
    ])
    return out.withColumn("median", F.round("median", 4))


def class_distribution(
    df: DataFrame, code: str = "class", labels: dict[int, str] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Pixels and percent per class present."""
    counts = df.groupBy(*by, code).agg(F.count("*").alias("pixels"))
    total = counts.groupBy(*by).agg(F.sum("pixels").alias("_total"))
    return _beside(counts, total, by).select(
        *by, code, labelled(F.col(code), labels or CLASS_LABELS).alias("label"), "pixels",
        percent(F.col("pixels"), F.col("_total")).alias("percent"),
    )


def coverage_distribution(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return class_distribution(df, "coverage", COVERAGE_LABELS, by)


def risk_distribution(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    n = F.count(val())

    def share(low: float | None, high: float | None) -> Column:
        inside = F.lit(True)
        if low is not None:
            inside = inside & (val() >= low)
        if high is not None:
            inside = inside & (val() < high)
        return F.round(F.count(F.when(inside & val().isNotNull(), 1)) / n, 4)

    return df.groupBy(*by).agg(
        F.round(F.avg(val()), 4).alias("mean_risk"),
        share(None, 0.2).alias("low_fraction"),
        share(0.2, 0.4).alias("moderate_fraction"),
        share(0.4, 0.6).alias("elevated_fraction"),
        share(0.6, 0.8).alias("high_fraction"),
        share(0.8, None).alias("critical_fraction"),
        n.alias("valid_pixel_count"),
    )


def mask_stats(df: DataFrame, mask: str = "mask", by: Sequence[str] = ()) -> DataFrame:
    """Pixels set, all pixels and coverage percent of a boolean column."""
    hit = F.count(F.when(F.col(mask), 1))
    return df.groupBy(*by).agg(
        hit.alias("mask_pixels"), F.count("*").alias("total_pixels"),
        F.round(percent(hit, F.count("*")), 3).alias("coverage_pct"),
    )


def threshold_counts(
    df: DataFrame, thresholds: Sequence[float] = (0.5, 0.6, 0.7, 0.8, 0.9),
    by: Sequence[str] = (),
) -> DataFrame:
    """Pixels at or above each threshold; one pass, one row per threshold."""
    counts = df.groupBy(*by).agg(
        F.count(val()).alias("valid_pixels"),
        F.array(
            *[
                F.struct(F.lit(float(t)).alias("threshold"),
                         F.count(F.when(val() >= t, 1)).alias("pixels"))
                for t in thresholds
            ]
        ).alias("_t"),
    )
    return counts.select(*by, "valid_pixels", F.inline("_t")).withColumn(
        "percent", percent(F.col("pixels"), F.col("valid_pixels"))
    )


def carbon_total(df: DataFrame, grid: Grid, by: Sequence[str] = ()) -> DataFrame:
    ha = F.lit(pixel_area_m2(grid) / 10000.0)
    return df.groupBy(*by).agg(
        F.avg(val()).alias("mean_rate"), F.count(val()).alias("pixels"),
        (F.count(val()) * ha).alias("area_ha"), (F.avg(val()) * F.count(val()) * ha).alias("total_emission"),
    )


def coordinate_bbox(
    df: DataFrame, lat: str = "lat", lon: str = "lon",
    fallback: tuple[float, float, float, float] | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """West, south, east, north of the valid coordinate pixels (zero and NaN excluded)."""
    la, lo = F.col(lat), F.col(lon)
    ok = (la != 0) & (lo != 0) & ~F.isnan(la) & ~F.isnan(lo)
    box = df.groupBy(*by).agg(
        F.min(F.when(ok, lo)).alias("west"), F.min(F.when(ok, la)).alias("south"),
        F.max(F.when(ok, lo)).alias("east"), F.max(F.when(ok, la)).alias("north"),
    )
    sane = (
        (F.col("south") > -90) & (F.col("south") < F.col("north")) & (F.col("north") < 90)
        & (F.col("west") > -180) & (F.col("west") < F.col("east")) & (F.col("east") < 180)
    )
    spare = fallback or (None, None, None, None)
    return box.select(
        *by,
        *[F.when(sane, F.col(n)).otherwise(F.lit(s)).cast("double").alias(n)
          for n, s in zip(("west", "south", "east", "north"), spare)],
    )


# --- Bins and cohorts -----------------------------------------------------------------


def subsidence_by_distance(
    df: DataFrame, edges: Sequence[float] = (0, 50, 100, 250, 500, 1000),
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean of ``value`` per half-open ``distance`` bin; empty bins are kept with a NULL mean."""
    d = F.col("distance")
    aggs = [
        F.struct(
            F.lit(float(a)).alias("start_m"), F.lit(float(b)).alias("end_m"),
            F.avg(F.when((d >= a) & (d < b), val())).alias("mean_value"),
            F.count(F.when((d >= a) & (d < b), val())).alias("pixel_count"),
        )
        for a, b in zip(edges, edges[1:])
    ]
    return df.groupBy(*by).agg(F.array(*aggs).alias("_b")).select(*by, F.inline("_b"))


def distance_profile(
    df: DataFrame, width: float = 200.0, reach: float = 3000.0, min_pixels: int = 10,
    min_total: int = 100, by: Sequence[str] = (),
) -> DataFrame:
    """Mean velocity per distance bin, up to one bin past the reach; sparse bins left out."""
    both = df.where(val().isNotNull() & F.col("distance").isNotNull())
    size = both.groupBy(*by).agg(F.count("*").alias("_n"), F.max("distance").alias("_max"))
    edge_end = F.ceil((F.least(F.col("_max"), F.lit(reach)) + width) / width) - 1
    bins = both.withColumn("_bin", F.floor(F.col("distance") / width)).groupBy(*by, "_bin").agg(
        F.avg(val()).alias("mean_velocity"), F.count("*").alias("pixel_count")
    )
    return (
        _beside(bins, size, by)
        .where((F.col("pixel_count") >= min_pixels) & (F.col("_n") >= min_total))
        .where(F.col("_bin") < edge_end)
        .select(
            *by, ((F.col("_bin") + 0.5) * width).alias("bin_center_m"), "mean_velocity",
            "pixel_count",
        )
    )


def cohort_of(lossyear: Column) -> Column:
    return F.coalesce(*[
        F.when(lossyear.between(first, last), name) for name, first, last in CLEARING_COHORTS
    ])


def cohort_stats(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Velocity statistics per clearing cohort, empty cohorts included (n = 0)."""
    rows = df.where(val().isNotNull()).withColumn("cohort", cohort_of(F.col("lossyear")))
    rows = rows.where(F.col("cohort").isNotNull())
    keys = [*by, "cohort"]
    stats = exact_median(rows, val(), keys, "median_velocity", [
        F.count("*").alias("n_pixels"), F.avg(val()).alias("mean_velocity"),
        F.stddev_pop(val()).alias("std_velocity"),
    ])
    names = F.explode(F.array(*[F.lit(n) for n, _, _ in CLEARING_COHORTS])).alias("cohort")
    rasters = df.select(*by).distinct() if by else df.sparkSession.range(1)
    every = rasters.select(*by, names)
    return every.join(stats, keys, "left").withColumn(
        "n_pixels", F.coalesce("n_pixels", F.lit(0).cast("bigint"))
    )


def cohort_verdict(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Whether recently cleared land sinks faster than land cleared long ago."""

    def mean_of(name: str) -> Column:
        return F.max(F.when(F.col("cohort") == name, F.col("mean_velocity")))

    recent, old = mean_of("2016-2023"), mean_of("2001-2005")
    return stats.groupBy(*by).agg(
        F.when(recent.isNull() | old.isNull(), "insufficient_data")
        .when(recent < old, "consistent").otherwise("inconsistent").alias("assessment")
    )


# --- Correlation and zones ------------------------------------------------------------


def correlation(
    df: DataFrame, a: Column, b: Column, label: str, min_pixels: int = 100,
    by: Sequence[str] = (),
) -> DataFrame:
    """Pearson r with two-sided p; NULL and ``insufficient_data`` below ``min_pixels`` pairs."""
    pairs = df.select(*by, a.alias("_a"), b.alias("_b")).where(
        F.col("_a").isNotNull() & F.col("_b").isNotNull()
    )
    one = pairs.groupBy(*by).agg(F.count("*").alias("n"), F.corr("_a", "_b").alias("_r"))
    return _with_p(one.withColumn("label", F.lit(label)), min_pixels, by)


def _with_p(one: DataFrame, min_pixels: int, by: Sequence[str]) -> DataFrame:
    enough = F.col("n") >= min_pixels
    r = F.when(enough, F.col("_r"))
    df = (F.col("n") - 2).cast("double")
    t = F.when(F.abs(r) >= 1, F.lit(float("inf"))).otherwise(r * F.sqrt(df / (1 - r * r)))
    return one.select(
        *by, "label", r.alias("correlation_r"), t_pvalue(t, df).alias("p_value"),
        F.col("n").alias("n_valid_pixels"),
    ).withColumn(
        "status",
        F.when(F.col("n_valid_pixels") < min_pixels, "insufficient_data")
        .when(F.col("p_value") < 0.05, "significant").otherwise("not_significant"),
    )


def zonal_stats(df: DataFrame, zone: str = "zone", by: Sequence[str] = ()) -> DataFrame:
    """n, mean, median and population std of ``value`` per zone."""
    rows = df.where(val().isNotNull() & F.col(zone).isNotNull())
    keys = [*by, zone]
    return exact_median(rows, val(), keys, also=[
        F.count("*").alias("n"), F.avg(val()).alias("mean"), F.stddev_pop(val()).alias("std"),
    ])


def welch_test(
    df: DataFrame, first: str, second: str, zone: str = "zone", by: Sequence[str] = (),
    min_each: int = 30,
) -> DataFrame:
    """Welch's t between two zones; NULL unless both hold ``min_each`` pixels."""

    def part(fn, name: str) -> Column:
        return fn(F.when(F.col(zone) == name, val()))

    m = df.groupBy(*by).agg(
        part(F.count, first).alias("n1"), part(F.count, second).alias("n2"),
        part(F.avg, first).alias("_m1"), part(F.avg, second).alias("_m2"),
        part(F.var_samp, first).alias("_v1"), part(F.var_samp, second).alias("_v2"),
    )
    e1, e2 = F.col("_v1") / F.col("n1"), F.col("_v2") / F.col("n2")
    diff = F.col("_m1") - F.col("_m2")
    ok = (F.col("n1") >= min_each) & (F.col("n2") >= min_each)
    inf = F.lit(float("inf"))
    t = (
        F.when(ok & ((e1 + e2) > 0), diff / F.sqrt(e1 + e2))
        .when(ok & (diff > 0), inf).when(ok & (diff < 0), -inf)
    )
    dof = F.when((e1 + e2) > 0, (e1 + e2) * (e1 + e2)
                 / (e1 * e1 / (F.col("n1") - 1) + e2 * e2 / (F.col("n2") - 1))).otherwise(1.0)
    return m.select(
        *by, "n1", "n2", t.alias("t_statistic"), t_pvalue(t, dof).alias("t_p_value")
    ).withColumn("difference_significant", F.col("t_p_value") < 0.05)


def velocity_vs_backscatter(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Correlation of ``value`` with backscatter ``other``, on linear and on dB scale."""
    db = F.lit(10.0) * F.log10(F.greatest(F.col("other"), F.lit(1e-10)))
    pairs = df.where(val().isNotNull() & F.col("other").isNotNull())
    one = pairs.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.array(
            F.struct(F.lit("velocity_vs_vv_backscatter").alias("label"),
                     F.corr("value", "other").alias("_r")),
            F.struct(F.lit("velocity_vs_vv_backscatter_dB").alias("label"),
                     F.corr(val(), db).alias("_r")),
        ).alias("_two"),
    )
    return _with_p(one.select(*by, "n", F.inline("_two")), 100, by)


def coherence_zone(coherence: Column, threshold: float = 0.5) -> Column:
    """cleared above the threshold; forested otherwise, invalid coherence included."""
    return F.when(coherence > threshold, "cleared").otherwise("forested")


def ndvi_zone(ndvi: Column) -> Column:
    return F.when(ndvi < 0.3, "low").when(ndvi > 0.6, "high")


def mask_agreement(detected: DataFrame, truth: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of two sparse pixel masks (truth already buffered)."""
    keys = [*by, "row", "col"]
    both = (
        detected.select(*keys).distinct().withColumn("_d", F.lit(1))
        .join(truth.select(*keys).distinct().withColumn("_t", F.lit(1)), keys, "full")
    )
    d, t = F.col("_d").isNotNull(), F.col("_t").isNotNull()
    n = both.groupBy(*by).agg(
        F.count("_t").alias("truth_pixels"), F.count("_d").alias("detected_pixels"),
        F.count(F.when(d & t, 1)).alias("truth_in_detected"),
        F.count(F.when(~d & t, 1)).alias("truth_not_in_detected"),
        F.count(F.when(d & ~t, 1)).alias("detected_not_in_truth"),
    )
    n = n.withColumn(
        "recall", F.when(F.col("truth_pixels") > 0, F.col("truth_in_detected") / F.col("truth_pixels"))
    ).withColumn(
        "precision",
        F.when(F.col("detected_pixels") > 0, F.col("truth_in_detected") / F.col("detected_pixels")),
    )
    total = F.col("precision") + F.col("recall")
    return n.withColumn(
        "f1_score", F.when(total > 0, 2 * F.col("precision") * F.col("recall") / total)
    )
