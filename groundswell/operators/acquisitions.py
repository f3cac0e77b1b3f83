"""Acquisition lists: orbit choice, spacing, pair networks, orbit files."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundswell.frames import materialized

_DAY = 86400 * 1_000_000


def best_orbit(scenes: DataFrame) -> DataFrame:
    """The relative orbit with most scenes; on a tie, the one seen first."""
    return (
        scenes.where(F.col("path_number").isNotNull()).groupBy("path_number")
        .agg(F.count("*").alias("scenes"), F.min("start_time").alias("first_time"))
        .orderBy(F.desc("scenes"), "first_time").limit(1)
    )


def _next_at_distance(times: DataFrame, by: Sequence[str], gap: int, bucket: int) -> DataFrame:
    """For each (by, us) the first time at least ``gap`` later.

    Queries and times meet in hour-sized buckets, so a crowded track is spread over
    its hours; only the list of hours of a track is ever one window.
    """
    by = list(by)
    span = lambda c: F.floor(c / bucket)
    points = times.select(*by, F.col("us").alias("at"), F.lit(None).cast("bigint").alias("us"))
    asks = times.select(*by, (F.col("us") + gap).alias("at"), "us")
    both = points.union(asks).withColumn("_b", span(F.col("at")))
    ahead = Window.partitionBy(*by, "_b").orderBy(F.desc("at"), F.col("us").isNotNull()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    # Descending order: the latest point seen so far is the nearest one at or after.
    seen = F.last(F.when(F.col("us").isNull(), F.col("at")), ignorenulls=True).over(ahead)
    asked = both.withColumn("_here", seen).where(F.col("us").isNotNull())
    hours = both.groupBy(*by, "_b").agg(
        F.min(F.when(F.col("us").isNull(), F.col("at"))).alias("_first")
    )
    later = Window.partitionBy(*by).orderBy(F.desc("_b")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    hours = hours.withColumn("_later", F.last("_first", ignorenulls=True).over(later))
    return asked.join(hours.select(*by, "_b", "_later"), [*by, "_b"]).select(
        *by, "us", F.coalesce("_here", "_later").alias("next")
    )


def min_gap_times(
    times: DataFrame, min_gap_days: int, by: Sequence[str] = ("track",), time: str = "start_time"
) -> DataFrame:
    """Times kept by the greedy rule: the first, then each at least the gap after the last kept.

    The rule is a chain of jumps to "first time at least the gap later".  Doubling the
    jump length each round marks all kept times in log2(span / gap) rounds of equi-joins,
    so even a track holding a third of all scenes is never folded in one task.
    """
    by = list(by)
    us = times.select(*by, F.unix_micros(F.col(time).cast("timestamp")).alias("us")).where(
        F.col("us").isNotNull()
    ).distinct()
    if min_gap_days <= 0:
        return us.select(*by, F.timestamp_micros("us").alias(time))
    gap = min_gap_days * _DAY
    span = us.groupBy(*by).agg((F.max("us") - F.min("us")).alias("s")).agg(F.max("s")).first()[0]
    rounds = math.ceil(math.log2((span or 0) / gap + 2))
    jumps = materialized(_next_at_distance(us, by, gap, _DAY // 24).where(F.col("next").isNotNull()))
    kept = us.groupBy(*by).agg(F.min("us").alias("us"))
    for left in range(rounds, 0, -1):
        # Each kept time gives itself and the time a jump away: no time comes up twice.
        both = F.explode(F.array_compact(F.array("us", "next"))).alias("us")
        kept = kept.join(jumps, [*by, "us"], "left").select(*by, both)
        if left > 1:
            far = jumps.select(*by, F.col("us").alias("next"), F.col("next").alias("_far"))
            jumps = materialized(
                jumps.join(far, [*by, "next"]).select(*by, "us", F.col("_far").alias("next"))
            )
    return kept.select(*by, F.timestamp_micros("us").alias(time))


def min_gap_scenes(
    scenes: DataFrame, min_gap_days: int, max_scenes: int | None = None,
    by: Sequence[str] = ("path_number",),
) -> DataFrame:
    """Scenes kept by the spacing rule; of scenes at one time the smallest id counts."""
    by = list(by)
    if min_gap_days <= 0:
        out = scenes.where(F.col("start_time").isNotNull())
    else:
        first = scenes.groupBy(*by, "start_time").agg(F.min("scene_id").alias("scene_id"))
        keep = min_gap_times(first, min_gap_days, by)
        chosen = first.withColumn("_ts", F.col("start_time").cast("timestamp")).join(
            keep.withColumnRenamed("start_time", "_ts"), [*by, "_ts"], "left_semi"
        )
        out = scenes.join(chosen.select(*by, "scene_id"), [*by, "scene_id"], "left_semi")
    if max_scenes is None:
        return out
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("start_time", "scene_id"))
    return out.withColumn("_k", rank).where(F.col("_k") <= max_scenes).drop("_k")


# --- Pair networks --------------------------------------------------------------------


def _dates(dates: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct dates: at most one row per calendar day and track, whatever the scene count."""
    return dates.select(*by, "acq_date").where(F.col("acq_date").isNotNull()).distinct()


def sbas_pairs(
    dates: DataFrame, max_days: int = 48, max_connections: int = 4, by: Sequence[str] = ("track",)
) -> DataFrame:
    """Each date with up to ``max_connections`` following dates within ``max_days``."""
    order = Window.partitionBy(*by).orderBy("acq_date")
    ahead = F.array(*[F.lead("acq_date", k).over(order) for k in range(1, max_connections + 1)])
    return (
        _dates(dates, by).withColumn("_next", ahead)
        .select(*by, F.col("acq_date").alias("ref_date"), F.explode("_next").alias("sec_date"))
        .withColumn("baseline_days", F.datediff("sec_date", "ref_date"))
        .where(F.col("baseline_days") <= max_days)
    )


def sequential_pairs(dates: DataFrame, by: Sequence[str] = ("track",)) -> DataFrame:
    order = Window.partitionBy(*by).orderBy("acq_date")
    return (
        _dates(dates, by).withColumn("sec_date", F.lead("acq_date").over(order))
        .where(F.col("sec_date").isNotNull())
        .select(*by, F.col("acq_date").alias("ref_date"), "sec_date",
                F.datediff("sec_date", "acq_date").alias("baseline_days"))
    )


def pair_dates(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return pairs.select(
        *by, F.explode(F.array("ref_date", "sec_date")).alias("acq_date")
    ).distinct()


def network_summary(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pair, date and baseline counts of a network, and pairs per spanning link."""
    b = F.col("baseline_days")
    main = pairs.groupBy(*by).agg(
        F.count("*").alias("num_pairs"), F.min(b).alias("min_baseline_days"),
        F.max(b).alias("max_baseline_days"), F.avg(b).alias("mean_baseline_days"),
    )
    dates = pair_dates(pairs, by).groupBy(*by).agg(F.count("*").alias("num_dates"))
    if by:
        both = main.join(dates, list(by))
    else:
        both = main.withColumn("num_dates", dates.scalar())
    return both.withColumn(
        "redundancy", F.col("num_pairs") / F.greatest(F.col("num_dates") - 1, F.lit(1))
    )


def orbit_cover(
    scenes: DataFrame, orbits: DataFrame, on: Sequence[str] = ()
) -> DataFrame:
    """Best orbit file for each ``(scene_id, start_time)``: precise before restituted, then name.

    The interval join is an equi-join on the day: an orbit file is listed under each day
    it covers (two or three).  Scenes without cover stay with a NULL name.
    """
    rank = F.when(F.col("kind") == "POEORB", 0).otherwise(1)
    by_day = orbits.select(
        *on, "kind", "name", "valid_from", "valid_to", rank.alias("_rank"),
        F.explode(F.sequence(F.to_date("valid_from"), F.to_date("valid_to"))).alias("_day"),
    )
    t = F.col("start_time").cast("timestamp")
    asked = scenes.select(*on, "scene_id", t.alias("start_time"), F.to_date(t).alias("_day"))
    same = [asked[k] == by_day[k] for k in [*on, "_day"]]
    covers = (by_day["valid_from"] <= asked["start_time"]) & (
        asked["start_time"] <= by_day["valid_to"]
    )
    for c in same:
        covers = covers & c
    best = F.min(F.when(F.col("name").isNotNull(), F.struct("_rank", "name", "kind")))
    return asked.join(by_day, covers, "left").groupBy("scene_id").agg(best.alias("_best")).select(
        "scene_id", F.col("_best.kind").alias("orbit_kind"), F.col("_best.name").alias("orbit_name")
    )
