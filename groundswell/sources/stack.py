"""Interferogram stacks: pair folders joined with their layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundswell.frames import attach, small


def discover_pairs(listing: DataFrame) -> DataFrame:
    """Pairs named ``yyyymmdd_yyyymmdd`` anywhere in object names, with both dates."""
    pattern = r"(\d{8})_(\d{8})"
    name = F.regexp_replace("name", r"(\d{4})-(\d{2})-(\d{2})", "$1$2$3")
    first, second = F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2)
    return (
        listing.select(first.alias("_a"), second.alias("_b")).where(F.col("_a") != "").distinct()
        .select(
            F.concat_ws("_", "_a", "_b").alias("pair_id"),
            F.try_to_date("_a", "yyyyMMdd").alias("ref_date"),
            F.try_to_date("_b", "yyyyMMdd").alias("sec_date"),
        )
    )


def stack_dates(pairs: DataFrame) -> DataFrame:
    """Acquisition dates of the network with a running index ``idx`` and the day number.

    A network has at most one date per calendar day, so the index is made on one short array.
    """
    days = F.array_sort(F.collect_set("acq_date"))
    listed = pairs.select(F.explode(F.array("ref_date", "sec_date")).alias("acq_date")).agg(days.alias("_d"))
    return listed.select(F.posexplode("_d").alias("idx", "acq_date"), F.col("_d")[0].alias("_first")).select(
        "idx", "acq_date", F.datediff("acq_date", "_first").alias("day"))


def indexed_pairs(pairs: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Pairs with the indexes of their dates and the days between: what the time series needs."""
    dates = stack_dates(pairs) if dates is None else dates
    at = dates.agg(F.map_from_entries(F.collect_list(F.struct("acq_date", "idx"))).alias("_at"))
    return attach(pairs, at).select(
        *pairs.columns, F.col("_at")[F.col("ref_date")].alias("ref_idx"),
        F.col("_at")[F.col("sec_date")].alias("sec_idx"),
        F.datediff("sec_date", "ref_date").alias("dt_days"))


def load_stack(
    pairs: DataFrame, phase: DataFrame, coherence: DataFrame, conncomp: DataFrame | None = None
) -> DataFrame:
    """Phase, coherence and component layers of every pair.

    Layers ``(pair_id, row, col, value)`` are read in one pass: they are stacked, and one
    aggregate by pair and pixel spreads them into columns.  It runs behind a shuffle of its own, so that its
    tasks are sized by the rows of all pairs and layers, not by those of a table they were made from.  A pair or layer with no file
    gives NULLs; one for a pair not listed is left out.
    """
    layers = phase.select("pair_id", "row", "col", F.lit("phase").alias("_k"), "value").union(
        coherence.select("pair_id", "row", "col", F.lit("coherence"), "value")
    )
    if conncomp is not None:
        layers = layers.union(
            conncomp.select("pair_id", "row", "col", F.lit("conncomp"), "value")
        )

    def layer(k: str) -> Column:
        return F.max(F.when(F.col("_k") == k, F.col("value"))).alias(k)

    wide = layers.repartition("pair_id", "row", "col").groupBy("pair_id", "row", "col").agg(
        layer("phase"), layer("coherence"), layer("conncomp")
    )
    # Layers meet their pair by broadcast, not by a shuffle on a handful of pair ids.
    pairs = small(pairs)
    empty = pairs.join(layers.select("pair_id").distinct(), "pair_id", "left_anti")
    return wide.join(pairs, "pair_id").unionByName(empty, allowMissingColumns=True)


def crop_geometry(geometry: DataFrame, height: int, width: int) -> DataFrame:
    """Geometry layers cut to the size of the stack."""
    return geometry.where((F.col("row") < height) & (F.col("col") < width))


def slant_range(col: Column, start: float, pixel: float) -> Column:
    return F.lit(float(start)) + col * F.lit(float(pixel))
