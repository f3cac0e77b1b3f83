"""Bursts of a swath: overlap search and vertical merging.

``lines(burst, row, col, value)`` holds the bursts; ``by`` adds swath or layer keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundswell.frames import small


def burst_sizes(lines: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Height and width per burst (a short table)."""
    return lines.groupBy(*by, "burst").agg(
        (F.max("row") + 1).cast("int").alias("height"), (F.max("col") + 1).cast("int").alias("width")
    )


def burst_overlaps(
    lines: DataFrame, max_search: int = 200, default: int = 120, by: Sequence[str] = (),
    min_search: int = 20, max_ratio: float = 0.1,
) -> DataFrame:
    """Overlap of each burst with the next: the candidate whose tail and head differ least.

    Only the centre column takes part: each sample of a burst's last lines is paired with
    the head sample it would lie on for every candidate, at most ``max_search`` of them.
    """
    by = list(by)
    keys = [*by, "burst"]
    sizes = burst_sizes(lines, by)
    nxt = sizes.select(*by, (F.col("burst") - 1).alias("burst"), F.col("height").alias("_hb"))
    pairs = small(
        sizes.join(nxt, keys).withColumn("_mid", F.floor(F.col("width") / 2).cast("int"))
    )
    signal = lines.select(*keys, "row", "col", "value")
    # The next burst is read at the column in the middle of the first one's width.
    a = signal.join(pairs, keys).where(F.col("col") == F.col("_mid"))
    limit = F.least(F.lit(max_search), F.col("height"), F.col("_hb"))
    spread = a.groupBy(*keys).agg((F.max("value") - F.min("value")).alias("_range"))
    tail = (
        a.withColumn("_limit", limit)
        .where(F.col("row") >= F.col("height") - F.col("_limit") + 1)
        .where(F.col("_limit") > min_search)
        .select(*keys, "_mid", F.col("value").alias("_tail"), F.explode(F.sequence(
            F.greatest(F.lit(min_search), F.col("height") - F.col("row")), F.col("_limit") - 1
        )).alias("candidate"), "row", "height")
        .withColumn("_head_row", F.col("row") - F.col("height") + F.col("candidate"))
    )
    head = signal.select(
        *by, (F.col("burst") - 1).alias("burst"), F.col("row").alias("_head_row"),
        F.col("col").alias("_mid"), F.col("value").alias("_head"),
    )
    scored = tail.join(head, [*keys, "_head_row", "_mid"]).groupBy(*keys, "candidate").agg(
        F.avg(F.abs(F.col("_tail") - F.col("_head"))).alias("_diff")
    )
    best = scored.groupBy(*keys).agg(
        F.min(F.struct("_diff", "candidate")).alias("_b")
    )
    unsure = (F.col("_range") > 0) & (
        F.coalesce(F.col("_b._diff") / F.col("_range"), F.lit(float("inf"))) > max_ratio
    )
    return pairs.join(spread, keys, "left").join(best, keys, "left").select(
        *keys,
        F.when(unsure, F.lit(default)).otherwise(F.coalesce(F.col("_b.candidate"), F.lit(default)))
        .cast("int").alias("overlap"),
    )


def merge_bursts(
    lines: DataFrame, overlaps: DataFrame | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Bursts one below the other, each trimmed by half of its overlaps.

    A burst that trimming would empty is kept whole.  Without overlaps the bursts are
    simply stacked.
    """
    by = list(by)
    keys = [*by, "burst"]
    sizes = burst_sizes(lines, by)
    if overlaps is None:
        cut = sizes.withColumns({"_top": F.lit(0), "_end": F.col("height")})
    else:
        below = overlaps.select(*keys, F.floor(F.col("overlap") / 2).cast("int").alias("_bottom"))
        above = below.select(
            *by, (F.col("burst") + 1).alias("burst"), F.col("_bottom").alias("_top")
        )
        cut = (
            sizes.join(above, keys, "left").join(below, keys, "left")
            .fillna(0, ["_top", "_bottom"])
            .withColumn("_end", F.col("height") - F.col("_bottom"))
            .withColumn("_whole", F.col("_end") <= F.col("_top"))
            .withColumns({
                "_top": F.when(F.col("_whole"), 0).otherwise(F.col("_top")),
                "_end": F.when(F.col("_whole"), F.col("height")).otherwise(F.col("_end")),
            })
        )
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("burst").rowsBetween(
        Window.unboundedPreceding, -1
    )
    cut = cut.select(
        *keys, "_top", "_end",
        F.coalesce(F.sum(F.col("_end") - F.col("_top")).over(before), F.lit(0)).alias("_start"),
    )
    return (
        lines.join(small(cut), keys)
        .where((F.col("row") >= F.col("_top")) & (F.col("row") < F.col("_end")))
        .withColumn("row", (F.col("row") - F.col("_top") + F.col("_start")).cast("int"))
        .drop("_top", "_end", "_start", "burst")
    )
