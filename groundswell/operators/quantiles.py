"""Exact interpolated percentiles of columns too large for one sorted group.

``percentile``/``median`` keep every distinct value of a group in one buffer, which
is right for a pixel's dates but not for a whole raster.  Here a group may hold a
third of all rows:

1. a mergeable quantile sketch brackets the wanted rank;
2. values below the bracket collapse to one count, values inside it to
   ``(value, count)`` pairs, both combined map-side, so ties cost nothing;
3. the bracket is cut into bins by rank, from a sketch of its distinct values, so that no bin has many of them
   however heavy the tail, and counts give each bin its rank offset;
4. ranks are finished inside bins, where the window partitions are small.

No step samples or drops a value: the result equals a full sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundswell.frames import attach, materialized

_GRID = 1024
_BINS = 256
_STEPS = ", ".join(f"{i / _GRID!r}D" for i in range(_GRID + 1))
_CUTS = ", ".join(f"{i / _BINS!r}D" for i in range(1, _BINS))


def exact_percentiles(
    df: DataFrame, value: Column | str, ps: Sequence[float], by: Sequence[str] = (),
    names: Sequence[str] | None = None, also: Sequence[Column] = (),
) -> DataFrame:
    """One row per ``by`` group with linearly interpolated percentiles (0..1) of non-NULL values.

    ``also`` are other aggregates of ``df`` (with their names) for the same groups: they come out of the
    scan that makes the sketch, so that all together reads the rows twice.  With them, a group without
    any value has a row too.
    """
    by = list(by)
    value = F.col(value) if isinstance(value, str) else value
    names = list(names or [f"p{i}" for i in range(len(ps))])
    base = df.withColumn("_v", value.cast("double"))
    v = base.select(*by, "_v").where(F.col("_v").isNotNull())

    sketch = (base if also else v).groupBy(*by).agg(
        *also, F.count("_v").alias("_n"),
        # As text: a thousand literal columns would take longer to build than the query.
        F.expr(f"percentile_approx(_v, array({_STEPS}), {4 * _GRID})").alias("_q"),
    )
    if also:
        sketch = materialized(sketch)
    small = F.col("_n") <= 4 * _GRID
    targets = []
    for i, p in enumerate(ps):
        rank = F.lit(float(p)) * (F.col("_n") - 1)
        cell = F.floor(rank * _GRID / F.col("_n")).cast("int")
        low = F.when(small, 1).otherwise(F.greatest(cell, F.lit(1)))
        high = F.when(small, _GRID + 1).otherwise(F.least(cell + 3, F.lit(_GRID + 1)))
        targets.append(
            F.struct(
                F.lit(i).alias("p"), rank.alias("rank"),
                F.element_at("_q", low).alias("lo"), F.element_at("_q", high).alias("hi"),
            )
        )
    brackets = sketch.select(*by, F.array(*targets).alias("_t"))

    t = F.col("_t")
    counted = (
        attach(v, brackets, by)
        .select(*by, "_v", F.explode(F.filter(t, lambda b: F.col("_v") <= b["hi"])).alias("_b"))
        .select(
            *by,
            F.col("_b.p").alias("_p"), F.col("_b.rank").alias("_rank"),
            F.col("_b.lo").alias("_lo"), F.col("_b.hi").alias("_hi"),
            F.when(F.col("_v") >= F.col("_b.lo"), F.col("_v")).alias("_v"),
        )
        .groupBy(*by, "_p", "_rank", "_lo", "_hi", "_v")
        .agg(F.count("*").alias("_c"))
    )
    group = [*by, "_p"]
    # Stored: three plans build on it, and what they need differs too much for one exchange to serve all.
    counted, inner = materialized(counted), F.col("_v").isNotNull()
    cuts = counted.where(inner).groupBy(*group).agg(
        F.expr(f"percentile_approx(_v, array({_CUTS}), {16 * _BINS})").alias("_cuts"))
    place = F.size(F.filter("_cuts", lambda e: e <= F.col("_v")))
    counted = counted.join(cuts, group).select(*counted.columns, F.when(inner, place).otherwise(-1).alias("_bin"))
    bins = counted.groupBy(*group, "_bin").agg(F.sum("_c").alias("_bc"))
    offset = F.sum("_bc").over(
        Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    )
    bins = bins.select(*group, "_bin", F.coalesce(offset, F.lit(0)).alias("_off"))
    local = Window.partitionBy(*group, "_bin").orderBy("_v")
    ranked = (
        counted.join(bins, [*group, "_bin"])
        .where(F.col("_v").isNotNull())
        .withColumn("_end", F.col("_off") + F.sum("_c").over(local))
        .withColumn("_start", F.col("_end") - F.col("_c"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v")))

    floor = F.floor("_rank")
    found = ranked.groupBy(*group).agg(
        at(floor).alias("_a"), at(floor + 1).alias("_z"),
        F.max(F.col("_rank") - floor).alias("_frac"),
    ).withColumn(
        "_x",
        F.when(F.col("_frac") > 0, F.col("_a") + (F.col("_z") - F.col("_a")) * F.col("_frac"))
        .otherwise(F.col("_a")),
    )
    out = found.groupBy(*by).agg(
        *[F.max(F.when(F.col("_p") == i, F.col("_x"))).alias(n) for i, n in enumerate(names)]
    )
    if not also:
        return out
    return attach(sketch.drop("_n", "_q"), out, by)


def exact_median(
    df: DataFrame, value: Column | str, by: Sequence[str] = (), name: str = "median", also: Sequence[Column] = (),
) -> DataFrame:
    return exact_percentiles(df, value, [0.5], by, [name], also)
