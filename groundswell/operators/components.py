"""4-connected components of a sparse mask.

1. Runs are cut at tile edges and labelled inside each tile (a tile's runs are
   bounded by its area, so a task never holds more than one tile).
2. Only labels that touch a tile seam can belong together; those pairs form a
   graph that grows with tile perimeters, not with pixels.
3. The seam graph is labelled by minimum-label spreading with pointer jumping.
   Each round is a few equi-joins with combined minima and ends in a reliable
   checkpoint, so a component spanning the whole raster is no single task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundswell.frames import materialized
from groundswell.operators.morphology import to_pixels, to_runs


def _run_labels(row: np.ndarray, c0: np.ndarray, c1: np.ndarray) -> np.ndarray:
    """Index of the first run of each run's component (runs sorted by row, c0)."""
    n = len(row)
    label = np.arange(n)
    # Overlaps with the row above: in sorted order the touching runs are one slice.
    width = int(c1.max()) + 2
    key0, key1 = (row - row.min()) * width + c0, (row - row.min()) * width + c1
    first = np.searchsorted(key1, key0 - width, "left")
    last = np.searchsorted(key0, key1 - width, "right")
    count = np.maximum(last - first, 0)
    a = np.repeat(np.arange(n), count)
    b = first.repeat(count) + (np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count))
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        open_ = label[a] != label[b]
        if not open_.any():
            break
        a, b = a[open_], b[open_]
    return label


def _spread(edges: DataFrame) -> DataFrame:
    """Smallest node id reachable from each node of ``edges(a, b)``."""
    both = materialized(edges.union(edges.select("b", "a")).distinct())
    labels = both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node"))
    while True:
        near = (
            both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        )
        seen = labels.join(near, labels.node == near.a, "left").select(
            "node", F.col("label").alias("old"),
            F.least("label", F.coalesce("near", "label")).alias("label"),
        )
        # What a label's members found is passed to the node the label names.
        hook = seen.where(F.col("label") < F.col("old")).groupBy("old").agg(
            F.min("label").alias("hook")
        )
        seen = seen.join(hook.withColumnRenamed("old", "node"), "node", "left").select(
            "node", "old", F.least("label", F.coalesce("hook", "label")).alias("label")
        )
        jump = seen.select(F.col("node").alias("label"), F.col("label").alias("up"))
        nxt = materialized(
            seen.join(jump, "label", "left").select(
                "node", "old", F.coalesce("up", "label").alias("label")
            )
        )
        labels = nxt.select("node", "label")
        if nxt.where(F.col("label") != F.col("old")).isEmpty():
            return labels


def label_runs(
    runs: DataFrame, by: Sequence[str] = (), tile: int = 512
) -> DataFrame:
    """Runs cut at tile edges with a component id unique within the table."""
    by = list(by)
    cut = (
        runs.select(
            *by, "row", "c0", "c1", F.floor(F.col("row") / tile).cast("int").alias("_tr"),
            F.explode(F.sequence(
                F.floor(F.col("c0") / tile).cast("int"), F.floor(F.col("c1") / tile).cast("int")
            )).alias("_tc"),
        )
        .withColumns({
            "c0": F.greatest("c0", F.col("_tc") * tile),
            "c1": F.least("c1", F.col("_tc") * tile + (tile - 1)),
        })
    )
    lead_fields = [T.StructField(n, T.LongType()) for n in ("_lead_row", "_lead_c0")]
    schema = T.StructType([*cut.schema.fields, *lead_fields])

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["row", "c0"], ignore_index=True)
        row, c0, c1 = (pdf[c].to_numpy(np.int64) for c in ("row", "c0", "c1"))
        lead = _run_labels(row, c0, c1)
        pdf["_lead_row"], pdf["_lead_c0"] = row[lead], c0[lead]
        return pdf

    tiles = cut.groupBy(*by, "_tr", "_tc").applyInPandas(local, schema)
    parts = materialized(
        tiles.select(
            *by, "row", "c0", "c1",
            F.concat_ws("/", *[F.col(k).cast("string") for k in [*by, "_lead_row", "_lead_c0"]])
            .alias("_part"),
        )
    )
    # Neighbours across seams: a run at a tile's last column and the next run, and
    # overlapping runs of the two rows that meet at a tile's last row.
    in_row = Window.partitionBy(*by, "row").orderBy("c0")
    side = (
        parts.where((F.col("c0") % tile == 0) | ((F.col("c1") + 1) % tile == 0))
        .withColumns({"_p": F.lag("_part").over(in_row), "_e": F.lag("c1").over(in_row)})
        .where((F.col("_e") + 1 == F.col("c0")) & (F.col("c0") % tile == 0))
        .select(F.col("_p").alias("a"), F.col("_part").alias("b"))
    )
    upper = parts.where((F.col("row") + 1) % tile == 0).withColumn("_seam", F.col("row") + 1)
    lower = parts.where((F.col("row") % tile == 0) & (F.col("row") > 0)).withColumn(
        "_seam", F.col("row")
    )
    meet = upper.withColumn("_up", F.lit(1)).union(lower.withColumn("_up", F.lit(0)))
    order = Window.partitionBy(*by, "_seam").orderBy("c0", "_up").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # Runs of one row are disjoint, so only the last run begun in the other row can reach.
    other = {
        u: F.last(F.when(F.col("_up") == u, F.struct("c1", "_part")), ignorenulls=True).over(order)
        for u in (0, 1)
    }
    below = (
        meet.withColumn("_o", F.when(F.col("_up") == 1, other[0]).otherwise(other[1]))
        .where(F.col("_o.c1") >= F.col("c0"))
        .select(F.col("_o._part").alias("a"), F.col("_part").alias("b"))
    )
    edges = side.union(below).where(F.col("a") != F.col("b"))
    if edges.isEmpty():
        return parts.withColumnRenamed("_part", "component")
    roots = _spread(edges)
    return (
        parts.join(roots, parts._part == roots.node, "left")
        .withColumn("component", F.coalesce("label", "_part"))
        .select(*by, "row", "c0", "c1", "component")
    )


def component_sizes(labelled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return labelled.groupBy(*by, "component").agg(
        F.sum(F.col("c1") - F.col("c0") + 1).alias("pixels")
    )


def remove_small_runs(
    runs: DataFrame, min_size: int = 50, by: Sequence[str] = (), tile: int = 512
) -> DataFrame:
    """Runs of the components holding at least ``min_size`` pixels."""
    labelled = label_runs(runs, by, tile)
    big = component_sizes(labelled, by).where(F.col("pixels") >= min_size)
    return labelled.join(big, [*by, "component"], "left_semi").select(*by, "row", "c0", "c1")


def remove_small_components(
    mask: DataFrame, min_size: int = 50, by: Sequence[str] = (), tile: int = 512
) -> DataFrame:
    return to_pixels(remove_small_runs(to_runs(mask, by), min_size, by, tile), by)
