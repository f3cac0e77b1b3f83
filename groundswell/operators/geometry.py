"""Grids and shapes: calibration tables, resampling, geocoding, rasterising, deramping."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundswell.frames import attach, materialized, small, val
from groundswell.functions.geodesy import Grid, project_utm, to_crs


# --- Calibration ----------------------------------------------------------------------


#: Table nodes (with their lines and pixels spread to indexes) of the scenes that one broadcast holds.
BLOCK_NODES = 4_000_000


def lut_tables(lut: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per table: sorted lines and pixels, the values row by row, and for each integer line
    and pixel inside the table the number of the node before it.

    A table must be a full grid of its lines and pixels; a hole is an error, not a lost pixel.
    """
    nodes = lut.groupBy(*by).agg(
        F.array_sort(F.collect_set("line")).alias("_lines"), F.array_sort(F.collect_set("pixel")).alias("_pixels"),
        F.array_sort(F.collect_list(F.struct("line", "pixel", F.col("value").cast("double").alias("value")))).alias("_nodes"))
    full = F.size("_nodes") == F.size("_lines") * F.size("_pixels")

    def before(name: str) -> Column:
        spots = F.col(name)
        gaps = F.transform(F.slice(spots, 2, F.greatest(F.size(spots) - 1, F.lit(0))),
                           lambda end, i: F.array_repeat(i, (end - spots[i]).cast("int")))
        return F.flatten(gaps)

    return nodes.select(
        *by, "_lines", "_pixels", F.when(full, F.col("_nodes.value")).otherwise(
            F.raise_error(F.lit("a calibration table is not a full grid")).cast("array<double>")).alias("_values"),
        before("_lines").alias("_line_at"), before("_pixels").alias("_pixel_at"))


def _calibrated(located: DataFrame, by: Sequence[str]) -> DataFrame:
    """sigma0 of pixels that stand beside their table: lookups by place, no search."""

    def axis(x: str, nodes: str, at: str) -> tuple[Column, Column, Column]:
        spots = F.col(nodes)
        held = F.least(F.greatest(F.col(x), spots[0]), F.element_at(spots, -1))
        i = F.coalesce(F.get(at, F.least(held, F.element_at(spots, -1) - 1) - spots[0]), F.lit(0))
        j = F.least(i + 1, F.size(spots) - 1)
        wide = (F.get(spots, j) - F.get(spots, i)).cast("double")
        return i, j, F.when(wide > 0, (held - F.get(spots, i)) / wide).otherwise(F.lit(0.0))

    i0, i1, fy = axis("row", "_lines", "_line_at")
    j0, j1, fx = axis("col", "_pixels", "_pixel_at")
    places = located.withColumns({"_i0": i0, "_i1": i1, "_fy": fy, "_j0": j0, "_j1": j1, "_fx": fx})
    width = F.size("_pixels")

    def node(i: str, j: str) -> Column:
        return F.get("_values", F.col(i) * width + F.col(j))

    left = node("_i0", "_j0") * (1 - F.col("_fy")) + node("_i1", "_j0") * F.col("_fy")
    right = node("_i0", "_j1") * (1 - F.col("_fy")) + node("_i1", "_j1") * F.col("_fy")
    raw = left * (1 - F.col("_fx")) + right * F.col("_fx")
    gain = F.when(F.col("_gain") == 0, F.lit(1.0)).otherwise(F.col("_gain"))
    return places.select(*by, "row", "col", "value", raw.alias("_gain")).select(
        *by, "row", "col", (val() * val() / (gain * gain)).alias("value"))


def calibrate(dn: DataFrame, lut: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """sigma0 = DN^2 / LUT^2, the table bilinear in line and pixel, held past its ends and across
    an axis with a single node.

    A table is one row of arrays.  Scenes are taken in blocks of at most ``BLOCK_NODES`` array entries
    (some 30 MB), whose tables are broadcast: pixels are never shuffled, and a reader prunes the
    pixels of a block by its keys.  A scene without a table drops out.
    """
    by = list(by)
    if not by:
        return _calibrated(attach(dn, lut_tables(lut)), by)
    tables = materialized(lut_tables(lut, by))
    size = F.size("_values") + F.size("_line_at") + F.size("_pixel_at")
    blocks: list[list] = [[]]
    held = 0
    for row in tables.select(*by, size.alias("_n")).orderBy(*by).collect():  # one short row per scene
        if blocks[-1] and held + row["_n"] > BLOCK_NODES:
            blocks.append([])
            held = 0
        blocks[-1].append(tuple(row)[:-1])
        held += row["_n"]
    parts = []
    for block in blocks:
        keys = F.struct(*by).isin([F.struct(*[F.lit(v) for v in key]) for key in block]) if len(by) > 1 else (
            F.col(by[0]).isin([key[0] for key in block]))
        side = F.broadcast(tables.where(keys))  # bounded by BLOCK_NODES
        parts.append(_calibrated(dn.where(keys).join(side, by), by))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- Grids and resampling -------------------------------------------------------------


def target_grid(spark: SparkSession, source: Grid, epsg: int, resolution: float) -> Grid:
    """Grid in another CRS covering the source's densified outline.

    The outline is a few hundred points whatever the raster size; its box comes
    back as one row.
    """
    n = 21
    step = F.col("id") % (n + 1) / F.lit(float(n))
    side = F.floor(F.col("id") / (n + 1))
    outline = spark.range(4 * (n + 1)).select(
        F.when(side == 0, step * source.width).when(side == 1, F.lit(float(source.width)))
        .when(side == 2, step * source.width).otherwise(0.0).alias("col"),
        F.when(side == 0, 0.0).when(side == 1, step * source.height)
        .when(side == 2, F.lit(float(source.height))).otherwise(step * source.height).alias("row"),
    )
    x, y = to_crs(*source.xy(F.col("row"), F.col("col")), source.epsg, epsg)
    box = outline.select(x.alias("x"), y.alias("y")).agg(
        F.min("x"), F.min("y"), F.max("x"), F.max("y")
    ).first()
    west, south, east, north = box
    width = max(1, -int(-(east - west) // resolution))
    height = max(1, -int(-(north - south) // resolution))
    return Grid(height, width, resolution, 0.0, west, 0.0, -resolution, north, epsg)


def grid_pixels(spark: SparkSession, grid: Grid) -> DataFrame:
    """Every (row, col) of a grid, made in parallel."""
    return spark.range(grid.height * grid.width).select(
        F.floor(F.col("id") / grid.width).cast("int").alias("row"),
        (F.col("id") % grid.width).cast("int").alias("col"),
    )


#: Edge of a source tile for bilinear sampling, and target pixels of one tile at most about.
TILE, TILE_TARGETS = 128, 1 << 18


def _tile_edge(source: Grid, target: Grid) -> int:
    """A finer target has more pixels a source tile: tiles get smaller, so that their work stays the same."""
    finer = target.height * target.width / max(1, source.height * source.width)
    edge = TILE
    while edge > 1 and finer * edge * edge > TILE_TARGETS:
        edge //= 2
    return edge


def gather_bilinear(tile: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Bilinear values of a tile (NaN for no data) at fractional places counted in pixel centres.

    No-data corners drop out and the other weights are rescaled; NaN where none is left.
    """
    r, c = np.floor(y).astype(int), np.floor(x).astype(int)
    fy, fx = y - r, x - c
    total, weight = np.zeros(len(y)), np.zeros(len(y))
    for dr, dc, w in ((0, 0, (1 - fy) * (1 - fx)), (0, 1, (1 - fy) * fx), (1, 0, fy * (1 - fx)), (1, 1, fy * fx)):
        v = tile[r + dr, c + dc]
        there = ~np.isnan(v)
        total += np.where(there, w * v, 0.0)
        weight += np.where(there, w, 0.0)
    return np.where(weight > 0, total / np.where(weight > 0, weight, 1.0), np.nan)


def _sampled(places: DataFrame, df: DataFrame, edge: int, by: list[str]) -> DataFrame:
    """Values of ``df`` at ``places`` (by, row, col and the fractional place _y, _x), tile by tile.

    A place goes to the source tile of its upper left neighbour; a tile holds one row and column
    more than its own.  Each side is shuffled once; a pixel on two tiles' seam goes to both.
    """
    tile = ["_tr", "_tc"]
    of = [F.floor((F.col(n)) / edge).cast("int").alias(t) for n, t in zip(("_y", "_x"), tile)]
    asked = places.select(*by, "row", "col", "_y", "_x", *of)
    shares = F.array(*[F.struct(
        F.floor((F.col("row") - dr) / edge).cast("int").alias("_tr"), F.floor((F.col("col") - dc) / edge).cast("int").alias("_tc"))
        for dr in (0, 1) for dc in (0, 1)])
    held = df.where(val().isNotNull()).select(
        *by, "row", "col", val().cast("double").alias("value"), F.inline(F.array_distinct(shares)))
    out = places.select(*by, "row", "col").schema.add("value", "double")
    names = out.names

    def meet(source: pa.Table, targets: pa.Table) -> pa.Table:
        if not targets.num_rows:
            return targets.select(names[:-1]).append_column("value", pa.array([], pa.float64()))
        r0, c0 = (targets.column(t)[0].as_py() * edge for t in tile)
        image = np.full((edge + 1, edge + 1), np.nan)
        image[source.column("row").to_numpy() - r0, source.column("col").to_numpy() - c0] = source.column("value").to_numpy()
        values = gather_bilinear(image, targets.column("_y").to_numpy() - r0, targets.column("_x").to_numpy() - c0)
        return targets.select(names[:-1]).append_column("value", pa.array(values, pa.float64(), mask=np.isnan(values)))

    keys = [*by, *tile]
    return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(meet, out)


def resample(
    df: DataFrame, source: Grid, target: Grid, method: str = "bilinear", by: Sequence[str] = ()
) -> DataFrame:
    """Values of ``df`` on another grid; NULL outside it.

    Target pixels are carried back to the source grid.  Nearest is one equi-join.  Bilinear meets by
    source tile and gathers a tile's pixels at once; NULL corners drop out and the other weights
    are rescaled.
    """
    if method not in ("bilinear", "nearest"):
        raise ValueError(f"unknown resampling {method!r}")
    by = list(by)
    spark = df.sparkSession
    pixels = grid_pixels(spark, target)
    if by:
        pixels = df.select(*by).distinct().select(
            *by, F.explode(F.sequence(F.lit(0), F.lit(target.height - 1))).alias("row")
        ).repartition(*by, "row").select(
            *by, "row", F.explode(F.sequence(F.lit(0), F.lit(target.width - 1))).alias("col")
        )
    x, y = target.xy(F.col("row") + 0.5, F.col("col") + 0.5)
    sx, sy = to_crs(x, y, target.epsg, source.epsg)
    srow, scol = source.rowcol(sx, sy)
    at = pixels.select(*by, "row", "col", srow.alias("_y"), scol.alias("_x"))
    if method == "nearest":
        at = at.select(
            *by, "row", "col", F.floor("_y").cast("int").alias("_r"),
            F.floor("_x").cast("int").alias("_c"),
        )
        src = df.select(*by, F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
        return at.join(src, [*by, "_r", "_c"], "left").select(*by, "row", "col", "value")

    at = at.withColumns({"_y": F.col("_y") - 0.5, "_x": F.col("_x") - 0.5})
    inside = (
        (F.col("_y") >= -0.5) & (F.col("_y") < source.height - 0.5)
        & (F.col("_x") >= -0.5) & (F.col("_x") < source.width - 0.5)
    )
    beyond = at.where(~F.coalesce(inside, F.lit(False))).select(*by, "row", "col", F.lit(None).cast("double").alias("value"))
    return _sampled(at.where(inside), df, _tile_edge(source, target), by).union(beyond)


def align_to(
    df: DataFrame, source: Grid, target: Grid, method: str = "bilinear", by: Sequence[str] = ()
) -> DataFrame:
    """Resample onto another raster's grid; nothing to do when the grids are equal."""
    return df if source == target else resample(df, source, target, method, by)


def scatter_geocode(
    samples: DataFrame, epsg: int, resolution: float,
    bounds: tuple[float, float, float, float] | None = None, order: str = "src_index",
    by: Sequence[str] = (),
) -> DataFrame:
    """Place ``(lon, lat, value)`` samples on a regular UTM grid; the last sample wins."""
    by = list(by)
    x, y = project_utm(F.col("lon"), F.col("lat"), epsg)
    placed = samples.where(
        val().isNotNull() & F.col("lon").isNotNull() & F.col("lat").isNotNull()
    ).select(*by, order, "value", x.alias("_x"), y.alias("_y"))
    if bounds is None:
        edges = placed.groupBy(*by).agg(
            F.min("_x").alias("_x0"), F.min("_y").alias("_y0"),
            F.max("_x").alias("_x1"), F.max("_y").alias("_y1"),
        )
        placed = attach(placed, edges, by)
    else:
        placed = placed.withColumns(
            {n: F.lit(float(b)) for n, b in zip(("_x0", "_y0", "_x1", "_y1"), bounds)}
        )
    # A cast to int drops the fraction toward zero, so samples just outside the first
    # row or column still land on it.
    row = ((F.col("_y1") - F.col("_y")) / resolution).cast("int")
    col = ((F.col("_x") - F.col("_x0")) / resolution).cast("int")
    height = F.ceil((F.col("_y1") - F.col("_y0")) / resolution)
    width = F.ceil((F.col("_x1") - F.col("_x0")) / resolution)
    return (
        placed.withColumns({"row": row, "col": col})
        .where((F.col("row") >= 0) & (F.col("row") < height)
               & (F.col("col") >= 0) & (F.col("col") < width))
        .groupBy(*by, "row", "col").agg(F.max_by("value", order).alias("value"))
    )


def sample_points(
    df: DataFrame, points: DataFrame, grid: Grid, by: Sequence[str] = ()
) -> DataFrame:
    """Raster value under each point ``(point_id, x, y)``; NULL for no data."""
    row, col = grid.rowcol(F.col("x"), F.col("y"))
    at = points.withColumns({
        "row": F.floor(row).cast("int"), "col": F.floor(col).cast("int")
    })
    keys = [*by, "row", "col"]
    pixels = df.select(*keys, "value")
    wanted = small(at.select(*keys).distinct(), write=False)
    # Few points: only the pixels under them travel.
    return at.join(pixels.join(wanted, keys, "left_semi"), keys, "left")


# --- Shapes to pixels -----------------------------------------------------------------


def _edges(points: DataFrame, keys: Sequence[str], closed: bool) -> DataFrame:
    """Consecutive points of each shape as ``x, y, x1, y1``.

    A point meets its successor in an equi-join on (shape, seq), so a coastline with a
    third of all points is spread like any other shape.
    """
    nxt = points.select(
        *keys, (F.col("seq") - 1).alias("seq"), F.col("x").alias("x1"), F.col("y").alias("y1")
    )
    if closed:
        last = points.groupBy(*keys).agg(F.max("seq").alias("seq"))
        first = points.where(F.col("seq") == 0).select(
            *keys, F.col("x").alias("x1"), F.col("y").alias("y1")
        )
        nxt = nxt.unionByName(first.join(last, list(keys)))
    return points.join(nxt, [*keys, "seq"]).select(*keys, "x", "y", "x1", "y1")


def polygon_runs(
    vertices: DataFrame, height: int, width: int, by: Sequence[str] = ()
) -> DataFrame:
    """Row runs inside polygons by the pixel-centre rule.

    ``vertices(feature_id, seq, x, y)`` are in pixel units, ``seq`` counting 0, 1, 2, ...  Each edge meets the row
    centres it spans; sorted crossings of a row pair up by the even-odd rule, over all rings of a
    feature: with a ``ring_id`` column a feature has several parts and holes.
    """
    ring = ["ring_id"] if "ring_id" in vertices.columns else []
    edges = _edges(vertices, [*by, "feature_id", *ring], closed=True)
    low, high = F.least("y", "y1"), F.greatest("y", "y1")
    r0 = F.greatest(F.ceil(low - 0.5), F.lit(0)).cast("int")
    r1 = F.least(F.ceil(high - 0.5) - 1, F.lit(height - 1)).cast("int")
    slope = (F.col("x1") - F.col("x")) / (F.col("y1") - F.col("y"))
    crossings = (
        edges.withColumns({"_r0": r0, "_r1": r1}).where(F.col("_r0") <= F.col("_r1"))
        .select("*", F.explode(F.sequence("_r0", "_r1")).alias("row"))
        .select(*by, "feature_id", "row",
                (F.col("x") + (F.col("row") + 0.5 - F.col("y")) * slope).alias("_x"))
    )
    in_row = Window.partitionBy(*by, "feature_id", "row").orderBy("_x")
    return (
        crossings.withColumns({"_k": F.row_number().over(in_row), "_end": F.lead("_x").over(in_row)})
        .where((F.col("_k") % 2 == 1) & F.col("_end").isNotNull())
        .select(
            *by, "feature_id", "row",
            F.greatest(F.ceil(F.col("_x") - 0.5), F.lit(0)).cast("int").alias("c0"),
            F.least(F.ceil(F.col("_end") - 0.5) - 1, F.lit(width - 1)).cast("int").alias("c1"),
        )
        .where(F.col("c0") <= F.col("c1"))
    )


def to_pixel_units(vertices: DataFrame, grid: Grid, epsg: int | None = None) -> DataFrame:
    """Vertices from map coordinates (``epsg``, the grid's own if not given) to pixel units."""
    x, y = to_crs(F.col("x"), F.col("y"), grid.epsg if epsg is None else epsg, grid.epsg)
    return vertices.withColumns({"_x": x, "_y": y}).withColumns(
        dict(zip(("y", "x"), grid.rowcol(F.col("_x"), F.col("_y"))))
    ).drop("_x", "_y")


#: Pixels that one task spreads polygons to.
TASK_PIXELS = 1_000_000


def rasterize_polygons(
    vertices: DataFrame, height: int, width: int, by: Sequence[str] = ()
) -> DataFrame:
    """Sparse mask of the union of polygons.

    Runs of a row are merged before they are spread to pixels, so no pixel is made twice.  Merged runs are stored
    and counted, and dealt to a task for every ``TASK_PIXELS``: a polygon is a few short rows before that.
    """
    runs = polygon_runs(vertices, height, width, by)
    so_far = Window.partitionBy(*by, "row").orderBy("c0", "c1").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("c1").over(so_far), F.lit(-1))
    fresh = runs.select(*by, "row", F.greatest("c0", reach + 1).alias("c0"), "c1")
    fresh = materialized(fresh.where("c0 <= c1"))
    pixels = fresh.agg(F.sum(F.col("c1").cast("long") - F.col("c0") + 1)).first()[0] or 0
    return fresh.repartition(1 + pixels // TASK_PIXELS, *by, "row").select(
        *by, "row", F.explode(F.sequence("c0", "c1")).alias("col"))


def polygons_or_box(
    vertices: DataFrame, box: Sequence[float]
) -> DataFrame:
    """The polygons, or the area of interest as one polygon when there are none."""
    x0, y0, x1, y1 = (float(v) for v in box)
    spark = vertices.sparkSession
    corners = [(0, x0, y0), (1, x1, y0), (2, x1, y1), (3, x0, y1)]
    spare = spark.range(1).select(
        F.inline(F.array(*[
            F.struct(F.lit(0).alias("feature_id"), F.lit(s).alias("seq"),
                     F.lit(x).alias("x"), F.lit(y).alias("y"))
            for s, x, y in corners
        ]))
    )
    any_row = vertices.agg(F.count("*").alias("n")).scalar()
    names = ["feature_id", "seq", "x", "y"]
    if "ring_id" in vertices.columns:
        names, spare = [*names, "ring_id"], spare.withColumn("ring_id", F.lit(0))
    spare = spare.where(any_row == 0).select(*[F.col(c).cast(vertices.schema[c].dataType) for c in names])
    return vertices.select(*names).unionByName(spare)


def features_in_box(vertices: DataFrame, box: Sequence[float]) -> DataFrame:
    """Features whose bounds overlap the box (x0, y0, x1, y1)."""
    x0, y0, x1, y1 = (float(v) for v in box)
    hits = vertices.groupBy("feature_id").agg(
        F.min("x").alias("a"), F.max("x").alias("b"), F.min("y").alias("c"), F.max("y").alias("d")
    ).where((F.col("a") <= x1) & (F.col("b") >= x0) & (F.col("c") <= y1) & (F.col("d") >= y0))
    return vertices.join(hits.select("feature_id"), "feature_id", "left_semi")


def waterway_filter(ways: DataFrame, box: Sequence[float] | None = None) -> DataFrame:
    """Ways with at least two nodes that are tagged as waterways other than rivers."""
    tagged = ways.where(F.col("waterway").isNotNull() & (F.col("waterway") != "river"))
    long = tagged.groupBy("way_id").agg(
        F.count("*").alias("_n"), F.min("x").alias("a"), F.max("x").alias("b"),
        F.min("y").alias("c"), F.max("y").alias("d"),
    ).where(F.col("_n") >= 2)
    if box is not None:
        x0, y0, x1, y1 = (float(v) for v in box)
        long = long.where(
            (F.col("a") <= x1) & (F.col("b") >= x0) & (F.col("c") <= y1) & (F.col("d") >= y0)
        )
    return tagged.join(long.select("way_id"), "way_id", "left_semi")


def rasterize_lines(
    nodes: DataFrame, height: int, width: int, by: Sequence[str] = ()
) -> DataFrame:
    """Every cell a polyline passes through.  ``nodes(way_id, seq, x, y)`` in pixel units,
    ``seq`` counting 0, 1, 2, ...

    A segment is cut wherever it meets a row or column line; each piece lies in one
    cell, which its midpoint names.
    """
    seg = _edges(nodes, [*by, "way_id"], closed=False)

    def cuts(a: str, b: str) -> Column:
        lo, hi = F.floor(F.least(a, b)) + 1, F.ceil(F.greatest(a, b)) - 1
        lines = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(lines, lambda k: (k - F.col(a)) / (F.col(b) - F.col(a)))

    ends = F.array(F.lit(0.0), F.lit(1.0))
    seg = seg.withColumn("_t", F.array_sort(F.concat(ends, cuts("x", "x1"), cuts("y", "y1"))))
    pairs = F.arrays_zip(
        F.slice("_t", F.lit(1), F.size("_t") - 1).alias("a"),
        F.slice("_t", F.lit(2), F.size("_t") - 1).alias("b"),
    )
    mid = (F.col("a") + F.col("b")) / 2
    return (
        seg.select(*by, "x", "y", "x1", "y1", F.inline(pairs))
        .select(
            *by,
            F.floor(F.col("y") + mid * (F.col("y1") - F.col("y"))).cast("int").alias("row"),
            F.floor(F.col("x") + mid * (F.col("x1") - F.col("x"))).cast("int").alias("col"),
        )
        .where((F.col("row") >= 0) & (F.col("row") < height)
               & (F.col("col") >= 0) & (F.col("col") < width))
        .distinct()
    )


# --- Ramps ----------------------------------------------------------------------------


def fit_ramp(df: DataFrame, by: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Least-squares plane c0 + c1*row + c2*col per raster, from one grouped aggregate.

    Fewer than three valid pixels give a zero plane; positions along one line give the
    smallest slopes that fit.
    """
    v = F.col(value)
    r, c = (F.when(v.isNotNull(), F.col(n).cast("double")) for n in ("row", "col"))
    m = df.groupBy(*by).agg(
        F.count(v).alias("_n"), F.avg(r).alias("_r"), F.avg(c).alias("_c"), F.avg(v).alias("_m"),
        F.var_pop(r).alias("_rr"), F.var_pop(c).alias("_cc"), F.covar_pop(r, c).alias("_rc"),
        F.covar_pop(r, v).alias("_rv"), F.covar_pop(c, v).alias("_cv"),
    )
    rr, cc, rc, rv, cv = (F.col(n) for n in ("_rr", "_cc", "_rc", "_rv", "_cv"))
    det, trace = rr * cc - rc * rc, rr + cc
    full = det > trace * trace * 1e-12
    slope = lambda top, flat: (
        F.when(F.col("_n") < 3, 0.0).when(full, top / det)
        .when(trace > 0, flat / trace).otherwise(0.0)
    )
    c1, c2 = slope(cc * rv - rc * cv, rv), slope(rr * cv - rc * rv, cv)
    return m.withColumns({"c1": c1, "c2": c2}).select(
        *by, "c1", "c2",
        F.when(F.col("_n") < 3, 0.0).otherwise(
            F.col("_m") - F.col("c1") * F.col("_r") - F.col("c2") * F.col("_c")
        ).alias("c0"),
    )


def deramp(df: DataFrame, by: Sequence[str] = (), value: str = "value") -> DataFrame:
    plane = F.col("c0") + F.col("c1") * F.col("row") + F.col("c2") * F.col("col")
    return attach(df, fit_ramp(df, by, value), by).withColumn(
        value, F.col(value) - plane
    ).drop("c0", "c1", "c2")
