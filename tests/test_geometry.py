import numpy as np
import pytest
from pixels import mask_array, to_array, to_pixels
from pyspark.sql import functions as F

from groundswell.functions.geodesy import Grid
from groundswell.operators import composite as C
from groundswell.operators import geometry as G


def test_deramp_fixture(spark, rng):
    r, c = np.indices((100, 100))
    a = 0.01 * r + 0.02 * c + 1 + 0.1 * rng.normal(size=r.shape)
    a[3, 4] = np.nan
    out = to_array(G.deramp(to_pixels(spark, a)), a.shape)
    ok = ~np.isnan(a)
    design = np.column_stack([np.ones(ok.sum()), r[ok], c[ok]])
    want = a.copy()
    want[ok] -= design @ np.linalg.lstsq(design, a[ok], rcond=None)[0]
    np.testing.assert_allclose(out, want, atol=1e-9)


def test_deramp_few_or_collinear_pixels(spark):
    two = to_pixels(spark, np.array([[1.0, 5.0]]))
    np.testing.assert_allclose(to_array(G.deramp(two), (1, 2)), [[1.0, 5.0]])
    line = to_pixels(spark, np.array([[1.0, 3.0, 5.0, 7.0]]))
    np.testing.assert_allclose(to_array(G.deramp(line), (1, 4)), 0.0, atol=1e-12)


def test_calibration_table(spark, rng):
    lines, pixels = [0, 10, 25], [0, 7, 20]
    lut = rng.uniform(50, 200, (3, 3))
    rows = [(l, p, float(lut[i, j])) for i, l in enumerate(lines) for j, p in enumerate(pixels)]
    table = spark.createDataFrame(rows, "line int, pixel int, value double")
    dn = rng.uniform(1, 100, (33, 28))
    by_line = np.array([[np.interp(r, lines, lut[:, j]) for j in range(3)] for r in range(33)])
    full = np.array([np.interp(np.arange(28), pixels, by_line[r]) for r in range(33)])
    got = to_array(G.calibrate(to_pixels(spark, dn), table), dn.shape)
    np.testing.assert_allclose(got, dn**2 / full**2)


def test_reprojection_equals_direct_lookup(spark, rng):
    a = rng.normal(size=(40, 50))
    src = Grid(40, 50, 0.0001, 0.0, 114.3, 0.0, -0.0001, -2.5, 4326)
    dst = G.target_grid(spark, src, 32649, 15.0)
    out = G.resample(to_pixels(spark, a), src, dst, "nearest")
    from groundswell.functions.geodesy import project_utm

    # Every source centre lies in the target; the target pixel holding it shows a near neighbour.
    lon, lat = src.xy(F.col("row") + 0.5, F.col("col") + 0.5)
    x, y = project_utm(lon, lat, 32649)
    row, col = dst.rowcol(x, y)
    at = to_pixels(spark, a).select(
        F.col("row").alias("r0"), F.col("col").alias("c0"), F.floor(row).cast("int").alias("row"),
        F.floor(col).cast("int").alias("col"))
    hits = at.join(out, ["row", "col"])
    assert hits.count() == a.size
    for h in hits.collect():
        if h["value"] is not None:
            near = a[max(h["r0"] - 2, 0) : h["r0"] + 3, max(h["c0"] - 2, 0) : h["c0"] + 3]
            assert h["value"] in near
    assert out.where("value IS NOT NULL").count() > 0.8 * dst.height * dst.width


def test_resample_keys_and_null_weights(spark):
    a = np.array([[1.0, np.nan], [3.0, 4.0]])
    src = Grid(2, 2, 2.0, 0, 0, 0, -2.0, 0)
    dst = Grid(1, 1, 2.0, 0, 1.0, 0, -2.0, -1.0)
    df = to_pixels(spark, a).withColumn("raster_id", F.lit("x"))
    got = G.resample(df, src, dst, "bilinear", ["raster_id"]).collect()
    assert len(got) == 1 and got[0]["value"] == pytest.approx((1 + 3 + 4) / 3)
    assert G.align_to(df, src, src) is df
    with pytest.raises(ValueError):
        G.resample(df, src, dst, "cubic")


def test_polygon_square_and_hole_free_union(spark):
    ring = [(1, 0, 2.0, 1.0), (1, 1, 6.0, 1.0), (1, 2, 6.0, 4.0), (1, 3, 2.0, 4.0),
            (2, 0, 4.0, 2.0), (2, 1, 9.0, 2.0), (2, 2, 9.0, 6.0), (2, 3, 4.0, 6.0)]
    v = spark.createDataFrame(ring, "feature_id int, seq int, x double, y double")
    want = np.zeros((8, 8), bool)
    want[1:4, 2:6] = True
    want[2:6, 4:8] = True
    np.testing.assert_array_equal(mask_array(G.rasterize_polygons(v, 8, 8), (8, 8)), want)


def test_polygon_pixels_are_made_by_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(G, "TASK_PIXELS", 1000, raising=False)
    ring = [(1, 0, 10.0, 0.0), (1, 1, 90.0, 0.0), (1, 2, 90.0, 200.0), (1, 3, 10.0, 200.0)]
    mask = G.rasterize_polygons(spark.createDataFrame(ring, "feature_id int, seq int, x double, y double"), 200, 100)
    want = np.zeros((200, 100), bool)
    want[:, 10:90] = True
    np.testing.assert_array_equal(mask_array(mask, want.shape), want)
    sizes = [r["count"] for r in mask.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 8 and max(sizes) < 4000


def test_concave_polygon(spark, rng):
    pts = [(70.1, 0.4), (110.3, 0.8), (90.5, 4.2), (112.6, 11.1), (71.3, 10.9)]
    v = spark.createDataFrame(
        [(1, i, x, y) for i, (x, y) in enumerate(pts)], "feature_id int, seq int, x double, y double")
    want = np.zeros((12, 125), bool)
    for r in range(12):
        for c in range(125):
            n = 0
            for (x0, y0), (x1, y1) in zip(pts, pts[1:] + pts[:1]):
                if (y0 <= r + 0.5) != (y1 <= r + 0.5):
                    n += c + 0.5 < x0 + (r + 0.5 - y0) / (y1 - y0) * (x1 - x0)
            want[r, c] = n % 2
    np.testing.assert_array_equal(mask_array(G.rasterize_polygons(v, 12, 125), want.shape), want)


def test_line_touches_every_cell(spark):
    nodes = spark.createDataFrame(
        [(1, 0, 1.5, 0.5), (1, 1, 41.5, 9.5), (2, 0, 80.2, 0.3), (2, 1, 81.7, 11.2), (3, 0, 5.5, 3.5)],
        "way_id int, seq int, x double, y double")
    got = mask_array(G.rasterize_lines(nodes, 12, 125), (12, 125))
    want = np.zeros((12, 125), bool)
    for (x0, y0), (x1, y1) in (((1.5, 0.5), (41.5, 9.5)), ((80.2, 0.3), (81.7, 11.2))):
        t = np.linspace(0, 1, 400001)
        want[np.floor(y0 + t * (y1 - y0)).astype(int), np.floor(x0 + t * (x1 - x0)).astype(int)] = True
    np.testing.assert_array_equal(got, want)


def test_multilook_drops_partial_blocks(spark, rng):
    a = rng.normal(size=(11, 29))
    got = to_array(C.multilook(to_pixels(spark, a), 3, 9), (3, 3))
    np.testing.assert_allclose(got, a[:9, :27].reshape(3, 3, 3, 9).mean(axis=(1, 3)))


def test_composite_rejects_unknown_method(spark):
    df = to_pixels(spark, np.ones((2, 2)))
    with pytest.raises(ValueError):
        C.temporal_composite(df, "mode")


def test_calibration_never_shuffles_pixels(spark, rng, monkeypatch):
    """Several blocks of scenes, single-node axes, and no exchange below the pixels."""
    monkeypatch.setattr(G, "BLOCK_NODES", 60)
    dn = np.round(rng.uniform(10, 500, (12, 10)))
    px = to_pixels(spark, dn).withColumn("scene_id", F.explode(F.sequence(F.lit(1), F.lit(5))))
    nodes = [(s, line, pixel, 2.0 + s + line + 3 * pixel) for s in range(1, 5)
             for line in ((2,) if s == 3 else (1, 5, 20)) for pixel in ((4,) if s == 4 else (0, 3, 8))]
    lut = spark.createDataFrame(nodes, "scene_id int, line int, pixel int, value double")
    out = G.calibrate(px, lut, ["scene_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") > 1
    got = {(r["scene_id"], r["row"], r["col"]): r["value"] for r in out.collect()}
    assert len(got) == 4 * dn.size
    for (s, r, c), v in got.items():
        line = 2 if s == 3 else min(max(r, 1), 20)
        pixel = 4 if s == 4 else min(max(c, 0), 8)
        assert v == pytest.approx(dn[r, c] ** 2 / (2.0 + s + line + 3 * pixel) ** 2)


def test_calibration_table_with_a_hole_fails(spark):
    lut = spark.createDataFrame([(0, 0, 1.0), (0, 5, 1.0), (5, 0, 1.0)], "line int, pixel int, value double")
    with pytest.raises(Exception, match="full grid"):
        G.calibrate(to_pixels(spark, np.ones((3, 3))), lut).collect()


@pytest.mark.parametrize("scale", [0.31, 1.0, 2.7])
def test_bilinear_tiles_equal_one_gather(spark, rng, monkeypatch, scale):
    """Seams of tiles, absent pixels, targets beyond the source, and finer and coarser targets."""
    monkeypatch.setattr(G, "TILE", 8)
    a = rng.normal(size=(37, 29))
    a[rng.random(a.shape) < 0.1] = np.nan
    src = Grid(37, 29, 2.0, 0.0, 10.0, 0.0, -2.0, 5.0)
    dst = Grid(40, 31, 2.0 * scale, 0.0, 7.3, 0.0, -2.0 * scale, 6.1)
    df = to_pixels(spark, a).where("NOT (row = 8 AND col >= 7)")
    a[8, 7:] = np.nan
    got = to_array(G.resample(df, src, dst), (40, 31))
    r, c = np.indices((40, 31)) + 0.5
    y, x = (5.0 - (6.1 - 2 * scale * r)) / 2 - 0.5, (7.3 + 2 * scale * c - 10.0) / 2 - 0.5
    wide = np.pad(a, 200, constant_values=np.nan)
    want = G.gather_bilinear(wide, y.ravel() + 200, x.ravel() + 200).reshape(40, 31)
    want[(y < -0.5) | (y >= 36.5) | (x < -0.5) | (x >= 28.5)] = np.nan
    np.testing.assert_allclose(got, want, atol=1e-9)


def test_bilinear_plan_shuffles_each_side_once(spark):
    src = Grid(300, 300, 1.0, 0, 0, 0, -1.0, 0)
    df = spark.range(90000).selectExpr("cast(id / 300 as int) row", "cast(id % 300 as int) col", "cast(id as double) value")
    plan = G.resample(df, src, Grid(200, 200, 1.4, 0, 0.2, 0, -1.4, -0.3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan
