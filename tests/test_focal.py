"""Focal operators against plain numpy on small images, with tile seams inside the image."""

import time

import numpy as np
import pytest
from pixels import mask_array, to_array, to_mask, to_pixels
from pyspark.sql import functions as F

from groundswell.operators import focal as FO
from groundswell.operators import morphology as M
from groundswell.operators.components import component_sizes, label_runs, remove_small_components
from groundswell.operators.distance import distance_map, lower_envelope
from groundswell.plans import products as P


def reflected(a, r):
    return np.pad(a, r, mode="symmetric")


def median_brute(a, size):
    filled = np.where(np.isnan(a), np.nanmedian(a), a)
    p = reflected(filled, size // 2)
    out = np.array([[np.median(p[i : i + size, j : j + size]) for j in range(a.shape[1])]
                    for i in range(a.shape[0])])
    out[np.isnan(a)] = np.nan
    return out


@pytest.mark.parametrize("tile", [16, 512])
def test_median(spark, rng, tile):
    a = rng.normal(size=(37, 45))
    a[rng.random(a.shape) < 0.1] = np.nan
    got = to_array(FO.median_filter(to_pixels(spark, a), 9, tile=tile), a.shape)
    np.testing.assert_allclose(got, median_brute(a, 9))


def test_box_mean_and_lee(spark, rng):
    a = rng.exponential(1.0, (30, 41))
    p = reflected(a, 3)
    mean = np.array([[p[i : i + 7, j : j + 7].mean() for j in range(41)] for i in range(30)])
    np.testing.assert_allclose(to_array(FO.box_mean(to_pixels(spark, a), 7), a.shape), mean)
    lee = to_array(FO.lee_sigma(to_pixels(spark, a), 7), a.shape)
    assert lee.var() < a.var() and not np.isnan(lee).any()
    ones = np.ones((20, 20))
    np.testing.assert_allclose(to_array(FO.lee_sigma(to_pixels(spark, ones)), ones.shape), ones)
    with pytest.raises(ValueError):
        FO.lee_sigma(to_pixels(spark, ones), 6)


def test_keys_keep_rasters_apart(spark, rng):
    a, b = rng.normal(size=(20, 22)), rng.normal(size=(26, 18))
    both = to_pixels(spark, a).withColumn("raster_id", F.lit("a")).union(
        to_pixels(spark, b).withColumn("raster_id", F.lit("b")))
    for fn, ref in ((lambda d, by: FO.median_filter(d, 5, by=by, tile=16), lambda x: median_brute(x, 5)),):
        out = fn(both, ["raster_id"])
        for name, x in (("a", a), ("b", b)):
            np.testing.assert_allclose(
                to_array(out.where(F.col("raster_id") == name), x.shape), ref(x))


def dilate_brute(m, element):
    out = np.zeros_like(m)
    for r, c in zip(*np.nonzero(m)):
        for dy, half in element:
            if 0 <= r + dy < m.shape[0]:
                out[r + dy, max(c - half, 0) : c + half + 1] = True
    return out


def erode_brute(m, element):
    return ~dilate_brute(~m, element)


@pytest.mark.parametrize("element", [M.disk(1), M.disk(2), M.disk(3), M.square(2)])
def test_morphology(spark, rng, element):
    m = rng.random((25, 33)) < 0.25
    m[5:15, 20:33] = True
    mask, size = to_mask(spark, m), m.shape
    np.testing.assert_array_equal(mask_array(M.dilate(mask, element, size=size), size), dilate_brute(m, element))
    np.testing.assert_array_equal(mask_array(M.erode(mask, element, size=size), size), erode_brute(m, element))
    closed = erode_brute(dilate_brute(m, element), element)
    np.testing.assert_array_equal(mask_array(M.close(mask, element, size=size), size), closed)


def test_morphology_needs_the_size(spark):
    with pytest.raises(ValueError):
        M.dilate(to_mask(spark, np.eye(3, dtype=bool)), M.disk(1))


def components_brute(m):
    label, n = np.zeros(m.shape, int), 0
    for start in zip(*np.nonzero(m)):
        if label[start]:
            continue
        n += 1
        todo = [start]
        label[start] = n
        while todo:
            r, c = todo.pop()
            for q in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if 0 <= q[0] < m.shape[0] and 0 <= q[1] < m.shape[1] and m[q] and not label[q]:
                    label[q] = n
                    todo.append(q)
    return label


def spiral(n):
    """One thin path that winds through every tile: the slowest case for label spreading."""
    m = np.zeros((n, n), bool)
    r = c = 0
    dr, dc, left = 0, 1, n
    m[0, :] = True
    c = n - 1
    step = n - 1
    dr, dc = 1, 0
    while step > 1:
        for _ in range(2):
            for _ in range(step):
                r, c = r + dr, c + dc
                m[r, c] = True
            dr, dc = dc, -dr
        step -= 2
    return m


@pytest.mark.parametrize("tile", [8, 512])
@pytest.mark.parametrize("kind", ["noise", "spiral", "comb"])
def test_components(spark, rng, tile, kind):
    if kind == "noise":
        m = rng.random((40, 40)) < 0.55
    elif kind == "spiral":
        m = spiral(33)
    else:
        m = np.zeros((30, 31), bool)
        m[:, ::2] = True
        m[29, :] = True
    labels = components_brute(m)
    sizes = sorted(np.bincount(labels.ravel())[1:].tolist())
    labelled = label_runs(M.to_runs(to_mask(spark, m)), tile=tile)
    assert sorted(r["pixels"] for r in component_sizes(labelled).collect()) == sizes
    keep = np.isin(labels, [i for i in range(1, labels.max() + 1) if (labels == i).sum() >= 12])
    got = mask_array(remove_small_components(to_mask(spark, m), 12, tile=tile), m.shape)
    np.testing.assert_array_equal(got, keep)


def test_small_component_fixture(spark):
    m = np.zeros((100, 100), bool)
    m[20:40, 20:40] = True
    m[80, 80] = True
    got = mask_array(P.water_cleanup(to_mask(spark, m), 10, 0, size=m.shape), m.shape)
    assert got.sum() == 400 and not got[80, 80]


@pytest.mark.parametrize("px", [(1.0, 1.0), (10.0, 12.0)])
def test_distance(spark, rng, px):
    m = rng.random((40, 29)) < 0.02
    m[7, 3] = True
    a = np.zeros(m.shape)
    got = to_array(distance_map(to_pixels(spark, a), to_mask(spark, m), *px), m.shape, "distance")
    r, c = np.nonzero(m)
    rr, cc = np.indices(m.shape)
    want = np.sqrt(((rr[..., None] - r) * px[1]) ** 2 + ((cc[..., None] - c) * px[0]) ** 2).min(-1)
    np.testing.assert_allclose(got, want)


def test_distance_fixture_and_empty_mask(spark):
    a = np.zeros((50, 50))
    row = np.zeros_like(a, bool)
    row[25] = True
    d = to_array(distance_map(to_pixels(spark, a), to_mask(spark, row), 10.0), a.shape, "distance")
    assert (d[25] == 0).all() and (d[24] == 10).all()
    none = distance_map(to_pixels(spark, a), to_mask(spark, row).limit(0), 10.0)
    assert none.where("distance IS NOT NULL").count() == 0


def test_lower_envelope_brute(rng):
    f = rng.random((6, 50)) * 100
    f[rng.random(f.shape) < 0.5] = np.inf
    f[3] = np.inf
    x = np.arange(50) * 1.7
    want = ((x[:, None] - x[None, :]) ** 2 + f[:, None, :]).min(-1)
    want[np.isinf(want)] = np.nan
    np.testing.assert_allclose(lower_envelope(f, 1.7), want)


def goldstein_brute(z, alpha, patch=32, overlap=8):
    total, weight = np.zeros_like(z), np.zeros(z.shape)
    hann = np.outer(np.hanning(patch), np.hanning(patch))
    for r in range(0, z.shape[0] - patch + 1, patch - overlap):
        for c in range(0, z.shape[1] - patch + 1, patch - overlap):
            s = np.fft.fft2(z[r : r + patch, c : c + patch])
            p = np.abs(s)
            total[r : r + patch, c : c + patch] += np.fft.ifft2(s * (p / p.max()) ** alpha) * hann
            weight[r : r + patch, c : c + patch] += hann
    return np.where(weight > 0, total / np.where(weight > 0, weight, 1), z)


@pytest.mark.parametrize("tile", [24, 48, None])
def test_goldstein(spark, rng, tile):
    r, c = np.indices((100, 100))
    z = np.exp(1j * (0.05 * r + 0.03 * c + 0.3 * rng.normal(size=r.shape)))
    df = to_pixels(spark, z.real, "re").join(to_pixels(spark, z.imag, "im"), ["row", "col"])
    out = FO.goldstein(df, 0.8, tile=tile)
    got = to_array(out, z.shape, "re") + 1j * to_array(out, z.shape, "im")
    np.testing.assert_allclose(got, goldstein_brute(z, 0.8), atol=1e-9)
    same = FO.goldstein(df, 0.0, tile=tile)
    np.testing.assert_allclose(to_array(same, z.shape, "re"), z.real, atol=1e-9)


def test_goldstein_keeps_no_data(spark, rng):
    z = np.exp(1j * 0.4 * rng.normal(size=(70, 70)))
    gone = rng.random(z.shape) < 0.1
    gone[:32, :32] = True
    df = to_pixels(spark, np.where(gone, np.nan, z.real), "re").join(to_pixels(spark, np.where(gone, np.nan, z.imag), "im"), ["row", "col"])
    out = FO.goldstein(df, 0.7)
    got = to_array(out, z.shape, "re") + 1j * to_array(out, z.shape, "im")
    assert (np.isnan(got) == gone).all()
    total, weight = np.zeros_like(z), np.zeros(z.shape)
    hann = np.outer(np.hanning(32), np.hanning(32))
    for r in (0, 24):
        for c in (0, 24):
            part = (slice(r, r + 32), slice(c, c + 32))
            s = np.fft.fft2(np.where(gone, 0, z)[part])
            share = (~gone[part]).mean()
            if share:
                total[part] += np.fft.ifft2(s * (abs(s) / abs(s).max()) ** 0.7) * hann * share
                weight[part] += hann * share
    want = np.where(weight > 0, total / np.where(weight > 0, weight, 1), z)
    np.testing.assert_allclose(got[~gone], want[~gone], atol=1e-9)
    sparse = FO.goldstein(df.where("re IS NOT NULL"), 0.7, dims=(70, 70))
    assert sparse.count() == (~gone).sum()


def test_goldstein_alpha_range(spark):
    df = spark.createDataFrame([(0, 0, 1.0, 0.0)], "row int, col int, re double, im double")
    with pytest.raises(ValueError):
        FO.goldstein(df, 1.5)


def test_ridge_seams_and_lines(spark, rng):
    a = 1.0 + 0.01 * rng.random((60, 70))
    a[:, 30:32] = 0.2
    whole = FO.ridge_strength(np.pad(a, 14, mode="symmetric"), (1, 2, 3))[14:-14, 14:-14]
    for tile in (16, 256):
        got = to_array(FO.ridge_map(to_pixels(spark, a), tile=tile), a.shape, "ridge")
        np.testing.assert_allclose(got, whole, atol=1e-9)
    mask = mask_array(FO.ridge_mask(to_pixels(spark, a), percentile=95.0), a.shape)
    assert mask[:, 30:32].all() and mask[:, :20].sum() == 0
    flat = FO.ridge_map(to_pixels(spark, np.ones((30, 30))))
    assert flat.agg(F.max("ridge")).first()[0] == pytest.approx(0.0, abs=1e-9)


def brute_median(a, size):
    """Median of reflected windows; gaps take the median of the image."""
    fill = np.nanmedian(a)
    x = np.pad(np.where(np.isnan(a), fill, a), size // 2, "symmetric")
    out = np.median(np.lib.stride_tricks.sliding_window_view(x, (size, size)), (2, 3))
    return np.where(np.isnan(a), np.nan, out)


@pytest.mark.parametrize("shape", [(3, 40), (1, 1), (2, 3), (24, 24), (20, 4)])
@pytest.mark.parametrize("sparse", [False, True])
def test_median_of_any_shape_with_gaps(spark, rng, shape, sparse):
    a = rng.normal(size=shape)
    a[rng.random(shape) < 0.3] = np.nan
    a[-1, -1] = 0.5
    px = to_pixels(spark, a)
    got = FO.median_filter(px.where("value is not null") if sparse else px, 9, tile=8)
    np.testing.assert_allclose(to_array(got, shape), brute_median(a, 9))


@pytest.mark.parametrize("name", ["box", "lee", "ridge", "goldstein"])
def test_absent_pixels_count_as_null(spark, rng, name):
    a = rng.random((30, 26)) + 0.1
    a[rng.random(a.shape) < 0.3] = np.nan
    px = to_pixels(spark, a)

    def run(df):
        if name == "box":
            return FO.box_mean(df, 5, dims=a.shape), "value"
        if name == "lee":
            return FO.lee_sigma(df, 5, dims=a.shape), "value"
        if name == "ridge":
            return FO.ridge_map(df, tile=12, dims=a.shape), "ridge"
        waves = df.select("row", "col", F.cos("value").alias("re"), F.sin("value").alias("im"))
        return FO.goldstein(waves, patch=8, overlap=4, dims=a.shape), "re"

    whole, sparse = (to_array(df.select("row", "col", v), a.shape, v) for df, v in
                     (run(px), run(px.where("value is not null"))))
    there = ~np.isnan(a)
    np.testing.assert_allclose(sparse[there], whole[there])
    assert np.isnan(sparse[~there]).all()


@pytest.mark.parametrize("strip", [1, 3, 32])
def test_distance_with_absent_pixels_and_a_mask_beyond_them(spark, rng, strip):
    shape = (23, 31)
    m = rng.random(shape) < 0.03
    m[0, 3] = m[22, 30] = True
    px = to_pixels(spark, np.zeros(shape))
    some = px.where("(row * 7 + col * 3) % 10 > 6 and row > 2")
    got = to_array(distance_map(some, to_mask(spark, m), 10.0, 12.0, strip_rows=strip), shape, "distance")
    rr, cc = np.nonzero(m)
    r, c = np.indices(shape)
    want = np.sqrt(((r[..., None] - rr) * 12.0) ** 2 + ((c[..., None] - cc) * 10.0) ** 2).min(-1)
    there = ((r * 7 + c * 3) % 10 > 6) & (r > 2)
    np.testing.assert_allclose(got[there], want[there])
    assert np.isnan(got[~there]).all()


def test_tiles_keep_origin_and_gaps(spark, rng):
    from groundswell.sources import raster as RS

    a = rng.normal(size=(40, 50))
    px = to_pixels(spark, a).where("row >= 3 and col >= 5 and (row + col) % 4 > 0").withColumn("raster_id", F.lit("r"))
    back = RS.from_tiles(RS.to_tiles(px, 16), 16)
    assert sorted(map(tuple, back.select("row", "col", "value").collect())) == sorted(
        map(tuple, px.select("row", "col", "value").collect()))


@pytest.mark.parametrize("width", [1, 2, 3, 7, 64, 65, 301])
def test_min_plus_equals_all_pairs(rng, width):
    from groundswell.operators.distance import lower_envelope

    f = rng.integers(0, 9, (12, width)).astype(float) ** 2
    f[rng.random(f.shape) < 0.6] = np.inf
    f[3] = np.inf
    i = np.arange(width)
    want = np.where(np.isfinite(f).any(1)[:, None], ((1.5 * (i[:, None] - i[None, :])) ** 2 + f[:, None, :]).min(2), np.nan)
    np.testing.assert_allclose(lower_envelope(f, 1.5), want)


def test_column_distances_equal_all_rows(rng):
    from groundswell.operators.distance import column_distances

    m, mc = rng.integers(0, 60, 30), rng.integers(0, 9, 30)
    got = column_distances(m, mc, 20, 8, 10)
    for k in range(8):
        for c in range(10):
            assert got[k, c] == min((abs(20 + k - x) for x, y in zip(m, mc) if y == c), default=np.inf)


def test_strips_have_no_loop_over_rows_or_columns():
    import ast
    import inspect

    from groundswell.operators import distance

    for f in (distance.column_distances, distance.distance_map, distance._seeds):
        assert not [n for n in ast.walk(ast.parse(inspect.getsource(f))) if isinstance(n, (ast.For, ast.While))]
    start = time.perf_counter()
    distance.lower_envelope(np.where(np.arange(32 * 20_000).reshape(32, -1) % 997 == 0, 0.0, np.inf), 1.0)
    assert time.perf_counter() - start < 10
