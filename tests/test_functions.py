import math

import numpy as np
import pytest
from pixels import to_pixels
from pyspark.sql import functions as F

from groundswell.functions import geodesy, naming
from groundswell.functions import scalar as S
from groundswell.functions.special import incomplete_beta, t_two_sided
from groundswell.operators import algebra as A
from groundswell.operators import stats
from groundswell.sources.raster import canonical


def column(spark, values, expr, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_displacement(spark):
    assert column(spark, [2 * math.pi], S.phase_to_los)[0] == pytest.approx(0.028)
    v = column(spark, [-0.05], lambda x: S.displacement_to_velocity(x, 365.25))
    assert v[0] == pytest.approx(-50.0)
    with pytest.raises(ValueError):
        S.displacement_to_velocity(F.lit(1.0), 0)
    with pytest.raises(ValueError):
        S.los_to_vertical(F.lit(1.0), 90.0)


def test_clamp_keeps_null(spark):
    assert column(spark, [0.3, -0.9, None, 0.01], S.clamp_velocity) == [200.0, -200.0, None, 10.0]


def test_classes_and_water(spark):
    assert column(spark, [-60.0, -30.0, -10.0, 5.0, None, 0.0], S.subsidence_class) == [1, 2, 3, 5, 0, 4]
    assert column(spark, [-50.0, -20.0, -5.0], S.subsidence_class) == [2, 3, 4]
    df = spark.createDataFrame([(0, 0, -60.0), (0, 1, -30.0), (0, 2, None)], "row int, col int, value double")
    water = spark.createDataFrame([(0, 0), (0, 2)], "row int, col int")
    got = {r["col"]: r["class"] for r in A.classify(df, water).collect()}
    assert got == {0: 6, 1: 2, 2: 6}


def test_risks(spark):
    assert column(spark, [0.0, 500.0, 1000.0, 2000.0], lambda x: S.proximity_risk(x, 1000.0)) == [1, .5, 0, 0]
    assert column(spark, [-100.0, -50.0, -25.0, 0.0, 10.0, None],
                  lambda x: S.subsidence_risk(x, -50.0)) == [1, 1, .5, 0, 0, 0]
    got = column(spark, [1.0, 0.0], lambda x: S.combined_risk(x, F.lit(1.0) - x, 0.4, 0.6))
    assert got == pytest.approx([0.4, 0.6])


def test_indices(spark):
    df = spark.createDataFrame([(.8, .1), (.1, .8), (.5, .5), (0., 0.)], "n double, r double")
    got = [r[0] for r in df.select(S.ndvi(F.col("n"), F.col("r"))).collect()]
    assert got[:3] == pytest.approx([7 / 9, -7 / 9, 0.0]) and got[3] is None


def test_nodata_nan_and_infinity_become_null(spark):
    df = spark.createDataFrame(
        [(0, -9999.0), (1, float("nan")), (2, float("inf")), (3, -30.0), (4, None)], "i int, value double")
    assert [r["value"] for r in canonical(df).orderBy("i").collect()] == [None, None, None, -30.0, None]


def test_water_thresholds(spark):
    db = spark.createDataFrame([(0, i, v) for i, v in enumerate([-25., -15., -30., -10., None])],
                               "row int, col int, value double")
    assert sorted(r["col"] for r in A.water_mask_db(db).collect()) == [0, 2]
    lin = spark.createDataFrame([(0, i, v) for i, v in enumerate([.005, .05, .001, .1])],
                                "row int, col int, value double")
    assert sorted(r["col"] for r in A.water_mask_linear(lin).collect()) == [0, 2]


def test_utm_known_point_and_round_trip(spark):
    # Central meridian on the equator, and the published Krueger example scale.
    df = spark.createDataFrame([(111.0, 0.0), (114.3, -2.5), (117.2, 3.1)], "lon double, lat double")
    x, y = geodesy.project_utm(F.col("lon"), F.col("lat"), 32649)
    rows = df.select("*", x.alias("x"), y.alias("y"))
    got = rows.collect()
    assert got[0]["x"] == pytest.approx(500000.0) and got[0]["y"] == pytest.approx(0.0, abs=1e-6)
    assert got[1]["y"] < 0  # northern zone south of the equator
    lon, lat = geodesy.unproject_utm(F.col("x"), F.col("y"), 32649)
    for r in rows.select("lon", "lat", lon.alias("a"), lat.alias("b")).collect():
        assert r["a"] == pytest.approx(r["lon"], abs=1e-9)
        assert r["b"] == pytest.approx(r["lat"], abs=1e-9)
    with pytest.raises(ValueError):
        geodesy.project_utm(F.lit(0.0), F.lit(0.0), 4326)


def test_utm_arc_length(spark):
    """Northing along the central meridian is 0.9996 times the meridian arc."""
    phi = np.linspace(0, math.radians(40), 200001)
    e2 = geodesy.WGS84_F * (2 - geodesy.WGS84_F)
    m = geodesy.WGS84_A * (1 - e2) / (1 - e2 * np.sin(phi) ** 2) ** 1.5
    arc = float(np.sum((m[1:] + m[:-1]) / 2 * np.diff(phi))) * 0.9996
    _, y = geodesy.project_utm(F.lit(111.0), F.lit(40.0), 32649)
    assert spark.range(1).select(y).first()[0] == pytest.approx(arc, abs=1e-3)


def test_pixel_area():
    utm = geodesy.Grid(1, 1, 10.0, 0, 0, 0, -10.0, 0, 32749)
    assert geodesy.pixel_area_m2(utm) == 100.0
    deg = geodesy.Grid(1, 1, 0.001, 0, 0, 0, -0.001, 0, 4326)
    assert geodesy.pixel_area_m2(deg) == pytest.approx(111.32**2)


def test_tile_names(spark):
    df = spark.createDataFrame([(114.3, -2.5), (-60.2, 3.0), (101.0, -12.0)], "lon double, lat double")
    got = [r[0] for r in df.select(geodesy.forest_tile_name(F.col("lon"), F.col("lat"))).collect()]
    assert got == ["00N_110E", "10N_070W", "10S_100E"]
    assert spark.range(1).select(geodesy.dem_tile_name(F.lit(-3), F.lit(114))).first()[0] == (
        "Copernicus_DSM_COG_10_S03_00_E114_00_DEM")


def test_names(spark):
    names = ["S1B_IW_SLC__1SDV_20240131T101112_x", "s1b_x", "other"]
    assert column(spark, names, naming.platform_of, "string") == ["S1B", "S1B", "S1A"]
    assert [t is None for t in column(spark, names, naming.acquisition_time, "string")] == [False, True, True]
    assert column(spark, ["EPSG:32649", "wgs"], naming.epsg_of, "string") == [32649, None]


def test_incomplete_beta():
    # Closed forms: I_x(a, 1) = x^a and I_x(1, b) = 1 - (1-x)^b; t with 2 degrees of freedom.
    for x in (0.01, 0.3, 0.77):
        assert incomplete_beta(2.5, 1.0, x) == pytest.approx(x**2.5)
        assert incomplete_beta(1.0, 3.5, x) == pytest.approx(1 - (1 - x) ** 3.5)
    t = 1.7
    assert t_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t))
    assert t_two_sided(12.706204736, 1) == pytest.approx(0.05, rel=1e-6)
    assert t_two_sided(float("inf"), 5) == 0.0


def test_valid_pairs_count(spark):
    a = spark.createDataFrame([(0, i, v) for i, v in enumerate([1., None, 3., 4., None])], "row int, col int, value double")
    b = spark.createDataFrame([(0, i, v) for i, v in enumerate([1., 2., None, 4., None])], "row int, col int, value double")
    assert A.valid_pairs(a, b).count() == 2


def test_zones_without_variance(spark):
    rows = [(i, -40.0, "a") for i in range(50)] + [(i, -20.0, "b") for i in range(50)]
    df = spark.createDataFrame(rows, "i int, value double, zone string")
    z = {r["zone"]: r["mean"] for r in stats.zonal_stats(df).collect()}
    assert z == {"a": -40.0, "b": -20.0}
    w = stats.welch_test(df, "a", "b").first()
    assert w["t_statistic"] == float("-inf") and w["t_p_value"] == 0.0 and w["difference_significant"]


def test_correlation_needs_pixels(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(50)], "value double, other double")
    r = stats.correlation(df, F.col("value"), F.col("other"), "x").first()
    assert r["status"] == "insufficient_data" and r["correlation_r"] is None
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(150)], "value double, other double")
    r = stats.correlation(df, F.col("value"), F.col("other"), "x").first()
    assert r["status"] == "significant" and r["correlation_r"] == pytest.approx(1.0)


def test_calibration_uses_all_pixels_when_few_are_coherent(spark, rng):
    v = rng.normal(-5, 3, (10, 10))
    out = A.calibrate_velocity(to_pixels(spark, v), to_pixels(spark, np.full((10, 10), 0.1)))
    assert out.agg(F.avg("value")).first()[0] == pytest.approx(-25.0)


def test_cohorts_keep_empty_ones(spark):
    df = spark.createDataFrame([(0, 0, -30.0, 20), (0, 1, -10.0, 2)], "row int, col int, value double, lossyear int")
    got = {r["cohort"]: r["n_pixels"] for r in stats.cohort_stats(df).collect()}
    assert got == {"2001-2005": 1, "2006-2010": 0, "2011-2015": 0, "2016-2023": 1, "no_loss": 0}
    assert stats.cohort_verdict(stats.cohort_stats(df)).first()[0] == "consistent"
    assert stats.cohort_verdict(stats.cohort_stats(df.where("lossyear=2"))).first()[0] == "insufficient_data"
