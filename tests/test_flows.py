import json

import numpy as np
from pixels import to_array, to_pixels
from pyspark.sql import functions as F

from groundswell.config import PRESETS, Settings
from groundswell.functions.geodesy import Grid
from groundswell.operators import algebra as A
from groundswell.plans import flows as FL
from groundswell.plans import reports as R


def scene(spark, rng):
    vel = -60 + 70 * np.arange(60)[None, :] / 60 + 5 * rng.normal(size=(50, 60))
    vel[0, 0] = np.nan
    vv = rng.uniform(0.01, 0.5, (50, 60))
    vv[20:24, :] *= 0.005
    coh = rng.beta(5, 2, (50, 60))
    return to_pixels(spark, vel), to_pixels(spark, coh), to_pixels(spark, vv)


def test_analysis_flow(spark, rng):
    vel, coh, vv = scene(spark, rng)
    forest = vel.select("row", "col", ((F.col("row") * 13) % 24).alias("lossyear"),
                        ((F.col("col") * 31) % 101).alias("treecover"))
    rings = spark.createDataFrame(
        [(1, 0, 5.0, 5.0), (1, 1, 55.0, 5.0), (1, 2, 55.0, 45.0), (1, 3, 5.0, 45.0)],
        "feature_id int, seq int, x double, y double")
    grid = Grid(50, 60, 10.0, 0, 0, 0, -10.0, 0, 32649)
    out = FL.analysis_flow(vel, coh, vv, forest=forest, peat_polygons=rings, grid=grid, size=(50, 60),
                           second=(vel.withColumn("value", F.col("value") * 0.8), coh))
    assert {"carbon_total", "clearing_assessment", "fused_velocity", "sensor_coverage", "fused_class", "fused_risk"} <= set(out)
    total, carbon = out["carbon_total"].first(), to_array(out["carbon_loss"], (50, 60))
    assert np.isclose(total["total_emission"], np.nansum(carbon) * 0.01)
    assert out["clearing_assessment"].first()["assessment"] in ("consistent", "inconsistent")
    assert {"canal_mask", "canal_distance", "water_mask", "calibrated_velocity", "subsidence_class",
            "peat_extent", "peat_velocity", "degraded_peatland", "canal_risk", "peat_risk",
            "time_adjusted_risk", "carbon_loss", "validation_report", "validation_clearing",
            "pipeline_report"} <= set(out)
    assert out["peat_extent_binary"].count() == 50 * 40
    risk = to_array(out["canal_risk"], (50, 60))
    assert np.isnan(risk[0, 0]) and np.nanmin(risk) >= 0 and np.nanmax(risk) <= 1
    report = json.loads(out["pipeline_report"].first()["report"])
    assert report["velocity_stats"]["valid_pixel_count"] == 2999
    assert report["product_count"] == len(report["products"])
    checks = json.loads(out["validation_report"].first()["report"])
    assert checks["summary"]["n_correlations"] == 3
    assert {z["zone"] for z in checks["zonal_analysis"]["coherence"]["zones"]} == {"cleared", "forested"}
    assert "t_statistic" in checks["zonal_analysis"]["coherence"]["welch"]


def test_without_backscatter(spark, rng):
    vel, coh, _ = scene(spark, rng)
    out = FL.analysis_flow(vel, coh)
    assert "canal_mask" not in out and "canal_risk" not in out
    assert out["subsidence_class"].count() == 3000


def test_fusion_nan_coherence(spark):
    one = lambda v, c: (to_pixels(spark, np.array([v])), to_pixels(spark, np.array([c])))
    n = np.nan
    cv, cc = one([-10.0, -10.0, n, -10.0], [0.8, 0.2, 0.9, n])
    lv, lc = one([-20.0, -20.0, -20.0, n], [0.4, 0.5, 0.9, 0.9])
    rows = {r["col"]: r for r in A.fuse(cv, cc, lv, lc).collect()}
    assert rows[0]["coverage"] == 3 and abs(rows[0]["value"] + (8 + 8) / 1.2) < 1e-9
    assert rows[1]["coverage"] == 2 and rows[1]["value"] == -20
    assert rows[2]["coverage"] == 2 and rows[2]["coherence"] == 0.9
    assert rows[3]["coverage"] == 0 and rows[3]["value"] is None and rows[3]["coherence"] is None


def test_timeseries_flow_has_every_layer(spark, rng):
    links = [(1, 0, 1), (2, 1, 2), (3, 0, 2)]
    days = [0, 12, 24]
    rows = [(p, a, b, r, c, -0.02 * (days[b] - days[a]) * (c + 1) / 10, 0.9)
            for p, a, b in links for r in range(6) for c in range(8)]
    stack = spark.createDataFrame(
        rows, "pair_id int, ref_idx int, sec_idx int, row int, col int, phase double, coherence double")
    dates = spark.createDataFrame(list(enumerate(days)), "idx int, day int")
    out = FL.timeseries_flow(stack, dates)
    assert set(out) == {"series", "subsidence_velocity", "velocity_uncertainty", "coherence"}
    assert out["subsidence_velocity"].count() == 48


def test_presets():
    assert PRESETS["default"] == Settings()
    shipped = PRESETS["shipped"].water
    assert (shipped.threshold_db, shipped.min_size, shipped.exclude_canals) == (-18.0, 25, False)


def test_report_skips_what_is_missing(spark, rng):
    vel, _, _ = scene(spark, rng)
    doc = json.loads(R.quality_report(spark, vel).first()["report"])
    assert "coherence_stats" not in doc and "risk_distribution" not in doc
