"""Small-baseline inversion, flows, reports and streaming."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from checks.acquisitions import gap_sql
from checks.focal import DIMS, around
from checks.geometry import BY_SCENE, scenes
from checks.projections import FUSED
from checks.registry import query
from checks.views import sql
from groundswell.config import Settings
from groundswell.frames import ensure_checkpoint_dir, val
from groundswell.functions.geodesy import Grid
from groundswell.operators import timeseries as TS
from groundswell.plans import flows as FL
from groundswell.plans import products as P
from groundswell.plans import reports as R
from groundswell.streaming import scenes as ST

LINKS = [(1, 0, 1), (2, 1, 2), (3, 2, 3), (4, 3, 4), (5, 0, 2), (6, 1, 3), (7, 2, 4)]


def inverse_sql() -> str:
    """The network's pseudo-inverse as (idx, pair_id, k) rows."""
    a = np.zeros((7, 5))
    for i, (_, r, s) in enumerate(LINKS):
        a[i, r], a[i, s] = -1, 1
    p = np.linalg.pinv(a[:, 1:])
    rows = ",".join(f"({d + 1},{LINKS[j][0]},{float(p[d, j])!r})" for d in range(4) for j in range(7))
    return f"SELECT * FROM (VALUES {rows}) AS t(idx,pair_id,k)"


SERIES = ("SELECT row, col, idx, sum(k*phase) AS phase FROM {s} JOIN inv USING (pair_id) GROUP BY row, "
          "col, idx UNION ALL SELECT DISTINCT row, col, 0, 0.0 FROM {s}")
CTE = {"inv": inverse_sql(), "series": SERIES.format(s="ifg")}


@query("modify_network", sql(
    "r_ifg", "SELECT pair_id, row, col, phase, coherence FROM r_ifg WHERE pair_id IN (SELECT pair_id "
    "FROM (SELECT pair_id, CASE WHEN pair_id%3=0 THEN coherence/4 ELSE coherence END AS c FROM r_ifg) "
    "GROUP BY pair_id HAVING avg(c)>=0.3)"), digits=None)
def _(d):
    low = F.when(F.col("pair_id") % 3 == 0, F.col("coherence") / 4).otherwise(F.col("coherence"))
    s = d.r_ifg.withColumn("_keep", F.col("coherence")).withColumn("coherence", low)
    return TS.modify_network(s).select(
        "pair_id", "row", "col", "phase", F.col("_keep").alias("coherence"))


REF = ("SELECT row, col FROM ifg GROUP BY row, col HAVING avg(coherence)>=0.7 ORDER BY "
       "avg(coherence) DESC, row, col LIMIT 1")


@query("reference_phase", sql(
    "ifg", "SELECT i.pair_id, i.row, i.col, i.phase-r.phase AS phase FROM ifg i JOIN (SELECT "
    "pair_id, phase FROM ifg JOIN ref USING (row, col)) r USING (pair_id)", "phase", ref=REF))
def _(d):
    return TS.reference_phase(d.ifg).select("pair_id", "row", "col", "phase")


@query("apply_delay", sql(
    "ifg", "SELECT pair_id, row, col, phase-(((row+sec_idx*col)%13-(row+ref_idx*col)%13)*0.01) AS "
    "phase FROM ifg", "phase"))
def _(d):
    idx = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("idx")
    delay = d.vel.select("row", "col", idx).select(
        "idx", "row", "col",
        ((F.col("row") + F.col("idx") * F.col("col")) % 13 * 0.01).alias("delay"))
    return TS.apply_delay(d.ifg, delay).select("pair_id", "row", "col", "phase")


@query("deramp_stack", sql(
    "ifg", "SELECT i.pair_id, i.row, i.col, i.phase-m+c1*r+c2*c-c1*i.row-c2*i.col AS phase FROM "
    "ifg i JOIN (SELECT pair_id, r, c, m, (cc*rv-rc*cv)/(rr*cc-rc*rc) AS c1, (rr*cv-rc*rv)/(rr*cc-"
    "rc*rc) AS c2 FROM (SELECT pair_id, avg(row) AS r, avg(col) AS c, avg(phase) AS m, var_pop(row) "
    "AS rr, var_pop(col) AS cc, covar_pop(row,col) AS rc, covar_pop(row,phase) AS rv, "
    "covar_pop(col,phase) AS cv FROM ifg GROUP BY pair_id)) USING (pair_id)", "phase"))
def _(d):
    return TS.deramp_stack(d.ifg).select("pair_id", "row", "col", "phase")


@query("invert_network", sql("ifg", "SELECT row, col, idx, phase FROM series", "phase", **CTE))
def _(d):
    return TS.invert_network(d.ifg)


# Pixels of four kinds: by (row*3+col)%4, which pairs they lack.
GAPS = {0: (), 1: (4, 5), 2: (2, 6), 3: (3,)}
SPLIT = {0: (), 1: (1, 5), 2: (3, 6, 7), 3: (4, 7)}


def gaps_sql(lacking: dict[int, tuple[int, ...]]) -> str:
    """Series of pixels that lack pairs: one pseudo-inverse a kind over the dates tied to date 0, and
    NULL for the other dates of its pairs."""
    rows = []
    for kind, gone in lacking.items():
        pairs = [p for p in LINKS if p[0] not in gone]
        tied = {0}
        for _ in LINKS:
            tied |= {x for _, a, b in pairs if tied & {a, b} for x in (a, b)}
        days = sorted({x for _, a, b in pairs for x in (a, b)})
        free = [x for x in days if x in tied and x]
        if 0 not in days:
            free = []
        design = np.array([[(b == x) - (a == x) for x in free] for _, a, b in pairs], float).reshape(len(pairs), len(free))
        inverse = np.linalg.pinv(design)
        for x in days:
            for j, (pair, _, _) in enumerate(pairs):
                k = repr(float(inverse[free.index(x), j])) if x in free else "0.0" if x == 0 else "NULL"
                rows.append(f"({kind},{x},{pair},{k})")
    return (f"SELECT row, col, idx, sum(k*phase) AS phase FROM ifg JOIN (SELECT kind, idx, pair_id, CAST(k AS DOUBLE) AS k FROM "
            f"(VALUES {','.join(rows)}) AS t(kind,idx,pair_id,k)) USING (pair_id) WHERE (row*3+col)%4=kind GROUP BY row, col, idx")


def _lacking(d, lacking: dict[int, tuple[int, ...]]):
    kind = (F.col("row") * 3 + F.col("col")) % 4
    gone = F.lit(False)
    for k, pairs in lacking.items():
        if pairs:
            gone = gone | ((kind == k) & F.col("pair_id").isin(*pairs))
    return d.ifg.where(~gone)


@query("invert_network_with_gaps", sql("ifg", gaps_sql(GAPS), "phase"))
def _(d):
    """Some pixels lack pairs, but all their dates hang together."""
    return TS.invert_network(_lacking(d, GAPS))


@query("invert_split_network", sql("ifg", gaps_sql(SPLIT), "phase"))
def _(d):
    """Pairs of some pixels fall into groups; dates that nothing ties to the first have no datum."""
    return TS.invert_network(_lacking(d, SPLIT))


VEL = ("SELECT row, col, regr_slope(phase, day/365.25) AS velocity, sqrt(greatest(regr_syy(phase, "
       "day/365.25)-pow(regr_sxy(phase, day/365.25),2)/regr_sxx(phase, day/365.25),0)/(count(*)-2)/"
       "regr_sxx(phase, day/365.25)) AS velocity_std FROM series JOIN v_days USING (idx) GROUP BY "
       "row, col")


@query("timeseries_velocity", sql("ifg v_days", VEL, "velocity velocity_std", **CTE))
def _(d):
    return TS.timeseries_velocity(TS.invert_network(d.ifg), d.v_days)


RESID = ("SELECT i.row, i.col, i.phase-(b.phase-a.phase) AS residual FROM ifg i JOIN series a ON "
         "a.row=i.row AND a.col=i.col AND a.idx=i.ref_idx JOIN series b ON b.row=i.row AND b.col=i.col "
         "AND b.idx=i.sec_idx")


@query("temporal_coherence", sql(
    "ifg", "SELECT row, col, sqrt(pow(avg(cos(residual)),2)+pow(avg(sin(residual)),2)) AS value "
    "FROM resid GROUP BY row, col", "value", **CTE, resid=RESID))
def _(d):
    return TS.temporal_coherence(d.ifg, TS.invert_network(d.ifg))


RMS = ("SELECT idx, sqrt(avg(pow(s.phase-a-b*day/365.25,2))) AS rms FROM series s JOIN v_days USING "
       "(idx) JOIN (SELECT row, col, regr_slope(phase, day/365.25) AS b, regr_intercept(phase, "
       "day/365.25) AS a FROM series JOIN v_days USING (idx) GROUP BY row, col) l ON l.row=s.row AND "
       "l.col=s.col GROUP BY idx")


@query("date_residual_rms", sql("ifg v_days", RMS, "rms", **CTE))
def _(d):
    return TS.date_residual_rms(TS.invert_network(d.ifg), d.v_days)


@query("reference_date", sql("ifg v_days", "SELECT idx, rms FROM rms ORDER BY rms, idx LIMIT 1",
                             "rms", **CTE, rms=RMS))
def _(d):
    return TS.reference_date(TS.date_residual_rms(TS.invert_network(d.ifg), d.v_days))


@query("stacked_velocity", sql(
    "ifg", "SELECT row, col, sum(phase*dt_days)/sum(dt_days*dt_days) AS value FROM ifg GROUP BY "
    "row, col", "value"))
def _(d):
    return TS.stacked_velocity(d.ifg)


@query("export_velocity", sql(
    "ifg v_days coh", "SELECT row-2 AS row, col-10 AS col, CASE WHEN c<0.5 THEN NULL ELSE "
    "greatest(least(velocity/40/cos(radians(37))*1000,200.0),-200.0) END AS value, CASE WHEN c<0.5 "
    "THEN NULL ELSE velocity_std/40*1000 END AS std FROM (SELECT v.*, coh.value AS c FROM vel_t v "
    "LEFT JOIN coh ON coh.row=v.row AND coh.col=v.col) WHERE row>=2 AND row<60 AND col>=10 AND col<85",
    "value std", **CTE, vel_t=VEL))
def _(d):
    """Clamp, clip to the buffered area, then mask by coherence."""
    v = TS.timeseries_velocity(TS.invert_network(d.ifg), d.v_days, 1 / 40)
    grid = Grid(120, 125, 0.01, 0.0, 100.0, 0.0, -0.01, 0.0)
    out = FL.export_velocity(v, d.coh, Settings(), grid, (100.1205, -0.4905, 100.7405, -0.1205))
    return out["subsidence_velocity"].join(
        out["velocity_uncertainty"].withColumnRenamed("value", "std"), ["row", "col"])


# --- Flows and reports ----------------------------------------------------------------


def _size(d):
    return d.vv.agg((F.max("row") + 1).cast("int").alias("_h"),
                    (F.max("col") + 1).cast("int").alias("_w"))


def _flow(d):
    h = d.vv.agg(F.max("row")).first()[0] + 1
    return FL.analysis_flow(
        d.vel, d.coh, d.vv, forest=d.r_lossyear, peat_polygons=d.v_rings, waterways=d.v_ways,
        grid=Grid(h, 125, 10.0, 0.0, 0.0, 0.0, -10.0, 0.0, 32649), size=(h, 125))


@query("analysis_flow_products")
def _(d):
    """Every raster product of the analysis flow: pixels and mean per product."""
    out = _flow(d)
    rows = None
    for name, layer in sorted(out.items()):
        column = next((c for c in ("value", "class", "degraded", "depth_class", "distance")
                       if c in layer.columns), None)
        if column is None and "row" not in layer.columns:
            continue
        one = layer.agg(F.count("*").alias("pixels"),
                        (F.avg(column) if column else F.lit(None)).cast("double").alias("mean"))
        one = one.select(F.lit(name).alias("product"), "pixels", "mean")
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query("quality_report")
def _(d):
    from groundswell.operators import algebra as A

    return R.quality_report(d.spark, d.vel, d.coh, d.m_canal, A.classify(d.vel, d.m_water), d.risk,
                            ["canal_mask", "canal_risk"])


#: Every number of the report: its place in the JSON and the SQL over v (velocity), c (coherence), k (risk).
_IN = "count(CASE WHEN {} THEN 1 END)"
REPORT_FIELDS = {
    "velocity_stats": ("vel", {
        "mean": "round(avg(value),2)", "std": "round(stddev_pop(value),2)", "min": "round(min(value),2)", "max": "round(max(value),2)",
        "median": "round(median(value),2)", "valid_pixel_count": "count(value)", "total_pixels": "count(*)"}),
    "coherence_stats": ("coh", {
        "mean": "round(avg(value),4)", "median": "round(median(value),4)", "pixels_above_05": _IN.format("value>0.5"),
        "fraction_above_05": f"round({_IN.format('value>0.5')}/count(value),4)", "pixels_above_07": _IN.format("value>0.7"),
        "fraction_above_07": f"round({_IN.format('value>0.7')}/count(value),4)", "valid_pixel_count": "count(value)"}),
    "canal_stats": ("vel", {
        "mask_pixels": _IN.format("col%40<3"), "total_pixels": "count(*)",
        "coverage_pct": f"round(100.0*{_IN.format('col%40<3')}/count(*),3)"}),
    "risk_distribution": ("risk", {
        "mean_risk": "round(avg(value),4)", "valid_pixel_count": "count(value)", **{
            f"{n}_fraction": f"round({_IN.format(c)}/count(value),4)" for n, c in (
                ("low", "value<0.2"), ("moderate", "value>=0.2 AND value<0.4"), ("elevated", "value>=0.4 AND value<0.6"),
                ("high", "value>=0.6 AND value<0.8"), ("critical", "value>=0.8"))}}),
    "data_quality": ("vel", {
        "valid_pixel_fraction": "round(count(value)/count(*),4)", "mean_coherence": "max((SELECT round(avg(value),4) FROM coh))",
        "high_coherence_fraction": f"max((SELECT round({_IN.format('value>0.7')}/count(value),4) FROM coh))"}),
    "parameters": ("vel", {"coherence_threshold": "max(0.5)", "max_influence_m": "max(1200.0)", "severe_velocity_mm_yr": "max(-40.0)"}),
}
_CODES = ("SELECT row, col, CASE WHEN w.row IS NOT NULL THEN 6 WHEN v.value IS NULL THEN 0 WHEN v.value<-50 THEN 1 WHEN v.value<-20 THEN 2 "
          "WHEN v.value<-5 THEN 3 WHEN v.value<5 THEN 4 ELSE 5 END AS class FROM vel v LEFT JOIN m_water w USING (row, col)")


@query("quality_report_fields", sql(
    "vel coh risk m_water", " UNION ALL ".join(
        f"SELECT '{part}.{name}' AS field, CAST({text} AS DOUBLE) AS value FROM {src}"
        for part, (src, fields) in REPORT_FIELDS.items() for name, text in fields.items())
    + " UNION ALL SELECT 'class_' || class || '.pixels', CAST(count(*) AS DOUBLE) FROM codes GROUP BY class UNION ALL SELECT 'class_' || "
      "class || '.percent', 100.0*count(*)/(SELECT count(*) FROM codes) FROM codes GROUP BY class UNION ALL SELECT 'product_count', 2.0",
    "value", codes=_CODES))
def _(d):
    from groundswell.operators import algebra as A

    report = R.quality_report(d.spark, d.vel, d.coh, d.m_canal, A.classify(d.vel, d.m_water), d.risk,
                              ["canal_mask", "canal_risk"])
    place = lambda p: F.get_json_object("report", f"$.{p}").cast("double")
    flat = [F.struct(F.lit(f"{part}.{name}").alias("field"), place(f"{part}.{name}").alias("value"))
            for part, (_, fields) in REPORT_FIELDS.items() for name in fields]
    flat.append(F.struct(F.lit("product_count").alias("field"), place("product_count").alias("value")))
    classes = F.from_json(F.get_json_object("report", "$.classification_distribution"),
                          "array<struct<class:int,pixels:bigint,percent:double>>")
    more = F.flatten(F.transform(classes, lambda c: F.array(*[
        F.struct(F.concat(F.lit("class_"), c["class"].cast("string"), F.lit(f".{n}")).alias("field"), c[n].cast("double").alias("value"))
        for n in ("pixels", "percent")])))
    return report.select(F.inline(F.concat(F.array(*flat), more)))


@query("quality_report_numbers", sql(
    "vel coh risk vv", "SELECT round(avg(value),2) AS mean, count(value) AS valid, (SELECT "
    "round(avg(value),4) FROM coh) AS mean_coherence, (SELECT round(avg(value),4) FROM risk) AS "
    "mean_risk, (SELECT count(*) FROM vv WHERE col%40<3) AS canals, round(count(value)/count(*),4) AS "
    "fraction FROM vel"))
def _(d):
    from groundswell.operators import algebra as A

    j = R.quality_report(d.spark, d.vel, d.coh, d.m_canal, A.classify(d.vel, d.m_water), d.risk)
    at = lambda p, t: F.get_json_object("report", p).cast(t)
    return j.select(
        at("$.velocity_stats.mean", "double").alias("mean"),
        at("$.velocity_stats.valid_pixel_count", "bigint").alias("valid"),
        at("$.coherence_stats.mean", "double").alias("mean_coherence"),
        at("$.risk_distribution.mean_risk", "double").alias("mean_risk"),
        at("$.canal_stats.mask_pixels", "bigint").alias("canals"),
        at("$.data_quality.valid_pixel_fraction", "double").alias("fraction"))


@query("validation_summary", sql(
    "vel vv coh", "SELECT count(*) AS n_correlations, count(CASE WHEN abs(r)*sqrt((n-2)/(1-r*r)) > "
    "1.9602 THEN 1 END) AS n_significant FROM (SELECT corr(vel.value, vv.value) AS r, count(*) AS n "
    "FROM vel JOIN vv USING (row, col) WHERE vel.value IS NOT NULL UNION ALL SELECT corr(vel.value, "
    "coh.value), count(*) FROM vel JOIN coh USING (row, col) WHERE vel.value IS NOT NULL AND "
    "coh.value IS NOT NULL)"))
def _(d):
    return R.validation_summary(R.correlations(d.vel, d.vv, d.coh))


LEE_BY_SCENE = (
    "SELECT scene_id, row, col, CASE WHEN x < m-0.9*sqrt(v) OR x > m+0.9*sqrt(v) THEN m ELSE m + CASE WHEN greatest(v-m*m,0)+m*m>0 "
    "THEN greatest(v-m*m,0)/(greatest(v-m*m,0)+m*m) ELSE 0 END*(x-m) END AS value FROM (SELECT n.scene_id, n.row, n.col, "
    "any_value(s.value) AS x, avg(n.value) AS m, greatest(avg(n.value*n.value)-avg(n.value)*avg(n.value),0) AS v FROM near n JOIN "
    "sigma0 s ON s.scene_id=n.scene_id AND s.row=n.row AND s.col=n.col GROUP BY n.scene_id, n.row, n.col)")
NEAR = around("vv", 3).replace("SELECT q.row, q.col, t.value", "SELECT t.scene_id, q.row, q.col, t.value").replace("JOIN vv t", "JOIN sigma0 t")


@query("backscatter_flow", sql(
    "vv v_lut", "SELECT row, col, 10*log10(greatest(median(value), 1e-5)) AS value FROM clean GROUP BY row, col", "value", **BY_SCENE,
    **DIMS, near=NEAR, clean=LEE_BY_SCENE))
def _(d):
    """Eight scenes, each with its own table: calibrated, despeckled, composited over time, in decibels."""
    return FL.backscatter_flow(*scenes(d))["vv_db"]


PLANE = ("SELECT i.pair_id, i.row, i.col, i.phase-m+c1*r+c2*c-c1*i.row-c2*i.col AS phase FROM {s} i JOIN (SELECT pair_id, "
         "r, c, m, (cc*rv-rc*cv)/(rr*cc-rc*rc) AS c1, (rr*cv-rc*rv)/(rr*cc-rc*rc) AS c2 FROM (SELECT pair_id, avg(row) AS r, "
         "avg(col) AS c, avg(phase) AS m, var_pop(row) AS rr, var_pop(col) AS cc, covar_pop(row,col) AS rc, covar_pop(row,phase) "
         "AS rv, covar_pop(col,phase) AS cv FROM {s} GROUP BY pair_id)) USING (pair_id)")


def flow_sql(ref: str, delay: str = "0.0") -> dict[str, str]:
    """CTEs from pairs to vertical velocity: delay, plane, reference pixel, series, slope, mask."""
    seconds = "day/365.25"
    return {
        "ref": ref, "late": f"SELECT pair_id, row, col, phase-({delay}) AS phase FROM ifg",
        "flat": PLANE.format(s="late"),
        "tied": "SELECT i.pair_id, i.row, i.col, i.phase-r.phase AS phase FROM flat i JOIN (SELECT pair_id, phase FROM flat "
                "JOIN ref USING (row, col)) r USING (pair_id)",
        "inv": inverse_sql(), "series": SERIES.format(s="tied"),
        "slope": f"SELECT row, col, regr_slope(phase*(0.056/(4*pi())), {seconds}) AS velocity FROM series JOIN v_days USING "
                 "(idx) GROUP BY row, col",
        "resid": "SELECT i.row, i.col, i.phase-(b.phase-a.phase) AS residual FROM tied i JOIN v_pairs p USING (pair_id) JOIN "
                 "series a ON a.row=i.row AND a.col=i.col AND a.idx=p.ref_idx JOIN series b ON b.row=i.row AND b.col=i.col AND "
                 "b.idx=p.sec_idx",
        "tcoh": "SELECT row, col, sqrt(pow(avg(cos(residual)),2)+pow(avg(sin(residual)),2)) AS c FROM resid GROUP BY row, col",
        "moved": "SELECT s.row, s.col, CASE WHEN c<0.5 THEN NULL ELSE greatest(least(velocity/cos(radians(37))*1000,200.0),"
                 "-200.0) END AS value FROM slope s JOIN tcoh USING (row, col)",
    }


LATE = "((row+sec_idx*col)%13-(row+ref_idx*col)%13)*0.01"


@query("timeseries_flow", sql("ifg v_days v_pairs", "SELECT row, col, value FROM moved", "value", **flow_sql(REF, LATE)))
def _(d):
    """Network to exported velocity; the most coherent pixel stays at zero through delay and ramp."""
    idx = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("idx")
    delay = d.vel.select("row", "col", idx).select(
        "idx", "row", "col", ((F.col("row") + F.col("idx") * F.col("col")) % 13 * 0.01).alias("delay"))
    return FL.timeseries_flow(d.ifg, d.v_days, delay=delay)["subsidence_velocity"]


@query("timeseries_from_listing", sql(
    "ifg v_days v_pairs", "SELECT row, col, value FROM moved", "value", **flow_sql("SELECT 4 AS row, 6 AS col")))
def _(d):
    """Object names and layers to velocity, against a reference given in degrees."""
    day = [20200101, 20200113, 20200125, 20200218, 20200301]
    names = [f"merged/{day[a]}_{day[b]}/filt_fine.unw" for _, a, b in LINKS]
    pair = F.element_at(F.create_map(*[F.lit(x) for p, a, b in LINKS for x in (p, f"{day[a]}_{day[b]}")]), F.col("pair_id"))
    layer = lambda c: d.ifg.select(pair.alias("pair_id"), "row", "col", F.col(c).alias("value"))
    listing = d.ifg.select("pair_id").distinct().select(
        F.element_at(F.create_map(*[F.lit(x) for (p, _, _), n in zip(LINKS, names) for x in (p, n)]), F.col("pair_id")).alias("name"))
    grid = Grid(2000, 125, 0.001, 0.0, 114.0, 0.0, -0.001, -2.0)
    return FL.timeseries_from_listing(
        listing, layer("phase"), layer("coherence"), grid=grid, reference_lonlat=(114.0065, -2.0045))["subsidence_velocity"]


@query("fuse_flow", sql(
    "vel coh vel_l coh_l m_water", "SELECT class, count(*) AS pixels FROM (SELECT CASE WHEN w.row IS "
    "NOT NULL THEN 6 WHEN v IS NULL THEN 0 WHEN v<-50 THEN 1 WHEN v<-20 THEN 2 WHEN v<-5 THEN 3 WHEN "
    "v<5 THEN 4 ELSE 5 END AS class FROM (SELECT c.row, c.col, CASE WHEN cok AND lok THEN (cc*cv+lc*"
    "lv)/(cc+lc) WHEN cok THEN cv WHEN lok THEN lv END AS v FROM both_s c) f LEFT JOIN m_water w ON "
    "w.row=f.row AND w.col=f.col) GROUP BY class",
    both_s=FUSED))
def _(d):
    out = FL.fuse_flow(d.vel, d.coh, d.vel_l, d.coh_l, water=d.m_water)
    return out["fused_class"].groupBy("class").agg(F.count("*").alias("pixels"))


@query("peat_products", sql(
    "vel v_rings", "SELECT count(value) AS valid_on_peat FROM vel WHERE EXISTS (SELECT 1 FROM hits h "
    "WHERE h.row=vel.row AND h.col=vel.col)",
    edges="SELECT feature_id, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x1, "
          "coalesce(lead(y) OVER w, first_value(y) OVER w) AS y1 FROM v_rings WINDOW w AS "
          "(PARTITION BY feature_id ORDER BY seq)",
    hits="SELECT DISTINCT row, col FROM (SELECT p.row, p.col, e.feature_id, count(*) AS n FROM vel p "
         "JOIN edges e ON (e.y<=p.row+0.5)<>(e.y1<=p.row+0.5) AND p.col+0.5<e.x+(p.row+0.5-e.y)/"
         "(e.y1-e.y)*(e.x1-e.x) GROUP BY p.row, p.col, e.feature_id) WHERE n%2=1"))
def _(d):
    h = d.vv.agg(F.max("row")).first()[0] + 1
    out = P.peat_products(d.vel, d.v_rings, Grid(h, 125, 10.0, 0.0, 0.0, 0.0, -10.0, 0.0, 32649))
    return out["peat_velocity"].agg(F.count("value").alias("valid_on_peat"))


@query("acquisition_flow", sql(
    "v_scenes v_orbits", "SELECT count(*) AS scenes, (SELECT count(*) FROM (SELECT row_number() OVER "
    "(ORDER BY d) AS i, d FROM dd) a JOIN (SELECT row_number() OVER (ORDER BY d) AS i, d FROM dd) b ON "
    "b.i>a.i AND b.i<=a.i+4) AS pairs FROM dd", recursive=True,
    found="SELECT * FROM v_scenes WHERE path_number=(SELECT path_number FROM v_scenes GROUP BY 1 ORDER "
          "BY count(*) DESC, min(start_time) LIMIT 1)",
    **gap_sql("found", 6),
    dd="SELECT CAST(t AS DATE) AS d FROM kept WHERE t IS NOT NULL"))
def _(d):
    from groundswell.config import Sensor
    from groundswell.operators import catalog as C

    scenes = d.v_scenes
    none = C.conform(scenes.select(F.col("scene_id").cast("string")).limit(0), C.SCENES)
    no_pairs = C.conform(scenes.select(F.lit("x").alias("pair_id")).limit(0), C.PAIRS)
    out = FL.acquisition_flow(
        scenes, none, no_pairs, d.v_orbits, d.v_remote, "2024-01-01", "2024-02-01",
        settings=Settings(sensor=Sensor(min_gap_days=6)))
    n = out["pairs"].agg(F.count("*").alias("n")).scalar()
    return out["scenes"].agg(F.count("*").alias("scenes")).select("scenes", n.alias("pairs"))


# --- Streaming ------------------------------------------------------------------------


def _stream(d):
    """The events table as a file stream."""
    events = d.table("events")
    files = d.spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
    return files.parquet(d.folder).select(
        F.col("event_id").cast("string").alias("scene_id"),
        F.col("ts").cast("timestamp").alias("start_time"), F.lit("S1A").alias("platform"),
        F.col("event_type").alias("processing_level"),
        F.col("user_id").cast("int").alias("relative_orbit"))


def _folder(d, name: str) -> str:
    import uuid

    ensure_checkpoint_dir(d.spark)
    return f"{d.spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query("scene_stream_register", sql(
    "", "SELECT CAST(event_id AS VARCHAR) AS scene_id, CAST(ts AS DATE) AS acquisition_date, "
    "event_type AS processing_level, 'pending' AS download_status FROM events"))
def _(d):
    twice = F.explode(F.array(F.lit(0), F.lit(1)))
    path = _folder(d, "catalog")
    ST.register_stream(
        _stream(d).withColumn("_again", twice).drop("_again"), path, _folder(d, "register"),
    ).trigger(availableNow=True).start().awaitTermination()
    from groundswell.operators.catalog import SCENES

    return d.spark.read.schema(SCENES).parquet(path).select(
        "scene_id", "acquisition_date", "processing_level", "download_status")


@query("min_gap_stream", sql(
    "v_scenes", "SELECT CAST(s.scene_id AS VARCHAR) AS scene_id, CAST(s.path_number AS INT) AS "
    "relative_orbit, s.start_time FROM v_scenes s JOIN kept k ON s.path_number=k.path_number AND "
    "s.start_time=k.t", recursive=True,
    **gap_sql("v_scenes", 3)))
def _(d):
    path = _folder(d, "kept")
    kept = ST.min_gap_stream(_stream(d), 3, "relative_orbit")
    kept.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", _folder(d, "gap")).trigger(availableNow=True).start().awaitTermination()
    return d.spark.read.schema(kept.schema).parquet(path)


@query("min_gap_register", sql(
    "v_scenes", "SELECT CAST(s.scene_id AS VARCHAR) AS scene_id, CAST(s.path_number AS INT) AS "
    "relative_orbit, s.start_time FROM v_scenes s JOIN kept k ON s.path_number=k.path_number AND "
    "s.start_time=k.t", recursive=True, **gap_sql("v_scenes", 3)))
def _(d):
    path = _folder(d, "spaced")
    ST.min_gap_register(_stream(d), path, _folder(d, "spacing"), 3, "relative_orbit").trigger(
        availableNow=True).start().awaitTermination()
    return d.spark.read.schema(
        "scene_id string, relative_orbit int, start_time timestamp").parquet(path).drop("batch")
