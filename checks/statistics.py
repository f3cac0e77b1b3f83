"""Composites, grid aggregates, statistics and validation."""

from __future__ import annotations


from pyspark.sql import functions as F

from checks.projections import CLASS, FUSED, FUSED_OUT
from checks.registry import query
from checks.views import sql
from groundswell.config import CLASS_LABELS
from groundswell.frames import val
from groundswell.functions import scalar as S
from groundswell.functions.geodesy import Grid
from groundswell.operators import algebra as A
from groundswell.operators import composite as C
from groundswell.operators import refpoints as RP
from groundswell.operators import stats as ST
from groundswell.operators.quantiles import exact_percentiles

LABELS = "(VALUES " + ",".join(f"({k},'{v}')" for k, v in CLASS_LABELS.items()) + ") AS l(class,label)"


@query("class_distribution", sql(
    "vel", "SELECT class, label, count(*) AS pixels, count(*)*100.0/sum(count(*)) OVER () AS "
    f"percent FROM (SELECT {CLASS} AS class FROM vel) JOIN {LABELS} USING (class) "
    "GROUP BY class, label", "percent"))
def _(d):
    """The minimum slice: one scan, one projection, one aggregate."""
    return ST.class_distribution(A.classify(d.vel))


for _method, _fn in (("median", "median"), ("mean", "avg"), ("max", "max"), ("min", "min")):
    query(f"temporal_composite_{_method}", sql(
        "r_stack", f"SELECT row, col, {_fn}(value) AS value FROM r_stack GROUP BY row, col",
        "value"))(lambda d, m=_method: C.temporal_composite(d.r_stack, m))


@query("composite_coverage", sql(
    "r_stack", "SELECT min(n) AS min_observations, max(n) AS max_observations, avg(n) AS "
    "mean_observations FROM (SELECT count(value) AS n FROM r_stack GROUP BY row, col)",
    "mean_observations"))
def _(d):
    return C.composite_coverage(d.r_stack)


NDVI_BANDS = ("SELECT CAST(floor(l_orderkey/125) AS INT) AS row, CAST(l_orderkey%125 AS INT) AS col, "
              "l_linenumber AS scene_id, l_extendedprice/10 AS nir, l_quantity*150 AS red FROM lineitem")


@query("ndvi_composite", sql(
    "", "SELECT row, col, median(CASE WHEN nir+red>0 THEN (nir-red)/(nir+red) END) AS value FROM bands "
    "WHERE scene_id IN (SELECT l_linenumber FROM lineitem GROUP BY 1 HAVING "
    "max((l_linenumber*13)%41)<30 ORDER BY max((l_linenumber*13)%41), 1 LIMIT 4) GROUP BY row, col",
    "value", bands=NDVI_BANDS))
def _(d):
    """Best four clear scenes; one observation per line of an order."""
    k = F.col("l_linenumber")
    scenes = d.table("lineitem").groupBy(k.alias("scene_id")).agg(
        F.max(k * 13 % 41).alias("cloud_cover"))
    key = F.col("l_orderkey")
    bands = d.table("lineitem").select(
        F.floor(key / 125).cast("int").alias("row"), (key % 125).cast("int").alias("col"),
        k.alias("scene_id"), (F.col("l_extendedprice") / 10).alias("nir"),
        (F.col("l_quantity") * 150).alias("red"))
    return C.ndvi_composite(scenes, bands, max_scenes=4)


@query("overview_pyramid", sql(
    "vel", "SELECT k AS level, CAST(floor(row/k) AS INT) AS row, CAST(floor(col/k) AS INT) AS col, "
    "avg(value/sqrt(7)) AS value FROM vel CROSS JOIN (VALUES (2),(4),(8),(16)) AS t(k) "
    "GROUP BY k, floor(row/k), floor(col/k)", "value"))
def _(d):
    return C.overview_pyramid(d.vel.withColumn("value", val() / F.sqrt(F.lit(7))))


@query("multilook", sql(
    "vel", "SELECT CAST(floor(row/3) AS INT) AS row, CAST(floor(col/9) AS INT) AS col, avg(value) "
    "AS value FROM vel WHERE floor(row/3) < floor((SELECT max(row)+1 FROM vel)/3) AND floor(col/9) "
    "< floor((SELECT max(col)+1 FROM vel)/9) GROUP BY floor(row/3), floor(col/9)", "value"))
def _(d):
    return C.multilook(d.vel)


@query("mosaic_clip", sql(
    "vel vel_l", "SELECT row, col, arg_min(value, k) AS value FROM (SELECT row, col, value, 1 AS k "
    "FROM vel UNION ALL SELECT row, col, value, 0 FROM vel_l) WHERE value IS NOT NULL AND row>=2 "
    "AND row<200 AND col>=3 AND col<128 GROUP BY row, col", "value"))
def _(d):
    both = d.vel.withColumn("tile_order", F.lit(1)).union(
        d.vel_l.withColumn("tile_order", F.lit(0)))
    return C.mosaic_clip(both, (2, 200, 3, 128))


@query("raster_stats", sql(
    "vel", "SELECT round(avg(value),2) AS mean, round(median(value),2) AS median, "
    "round(stddev_pop(value),2) AS std, round(min(value),2) AS min, round(max(value),2) AS max, "
    "count(value) AS valid_pixel_count, count(*) AS total_pixels FROM vel"))
def _(d):
    return ST.raster_stats(d.vel)


@query("exact_percentile", sql(
    "vv", "SELECT quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.5) AS p50, "
    "quantile_cont(value, 0.853) AS p85 FROM vv", "p10 p50 p85"))
def _(d):
    return exact_percentiles(d.vv, val(), [0.1, 0.5, 0.853], names=["p10", "p50", "p85"])


@query("heavy_tail_percentile", sql(
    "vv", "SELECT round(quantile_cont(log10(v), 0.5), 2) AS p50, round(quantile_cont(log10(v), 0.999), 2) AS p999 FROM (SELECT "
    "pow(1000*value+1.5, 40) AS v FROM vv WHERE value IS NOT NULL)"), digits=None)
def _(d):
    """Values over a hundred orders of magnitude; neighbours in rank, so logarithms interpolate alike."""
    v = F.pow(val() * 1000 + 1.5, F.lit(40.0))
    p = exact_percentiles(d.vv, v, [0.5, 0.999], names=["p50", "p999"])
    return p.select(F.round(F.log10("p50"), 2).alias("p50"), F.round(F.log10("p999"), 2).alias("p999"))


@query("exact_percentile_by_scene", sql(
    "r_stack", "SELECT scene_id, quantile_cont(value, 0.25) AS p25, median(value) AS p50 FROM "
    "r_stack WHERE value IS NOT NULL GROUP BY scene_id", "p25 p50"))
def _(d):
    """Values with heavy ties, one raster per scene."""
    return exact_percentiles(d.r_stack, val(), [0.25, 0.5], ["scene_id"], ["p25", "p50"])


@query("coherence_stats", sql(
    "coh", "SELECT round(avg(value),4) AS mean, round(median(value),4) AS median, "
    "count(CASE WHEN value>0.5 THEN 1 END) AS pixels_above_05, round(count(CASE WHEN value>0.5 "
    "THEN 1 END)/count(value),4) AS fraction_above_05, count(CASE WHEN value>0.7 THEN 1 END) AS "
    "pixels_above_07, round(count(CASE WHEN value>0.7 THEN 1 END)/count(value),4) AS "
    "fraction_above_07, count(value) AS valid_pixel_count FROM coh"))
def _(d):
    return ST.coherence_stats(d.coh)


@query("risk_distribution", sql(
    "risk", "SELECT round(avg(value),4) AS mean_risk, " + ", ".join(
        f"round(count(CASE WHEN value>={a} AND value<{b} THEN 1 END)/count(value),4) AS {n}_fraction"
        for a, b, n in ((-1, 0.2, "low"), (0.2, 0.4, "moderate"), (0.4, 0.6, "elevated"),
                        (0.6, 0.8, "high"), (0.8, 9, "critical")))
    + ", count(value) AS valid_pixel_count FROM risk"))
def _(d):
    return ST.risk_distribution(d.risk)


@query("canal_stats", sql(
    "vv", "SELECT count(CASE WHEN col%40<3 THEN 1 END) AS mask_pixels, count(*) AS total_pixels, "
    "round(count(CASE WHEN col%40<3 THEN 1 END)*100.0/count(*),3) AS coverage_pct FROM vv"))
def _(d):
    return ST.mask_stats(A.with_mask(d.vv, d.m_canal, "mask"))


@query("threshold_counts", sql(
    "coh", "SELECT threshold, (SELECT count(value) FROM coh) AS valid_pixels, count(*) AS pixels, "
    "count(*)*100.0/(SELECT count(value) FROM coh) AS percent FROM coh JOIN (VALUES (0.5),(0.6),"
    "(0.7),(0.8),(0.9)) AS t(threshold) ON value>=threshold GROUP BY threshold", "percent"))
def _(d):
    return ST.threshold_counts(d.coh)


@query("carbon_total", sql(
    "vel", f"SELECT avg(v) AS mean_rate, count(v) AS pixels, count(v)*{0.0005**2 * 111320.0**2 / 1e4!r} "
    f"AS area_ha, avg(v)*count(v)*{0.0005**2 * 111320.0**2 / 1e4!r} AS total_emission FROM (SELECT "
    "CASE WHEN value<0 THEN -value*0.5 WHEN value IS NOT NULL THEN 0.0 END AS v FROM vel)",
    "mean_rate area_ha total_emission"))
def _(d):
    rate = d.vel.withColumn("value", S.carbon_rate(val()))
    return ST.carbon_total(rate, Grid(0, 0, 0.0005, 0, 0, 0, -0.0005, 0, 4326))


@query("coordinate_bbox", sql(
    "vv", "SELECT min(col*0.001+114) AS west, min(-2.5-row*0.001) AS south, max(col*0.001+114) AS "
    "east, max(-2.5-row*0.001) AS north FROM vv WHERE (row+col)%9<>0", "west south east north"))
def _(d):
    hole = (F.col("row") + F.col("col")) % 9 == 0
    return ST.coordinate_bbox(d.vv.select(
        F.when(hole, 0.0).otherwise(F.col("col") * 0.001 + 114).alias("lon"),
        F.when(hole, 0.0).otherwise(-F.col("row") * 0.001 - 2.5).alias("lat")))


@query("subsidence_by_distance", sql(
    "vel d_canal", "SELECT start_m, end_m, avg(value) AS mean_value, count(value) AS pixel_count "
    "FROM (VALUES (0.0,50.0),(50.0,100.0),(100.0,250.0),(250.0,500.0),(500.0,1000.0),"
    "(4000.0,5000.0)) AS b(start_m,end_m) LEFT JOIN (SELECT distance, value FROM vel JOIN d_canal "
    "USING (row, col)) ON distance>=start_m AND distance<end_m GROUP BY start_m, end_m",
    "mean_value"))
def _(d):
    both = A.aligned(d.vel, d.d_canal, "distance", value="distance")
    first = ST.subsidence_by_distance(both)
    return first.union(ST.subsidence_by_distance(both, (4000, 5000)))


@query("distance_profile", sql(
    "vel d_canal", "SELECT (b+0.5)*200 AS bin_center_m, avg(value) AS mean_velocity, count(*) AS "
    "pixel_count FROM (SELECT floor(distance/200) AS b, value FROM vel JOIN d_canal USING (row, "
    "col) WHERE value IS NOT NULL) WHERE b<15 OR (b=15 AND false) GROUP BY b HAVING count(*)>=10",
    "bin_center_m mean_velocity"))
def _(d):
    return ST.distance_profile(A.aligned(d.vel, d.d_canal, "distance", value="distance"))


COHORT = ("CASE WHEN lossyear BETWEEN 1 AND 5 THEN '2001-2005' WHEN lossyear BETWEEN 6 AND 10 THEN "
          "'2006-2010' WHEN lossyear BETWEEN 11 AND 15 THEN '2011-2015' WHEN lossyear BETWEEN 16 "
          "AND 23 THEN '2016-2023' ELSE 'no_loss' END")


@query("clearing_cohorts", sql(
    "vel r_lossyear", f"SELECT {COHORT} AS cohort, count(*) AS n_pixels, avg(value) AS "
    "mean_velocity, stddev_pop(value) AS std_velocity, median(value) AS median_velocity FROM vel "
    "JOIN r_lossyear USING (row, col) WHERE value IS NOT NULL GROUP BY 1",
    "mean_velocity std_velocity median_velocity"))
def _(d):
    return ST.cohort_stats(A.aligned(d.vel, d.r_lossyear, "lossyear", value="lossyear"))


@query("clearing_verdict", sql(
    "vel r_lossyear", "SELECT CASE WHEN r IS NULL OR o IS NULL THEN 'insufficient_data' WHEN r<o "
    "THEN 'consistent' ELSE 'inconsistent' END AS assessment FROM (SELECT avg(CASE WHEN lossyear>=16 "
    "THEN value END) AS r, avg(CASE WHEN lossyear BETWEEN 1 AND 5 THEN value END) AS o FROM vel JOIN "
    "r_lossyear USING (row, col))"))
def _(d):
    joined = A.aligned(d.vel, d.r_lossyear, "lossyear", value="lossyear")
    return ST.cohort_verdict(ST.cohort_stats(joined))


def t_test_sql(source: str, t: str, df: str) -> dict[str, str]:
    """CTEs for two-sided p of Student's t: continued fraction of the incomplete beta, run
    a fixed number of steps by a recursive query.  ``source`` has a key ``k``."""
    x = f"({df})/(({df})+({t})*({t}))"
    return {
        "tin": f"SELECT k, {df} AS df, CASE WHEN {x} < ({df}/2+1)/({df}/2+2.5) THEN {df}/2 ELSE 0.5 "
               f"END AS a, CASE WHEN {x} < ({df}/2+1)/({df}/2+2.5) THEN 0.5 ELSE {df}/2 END AS b, "
               f"CASE WHEN {x} < ({df}/2+1)/({df}/2+2.5) THEN {x} ELSE 1-{x} END AS x, "
               f"{x} < ({df}/2+1)/({df}/2+2.5) AS direct FROM {source} WHERE {t} IS NOT NULL",
        "cf": "SELECT k, a, b, x, 1 AS m, CAST(1 AS DOUBLE) AS c, 1/(1-(a+b)*x/(a+1)) AS d, "
              "1/(1-(a+b)*x/(a+1)) AS h FROM tin UNION ALL SELECT k, a, b, x, m+1, "
              "1+n2/(1+n1/c), 1/(1+n2*(1/(1+n1*d))), h*(1+n1/c)*(1/(1+n1*d))*(1+n2/(1+n1/c))*"
              "(1/(1+n2*(1/(1+n1*d)))) FROM (SELECT *, m*(b-m)*x/((a+2*m-1)*(a+2*m)) AS n1, "
              "-(a+m)*(a+b+m)*x/((a+2*m)*(a+2*m+1)) AS n2 FROM cf WHERE m<400)",
        "pv": "SELECT k, CASE WHEN direct THEN p ELSE 1-p END AS p FROM (SELECT cf.k, direct, "
              "exp(lgamma(cf.a+cf.b)-lgamma(cf.a)-lgamma(cf.b)+cf.a*ln(cf.x)+cf.b*ln(1-cf.x))*h/cf.a "
              "AS p FROM cf JOIN tin USING (k) WHERE m=400)",
    }


STATUS = ("CASE WHEN n<100 THEN 'insufficient_data' WHEN p<0.05 THEN 'significant' ELSE "
          "'not_significant' END AS status")
R_OUT = ("SELECT label, r AS correlation_r, p AS p_value, n AS n_valid_pixels, "
         f"{STATUS} FROM rs LEFT JOIN pv USING (k)")


def correlation_sql(views: str, rs: str) -> str:
    t = t_test_sql("rs", "r*sqrt((n-2)/(1-r*r))", "CAST(n-2 AS DOUBLE)")
    return sql(views, R_OUT, "correlation_r p_value", recursive=True, rs=rs, **t)


@query("pearson_correlation", correlation_sql(
    "vel coh", "SELECT 1 AS k, 'velocity_vs_coherence' AS label, corr(vel.value, coh.value) AS r, "
    "count(*) AS n FROM vel JOIN coh USING (row, col) WHERE vel.value IS NOT NULL AND coh.value IS "
    "NOT NULL"))
def _(d):
    return ST.correlation(A.valid_pairs(d.vel, d.coh), val(), F.col("other"),
                          "velocity_vs_coherence")


@query("velocity_vs_backscatter", correlation_sql(
    "vel vv", "SELECT 1 AS k, 'velocity_vs_vv_backscatter' AS label, corr(vel.value, vv.value) AS "
    "r, count(*) AS n FROM vel JOIN vv USING (row, col) WHERE vel.value IS NOT NULL UNION ALL "
    "SELECT 2, 'velocity_vs_vv_backscatter_dB', corr(vel.value, 10*log10(greatest(vv.value,1e-10)))"
    ", count(*) FROM vel JOIN vv USING (row, col) WHERE vel.value IS NOT NULL"))
def _(d):
    return ST.velocity_vs_backscatter(A.valid_pairs(d.vel, d.vv))


@query("velocity_vs_distance", correlation_sql(
    "vel d_canal", "SELECT 1 AS k, 'velocity_vs_canal_distance' AS label, corr(value, distance) AS "
    "r, count(*) AS n FROM vel JOIN d_canal USING (row, col) WHERE value IS NOT NULL"))
def _(d):
    both = A.aligned(d.vel, d.d_canal, "distance", value="distance")
    return ST.correlation(both, val(), F.col("distance"), "velocity_vs_canal_distance")


WELCH = ("SELECT 1 AS k, n1, n2, (m1-m2)/sqrt(v1/n1+v2/n2) AS t, pow(v1/n1+v2/n2,2)/(pow(v1/n1,2)/"
         "(n1-1)+pow(v2/n2,2)/(n2-1)) AS dof FROM (SELECT count(CASE WHEN zone='{a}' THEN value END) "
         "AS n1, count(CASE WHEN zone='{b}' THEN value END) AS n2, avg(CASE WHEN zone='{a}' THEN "
         "value END) AS m1, avg(CASE WHEN zone='{b}' THEN value END) AS m2, var_samp(CASE WHEN "
         "zone='{a}' THEN value END) AS v1, var_samp(CASE WHEN zone='{b}' THEN value END) AS v2 "
         "FROM zoned)")
W_OUT = ("SELECT n1, n2, t AS t_statistic, p AS t_p_value, p<0.05 AS difference_significant FROM rs "
         "LEFT JOIN pv USING (k)")


def welch_sql(views: str, zoned: str, a: str, b: str) -> str:
    return sql(views, W_OUT, "t_statistic t_p_value", recursive=True, zoned=zoned,
               rs=WELCH.format(a=a, b=b), **t_test_sql("rs", "t", "dof"))


COH_ZONE = ("SELECT vel.value, CASE WHEN coh.value>0.5 THEN 'cleared' ELSE 'forested' END AS zone "
            "FROM vel LEFT JOIN coh USING (row, col) WHERE vel.value IS NOT NULL")
NDVI_ZONE = ("SELECT value, CASE WHEN (nir-red)/(nir+red)<0.3 THEN 'low' WHEN (nir-red)/(nir+red)>"
             "0.6 THEN 'high' END AS zone FROM vel JOIN r_bands USING (row, col) WHERE value IS NOT "
             "NULL AND nir<>0 AND red<>0")


def _coh_zoned(d):
    return A.aligned(d.vel, d.coh, "c").withColumn("zone", ST.coherence_zone(F.col("c")))


def _ndvi_zoned(d):
    b = d.r_bands.select("row", "col", S.ndvi(F.col("nir"), F.col("red")).alias("value"))
    return A.aligned(d.vel, b, "ndvi").withColumn("zone", ST.ndvi_zone(F.col("ndvi")))


@query("zonal_stats", sql(
    "vel coh", "SELECT zone, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS std, "
    "median(value) AS median FROM zoned GROUP BY zone", "mean std median", zoned=COH_ZONE))
def _(d):
    return ST.zonal_stats(_coh_zoned(d))


@query("velocity_vs_coherence_zones", welch_sql("vel coh", COH_ZONE, "cleared", "forested"))
def _(d):
    return ST.welch_test(_coh_zoned(d), "cleared", "forested")


@query("velocity_vs_ndvi_zones", welch_sql("vel r_bands", NDVI_ZONE, "low", "high"))
def _(d):
    return ST.welch_test(_ndvi_zoned(d), "low", "high")


@query("velocity_vs_ndvi", correlation_sql(
    "vel r_bands", "SELECT 1 AS k, 'velocity_vs_ndvi' AS label, corr(value, (nir-red)/(nir+red)) "
    "AS r, count(*) AS n FROM vel JOIN r_bands USING (row, col) WHERE value IS NOT NULL AND nir<>0 "
    "AND red<>0"))
def _(d):
    return ST.correlation(_ndvi_zoned(d), val(), F.col("ndvi"), "velocity_vs_ndvi")


@query("mask_agreement", sql(
    "m_canal m_water", "SELECT *, CASE WHEN precision+recall>0 THEN 2*precision*recall/"
    "(precision+recall) END AS f1_score FROM (SELECT *, truth_in_detected/truth_pixels AS recall, "
    "truth_in_detected/detected_pixels AS precision FROM (SELECT count(w.row) AS truth_pixels, "
    "count(c.row) AS detected_pixels, count(CASE WHEN c.row IS NOT NULL AND w.row IS NOT NULL THEN "
    "1 END) AS truth_in_detected, count(CASE WHEN c.row IS NULL THEN 1 END) AS "
    "truth_not_in_detected, count(CASE WHEN w.row IS NULL THEN 1 END) AS detected_not_in_truth "
    "FROM m_canal c FULL JOIN m_water w ON c.row=w.row AND c.col=w.col))",
    "recall precision f1_score"))
def _(d):
    return ST.mask_agreement(d.m_canal, d.m_water)


@query("sensor_coverage_distribution", sql(
    "vel coh vel_l coh_l", "SELECT coverage, label, count(*) AS pixels, count(*)*100.0/"
    "sum(count(*)) OVER () AS percent FROM fused JOIN (VALUES (0,'none'),(1,'C-band only'),"
    "(2,'L-band only'),(3,'both')) AS l(coverage,label) USING (coverage) GROUP BY coverage, label",
    "percent", both_s=FUSED, fused=FUSED_OUT))
def _(d):
    return ST.coverage_distribution(A.fuse(d.vel, d.coh, d.vel_l, d.coh_l, 0.3, 1.5))


@query("degraded_summary", sql(
    "vel m_water m_peat", "SELECT CAST(sum(g) AS BIGINT) AS degraded_pixels, count(value) AS "
    "valid_pixels, sum(g)*100.0/count(value) AS degraded_pct FROM (SELECT v.value, CASE WHEN "
    "v.value<-10 AND w.row IS NULL AND p.row IS NOT NULL THEN 1 ELSE 0 END AS g FROM vel v LEFT "
    "JOIN m_water w ON v.row=w.row AND v.col=w.col LEFT JOIN m_peat p ON v.row=p.row AND "
    "v.col=p.col)", "degraded_pct"))
def _(d):
    from groundswell.plans.reports import degraded_summary

    return degraded_summary(A.degraded_mask(d.vel, d.m_water, d.m_peat))


REF_GRID = Grid(0, 0, 0.0011, 0.0, 114.29, 0.0, -0.0013, -2.49)
REF_TOP = ("SELECT row, col, coherence, lon, lat FROM (SELECT *, row_number() OVER (PARTITION BY "
           "round(lat,3), round(lon,3) ORDER BY coherence DESC, row, col) AS k FROM (SELECT row, "
           "col, value AS coherence, 114.29+col*0.0011+row*0.0 AS lon, -2.49+col*0.0+row*-0.0013 AS "
           "lat FROM coh WHERE value>=0 AND value<=1 ORDER BY value DESC, row, col LIMIT 100)) "
           "WHERE k=1 ORDER BY coherence DESC, row, col LIMIT 20")


@query("top_reference_points", sql("coh", REF_TOP, "lon lat"))
def _(d):
    return RP.top_reference_points(d.coh, REF_GRID)


SCORED = (
    "SELECT t.*, inside AS in_aoi, coherence + CASE WHEN inside THEN 0.1 ELSE 0 END + "
    "greatest(0.0, 0.1*(1-dist/0.05)) + CASE WHEN inside AND least(abs(lat+2.611),abs(lat+2.511),"
    "abs(lon-114.304),abs(lon-114.404))<0.02 THEN 0.05 ELSE 0 END AS score, nearest_feature FROM "
    "top t JOIN (SELECT row, col, lon BETWEEN 114.304 AND 114.404 AND lat BETWEEN -2.611 AND -2.511 "
    "AS inside, min(sqrt(pow(lat-flat,2)+pow(lon-flon,2))) AS dist, arg_min(name, "
    "sqrt(pow(lat-flat,2)+pow(lon-flon,2))) AS nearest_feature FROM top, (VALUES "
    + ",".join(f"('{n}',{a},{b})" for n, (a, b) in RP.STABLE_FEATURES.items())
    + ") AS f(name,flat,flon) GROUP BY row, col, lon, lat) USING (row, col)"
)


@query("score_reference_points", sql("coh", SCORED, "lon lat score", top=REF_TOP))
def _(d):
    return RP.score_reference_points(RP.top_reference_points(d.coh, REF_GRID))


@query("best_reference_point", sql(
    "coh", "SELECT scope, row, col, lat, lon, coherence, score, nearest_feature FROM (SELECT *, "
    "row_number() OVER (PARTITION BY scope ORDER BY score DESC, coherence DESC, row, col) AS k FROM "
    "(SELECT 'overall' AS scope, * FROM scored UNION ALL SELECT 'aoi', * FROM scored WHERE in_aoi)) "
    "WHERE k=1", "lat lon score", top=REF_TOP, scored=SCORED))
def _(d):
    return RP.best_reference_point(
        RP.score_reference_points(RP.top_reference_points(d.coh, REF_GRID)))
