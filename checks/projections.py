"""Scalar functions, masks and map algebra."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import sql
from groundswell.frames import val
from groundswell.functions import geodesy, naming
from groundswell.functions import scalar as S
from groundswell.functions.geodesy import Grid
from groundswell.operators import algebra as A
from groundswell.operators import refpoints
from groundswell.plans import flows as FL
from groundswell.plans import products as P
from groundswell.sources.raster import canonical



def per_pixel(name: str, view: str, column, expression: str, exact: bool = False):
    body = f"SELECT row, col, {expression} AS value FROM {view}"
    query(name, sql(view, body, "" if exact else "value"), None if exact else 6)(
        lambda d: getattr(d, view).select("row", "col", column().alias("value"))
    )


per_pixel("phase_to_los", "vel", lambda: S.phase_to_los(val()), f"value*0.056/{4 * math.pi!r}")
per_pixel("los_to_vertical", "vel", lambda: S.los_to_vertical(val(), 37.0), "value/cos(radians(37.0))")
per_pixel("displacement_to_velocity", "vel", lambda: S.displacement_to_velocity(val(), 96.0),
          f"value*1000.0/{96.0 / 365.25!r}", True)
per_pixel("clamp_velocity", "vel", lambda: S.clamp_velocity(val() / 200.0),
          "CASE WHEN value IS NOT NULL THEN greatest(least(value/200.0*1000, 200.0), -200.0) END")
per_pixel("to_decibels", "vv", lambda: S.to_decibels(val()), "10*log10(greatest(value, pow(10.0,-5)))")
per_pixel("db_to_linear", "vel", lambda: S.db_to_linear(val()), "pow(10.0, value/10.0)")
per_pixel("subsidence_risk", "vel", lambda: S.subsidence_risk(val()),
          "CASE WHEN value<0 THEN least(-value/40.0, 1.0) ELSE 0.0 END", True)
per_pixel("carbon_rate", "vel", lambda: S.carbon_rate(val()),
          "CASE WHEN value<0 THEN -value*0.5 WHEN value IS NOT NULL THEN 0.0 END", True)


@query("valid_mask", sql(
    "r_velocity", "SELECT row, col, CASE WHEN value<>-9999 THEN value END AS value FROM r_velocity",
    "value"))
def _(d):
    return canonical(d.r_velocity)


@query("compute_displacement", sql(
    "vel", "SELECT row, col, los, los/cos(radians(37.0)) AS vertical, "
    "los/cos(radians(37.0))*1000.0/(120.0/365.25) AS velocity FROM "
    f"(SELECT row, col, value*0.056/{4 * math.pi!r} AS los FROM vel)", "los vertical velocity"))
def _(d):
    return P.displacement_products(d.vel, 120.0)


@query("displacement_by_angle", sql(
    "vel coh", "SELECT row, col, los, CASE WHEN cosine>0 THEN los/cosine END AS vertical, "
    "CASE WHEN cosine>0 THEN los/cosine END*1000.0/(120.0/365.25) AS velocity FROM "
    f"(SELECT vel.row, vel.col, vel.value*0.056/{4 * math.pi!r} AS los, cos(radians(coh.value*80)) AS cosine FROM vel LEFT JOIN coh "
    "USING (row, col))", "los vertical velocity"))
def _(d):
    """Each pixel at its own incidence angle."""
    return P.displacement_products(d.vel, 120.0, incidence=d.coh.withColumn("value", val() * 80))


@query("export_by_angle", sql(
    "vel coh", "SELECT vel.row, vel.col, CASE WHEN vel.value IS NOT NULL AND coalesce(coh.value>=0.5, true) AND cos(radians(coh.value*80))>0 THEN "
    "greatest(least(vel.value/1000/cos(radians(coh.value*80))*1000, 200), -200) END AS value FROM vel LEFT JOIN coh USING (row, col)",
    "value"))
def _(d):
    """Vertical velocity of the export, each pixel at its own incidence angle."""
    v = d.vel.select("row", "col", (val() / 1000).alias("velocity"), F.lit(0.001).alias("velocity_std"))
    return FL.export_velocity(v, d.coh, incidence=d.coh.withColumn("value", val() * 80))["subsidence_velocity"]


@query("los_to_vertical_by_angle", sql(
    "vel coh", "SELECT vel.row, vel.col, CASE WHEN cos(radians(coh.value*80))>0 THEN "
    "vel.value/cos(radians(coh.value*80)) END AS value FROM vel LEFT JOIN coh USING (row, col)",
    "value"))
def _(d):
    both = A.aligned(d.vel, d.coh, "c")
    return both.select(
        "row", "col", S.los_to_vertical_by_angle(val(), F.col("c") * 80).alias("value"))


@query("vegetation_water_indices", sql(
    "r_bands", "SELECT row, col, CASE WHEN nir<>0 AND red<>0 THEN (nir-red)/(nir+red) END AS ndvi, "
    "CASE WHEN green<>0 AND swir<>0 THEN (green-swir)/(green+swir) END AS mndwi, "
    "CASE WHEN nir+red>0 THEN (nir/10000-red/10000)/(nir/10000+red/10000) END AS scaled "
    "FROM r_bands", "ndvi mndwi scaled"))
def _(d):
    return d.r_bands.select(
        "row", "col", S.ndvi(F.col("nir"), F.col("red")).alias("ndvi"),
        S.mndwi(F.col("green"), F.col("swir")).alias("mndwi"),
        S.scaled_ndvi(F.col("nir"), F.col("red")).alias("scaled"))


@query("proximity_risk", sql(
    "d_canal", "SELECT row, col, greatest(least(1-distance/1200, 1.0), 0.0) AS value FROM d_canal",
    "value"))
def _(d):
    return d.d_canal.select("row", "col", S.proximity_risk(F.col("distance")).alias("value"))


@query("combined_risk", sql(
    "vel d_canal", "SELECT row, col, greatest(least((0.45*greatest(least(1-distance/1200,1.0),0.0)"
    "+0.55*(CASE WHEN value<0 THEN least(-value/40.0,1.0) ELSE 0.0 END))/(0.45+0.55),1.0),0.0) "
    "AS value FROM vel JOIN d_canal USING (row, col)", "value"))
def _(d):
    both = A.aligned(d.vel, d.d_canal, "dist", value="distance")
    return both.select("row", "col", S.combined_risk(
        S.proximity_risk(F.col("dist")), S.subsidence_risk(val())).alias("value"))


@query("forest_clearing_factor", sql(
    "r_lossyear", "SELECT row, col, CASE WHEN lossyear>0 THEN CAST(2024-(2000+lossyear) AS DOUBLE) "
    "END AS years, CASE WHEN lossyear>0 AND 2024-(2000+lossyear)<=5 THEN 1.2 WHEN lossyear>0 AND "
    "2024-(2000+lossyear)<=15 THEN 1.0 WHEN lossyear>0 THEN 0.8 WHEN treecover>=50 THEN 0.6 "
    "ELSE 1.0 END AS factor FROM r_lossyear", "years factor"))
def _(d):
    years = S.time_since_clearing(F.col("lossyear"))
    return d.r_lossyear.select("row", "col", years.alias("years")).join(
        d.r_lossyear, ["row", "col"]
    ).select("row", "col", "years", S.clearing_risk_factor(
        F.col("years"), F.col("treecover")).alias("factor"))


@query("peat_risk_weight", sql(
    "c_peat", "SELECT row, col, CASE depth_class WHEN 1 THEN 0.6 WHEN 2 THEN 0.8 WHEN 3 THEN 1.0 "
    "ELSE 0.0 END AS weight FROM c_peat", "weight"))
def _(d):
    return d.c_peat.select("row", "col", S.peat_risk_weight(F.col("depth_class")).alias("weight"))


CLASS = ("CASE WHEN value IS NULL THEN 0 WHEN value<-50 THEN 1 WHEN value<-20 THEN 2 "
         "WHEN value<-5 THEN 3 WHEN value<5 THEN 4 ELSE 5 END")


@query("classify_subsidence", sql(
    "vel m_water", f"SELECT v.row, v.col, CASE WHEN w.row IS NOT NULL THEN 6 ELSE {CLASS} END "
    "AS class FROM vel v LEFT JOIN m_water w ON v.row=w.row AND v.col=w.col"))
def _(d):
    return A.classify(d.vel, d.m_water)


@query("pixel_coordinates", sql(
    "vv", "SELECT row, col, 114.3+col*0.0005 AS lon, -2.5-row*0.0005 AS lat, "
    "111320*cos(radians(abs(-2.5-row*0.0005))) AS m_per_deg_x, 111320.0 AS m_per_deg_y FROM vv",
    "lon lat m_per_deg_x m_per_deg_y"))
def _(d):
    g = Grid(0, 0, 0.0005, 0.0, 114.3, 0.0, -0.0005, -2.5)
    lon, lat = geodesy.pixel_to_lonlat(F.col("row"), F.col("col"), g)
    at = d.vv.select("row", "col", lon.alias("lon"), lat.alias("lat"))
    mx, my = geodesy.metres_per_degree(F.col("lat"))
    return at.withColumns({"m_per_deg_x": mx, "m_per_deg_y": my})


_NS = ("printf('%02d', CAST(abs(floor(lat/10)*10+10) AS INT)) || "
       "CASE WHEN floor(lat/10)*10+10>=0 THEN 'N' ELSE 'S' END || '_' || "
       "printf('%03d', CAST(abs(floor(lon/10)*10) AS INT)) || "
       "CASE WHEN floor(lon/10)*10>=0 THEN 'E' ELSE 'W' END")


@query("forest_tile_name", sql("v_places", f"SELECT place_id, {_NS} AS tile_name FROM v_places"))
def _(d):
    return d.v_places.select(
        "place_id", geodesy.forest_tile_name(F.col("lon"), F.col("lat")).alias("tile_name"))


@query("dem_tile_cover", sql(
    "", "SELECT area_id, CAST(lat AS BIGINT) AS lat, CAST(lon AS BIGINT) AS lon, "
    "'Copernicus_DSM_COG_10_' || CASE WHEN lat>=0 THEN 'N' ELSE 'S' END || "
    "printf('%02d', CAST(abs(lat) AS INT)) || '_00_' || CASE WHEN lon>=0 THEN 'E' ELSE 'W' END || "
    "printf('%03d', CAST(abs(lon) AS INT)) || '_00_DEM' AS tile_name FROM ("
    "SELECT area_id, lat, unnest(generate_series(CAST(floor(west-0.15) AS BIGINT), "
    "CAST(ceil(east+0.15) AS BIGINT)-1)) AS lon FROM (SELECT *, unnest(generate_series("
    "CAST(floor(south-0.15) AS BIGINT), CAST(ceil(north+0.15) AS BIGINT)-1)) AS lat FROM areas))",
    areas="SELECT c_custkey AS area_id, CAST((c_custkey*7)%340 AS DOUBLE)-170+0.31 AS west, "
          "CAST((c_custkey*7)%340 AS DOUBLE)-170+1.27 AS east, CAST((c_custkey*11)%150 AS DOUBLE)"
          "-75+0.44 AS south, CAST((c_custkey*11)%150 AS DOUBLE)-75+1.02 AS north FROM customer"))
def _(d):
    from groundswell.sources.scenes import tile_cover

    k = F.col("c_custkey")
    west, south = (k * 7) % 340 - 170.0, (k * 11) % 150 - 75.0
    return tile_cover(d.table("customer").select(
        k.alias("area_id"), (west + 0.31).alias("west"), (west + 1.27).alias("east"),
        (south + 0.44).alias("south"), (south + 1.02).alias("north")))


@query("parse_product_names", sql(
    "", "SELECT event_id, CASE WHEN upper(name) LIKE 'S1B%' THEN 'S1B' ELSE 'S1A' END AS platform, "
    "CASE WHEN event_id%5=0 THEN NULL ELSE date_trunc('second', ts) END AS acquired, "
    "date_trunc('second', ts) AS valid_from, date_trunc('second', ts + INTERVAL 1 DAY) AS valid_to "
    "FROM (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, CASE event_id%3 WHEN 0 THEN 's1b_IW' WHEN 1 THEN "
    "'S1A_IW' ELSE 'XX_IW' END AS name FROM events)"))
def _(d):
    ts = F.col("ts").cast("timestamp")
    stamp = lambda t: F.date_format(t, "yyyyMMdd'T'HHmmss")
    k = F.col("event_id") % 3
    head = F.when(k == 0, "s1b_IW").when(k == 1, "S1A_IW").otherwise("XX_IW")
    name = F.when(F.col("event_id") % 5 == 0, head).otherwise(
        F.concat_ws("_", head, stamp(ts), stamp(ts + F.expr("INTERVAL 1 MINUTE"))))
    orbit = F.concat(F.lit("S1A_OPER_AUX_V"), stamp(ts), F.lit("_"),
                     stamp(ts + F.expr("INTERVAL 1 DAY")), F.lit(".EOF"))
    a, b = naming.orbit_validity(F.col("orbit"))
    return d.table("events").select("event_id", name.alias("name"), orbit.alias("orbit")).select(
        "event_id", naming.platform_of(F.col("name")).alias("platform"),
        naming.acquisition_time(F.col("name")).alias("acquired"),
        a.alias("valid_from"), b.alias("valid_to"))


@query("parse_date_any", sql(
    "", "SELECT event_id, CASE event_id%5 WHEN 0 THEN date_trunc('second', t) WHEN 1 THEN "
    "date_trunc('day', t) WHEN 2 THEN date_trunc('day', t) WHEN 3 THEN date_trunc('second', t) END "
    "AS parsed FROM (SELECT event_id, CAST(ts AS TIMESTAMP) AS t FROM events)"))
def _(d):
    ts, k = F.col("ts").cast("timestamp"), F.col("event_id") % 5
    text = (
        F.when(k == 0, F.date_format(ts, "yyyyMMdd'T'HHmmss"))
        .when(k == 1, F.date_format(ts, "yyyy-MM-dd")).when(k == 2, F.date_format(ts, "yyyyMMdd"))
        .when(k == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("unknown"))
    return d.table("events").select("event_id", text.alias("text")).select(
        "event_id", naming.parse_date_any(F.col("text")).alias("parsed"))


@query("nearest_feature", sql(
    "v_places", "SELECT place_id, arg_min(name, struct_pack(d := sqrt(pow(lat-flat,2)+pow(lon-flon,2)), k := k)) AS "
    "nearest_feature, min(sqrt(pow(lat-flat,2)+pow(lon-flon,2))) AS distance FROM v_places, (VALUES "
    + ",".join(f"({i},'{n}',{a},{b})" for i, (n, (a, b)) in enumerate(refpoints.STABLE_FEATURES.items()))
    + ") AS f(k,name,flat,flon) GROUP BY place_id", "distance"))
def _(d):
    near = refpoints.nearest_feature(F.col("lat"), F.col("lon"))
    return d.v_places.select("place_id", near.alias("n")).select(
        "place_id", F.col("n.name").alias("nearest_feature"), F.col("n.distance").alias("distance"))


# --- Masks and algebra ----------------------------------------------------------------


@query("valid_pairs", sql(
    "vel coh", "SELECT vel.row, vel.col, vel.value AS value, coh.value AS other FROM vel JOIN coh "
    "USING (row, col) WHERE vel.value IS NOT NULL AND coh.value IS NOT NULL", "value other"))
def _(d):
    return A.valid_pairs(d.vel, d.coh)


@query("water_mask_db", sql("vv", "SELECT row, col FROM vv WHERE 10*log10(value) < -20"))
def _(d):
    return A.water_mask_db(d.vv.withColumn("value", F.lit(10.0) * F.log10("value")))


@query("water_mask_linear", sql(
    "vv", "SELECT row, col FROM vv WHERE value>0 AND value < pow(10.0, -2.0)"))
def _(d):
    return A.water_mask_linear(d.vv)


@query("exclude_canals", sql(
    "m_water m_canal", "SELECT row, col FROM m_water w WHERE NOT EXISTS (SELECT 1 FROM m_canal c "
    "WHERE c.row=w.row AND c.col=w.col)"))
def _(d):
    return A.exclude_canals(d.m_water, d.m_canal)


@query("mask_union", sql(
    "m_water m_canal", "SELECT row, col FROM m_water UNION SELECT row, col FROM m_canal"))
def _(d):
    return A.mask_union(d.m_water, d.m_canal)


@query("mask_intersection", sql(
    "m_water m_canal", "SELECT row, col FROM m_water INTERSECT SELECT row, col FROM m_canal"))
def _(d):
    return A.mask_intersection(d.m_water, d.m_canal)


@query("coherence_mask", sql(
    "vel coh", "SELECT vel.row, vel.col, CASE WHEN coh.value<0.5 THEN NULL ELSE vel.value END AS "
    "value FROM vel LEFT JOIN coh USING (row, col)", "value"))
def _(d):
    return A.coherence_mask(d.vel, d.coh)


@query("aoi_clip", sql(
    "vel", "SELECT row-4 AS row, col-20 AS col, value FROM vel WHERE row>=4 AND col>=20 AND col<80 "
    "AND row < 1000000", "value"))
def _(d):
    return A.window_clip(d.vel, 4, 1000000, 20, 80)


@query("apply_peat_mask", sql(
    "vel m_peat", "SELECT v.row, v.col, CASE WHEN p.row IS NOT NULL THEN v.value END AS value FROM "
    "vel v LEFT JOIN m_peat p ON v.row=p.row AND v.col=p.col", "value"))
def _(d):
    return A.apply_peat_mask(d.vel, d.m_peat)


@query("degraded_mask", sql(
    "vel m_water m_peat", "SELECT v.row, v.col, CASE WHEN v.value<-10 AND w.row IS NULL AND p.row "
    "IS NOT NULL THEN 1 ELSE 0 END AS degraded, v.value IS NOT NULL AS is_valid FROM vel v LEFT "
    "JOIN m_water w ON v.row=w.row AND v.col=w.col LEFT JOIN m_peat p ON v.row=p.row AND "
    "v.col=p.col"))
def _(d):
    return A.degraded_mask(d.vel, d.m_water, d.m_peat)


@query("peat_weighted_risk", sql(
    "risk c_peat", "SELECT row, col, CASE WHEN w<>0 THEN value*w END AS value FROM (SELECT r.row, "
    "r.col, r.value, CASE depth_class WHEN 1 THEN 0.6 WHEN 2 THEN 0.8 WHEN 3 THEN 1.0 ELSE 0 END "
    "AS w FROM risk r LEFT JOIN c_peat p ON r.row=p.row AND r.col=p.col)", "value"))
def _(d):
    return A.peat_weighted_risk(d.risk, d.c_peat)


@query("time_adjusted_risk", sql(
    "risk r_lossyear", "SELECT r.row, r.col, CASE WHEN r.value IS NOT NULL THEN greatest(least("
    "r.value*(CASE WHEN lossyear>0 AND 24-lossyear<=5 THEN 1.2 WHEN lossyear>0 AND 24-lossyear<=15 "
    "THEN 1.0 WHEN lossyear>0 THEN 0.8 WHEN treecover>=50 THEN 0.6 ELSE 1.0 END),1.0),0.0) END AS "
    "value FROM risk r JOIN r_lossyear l ON r.row=l.row AND r.col=l.col", "value"))
def _(d):
    from groundswell.plans.products import forest_products

    return A.time_adjusted_risk(d.risk, forest_products(d.r_lossyear))


@query("calibrate_velocity", sql(
    "vel coh", "SELECT row, col, value + (SELECT -25.0 - CASE WHEN count(CASE WHEN coh.value>0.7 "
    "THEN vel.value END)>=50 THEN avg(CASE WHEN coh.value>0.7 THEN vel.value END) ELSE "
    "avg(vel.value) END FROM vel LEFT JOIN coh USING (row, col)) AS value FROM vel", "value"))
def _(d):
    return A.calibrate_velocity(d.vel, d.coh)


FUSED = (
    "SELECT c.row, c.col, c.value AS cv, cc.value AS cc, l.value AS lv, lc.value AS lc, "
    "coalesce(c.value IS NOT NULL AND cc.value>=0.3, false) AS cok, "
    "coalesce(l.value IS NOT NULL AND lc.value>=0.3, false) AS lok FROM vel c "
    "LEFT JOIN coh cc ON c.row=cc.row AND c.col=cc.col "
    "LEFT JOIN vel_l l ON c.row=l.row AND c.col=l.col "
    "LEFT JOIN coh_l lc ON c.row=lc.row AND c.col=lc.col"
)
FUSED_OUT = (
    "SELECT row, col, CASE WHEN cok AND lok THEN (cc*1.5*cv+lc*lv)/(cc*1.5+lc) WHEN cok THEN cv "
    "WHEN lok THEN lv END AS value, CASE WHEN cc IS NOT NULL AND lc IS NOT NULL THEN "
    "greatest(cc,lc) END AS coherence, CAST(cok AS INT)+2*CAST(lok AS INT) AS coverage FROM both_s"
)


@query("fuse_sensors", sql("vel coh vel_l coh_l", FUSED_OUT, "value coherence", both_s=FUSED))
def _(d):
    return A.fuse(d.vel, d.coh, d.vel_l, d.coh_l, 0.3, 1.5)


@query("forest_products", sql(
    "r_lossyear", "SELECT row, col, lossyear, treecover, CASE WHEN lossyear>0 THEN "
    "CAST(24-lossyear AS DOUBLE) END AS years_since_clearing, CASE WHEN lossyear>0 AND "
    "24-lossyear<=5 THEN 1.2 WHEN lossyear>0 AND 24-lossyear<=15 THEN 1.0 WHEN lossyear>0 THEN 0.8 "
    "WHEN treecover>=50 THEN 0.6 ELSE 1.0 END AS value FROM r_lossyear", "value"))
def _(d):
    from groundswell.plans.products import forest_products

    return forest_products(d.r_lossyear)
