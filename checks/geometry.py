"""Grids and shapes: calibration, projection, resampling, rasterising, deramping, storage."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import sql
from groundswell.frames import ensure_checkpoint_dir, val
from groundswell.functions import geodesy as GD
from groundswell.functions.geodesy import Grid
from groundswell.operators import bursts as B
from groundswell.operators import geometry as G
from groundswell.operators import morphology as M
from groundswell.operators import stats as ST
from groundswell.sources import raster as RS

CELLS = ("SELECT a.line AS line0, b.line AS line1, a.pixel AS pixel0, b.pixel AS pixel1, a.value AS "
         "v00, c.value AS v01, e.value AS v10, b.value AS v11 FROM v_lut a JOIN v_lut b ON b.line="
         "(SELECT min(line) FROM v_lut WHERE line>a.line) AND b.pixel=(SELECT min(pixel) FROM v_lut "
         "WHERE pixel>a.pixel) JOIN v_lut c ON c.line=a.line AND c.pixel=b.pixel JOIN v_lut e ON "
         "e.line=b.line AND e.pixel=a.pixel")


@query("calibrate", sql(
    "vv v_lut", "SELECT row, col, v*v*1e10/((l*(1-fx)+r*fx)*(l*(1-fx)+r*fx)) AS value FROM (SELECT "
    "row, col, value AS v, least(greatest((col-pixel0)/(pixel1-pixel0),0),1) AS fx, "
    "v00+(v10-v00)*least(greatest((row-line0)/(line1-line0),0),1) AS l, v01+(v11-v01)*"
    "least(greatest((row-line0)/(line1-line0),0),1) AS r FROM vv JOIN cells ON line0=(SELECT "
    "max(line0) FROM cells WHERE line0<=vv.row) AND pixel0=(SELECT max(pixel0) FROM cells WHERE "
    "pixel0<=vv.col))", "value", cells=CELLS))
def _(d):
    return G.calibrate(d.vv.withColumn("value", val() * 1e5), d.v_lut)


# Eight scenes, each with a table of its own nodes; scene 8 has a single line of them.
SCENES_SQL = "(SELECT unnest(generate_series(1,8)) AS scene_id)"
LUTS = (f"SELECT s.scene_id, l.line+3*s.scene_id AS line, l.pixel+2*s.scene_id AS pixel, l.value+10*s.scene_id AS value FROM v_lut l "
        f"CROSS JOIN {SCENES_SQL} s WHERE s.scene_id<8 OR l.line=40")
#: Nodes around a place on one axis: the last one at or before it (but not the last of all) and the next.
AXIS = ("SELECT scene_id, x AS {k}, a AS {k}0, coalesce(nxt, a) AS {k}1, CASE WHEN nxt IS NULL THEN 0 ELSE "
        "least(greatest((x-a)/(nxt-a),0),1) END AS f{k} FROM (SELECT n.scene_id, p.x, max(n.{k}) AS a, max_by(n.nxt, n.{k}) AS nxt "
        "FROM (SELECT DISTINCT {c} AS x FROM vv) p JOIN (SELECT scene_id, {k}, lead({k}) OVER w AS nxt, row_number() OVER w AS r, "
        "count(*) OVER (PARTITION BY scene_id) AS m FROM (SELECT DISTINCT scene_id, {k} FROM luts) WINDOW w AS (PARTITION BY scene_id "
        "ORDER BY {k})) n ON (n.{k}<=p.x OR r=1) AND (r<m OR m=1) GROUP BY n.scene_id, p.x)")
BY_SCENE = {"luts": LUTS, "lines": AXIS.format(k="line", c="row"),
            "pixels": AXIS.format(k="pixel", c="col"),
            "sigma0": "SELECT y.scene_id, vv.row, vv.col, pow(vv.value*1e5*(1+y.scene_id*0.1),2)/pow((a.value*(1-fline)+b.value*fline)*"
                      "(1-fpixel)+(c.value*(1-fline)+e.value*fline)*fpixel,2) AS value FROM vv JOIN lines y ON y.line=vv.row JOIN pixels "
                      "x ON x.pixel=vv.col AND x.scene_id=y.scene_id JOIN luts a ON a.scene_id=y.scene_id AND a.line=line0 AND "
                      "a.pixel=pixel0 JOIN luts b ON b.scene_id=y.scene_id AND b.line=line1 AND b.pixel=pixel0 JOIN luts c ON "
                      "c.scene_id=y.scene_id AND c.line=line0 AND c.pixel=pixel1 JOIN luts e ON e.scene_id=y.scene_id AND e.line=line1 "
                      "AND e.pixel=pixel1"}


def scenes(d):
    """Digital numbers and calibration tables of eight scenes."""
    each = F.explode(F.sequence(F.lit(1), F.lit(8))).alias("scene_id")
    dn = d.vv.select("row", "col", "value", each).withColumn("value", val() * 1e5 * (F.col("scene_id") * 0.1 + 1))
    k = F.col("scene_id")
    lut = d.v_lut.select("line", "pixel", "value", each).where("scene_id < 8 OR line = 40").select(
        "scene_id", (F.col("line") + k * 3).alias("line"), (F.col("pixel") + k * 2).alias("pixel"), (val() + k * 10).alias("value"))
    return dn, lut


@query("calibrate_by_scene", sql("vv v_lut", "SELECT scene_id, row, col, value FROM sigma0", "value", **BY_SCENE))
def _(d):
    return G.calibrate(*scenes(d), ["scene_id"])



def utm_sql(lon: str, lat: str, epsg: int) -> tuple[str, str]:
    """Krueger series as SQL text (x, y)."""
    lon0, north0 = GD._zone(epsg)
    phi, lam = f"radians({lat})", f"(radians({lon})-{lon0!r})"
    e, k = GD._E, GD._SCALE * GD._RADIUS
    t = f"sinh(atanh(sin({phi}))-{e!r}*atanh({e!r}*sin({phi})))"
    xi = f"atan2({t},cos({lam}))"
    eta = f"asinh(sin({lam})/sqrt({t}*{t}+cos({lam})*cos({lam})))"
    ex = "".join(f"+{a!r}*cos({2 * j}*{xi})*sinh({2 * j}*{eta})" for j, a in enumerate(GD.ALPHA, 1))
    no = "".join(f"+{a!r}*sin({2 * j}*{xi})*cosh({2 * j}*{eta})" for j, a in enumerate(GD.ALPHA, 1))
    return f"500000.0+{k!r}*({eta}{ex})", f"{north0!r}+{k!r}*({xi}{no})"


PLACES = ("SELECT c_custkey AS place_id, 111.0+(c_custkey*7919%5000)/CAST(1000 AS DOUBLE) AS lon, "
          "-3.0+(c_custkey*104729%4000)/CAST(1000 AS DOUBLE) AS lat FROM customer")


def _places(d):
    k = F.col("c_custkey")
    return d.table("customer").select(
        k.alias("place_id"), (k * 7919 % 5000 / 1000.0 + 111.0).alias("lon"),
        (k * 104729 % 4000 / 1000.0 - 3.0).alias("lat"))


_X, _Y = utm_sql("lon", "lat", 32649)


@query("project_utm", sql("", f"SELECT place_id, {_X} AS x, {_Y} AS y FROM places", "x y",
                          digits=4, places=PLACES), digits=4)
def _(d):
    x, y = GD.project_utm(F.col("lon"), F.col("lat"), 32649)
    return _places(d).select("place_id", x.alias("x"), y.alias("y"))


@query("unproject_utm", sql("", "SELECT place_id, lon, lat FROM places", "lon lat", places=PLACES))
def _(d):
    """Projected and back: the inverse must give the input again."""
    x, y = GD.project_utm(F.col("lon"), F.col("lat"), 32749)
    at = _places(d).select("place_id", x.alias("x"), y.alias("y"))
    lon, lat = GD.unproject_utm(F.col("x"), F.col("y"), 32749)
    return at.select("place_id", lon.alias("lon"), lat.alias("lat"))


@query("scatter_geocode", sql(
    "", "SELECT CAST(trunc((y1-y)/5000) AS INT) AS row, CAST(trunc((x-x0)/5000) AS INT) AS col, "
    "arg_max(place_id*0.37, place_id) AS value FROM xy, (SELECT min(x) AS x0, max(x) AS x1, min(y) "
    "AS y0, max(y) AS y1 FROM xy) WHERE trunc((y1-y)/5000)<ceil((y1-y0)/5000) AND "
    "trunc((x-x0)/5000)<ceil((x1-x0)/5000) GROUP BY 1, 2", "value", places=PLACES,
    xy=f"SELECT place_id, {_X} AS x, {_Y} AS y FROM places"))
def _(d):
    samples = _places(d).select(
        "lon", "lat", F.col("place_id").alias("src_index"), (F.col("place_id") * 0.37).alias("value"))
    return G.scatter_geocode(samples, 32649, 5000.0)


def _height(d) -> int:
    """Image height: one number for the grid description."""
    return d.vv.agg(F.max("row")).first()[0] + 1


SRC = lambda h: Grid(h, 125, 10.0, 0.0, 0.0, 0.0, -10.0, 0.0, 32649)
TGT = lambda h: Grid((h * 10 - 40) // 7, 165, 7.0, 0.0, 33.3, 0.0, -7.0, -21.7, 32649)
AT = ("SELECT r AS row, c AS col, (21.7+(r+0.5)*7)/10 AS y, (33.3+(c+0.5)*7)/10 AS x FROM (SELECT "
      "unnest(generate_series(0, (SELECT CAST(floor(((max(row)+1)*10-40)/7) AS INT)-1 FROM vv))) AS "
      "r) a CROSS JOIN (SELECT unnest(generate_series(0,164)) AS c) b")


@query("resample_nearest", sql(
    "vel vv", "SELECT a.row, a.col, v.value FROM at_t a LEFT JOIN vel v ON v.row=floor(a.y) AND "
    "v.col=floor(a.x)", "value", at_t=AT))
def _(d):
    h = _height(d)
    return G.resample(d.vel, SRC(h), TGT(h), "nearest")


@query("resample_bilinear", sql(
    "vel vv", "SELECT row, col, CASE WHEN sum(CASE WHEN value IS NOT NULL THEN w END)>0 AND "
    "any_value(y)>=0 AND any_value(x)>=0 AND any_value(x)<125 AND any_value(y)<(SELECT max(row)+1 "
    "FROM vv) THEN sum(w*value)/sum(CASE WHEN value IS NOT NULL THEN w END) END AS value FROM "
    "(SELECT a.row, a.col, a.y, a.x, v.value, (CASE dr WHEN 0 THEN 1-(a.y-0.5-floor(a.y-0.5)) ELSE "
    "a.y-0.5-floor(a.y-0.5) END)*(CASE dc WHEN 0 THEN 1-(a.x-0.5-floor(a.x-0.5)) ELSE "
    "a.x-0.5-floor(a.x-0.5) END) AS w FROM at_t a CROSS JOIN (VALUES (0,0),(0,1),(1,0),(1,1)) AS "
    "k(dr,dc) LEFT JOIN src v ON v.row=floor(a.y-0.5)+dr AND v.col=floor(a.x-0.5)+dc) GROUP BY row, "
    "col", "value", at_t=AT, src="SELECT row, col, value/sqrt(7) AS value FROM vel"))
def _(d):
    h = _height(d)
    src = d.vel.withColumn("value", val() / F.sqrt(F.lit(7)))
    return G.resample(src, SRC(h), TGT(h), "bilinear")


@query("align_to_reference", sql(
    "vel_l", "SELECT row-3 AS row, col-5 AS col, value FROM vel_l", "value"))
def _(d):
    """L-band pixels sit 3 rows and 5 columns away from the C-band grid."""
    h = _height(d)
    source = Grid(h + 3, 130, 10.0, 0.0, 0.0, 0.0, -10.0, 0.0, 32649)
    target = Grid(h, 125, 10.0, 0.0, 50.0, 0.0, -10.0, -30.0, 32649)
    return G.align_to(d.vel_l, source, target, "bilinear")


def _series(first: str, second: str, terms, angle: str, other: str) -> str:
    """Sum of terms[j] * first(2 j angle) * second(2 j other)."""
    return "(" + "+".join(f"({t!r})*{first}({angle}*{2 * j})" + (f"*{second}({other}*{2 * j})" if second else "")
                          for j, t in enumerate(terms, 1)) + ")"


_K = repr(GD._SCALE * GD._RADIUS)


def _to_utm(rows: str, central: float) -> str:
    """Rows with lon and lat, with x and y added: the forward series step by step, north of the equator's zero."""
    return (f"SELECT * EXCLUDE (t, l, xi, eta), 500000.0::DOUBLE+{_K}*(eta+{_series('cos', 'sinh', GD.ALPHA, 'xi', 'eta')}) AS x, "
            f"{_K}*(xi+{_series('sin', 'cosh', GD.ALPHA, 'xi', 'eta')}) AS y FROM (SELECT *, atan2(t, cos(l)) AS xi, "
            f"asinh(sin(l)/sqrt(t*t+cos(l)*cos(l))) AS eta FROM (SELECT *, sinh(atanh(sin(radians(lat)))-{GD._E!r}*atanh({GD._E!r}*"
            f"sin(radians(lat)))) AS t, radians(lon)-{math.radians(central)!r} AS l FROM ({rows})))")


def _from_utm(rows: str, central: float) -> str:
    """Rows with x and y, with lon and lat added: the inverse series step by step."""
    return (f"SELECT * EXCLUDE (xi, eta, xi1, eta1, chi), degrees(atan2(sinh(eta1), cos(xi1))+{math.radians(central)!r}) AS lon, "
            f"degrees(chi+{_series('sin', '', GD.DELTA, 'chi', '')}) AS lat FROM (SELECT *, asin(sin(xi1)/cosh(eta1)) AS chi FROM "
            f"(SELECT *, xi-{_series('sin', 'cosh', GD.BETA, 'xi', 'eta')} AS xi1, eta-{_series('cos', 'sinh', GD.BETA, 'xi', 'eta')} AS eta1 "
            f"FROM (SELECT *, y/{_K} AS xi, (x-500000)/{_K} AS eta FROM ({rows}))))")


# Outline of the source grid (125 columns of 1e-4 degrees from 114.3 E, 2.5 S) with 21 steps a side, in zone 49 N.
_OUTLINE = ("SELECT 114.3+0.0001*(CASE side WHEN 0 THEN s*125 WHEN 1 THEN 125.0 WHEN 2 THEN s*125 ELSE 0.0 END) AS lon, "
            "-2.5-0.0001*(CASE side WHEN 0 THEN 0.0 WHEN 1 THEN s*h WHEN 2 THEN h*1.0 ELSE s*h END) AS lat FROM (SELECT (i%22)/21.0::DOUBLE AS s, "
            "i//22 AS side, h FROM (SELECT unnest(range(88)) AS i), (SELECT max(row)+1 AS h FROM vv))")
BOX = ("SELECT min(x) AS west, max(y) AS north, greatest(1, ceil((max(x)-min(x))/{r}))::INT AS width, "
       "greatest(1, ceil((max(y)-min(y))/{r}))::INT AS height FROM ({o})").replace("{o}", _to_utm(_OUTLINE, 111))
# Target pixels with the fractional place of their centres on the source grid.
PLACES = _from_utm("SELECT r AS row, c AS col, west+(c+0.5)*{r} AS x, north-(r+0.5)*{r} AS y FROM box, "
                   "unnest(range(height)) AS a(r), unnest(range(width)) AS b(c)", 111)


def _degrees(d) -> Grid:
    return Grid(_height(d), 125, 0.0001, 0.0, 114.3, 0.0, -0.0001, -2.5, 4326)


@query("target_grid", sql("vv", "SELECT * FROM box", "west north", box=BOX.format(r=30)))
def _(d):
    g = G.target_grid(d.spark, _degrees(d), 32649, 30.0)
    # The box is all that comes back; the row is made from it.
    return d.spark.range(1).select(
        F.lit(g.c).alias("west"), F.lit(g.f).alias("north"), F.lit(g.width).alias("width"), F.lit(g.height).alias("height"))


@query("reproject_to_utm", sql(
    "vel vv", "SELECT p.row, p.col, v.value FROM places p LEFT JOIN vel v ON v.row=floor((p.lat+2.5)/(-0.0001)) AND "
    "v.col=floor((p.lon-114.3)/0.0001)", "value", box=BOX.format(r=10), places=PLACES.format(r=10)))
def _(d):
    """Degrees to UTM on a derived target grid, nearest source pixel."""
    return G.resample(d.vel, _degrees(d), G.target_grid(d.spark, _degrees(d), 32649, 10.0), "nearest")


@query("reproject_bilinear", sql(
    "vel vv", "SELECT row, col, CASE WHEN sum(w) FILTER (WHERE value IS NOT NULL)>0 AND any_value(y)>=0 AND any_value(x)>=0 AND "
    "any_value(x)<125 AND any_value(y)<(SELECT max(row)+1 FROM vv) THEN sum(w*value)/(sum(w) FILTER (WHERE value IS NOT NULL)) "
    "END AS value FROM (SELECT a.*, v.value, (CASE dr WHEN 0 THEN 1-(y-0.5-floor(y-0.5)) ELSE y-0.5-floor(y-0.5) END)*"
    "(CASE dc WHEN 0 THEN 1-(x-0.5-floor(x-0.5)) ELSE x-0.5-floor(x-0.5) END) AS w FROM (SELECT row, col, (lat+2.5)*0.0001::DOUBLE/(0.0001::DOUBLE*-0.0001) AS y, "
    "(lon-114.3)*-0.0001::DOUBLE/(0.0001::DOUBLE*-0.0001) AS x FROM places) a CROSS JOIN (VALUES (0,0),(0,1),(1,0),(1,1)) AS k(dr,dc) LEFT JOIN vel v ON "
    "v.row=floor(y-0.5)+dr AND v.col=floor(x-0.5)+dc) GROUP BY row, col", "value", digits=3, box=BOX.format(r=7), places=PLACES.format(r=7)), digits=3)
def _(d):
    """Degrees to UTM, bilinear.  Three digits: an ulp of a longitude moves a value by some 1e-8."""
    return G.resample(d.vel, _degrees(d), G.target_grid(d.spark, _degrees(d), 32649, 7.0), "bilinear")


#: Each feature with a second part to its right and a hole in the first: even-odd over all rings.
RINGS = ("SELECT feature_id, ring_id, seq, CASE ring_id WHEN 0 THEN x WHEN 1 THEN x+23.11 ELSE cx+(x-cx)*0.37 END AS x, CASE ring_id "
         "WHEN 2 THEN cy+(y-cy)*0.37 ELSE y END AS y FROM (SELECT *, avg(x) OVER (PARTITION BY feature_id) AS cx, avg(y) OVER "
         "(PARTITION BY feature_id) AS cy FROM v_rings) CROSS JOIN (SELECT unnest([0,1,2]) AS ring_id)")


@query("rasterize_polygons_with_holes", sql(
    "vv v_rings", "SELECT DISTINCT row, col FROM (SELECT p.row, p.col, e.feature_id, count(*) AS n "
    "FROM vv p JOIN edges e ON (e.y<=p.row+0.5)<>(e.y1<=p.row+0.5) AND p.col+0.5 < e.x+(p.row+0.5-"
    "e.y)/(e.y1-e.y)*(e.x1-e.x) GROUP BY p.row, p.col, e.feature_id) WHERE n%2=1", rings=RINGS,
    edges="SELECT feature_id, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x1, coalesce(lead(y) OVER w, first_value(y) "
          "OVER w) AS y1 FROM rings WINDOW w AS (PARTITION BY feature_id, ring_id ORDER BY seq)"))
def _(d):
    """Vertices arrive in degrees and go through the grid to pixel units."""
    middle = d.v_rings.groupBy("feature_id").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    k = F.col("ring_id")
    rings = d.v_rings.join(middle, "feature_id").withColumn("ring_id", F.explode(F.array(*map(F.lit, (0, 1, 2))))).select(
        "feature_id", "ring_id", "seq",
        F.when(k == 0, F.col("x")).when(k == 1, F.col("x") + 23.11).otherwise(F.col("cx") + (F.col("x") - F.col("cx")) * 0.37).alias("x"),
        F.when(k == 2, F.col("cy") + (F.col("y") - F.col("cy")) * 0.37).otherwise(F.col("y")).alias("y"))
    grid = Grid(_height(d), 125, 0.001, 0.0, 114.0, 0.0, -0.001, -2.0)
    degrees = rings.withColumns({"x": F.col("x") * 0.001 + 114.0, "y": F.col("y") * -0.001 - 2.0})
    return G.rasterize_polygons(G.to_pixel_units(degrees, grid, 4326), _height(d), 125)


@query("rasterize_polygons", sql(
    "vv v_rings", "SELECT DISTINCT row, col FROM (SELECT p.row, p.col, e.feature_id, count(*) AS n "
    "FROM vv p JOIN edges e ON (e.y<=p.row+0.5)<>(e.y1<=p.row+0.5) AND p.col+0.5 < e.x+(p.row+0.5-"
    "e.y)/(e.y1-e.y)*(e.x1-e.x) GROUP BY p.row, p.col, e.feature_id) WHERE n%2=1",
    edges="SELECT feature_id, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x1, "
          "coalesce(lead(y) OVER w, first_value(y) OVER w) AS y1 FROM v_rings WINDOW w AS "
          "(PARTITION BY feature_id ORDER BY seq)"))
def _(d):
    return G.rasterize_polygons(d.v_rings, _height(d), 125)


SEG = ("SELECT * FROM (SELECT way_id, x, y, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM ways "
       "WINDOW w AS (PARTITION BY way_id ORDER BY seq)) WHERE x1 IS NOT NULL")
CUTS = ("SELECT way_id, x, y, x1, y1, 0.0 AS t FROM seg UNION SELECT way_id, x, y, x1, y1, 1.0 FROM "
        "seg UNION SELECT way_id, x, y, x1, y1, (k-x)/(x1-x) FROM (SELECT *, unnest(generate_series("
        "CAST(floor(least(x,x1)) AS BIGINT)+1, CAST(ceil(greatest(x,x1)) AS BIGINT)-1)) AS k FROM seg) "
        "UNION SELECT way_id, x, y, x1, y1, (k-y)/(y1-y) FROM (SELECT *, unnest(generate_series("
        "CAST(floor(least(y,y1)) AS BIGINT)+1, CAST(ceil(greatest(y,y1)) AS BIGINT)-1)) AS k FROM seg)")
LINES = ("SELECT DISTINCT row, col FROM (SELECT CAST(floor(y+m*(y1-y)) AS INT) AS row, "
         "CAST(floor(x+m*(x1-x)) AS INT) AS col FROM (SELECT *, (t+lead(t) OVER (PARTITION BY way_id, "
         "x, y, x1, y1 ORDER BY t))/2 AS m FROM cuts) WHERE m IS NOT NULL) WHERE row>=0 AND row<h "
         "AND col>=0 AND col<125")
WAYS = ("SELECT * FROM v_ways WHERE waterway<>'river' AND way_id IN (SELECT way_id FROM v_ways GROUP "
        "BY way_id HAVING count(*)>=2)")


@query("waterway_filter", sql("v_ways", "SELECT way_id, waterway, seq, x, y FROM ways", "x y",
                              ways=WAYS))
def _(d):
    return G.waterway_filter(d.v_ways)


@query("rasterize_lines", sql(
    "vv v_ways", LINES.replace("<h", "<(SELECT max(row)+1 FROM vv)"), ways=WAYS, seg=SEG, cuts=CUTS))
def _(d):
    return G.rasterize_lines(G.waterway_filter(d.v_ways), _height(d), 125)


@query("waterway_agreement", sql(
    "vv v_ways m_canal", "SELECT *, CASE WHEN precision+recall>0 THEN 2*precision*recall/"
    "(precision+recall) END AS f1_score FROM (SELECT *, truth_in_detected/truth_pixels AS recall, "
    "truth_in_detected/detected_pixels AS precision FROM (SELECT count(w.row) AS truth_pixels, "
    "count(c.row) AS detected_pixels, count(CASE WHEN c.row IS NOT NULL AND w.row IS NOT NULL THEN "
    "1 END) AS truth_in_detected, count(CASE WHEN c.row IS NULL THEN 1 END) AS "
    "truth_not_in_detected, count(CASE WHEN w.row IS NULL THEN 1 END) AS detected_not_in_truth FROM "
    "m_canal c FULL JOIN wide w ON c.row=w.row AND c.col=w.col))", "recall precision f1_score",
    ways=WAYS, seg=SEG, cuts=CUTS, lines=LINES.replace("<h", "<(SELECT max(row)+1 FROM vv)"),
    wide="SELECT DISTINCT row+dy AS row, col+dx AS col FROM lines CROSS JOIN (SELECT "
         "unnest(generate_series(-1,1)) AS dy) CROSS JOIN (SELECT unnest(generate_series(-1,1)) AS "
         "dx) WHERE row+dy>=0 AND row+dy<(SELECT max(row)+1 FROM vv) AND col+dx>=0 AND col+dx<125"))
def _(d):
    """Canal mask against mapped waterways buffered by one pixel."""
    h = _height(d)
    lines = G.rasterize_lines(G.waterway_filter(d.v_ways), h, 125)
    return ST.mask_agreement(d.m_canal, M.dilate(lines, M.square(1), size=(h, 125)))


@query("polygon_box_filter", sql(
    "v_rings", "SELECT feature_id, seq, x, y FROM v_rings WHERE feature_id IN (SELECT feature_id FROM "
    "v_rings GROUP BY feature_id HAVING min(x)<=60 AND max(x)>=40 AND min(y)<=70 AND max(y)>=30)",
    "x y"))
def _(d):
    return G.features_in_box(d.v_rings, (40, 30, 60, 70)).select("feature_id", "seq", "x", "y")


@query("polygon_box_fallback", sql(
    "v_rings", "SELECT 0 AS feature_id, seq, x, y FROM (VALUES (0,1.0,2.0),(1,9.0,2.0),(2,9.0,7.0),"
    "(3,1.0,7.0)) AS t(seq,x,y) WHERE NOT EXISTS (SELECT 1 FROM v_rings WHERE x>1000)"))
def _(d):
    """No polygon lies there, so the box itself is used."""
    return G.polygons_or_box(G.features_in_box(d.v_rings, (1000, 0, 1001, 1)), (1, 2, 9, 7))


PLANE = ("SELECT scene_id, n, CASE WHEN n<3 THEN 0 ELSE (cc*rv-rc*cv)/(rr*cc-rc*rc) END AS c1, CASE "
         "WHEN n<3 THEN 0 ELSE (rr*cv-rc*rv)/(rr*cc-rc*rc) END AS c2, r, c, m FROM (SELECT scene_id, "
         "count(value) AS n, avg(row) AS r, avg(col) AS c, avg(value) AS m, var_pop(row) AS rr, "
         "var_pop(col) AS cc, covar_pop(row,col) AS rc, covar_pop(row,value) AS rv, "
         "covar_pop(col,value) AS cv FROM src WHERE value IS NOT NULL GROUP BY scene_id)")
RAMPED = ("SELECT row, col, scene_id, max(value)*100+0.01*row+0.02*col AS value FROM r_stack GROUP BY "
          "row, col, scene_id")


@query("deramp_by_scene", sql(
    "r_stack", "SELECT s.row, s.col, s.scene_id, s.value-(m-c1*r-c2*c)-c1*s.row-c2*s.col AS value "
    "FROM src s LEFT JOIN plane p USING (scene_id)", "value", src=RAMPED, plane=PLANE))
def _(d):
    src = d.r_stack.groupBy("row", "col", "scene_id").agg(
        (F.max("value") * 100 + 0.01 * F.col("row") + 0.02 * F.col("col")).alias("value"))
    return G.deramp(src, ["scene_id"])


@query("sample_points", sql(
    "v_points vel", "SELECT point_id, CAST(floor(y) AS INT) AS row, CAST(floor(x) AS INT) AS col, "
    "p.x, p.y, v.value FROM v_points p LEFT JOIN vel v ON v.row=floor(p.y) AND v.col=floor(p.x)",
    "value"))
def _(d):
    return G.sample_points(d.vel, d.v_points, Grid(0, 0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0))


# --- Bursts ---------------------------------------------------------------------------

BURST = ("SELECT CAST(floor(row/30) AS INT) AS burst, row%30 AS row, col, CASE WHEN row%30<25 AND "
         "row>=30 AND (row-30)%30<6 THEN sin((row%30)*1.7+floor(row/30)) ELSE sin(((row%30)-24)*1.7+"
         "floor(row/30)+1) END + col*0.01 AS value FROM vv")
SIZES = "SELECT burst, max(row)+1 AS height, max(col)+1 AS width FROM lines GROUP BY burst"
OVER = (
    "SELECT s.burst, CASE WHEN range>0 AND coalesce(diff/range, 1e9)>0.1 THEN 120 ELSE coalesce(best, "
    "120) END AS overlap FROM pairs s LEFT JOIN (SELECT l.burst, max(value)-min(value) AS range FROM "
    "lines l JOIN pairs s ON s.burst=l.burst AND l.col=s.mid GROUP BY l.burst) r USING (burst) LEFT "
    "JOIN (SELECT burst, min(diff) AS diff, arg_min(k, struct_pack(d := diff, k := k)) AS best FROM "
    "(SELECT t.burst, k, avg(abs(t.value-h.value)) AS diff FROM (SELECT s.burst, s.mid, s.height, "
    "unnest(generate_series(4, CAST(least(200, s.height, s.hb)-1 AS BIGINT))) AS k FROM pairs s) c JOIN lines t "
    "ON t.burst=c.burst AND t.col=c.mid AND t.row>=c.height-k JOIN lines h ON h.burst=c.burst+1 AND "
    "h.col=c.mid AND h.row=t.row-c.height+k GROUP BY t.burst, k) GROUP BY burst) b USING (burst)")
BPAIRS = ("SELECT a.burst, a.height, b.height AS hb, CAST(floor(a.width/2) AS INT) AS mid FROM sizes a "
          "JOIN sizes b ON b.burst=a.burst+1")


def _bursts(d):
    r, b = F.col("row"), F.floor(F.col("row") / 30)
    head = (r % 30 < 25) & (r >= 30) & ((r - 30) % 30 < 6)
    value = F.when(head, F.sin((r % 30) * 1.7 + b)).otherwise(
        F.sin((r % 30 - 24) * 1.7 + b + 1)) + F.col("col") * 0.01
    return d.vv.select(b.cast("int").alias("burst"), (r % 30).alias("row"), "col", value.alias("value"))


@query("burst_overlaps", sql("vv", OVER, lines=BURST, sizes=SIZES, pairs=BPAIRS))
def _(d):
    return B.burst_overlaps(_bursts(d), min_search=4)


@query("merge_bursts", sql(
    "vv", "SELECT CAST(l.row-top+start AS INT) AS row, l.col, l.value FROM lines l JOIN (SELECT *, "
    "coalesce(sum(bot-top) OVER (ORDER BY burst ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) "
    "AS start FROM (SELECT burst, CASE WHEN h-b<=t THEN 0 ELSE t END AS top, CASE WHEN h-b<=t THEN h "
    "ELSE h-b END AS bot FROM (SELECT s.burst, s.height AS h, coalesce(floor(p.overlap/2),0) AS t, "
    "coalesce(floor(n.overlap/2),0) AS b FROM sizes s LEFT JOIN over_t p ON p.burst=s.burst-1 LEFT "
    "JOIN over_t n ON n.burst=s.burst))) c ON c.burst=l.burst AND l.row>=top AND l.row<bot",
    "value", lines=BURST, sizes=SIZES, pairs=BPAIRS, over_t=OVER))
def _(d):
    lines = _bursts(d)
    return B.merge_bursts(lines, B.burst_overlaps(lines, min_search=4))


@query("stack_bursts", sql("vv", "SELECT b.burst*30+b.row AS row, b.col, b.value FROM lines b",
                           "value", lines=BURST))
def _(d):
    return B.merge_bursts(_bursts(d))


# --- Storage --------------------------------------------------------------------------


@query("write_read_raster", sql(
    "vel", "SELECT 'velocity' AS raster_id, row, col, value FROM vel WHERE row>=3 AND row<90 AND "
    "col>=10 AND col<100", "value"))
def _(d):
    """Tiled write, then a windowed read with pushed-down row and column ranges."""
    ensure_checkpoint_dir(d.spark)
    base = f"{d.spark.sparkContext.getCheckpointDir()}/raster-{abs(hash(d.folder)) % 10**8}"
    pixels = d.vel.withColumn("raster_id", F.lit("velocity"))
    RS.write_raster(pixels, base, Grid(_height(d), 125), dtype="double", band="v", tile=64,
                    mode="overwrite")
    return RS.read_raster(d.spark, base, ["velocity"], (3, 90, 10, 100))


@query("tile_round_trip", sql("vel", "SELECT 'v' AS raster_id, row, col, value FROM vel", "value"))
def _(d):
    tiles = RS.to_tiles(d.vel.withColumn("raster_id", F.lit("v")), 32)
    back = RS.from_tiles(tiles, 32)
    return back.select("raster_id", "row", "col", "value")


@query("tile_round_trip_shifted", sql(
    "vel_l", "SELECT 'v' AS raster_id, row, col, value FROM vel_l WHERE (row+col)%5>0", "value"))
def _(d):
    """A raster with gaps that starts at (3, 5): nothing moves."""
    px = d.vel_l.where("(row+col)%5>0").withColumn("raster_id", F.lit("v"))
    return RS.from_tiles(RS.to_tiles(px, 32), 32).select("raster_id", "row", "col", "value")


@query("transform_from_bounds", sql(
    "", "SELECT c_custkey AS raster_id, (e-w)/width AS a, 0.0 AS b, w AS c, 0.0 AS d, -(n-s)/height "
    "AS e, n AS f FROM (SELECT c_custkey, 100.0+c_custkey%50 AS w, 101.5+c_custkey%50 AS e, "
    "-5.0+c_custkey%7 AS s, -4.25+c_custkey%7 AS n, 300+c_custkey%11 AS width, 200+c_custkey%13 AS "
    "height FROM customer)", "a b c d e f"))
def _(d):
    k = F.col("c_custkey")
    boxes = d.table("customer").select(
        k.alias("raster_id"), (k % 50 + 100.0).alias("west"), (k % 50 + 101.5).alias("east"),
        (k % 7 - 5.0).alias("south"), (k % 7 - 4.25).alias("north"), (k % 11 + 300).alias("width"),
        (k % 13 + 200).alias("height"))
    return RS.transform_from_bounds(boxes).select("raster_id", "transform.*")


@query("product_metadata", sql(
    "", "SELECT 'c' || CAST(c_custkey AS VARCHAR) AS raster_id, 'Feature' AS type, CASE WHEN "
    "c_custkey%2=0 THEN 32649 END AS epsg, 100.0+c_custkey%50 AS west, 5.0-2.0*(200+c_custkey%13) AS "
    "south, 100.0+c_custkey%50+2.0*(300+c_custkey%11) AS east, 5.0 AS north FROM customer",
    "west south east north"))
def _(d):
    k = F.col("c_custkey")
    t = F.struct(F.lit(2.0).alias("a"), F.lit(0.0).alias("b"), (k % 50 + 100.0).alias("c"),
                 F.lit(0.0).alias("d"), F.lit(-2.0).alias("e"), F.lit(5.0).alias("f"))
    rasters = d.table("customer").select(
        F.concat(F.lit("c"), k.cast("string")).alias("raster_id"), F.lit("velocity").alias("product_type"),
        F.when(k % 2 == 0, "EPSG:32649").otherwise("local").alias("crs"), t.alias("transform"),
        (k % 11 + 300).alias("width"), (k % 13 + 200).alias("height"), F.lit("float").alias("dtype"),
        F.lit(-9999.0).alias("nodata"), F.lit(1).alias("bands"))
    j = RS.product_metadata(rasters, F.array("raster_id"))
    at = lambda p: F.get_json_object("metadata", p)
    return j.select(
        "raster_id", at("$.type").alias("type"),
        at("$.properties['proj:epsg']").cast("int").alias("epsg"),
        *[at(f"$.bbox[{i}]").cast("double").alias(n)
          for i, n in enumerate(("west", "south", "east", "north"))])
