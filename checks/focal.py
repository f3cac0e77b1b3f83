"""Neighbourhood operators, morphology, components, distance and the masks built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import sql
from groundswell.config import CanalSettings, WaterSettings
from groundswell.frames import val
from groundswell.functions import scalar as S
from groundswell.operators import focal as FO
from groundswell.operators import morphology as M
from groundswell.operators.components import component_sizes, label_runs, remove_small_components
from groundswell.operators.distance import distance_map
from groundswell.plans import products as P

DIMS = {"dims": "SELECT max(row)+1 AS h, max(col)+1 AS w FROM vv"}


def offsets(r: int) -> str:
    rng = f"(SELECT unnest(generate_series(-{r},{r}))"
    return f"SELECT dy, dx FROM {rng} AS dy) a CROSS JOIN {rng} AS dx) b"


def around(src: str, r: int) -> str:
    """Each pixel with its (2r+1)^2 neighbourhood, edges reflected by half a sample."""
    m = lambda p, n: f"CASE WHEN {p}<0 THEN -({p})-1 WHEN {p}>={n} THEN 2*{n}-1-({p}) ELSE {p} END"
    return (f"SELECT q.row, q.col, t.value FROM (SELECT s.row, s.col, {m('s.row+dy', 'h')} AS r, "
            f"{m('s.col+dx', 'w')} AS c FROM {src} s CROSS JOIN ({offsets(r)}) o CROSS JOIN dims) q "
            f"JOIN {src} t ON t.row=q.r AND t.col=q.c")


def dilated(src: str, shape: str, r: int) -> str:
    return (f"SELECT DISTINCT row+dy AS row, col+dx AS col FROM {src} CROSS JOIN ({offsets(r)}) o "
            f"CROSS JOIN dims WHERE {shape} AND row+dy>=0 AND row+dy<h AND col+dx>=0 AND col+dx<w")


def eroded(src: str, shape: str, r: int) -> str:
    return (f"SELECT q.row, q.col FROM (SELECT row, col, row+dy AS nr, col+dx AS nc FROM {src} CROSS "
            f"JOIN ({offsets(r)}) o CROSS JOIN dims WHERE {shape} AND row+dy>=0 AND row+dy<h AND "
            f"col+dx>=0 AND col+dx<w) q LEFT JOIN {src} t ON t.row=q.nr AND t.col=q.nc GROUP BY "
            "q.row, q.col HAVING count(t.row)=count(*)")


def disk(r: int) -> str:
    return f"dx*dx+dy*dy<={r * r}"


def big_components(src: str, prefix: str, size: int) -> dict[str, str]:
    """CTEs; ``{prefix}_big`` holds the pixels of 4-connected components of at least ``size``."""
    return {
        f"{prefix}_id": f"SELECT row*100000+col AS a, row, col FROM {src}",
        f"{prefix}_edge": f"SELECT p.a, q.a AS b FROM {prefix}_id p JOIN (VALUES (1),(-1),(100000),"
                          f"(-100000)) AS s(s) ON true JOIN {prefix}_id q ON q.a=p.a+s.s",
        f"{prefix}_reach": f"SELECT a, a AS b FROM {prefix}_id UNION SELECT r.a, e.b FROM "
                           f"{prefix}_reach r JOIN {prefix}_edge e ON e.a=r.b",
        f"{prefix}_big": f"SELECT i.row, i.col, n.n, n.first FROM {prefix}_id i JOIN (SELECT a, "
                         f"count(*) AS n, min(b) AS first FROM {prefix}_reach GROUP BY a HAVING "
                         f"count(*)>={size}) n USING (a)",
    }


for _name, _r, _element, _shape in (
    ("dilate_disk", 3, M.disk(3), disk(3)), ("dilate_square", 2, M.square(2), "true"),
):
    query(_name, sql("m_water vv", dilated("m_water", _shape, _r), **DIMS))(
        lambda d, e=_element: M.dilate(d.m_water, e, size=d.vv.agg(
            (F.max("row") + 1).cast("int").alias("_h"), (F.max("col") + 1).cast("int").alias("_w"))))


def _size(d):
    return d.vv.agg((F.max("row") + 1).cast("int").alias("_h"),
                    (F.max("col") + 1).cast("int").alias("_w"))


@query("erode_disk", sql("m_peat vv", eroded("m_peat", disk(1), 1), **DIMS))
def _(d):
    return M.erode(d.m_peat, M.disk(1), size=_size(d))


@query("close_disk", sql("m_water vv", eroded("wide", disk(2), 2), **DIMS,
                         wide=dilated("m_water", disk(2), 2)))
def _(d):
    return M.close(d.m_water, M.disk(2), size=_size(d))


@query("remove_small_components", sql(
    "m_water", "SELECT row, col FROM c_big", recursive=True, **big_components("m_water", "c", 12)))
def _(d):
    return remove_small_components(d.m_water, 12)


@query("component_sizes", sql(
    "m_water", "SELECT n AS pixels, count(DISTINCT first) AS components FROM c_big GROUP BY n",
    recursive=True, **big_components("m_water", "c", 1)))
def _(d):
    """Cut into 16-pixel tiles, so that the seam graph does the work."""
    labelled = label_runs(M.to_runs(d.m_water), tile=16)
    return component_sizes(labelled).groupBy("pixels").agg(F.count("*").alias("components"))


ROOT = "SELECT row, col, value/sqrt(7) AS value FROM vv"


def _root(d):
    """Backscatter over an irrational, so that no mean lies half way between two digits."""
    return d.vv.withColumn("value", val() / F.sqrt(F.lit(7)))


@query("box_mean", sql(
    "vv", "SELECT row, col, avg(value) AS value FROM near GROUP BY row, col", "value", **DIMS,
    src=ROOT, near=around("src", 2)))
def _(d):
    return FO.box_mean(_root(d), 5)


LEE = ("SELECT row, col, CASE WHEN x < m-0.9*sqrt(v) OR x > m+0.9*sqrt(v) THEN m ELSE m + CASE WHEN "
       "greatest(v-m*m,0)+m*m>0 THEN greatest(v-m*m,0)/(greatest(v-m*m,0)+m*m) ELSE 0 END*(x-m) END "
       "AS value FROM (SELECT n.row, n.col, any_value(s.value) AS x, avg(n.value) AS m, "
       "greatest(avg(n.value*n.value)-avg(n.value)*avg(n.value),0) AS v FROM near n JOIN {s} s ON "
       "s.row=n.row AND s.col=n.col GROUP BY n.row, n.col)")


@query("lee_sigma", sql("vv", LEE.format(s="src"), "value", **DIMS, src=ROOT, near=around("src", 3)))
def _(d):
    return FO.lee_sigma(_root(d), 7)


MEDIAN = ("SELECT n.row, n.col, CASE WHEN any_value(s.value) IS NOT NULL THEN median(n.value) END AS "
          "value FROM near n JOIN {s} s ON s.row=n.row AND s.col=n.col GROUP BY n.row, n.col")
FILLED = "SELECT row, col, coalesce(value, (SELECT median(value) FROM {s})) AS value FROM {s}"


@query("median_filter", sql(
    "vel vv", MEDIAN.format(s="vel"), "value", **DIMS, filled=FILLED.format(s="vel"),
    near=around("filled", 4)))
def _(d):
    return FO.median_filter(d.vel, 9)


@query("distance_map", sql(
    "vv m_water", "SELECT p.row, p.col, min(sqrt((p.row-m.row)*(p.row-m.row)*144.0+(p.col-m.col)*"
    "(p.col-m.col)*100.0)) AS distance FROM vv p CROSS JOIN m_water m GROUP BY p.row, p.col",
    "distance"))
def _(d):
    """Anisotropic pixels, 10 m by 12 m."""
    return distance_map(d.vv, d.m_water, 10.0, 12.0)


CUT = ("SELECT row, col FROM vv WHERE value>0 AND value<(SELECT quantile_cont(value, 0.1) FROM vv "
       "WHERE value>0)")


@query("threshold_canals", sql("vv", CUT))
def _(d):
    return P.threshold_canals(d.vv, 10.0)


CANAL_CTES = {
    **DIMS, "dark": CUT, "wide": dilated("dark", disk(2), 2), "closed": eroded("wide", disk(2), 2),
    **big_components("closed", "c", 50), "canals": dilated("c_big", disk(1), 1),
}


@query("detect_canals", sql("vv", "SELECT row, col FROM canals", recursive=True, **CANAL_CTES))
def _(d):
    return P.detect_canals(d.vv, size=_size(d))


@query("canal_distance", sql(
    "vv", "SELECT p.row, p.col, min(sqrt((p.row-m.row)*(p.row-m.row)+(p.col-m.col)*(p.col-m.col))*"
    "1.0) AS distance FROM vv p CROSS JOIN canals m GROUP BY p.row, p.col", "distance",
    recursive=True, **CANAL_CTES))
def _(d):
    return P.canal_distance(d.vv, P.detect_canals(d.vv, size=_size(d)))


@query("canal_cleanup", sql(
    "m_water vv", "SELECT row, col FROM (" + dilated("c_big", disk(1), 1) + ")", recursive=True,
    **DIMS, wide=dilated("m_water", disk(2), 2), closed=eroded("wide", disk(2), 2),
    **big_components("closed", "c", 60)))
def _(d):
    return P.canal_cleanup(d.m_water, CanalSettings(min_size=60), size=_size(d))


@query("water_cleanup", sql(
    "m_water", "SELECT row, col FROM c_big", recursive=True, **big_components("m_water", "c", 30)))
def _(d):
    return P.water_cleanup(d.m_water, 30, 0)


WATER = {**DIMS, "dark": "SELECT row, col FROM vv WHERE value>0 AND value<pow(10.0,-2)",
         "wide": dilated("dark", disk(3), 3), "closed": eroded("wide", disk(3), 3),
         **big_components("closed", "c", 50)}


@query("water_mask", sql(
    "vv m_water", "SELECT row, col FROM c_big b WHERE NOT EXISTS (SELECT 1 FROM m_water m WHERE "
    "m.row=b.row AND m.col=b.col)", recursive=True, **WATER))
def _(d):
    return P.water_mask(d.vv, WaterSettings(), canals=d.m_water, size=_size(d))


@query("water_mask_from_db", sql("vv", "SELECT row, col FROM c_big", recursive=True, **WATER))
def _(d):
    db = d.vv.withColumn("value", S.to_decibels(val()))
    return P.water_mask(d.vv, WaterSettings(exclude_canals=False), vv_db=db, size=_size(d))


@query("peat_depth_class", sql(
    "vv m_peat", "SELECT row, col, CASE WHEN d=0 THEN 0 WHEN d<=60 THEN 1 WHEN d<=150 THEN 2 ELSE 3 "
    "END AS depth_class FROM (SELECT p.row, p.col, min(sqrt((p.row-m.row)*(p.row-m.row)*1600.0+"
    "(p.col-m.col)*(p.col-m.col)*900.0)) AS d FROM vv p CROSS JOIN (SELECT row, col FROM vv WHERE "
    "NOT (col>=11 AND (row+col)%19<>0)) m GROUP BY p.row, p.col)"))
def _(d):
    from groundswell.config import PeatSettings

    return P.peat_depth(d.vv, d.m_peat, 30.0, 40.0, PeatSettings(60.0, 150.0))


SMOOTH = {**DIMS, "filled": FILLED.format(s="vel"), "near": around("filled", 4),
          "smooth": MEDIAN.format(s="vel")}


@query("risk_map", sql(
    "vel vv d_canal m_water", "SELECT s.row, s.col, CASE WHEN s.value IS NOT NULL AND w.row IS NULL "
    "THEN (0.45*greatest(least(1-distance/1200,1.0),0.0)+0.55*CASE WHEN s.value<0 THEN "
    "least(-s.value/40.0,1.0) ELSE 0 END)/(0.45+0.55) END AS value FROM smooth s JOIN d_canal d ON "
    "d.row=s.row AND d.col=s.col LEFT JOIN m_water w ON w.row=s.row AND w.col=s.col", "value",
    **SMOOTH))
def _(d):
    return P.risk_map(d.vel, d.d_canal, d.m_water)


@query("peat_depth_geographic", sql(
    "vel vv m_peat", "SELECT row, col, CASE WHEN d IS NULL THEN 0 WHEN d=0 THEN 0 WHEN d<=500 THEN 1 WHEN d<=1500 THEN 2 ELSE 3 END AS depth_class "
    "FROM (SELECT p.row, p.col, min(sqrt(pow((p.row-m.row)*0.004*111320,2)+pow((p.col-m.col)*0.004*111320*cos(radians(2+0.004*h/2)),2))) "
    "AS d FROM vv p CROSS JOIN (SELECT row, col FROM vv WHERE NOT (row>=2 AND row<h-1 AND col>=1 AND col<=100)) m GROUP BY p.row, "
    "p.col, h)".replace("FROM vv p CROSS", "FROM vv p CROSS JOIN dims CROSS").replace("FROM vv WHERE NOT", "FROM vv, dims WHERE NOT"),
    **DIMS))
def _(d):
    """A grid in degrees: depth classes by metres at its latitude; polygons in degrees as well."""
    from groundswell.functions.geodesy import Grid

    h = d.vv.agg(F.max("row")).first()[0] + 1
    grid = Grid(h, 125, 0.004, 0.0, 114.0, 0.0, -0.004, -2.0)
    corners = [(1.0, 2.0), (101.0, 2.0), (101.0, h - 1.0), (1.0, h - 1.0)]
    box = d.spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(1).alias("feature_id"), F.lit(k).alias("seq"), F.lit(114.0 + x * 0.004).alias("x"), F.lit(-2.0 - y * 0.004).alias("y"))
        for k, (x, y) in enumerate(corners)])))
    return P.peat_products(d.vel, box, grid, epsg=4326)["peat_extent"].select("row", "col", "depth_class")


# Absent pixels count as NULL: the oracle puts them back on the grid of ``vv``.
SPARSE = {**DIMS, "grid": "SELECT vv.row, vv.col, s.value FROM vv LEFT JOIN vel_s s USING (row, col)",
          "filled": "SELECT row, col, coalesce(value, (SELECT median(value) FROM vel_s)) AS value FROM grid",
          "near": around("filled", 4), "smooth": MEDIAN.format(s="vel_s")}


@query("median_filter_sparse", sql("vel_s vv", "SELECT row, col, value FROM smooth", "value", **SPARSE))
def _(d):
    return FO.median_filter(d.vel_s, 9, dims=_size(d))


@query("risk_map_sparse", sql(
    "vel_s vv d_canal m_water", "SELECT s.row, s.col, CASE WHEN s.value IS NOT NULL AND w.row IS NULL "
    "THEN (0.45*greatest(least(1-distance/1200,1.0),0.0)+0.55*CASE WHEN s.value<0 THEN "
    "least(-s.value/40.0,1.0) ELSE 0 END)/(0.45+0.55) END AS value FROM smooth s JOIN d_canal d ON "
    "d.row=s.row AND d.col=s.col LEFT JOIN m_water w ON w.row=s.row AND w.col=s.col", "value",
    **SPARSE))
def _(d):
    return P.risk_map(d.vel_s, d.d_canal, d.m_water, size=_size(d))


@query("distance_map_sparse", sql(
    "vel_s m_water", "SELECT p.row, p.col, min(sqrt((p.row-m.row)*(p.row-m.row)*144.0+(p.col-m.col)*"
    "(p.col-m.col)*100.0)) AS distance FROM (SELECT row, col FROM vel_s WHERE row>0) p CROSS JOIN "
    "m_water m GROUP BY p.row, p.col", "distance"))
def _(d):
    """The mask also has pixels where the raster has none, and reaches above it."""
    return distance_map(d.vel_s.where("row > 0"), d.m_water, 10.0, 12.0)


@query("carbon_loss", sql(
    "vel vv coh m_water", "SELECT s.row, s.col, CASE WHEN w.row IS NULL AND s.value<0 THEN "
    "-s.value*0.5 WHEN w.row IS NULL AND s.value IS NOT NULL THEN 0.0 END AS value FROM smooth s "
    "LEFT JOIN wet w ON w.row=s.row AND w.col=s.col", "value", **DIMS,
    src="SELECT vel.row, vel.col, CASE WHEN coh.value<0.7 THEN NULL ELSE vel.value/sqrt(2) END AS "
        "value FROM vel LEFT JOIN coh USING (row, col)",
    filled=FILLED.format(s="src"), near=around("filled", 4), smooth=MEDIAN.format(s="src"),
    wet=dilated("m_water", disk(3), 3)))
def _(d):
    vel = d.vel.withColumn("value", val() / F.sqrt(F.lit(2)))
    return P.carbon_loss(vel, d.coh, d.m_water)


def _kernel(sigma: int) -> str:
    """Offsets with the sampled Gaussian and its first two derivatives, as the operator defines them."""
    r, q = 4 * sigma + 1, float(sigma * sigma)
    return (f"SELECT k, g, -k/{q}*g AS d1, s-sum(s) OVER ()*g AS d2 FROM (SELECT k, g, (k*k/{q * q}-1/{q})*g AS s FROM "
            f"(SELECT k, e/sum(e) OVER () AS g FROM (SELECT CAST(k AS DOUBLE) AS k, exp(-k*k/(2*{q})) AS e FROM "
            f"(SELECT unnest(generate_series(-{r},{r})) AS k))))")


def _ridge_ctes() -> dict[str, str]:
    """Strength of dark lines: three separable filters per sigma over reflected edges.

    Rows and columns are extended by the margin once, so each filter is a join on the offset."""
    pad = 13

    def ext(axis: str, other: str, src: str, n: str, cols: str) -> str:
        m = f"CASE WHEN p<0 THEN -p-1 WHEN p>={n} THEN 2*{n}-1-p ELSE p END"
        # Reflected twice where the image is smaller than the margin.
        m2 = m.replace("p", "q")
        return (f"SELECT e.p AS {axis}, s.{other}, {cols} FROM (SELECT p, {m2} AS {axis} FROM (SELECT p, {n}, {m} AS q FROM "
                f"(SELECT unnest(generate_series(-{pad}, {n}-1+{pad})) AS p, {n} FROM dims))) e JOIN {src} s ON s.{axis}=e.{axis}")

    ctes = {**{k: v.replace("max(row)+1 AS h", "CAST(max(row)+1 AS INT) AS h").replace("max(col)+1 AS w", "CAST(max(col)+1 AS INT) AS w")
               for k, v in DIMS.items()},
            "base": "SELECT row, col, CASE WHEN value>0 THEN value ELSE (SELECT median(value) FROM vv WHERE value>0) END AS x FROM vv"}
    for q in (1, 2, 3):
        ctes |= {
            f"k{q}": _kernel(q),
            f"down{q}": ext("row", "col", "base", "h", "s.x"),
            # Correlation with the reversed kernel: the sample at row + k meets the weight of -k.
            f"v{q}": f"SELECT CAST(d.row+k.k AS INT) AS row, d.col, sum(g*x) AS g, sum(d1*x) AS d1, sum(d2*x) AS d2 FROM down{q} d, "
                     f"k{q} k, dims WHERE d.row+k.k>=0 AND d.row+k.k<h GROUP BY ALL",
            f"side{q}": ext("col", "row", f"v{q}", "w", "s.g, s.d1, s.d2"),
            f"h{q}": f"SELECT d.row, CAST(d.col+k.k AS INT) AS col, sum(k.g*d.d2) AS rr, sum(k.d2*d.g) AS cc, sum(k.d1*d.d1) AS rc "
                     f"FROM side{q} d, k{q} k, dims WHERE d.col+k.k>=0 AND d.col+k.k<w GROUP BY ALL",
            f"e{q}": f"SELECT row, col, {q * q}.0*greatest((rr+cc)/2+sqrt(((rr-cc)/2)*((rr-cc)/2)+rc*rc),0) AS s FROM h{q}",
        }
    ctes["ridge"] = ("SELECT row, col, max(s) AS s FROM (SELECT * FROM e1 UNION ALL SELECT * FROM e2 UNION ALL SELECT * FROM e3) "
                     "GROUP BY row, col")
    return ctes


@query("ridge_map", sql(
    "vv", "SELECT r.row, r.col, r.s AS ridge, v.value>0 AS is_valid FROM ridge r JOIN vv v ON v.row=r.row AND v.col=r.col",
    "ridge", **_ridge_ctes()))
def _(d):
    return FO.ridge_map(d.vv)


@query("ridge_mask", sql(
    "vv", "SELECT r.row, r.col FROM ridge r JOIN vv v ON v.row=r.row AND v.col=r.col WHERE v.value>0 AND "
    "r.s>=(SELECT quantile_cont(s, 0.85) FROM ridge WHERE s>0)", **_ridge_ctes()))
def _(d):
    """Dark-line strength on halo tiles."""
    return FO.ridge_mask(d.vv)


_TURN = "6.283185307179586*({k}*{x}%32)/32"


def _dft(rows: str, along: str, to: str, sign: str) -> str:
    """One axis of a patch's Fourier transform: sum over ``along`` at each frequency ``to``."""
    kept = [c for c in ("t", "l", "y", "x", "v", "u") if c in rows.split("|")[0].split() and c != along]
    names, body = ", ".join(kept), rows.split("|")[1]
    turn = _TURN.format(k="k.n", x=along)
    return (f"{' '.join([*kept, to])}|(SELECT {names}, k.n AS {to}, sum(re*cos({turn}) {'+' if sign == '-' else '-'} im*sin({turn})) AS re, "
            f"sum(im*cos({turn}) {sign} re*sin({turn})) AS im FROM {body}, unnest(range(32)) AS k(n) GROUP BY {names}, k.n)")


def goldstein_sql(alpha: float) -> str:
    """The filter by separable transforms of 32 x 32 patches 24 pixels apart."""
    patches = ("t l y x|(SELECT t, l, row-t AS y, col-l AS x, coalesce(re, 0) AS re, coalesce(im, 0) AS im FROM tops, lefts, z WHERE "
               "row BETWEEN t AND t+31 AND col BETWEEN l AND l+31)")
    spectrum = _dft(_dft(patches, "x", "u", "-"), "y", "v", "-").split("|")[1]
    shrunk = (f"t l v u|(SELECT t, l, v, u, re*f AS re, im*f AS im FROM (SELECT *, CASE WHEN peak>0 THEN pow(power/peak, {alpha}) ELSE 1 END AS f "
              "FROM (SELECT *, max(power) OVER (PARTITION BY t, l) AS peak FROM (SELECT *, sqrt(re*re+im*im) AS power FROM spectrum))))")
    back = _dft(_dft(shrunk, "u", "x", "+"), "v", "y", "+").split("|")[1]
    hann = "(0.5-0.5*cos(6.283185307179586*y/31))*(0.5-0.5*cos(6.283185307179586*x/31))"
    return (f"WITH z AS (SELECT row, col, cos(value/10) AS re, sin(value/10) AS im FROM vel), "
            "tops AS (SELECT unnest(range(0, (SELECT max(row)-30 FROM z), 24)) AS t), lefts AS (SELECT unnest(range(0, (SELECT max(col)-30 FROM z), 24)) AS l), "
            f"spectrum AS (SELECT * FROM {spectrum}), smooth AS (SELECT * FROM {back}), "
            "shares AS (SELECT t, l, count(re)/1024.0 AS s FROM tops, lefts, z WHERE row BETWEEN t AND t+31 AND col BETWEEN l AND l+31 GROUP BY t, l), "
            f"summed AS (SELECT t+y AS row, l+x AS col, sum(re*s*{hann})/1024 AS re, sum(im*s*{hann})/1024 AS im, sum(s*{hann}) AS w "
            "FROM smooth JOIN shares USING (t, l) GROUP BY 1, 2) SELECT z.row, z.col, CASE WHEN z.re IS NULL THEN NULL WHEN w>0 THEN s.re/w ELSE z.re END AS re, "
            "CASE WHEN z.re IS NULL THEN NULL WHEN w>0 THEN s.im/w ELSE z.im END AS im FROM z LEFT JOIN summed s ON s.row=z.row AND s.col=z.col")


@query("goldstein", sql("vel", goldstein_sql(0.8), "re im", digits=5), digits=5)
def _(d):
    """Adaptive phase filter; pixels without data stay so."""
    phase = val() / 10
    return FO.goldstein(d.vel.select(
        "row", "col", F.cos(phase).alias("re"), F.sin(phase).alias("im")))
