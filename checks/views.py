"""Raster, stack and listing views over the test tables, as SQL both engines run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundswell.session import configure

TABLES = ("orders", "lineitem", "events", "customer", "supplier", "part", "documents", "pages")

_RC = "CAST(floor({k}/125) AS INT) AS row, CAST({k}%125 AS INT) AS col"
_O = _RC.format(k="o_orderkey")

VIEWS = {
    # Rasters as stored: -9999 and NULL for no data.
    "r_velocity": f"SELECT {_O}, CASE WHEN o_orderkey%17=0 THEN CAST(-9999 AS DOUBLE) ELSE o_totalprice/CAST(500000 AS DOUBLE)*150-120 END AS value FROM orders",
    "r_velocity_l": "SELECT CAST(floor(o_orderkey/125) AS INT)+3 AS row, CAST(o_orderkey%125 AS INT)+5 AS col, CASE WHEN o_orderkey%13=0 THEN CAST(-9999 AS DOUBLE) ELSE o_totalprice/CAST(500000 AS DOUBLE)*120-90 END AS value FROM orders",
    "r_coherence": f"SELECT {_O}, CASE WHEN o_orderkey%29=0 THEN NULL ELSE CAST((o_orderkey*7919)%1000 AS DOUBLE)/1000 END AS value FROM orders",
    "r_coherence_l": "SELECT CAST(floor(o_orderkey/125) AS INT)+3 AS row, CAST(o_orderkey%125 AS INT)+5 AS col, CAST((o_orderkey*104729)%1000 AS DOUBLE)/1000 AS value FROM orders",
    "r_vv": f"SELECT {_O}, (o_totalprice/CAST(1000000 AS DOUBLE)+CAST(0.02 AS DOUBLE)) * CASE WHEN (o_orderkey%125)%40<3 THEN CAST(0.02 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS value FROM orders",
    "r_lossyear": f"SELECT {_O}, CAST((o_orderkey*13)%24 AS INT) AS lossyear, CAST((o_orderkey*31)%101 AS INT) AS treecover FROM orders",
    "r_stack": f"SELECT {_RC.format(k='l_orderkey')}, l_linenumber AS scene_id, CASE WHEN l_returnflag='R' THEN NULL ELSE l_discount+CAST(0.001 AS DOUBLE) END AS value FROM lineitem",
    "r_bands": f"SELECT {_O}, CAST((o_orderkey*37)%10000 AS DOUBLE) AS red, CAST((o_orderkey*53)%10000 AS DOUBLE) AS nir, CAST((o_orderkey*71)%10000 AS DOUBLE) AS green, CAST((o_orderkey*89)%10000 AS DOUBLE) AS swir FROM orders",
    # The same with no data as NULL.
    "vel": "SELECT row, col, CASE WHEN value<>-9999 THEN value END AS value FROM r_velocity",
    "vel_l": "SELECT row, col, CASE WHEN value<>-9999 THEN value END AS value FROM r_velocity_l",
    # Three pixels in ten absent, the first and last rows and columns among them.
    "vel_s": "SELECT row, col, value FROM vel WHERE (row*7+col*3)%10>=3",
    "coh": "SELECT row, col, value FROM r_coherence",
    "coh_l": "SELECT row, col, value FROM r_coherence_l",
    "vv": "SELECT row, col, value FROM r_vv",
    # Sparse masks and distances in closed form, for operators that take them as input.
    "m_canal": "SELECT row, col FROM r_vv WHERE col%40<3",
    "m_water": "SELECT row, col FROM r_vv WHERE (row*31+col*17)%23<3 OR (row%20<6 AND col%25<7)",
    "m_peat": "SELECT row, col FROM r_vv WHERE col>=11 AND (row+col)%19<>0",
    "d_canal": "SELECT row, col, CAST((row*37+col*53)%3500 AS DOUBLE) AS distance FROM r_vv",
    "c_peat": "SELECT row, col, CAST((row*3+col*5)%4 AS INT) AS depth_class FROM r_vv",
    "risk": "SELECT row, col, CASE WHEN value IS NOT NULL THEN ((row*29+col*41)%101)/CAST(100 AS DOUBLE) END AS value FROM vel",
    # Interferograms: 5 dates, 7 pairs.
    "v_pairs": "SELECT * FROM (VALUES (1,0,1,12),(2,1,2,12),(3,2,3,24),(4,3,4,12),(5,0,2,24),(6,1,3,36),(7,2,4,36)) AS t(pair_id,ref_idx,sec_idx,dt_days)",
    "v_days": "SELECT * FROM (VALUES (0,0),(1,12),(2,24),(3,48),(4,60)) AS t(idx,day)",
    "r_ifg": "SELECT p.pair_id, p.ref_idx, p.sec_idx, p.dt_days, v.row, v.col, v.value*p.dt_days*CAST(0.001 AS DOUBLE)+CAST((v.row*7+v.col*3+p.pair_id)%11 AS DOUBLE)*CAST(0.01 AS DOUBLE) AS phase, c.value AS coherence FROM r_velocity v CROSS JOIN v_pairs p LEFT JOIN r_coherence c ON v.row=c.row AND v.col=c.col WHERE v.value<>-9999",
    # Phases over an irrational: no sum lies half way between two digits.
    "ifg": "SELECT pair_id, ref_idx, sec_idx, dt_days, row, col, phase/sqrt(7) AS phase, coherence FROM r_ifg",
    "v_lut": "SELECT l.line, x.pixel, CAST(100+l.line+2*x.pixel+(l.line*x.pixel)%7 AS DOUBLE) AS value FROM (VALUES (0),(40),(80),(110)) AS l(line) CROSS JOIN (VALUES (0),(30),(60),(90),(120)) AS x(pixel)",
    # Shapes that grow with the tables: one quadrilateral per supplier, one way per customer.
    "v_rings": "SELECT CAST(s_suppkey AS INT) AS feature_id, CAST(k AS INT) AS seq, CAST((s_suppkey*13)%97 AS DOUBLE)+0.2+CASE k WHEN 0 THEN 0.13 WHEN 1 THEN 17.21 WHEN 2 THEN 9.37 ELSE 3.41 END AS x, CAST((s_suppkey*7)%101 AS DOUBLE)+0.31+CASE k WHEN 0 THEN 0.03 WHEN 1 THEN 4.17 WHEN 2 THEN 5.21 ELSE 12.34 END AS y FROM supplier CROSS JOIN (VALUES (0),(1),(2),(3)) AS t(k)",
    "v_ways": "SELECT CAST(c_custkey AS INT) AS way_id, CASE c_custkey%4 WHEN 0 THEN 'river' WHEN 1 THEN 'canal' WHEN 2 THEN 'drain' ELSE 'ditch' END AS waterway, CAST(k AS INT) AS seq, CAST((c_custkey*37)%111 AS DOUBLE)+0.37+k*CAST((c_custkey%9) AS DOUBLE)*0.83 AS x, CAST((c_custkey*59)%113 AS DOUBLE)+0.21+k*CAST(((c_custkey*5)%7) AS DOUBLE)*0.71 AS y FROM customer CROSS JOIN (VALUES (0),(1),(2)) AS t(k) WHERE k=0 OR c_custkey%5<>0",
    # Acquisitions: one track per user.
    "v_scenes": "SELECT event_id AS scene_id, CAST(ts AS TIMESTAMP) AS start_time, user_id AS path_number, event_type AS processing_level, value AS size_mb, CAST(event_id%360-180 AS DOUBLE) AS fp_west, CAST(event_id%360-178 AS DOUBLE) AS fp_east, CAST((event_id*7)%160-80 AS DOUBLE) AS fp_south, CAST((event_id*7)%160-78 AS DOUBLE) AS fp_north, CASE WHEN event_id%3=0 THEN 'S1B' ELSE 'S1A' END AS platform FROM events",
    "v_dates": "SELECT DISTINCT user_id AS track, CAST(ts AS DATE) AS acq_date FROM events",
    "v_days_seen": "SELECT DISTINCT CAST(ts AS DATE) AS d FROM events",
    "v_orbits": "SELECT 'RESORB' AS kind, concat('R', CAST(d AS STRING)) AS name, CAST(d AS TIMESTAMP) AS valid_from, CAST(d AS TIMESTAMP) + INTERVAL '26' HOUR AS valid_to FROM v_days_seen WHERE day(d)%7<>0 UNION ALL SELECT 'POEORB' AS kind, concat('P', CAST(d AS STRING)) AS name, CAST(d AS TIMESTAMP) - INTERVAL '2' HOUR AS valid_from, CAST(d AS TIMESTAMP) + INTERVAL '26' HOUR AS valid_to FROM v_days_seen WHERE day(d)%2=0 AND day(d)%14<>0",
    # Object listings.
    "v_remote": "SELECT concat('interferograms/', CAST(20200101+o_orderkey AS STRING), '_', CAST(20210101+o_orderkey AS STRING), '/merged/', CASE WHEN o_orderkey%3=0 THEN 'filt_topophase.unw' ELSE 'phsig.cor' END) AS name, CAST(floor(o_totalprice) AS BIGINT) AS size FROM orders",
    "v_local": "SELECT name, size + CASE WHEN size%5=0 THEN 1 ELSE 0 END AS size FROM v_remote WHERE size%2=0",
    "v_points": "SELECT c_custkey AS point_id, CAST((c_custkey*17)%130 AS DOUBLE)+CAST(0.25 AS DOUBLE) AS x, CAST((c_custkey*5)%140 AS DOUBLE)+CAST(0.75 AS DOUBLE) AS y FROM customer",
    "v_places": "SELECT c_custkey AS place_id, CAST((c_custkey*7919)%36000 AS DOUBLE)/100-180 AS lon, CAST((c_custkey*104729)%16000 AS DOUBLE)/100-80 AS lat FROM customer",
}


def needed(names: str) -> list[str]:
    """View names with the views they read, in order of definition."""
    found: list[str] = []

    def visit(n: str) -> None:
        if n in found:
            return
        for word in re.findall(r"\b[a-z]+_?[a-z_]*\b", VIEWS[n]):
            if word in VIEWS and word != n and re.search(rf"(FROM|JOIN)\s+{word}\b", VIEWS[n]):
                visit(word)
        found.append(n)

    for name in names.split():
        visit(name)
    return found


def with_views(names: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    parts = [f"{n} AS ({VIEWS[n]})" for n in needed(names)]
    parts += [f"{n} AS ({b})" for n, b in (extra or {}).items()]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) if parts else ""


def sql(
    names: str, body: str, r: str = "", recursive: bool = False, digits: int = 6, **ctes: str
) -> str:
    """Oracle text: views, extra CTEs, body; columns named in ``r`` are rounded."""
    if r:
        rounded = ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in r.split())
        body = f"SELECT * REPLACE ({rounded}) FROM ({body})"
    return f"{with_views(names, ctes, recursive)}\n{body}"


class Data:
    """The tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        """A view as a DataFrame.  Most are projections of one table and run as SQL; those
        with a short fixed list inside spread it with ``inline`` instead of a cross join."""
        if name in ("r_ifg", "ifg", "v_rings", "v_ways", "v_lut"):
            return getattr(self, f"_{name}")()
        prefix = f"gs_{abs(hash(self.folder)) % 10**8}_"
        text = f"{with_views(name)} SELECT * FROM {name}"
        for t in TABLES:
            if re.search(rf"\b{t}\b", text):
                self.table(t).createOrReplaceTempView(prefix + t)
                text = re.sub(rf"(FROM|JOIN)\s+{t}\b", rf"\1 {prefix}{t}", text)
        return self.spark.sql(text)

    def _r_ifg(self) -> DataFrame:
        links = [(1, 0, 1, 12), (2, 1, 2, 12), (3, 2, 3, 24), (4, 3, 4, 12), (5, 0, 2, 24),
                 (6, 1, 3, 36), (7, 2, 4, 36)]
        names = ("pair_id", "ref_idx", "sec_idx", "dt_days")
        pairs = F.inline(F.array(*[
            F.struct(*[F.lit(x).alias(n) for n, x in zip(names, link)]) for link in links]))
        coherence = self.coh.withColumnRenamed("value", "coherence")
        at = self.vel.where("value IS NOT NULL").join(coherence, ["row", "col"], "left")
        noise = (F.col("row") * 7 + F.col("col") * 3 + F.col("pair_id")) % 11
        return at.select("row", "col", "value", "coherence", pairs).select(
            *names, "row", "col",
            (F.col("value") * F.col("dt_days") * 0.001 + noise.cast("double") * 0.01).alias("phase"),
            "coherence")

    def _ifg(self) -> DataFrame:
        return self._r_ifg().withColumn("phase", F.col("phase") / F.sqrt(F.lit(7)))

    def _v_lut(self) -> DataFrame:
        nodes = F.inline(F.array(*[
            F.struct(F.lit(a).alias("line"), F.lit(p).alias("pixel"),
                     F.lit(float(100 + a + 2 * p + (a * p) % 7)).alias("value"))
            for a in (0, 40, 80, 110) for p in (0, 30, 60, 90, 120)]))
        return self.spark.range(1).select(nodes)

    def _v_rings(self) -> DataFrame:
        k = F.col("s_suppkey")
        corners = [(0.13, 0.03), (17.21, 4.17), (9.37, 5.21), (3.41, 12.34)]
        x, y = (k * 13 % 97).cast("double") + 0.2, (k * 7 % 101).cast("double") + 0.31
        ring = F.inline(F.array(*[
            F.struct(F.lit(i).alias("seq"), (x + a).alias("x"), (y + b).alias("y"))
            for i, (a, b) in enumerate(corners)]))
        return self.table("supplier").select(k.cast("int").alias("feature_id"), ring)

    def _v_ways(self) -> DataFrame:
        k = F.col("c_custkey")
        kind = (F.when(k % 4 == 0, "river").when(k % 4 == 1, "canal").when(k % 4 == 2, "drain")
                .otherwise("ditch"))
        x, y = (k * 37 % 111).cast("double") + 0.37, (k * 59 % 113).cast("double") + 0.21
        nodes = F.inline(F.array(*[
            F.struct(F.lit(i).alias("seq"), (x + (k % 9).cast("double") * i * 0.83).alias("x"),
                     (y + (k * 5 % 7).cast("double") * i * 0.71).alias("y")) for i in range(3)]))
        return self.table("customer").select(
            k.cast("int").alias("way_id"), kind.alias("waterway"), k, nodes
        ).where((F.col("seq") == 0) | (F.col("c_custkey") % 5 != 0)).drop("c_custkey")

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.view(name)
        raise AttributeError(name)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    return df.select(*[
        F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ])
