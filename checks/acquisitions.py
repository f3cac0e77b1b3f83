"""Scenes, pair networks, orbit files, object listings and catalog tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import sql
from groundswell.frames import ensure_checkpoint_dir
from groundswell.operators import acquisitions as Q
from groundswell.operators import catalog as C
from groundswell.sources import objects as O
from groundswell.sources import scenes as SC
from groundswell.sources import stack as SK
from groundswell.sources.keyed import KeyedTable

SEARCH = ("SELECT scene_id, start_time, path_number FROM v_scenes WHERE start_time>=TIMESTAMP "
          "'2024-01-05' AND start_time<=TIMESTAMP '2024-01-20' AND processing_level='click' AND "
          "fp_east>=100 AND fp_west<=140 AND fp_north>=-30 AND fp_south<=20")


@query("scene_search", sql("v_scenes", SEARCH))
def _(d):
    return SC.search_scenes(
        d.v_scenes, "2024-01-05", "2024-01-20", "click", (100, -30, 140, 20)
    ).select("scene_id", "start_time", "path_number")


@query("scene_search_capped", sql(
    "v_scenes", "SELECT scene_id, start_time FROM v_scenes WHERE start_time>=TIMESTAMP '2024-01-05' "
    "AND start_time<=TIMESTAMP '2024-01-20' AND platform='S1B' ORDER BY start_time, scene_id LIMIT 25"))
def _(d):
    return SC.search_scenes(
        d.v_scenes, "2024-01-05", "2024-01-20", platform="S1B", max_results=25
    ).select("scene_id", "start_time")


@query("best_orbit", sql(
    "v_scenes", "SELECT path_number, count(*) AS scenes, min(start_time) AS first_time FROM v_scenes "
    "GROUP BY path_number ORDER BY 2 DESC, 3 LIMIT 1"))
def _(d):
    return Q.best_orbit(d.v_scenes)


def gap_sql(source: str, days: int) -> dict[str, str]:
    """Greedy spacing as a recursive chain: (track, time) kept so far."""
    return {
        "kept": f"SELECT path_number, min(start_time) AS t FROM {source} GROUP BY path_number "
                f"UNION ALL SELECT k.path_number, (SELECT min(s.start_time) FROM {source} s WHERE "
                f"s.path_number=k.path_number AND s.start_time>=k.t+INTERVAL {days} DAY) FROM kept k "
                "WHERE k.t IS NOT NULL"
    }


@query("min_gap_filter", sql(
    "v_scenes", "SELECT s.scene_id, s.path_number, s.start_time FROM v_scenes s JOIN kept k ON "
    "s.path_number=k.path_number AND s.start_time=k.t", recursive=True, **gap_sql("v_scenes", 3)))
def _(d):
    return Q.min_gap_scenes(d.v_scenes.select("scene_id", "path_number", "start_time"), 3)


@query("min_gap_dates", sql(
    "v_dates", "SELECT path_number AS track, t AS acq_date FROM kept WHERE t IS NOT NULL",
    recursive=True, dated="SELECT track AS path_number, CAST(acq_date AS TIMESTAMP) AS start_time "
    "FROM v_dates", **gap_sql("dated", 4)))
def _(d):
    return Q.min_gap_times(d.v_dates, 4, ["track"], "acq_date")


@query("acquisition_stack", sql(
    "v_scenes", "SELECT s.scene_id, s.path_number, s.start_time FROM found s JOIN kept k ON "
    "s.path_number=k.path_number AND s.start_time=k.t WHERE k.t IS NOT NULL ORDER BY 3 LIMIT 6",
    recursive=True,
    found="SELECT * FROM (SELECT scene_id, path_number, start_time FROM v_scenes WHERE "
          "start_time>=TIMESTAMP '2024-01-02' AND start_time<=TIMESTAMP '2024-01-28') WHERE "
          "path_number=(SELECT path_number FROM v_scenes WHERE start_time>=TIMESTAMP '2024-01-02' "
          "AND start_time<=TIMESTAMP '2024-01-28' GROUP BY 1 ORDER BY count(*) DESC, "
          "min(start_time) LIMIT 1)", **gap_sql("found", 3)))
def _(d):
    return SC.acquisition_stack(
        d.v_scenes, "2024-01-02", "2024-01-28", min_gap_days=3, max_scenes=6
    ).select("scene_id", "path_number", "start_time")


PAIRS = ("SELECT track, ref_date, sec_date, CAST(date_diff('day', ref_date, sec_date) AS INT) AS "
         "baseline_days FROM (SELECT a.track, a.acq_date AS ref_date, b.acq_date AS sec_date, "
         "row_number() OVER (PARTITION BY a.track, a.acq_date ORDER BY b.acq_date) AS k FROM v_dates "
         "a JOIN v_dates b ON a.track=b.track AND b.acq_date>a.acq_date) WHERE k<=4 AND "
         "date_diff('day', ref_date, sec_date)<=5")


@query("sbas_pairs", sql("v_dates", PAIRS))
def _(d):
    return Q.sbas_pairs(d.v_dates, 5, 4)


@query("sequential_pairs", sql(
    "v_dates", "SELECT *, CAST(date_diff('day', ref_date, sec_date) AS INT) AS baseline_days FROM "
    "(SELECT track, acq_date AS ref_date, lead(acq_date) OVER (PARTITION BY track ORDER BY "
    "acq_date) AS sec_date FROM v_dates) WHERE sec_date IS NOT NULL"))
def _(d):
    return Q.sequential_pairs(d.v_dates)


@query("network_summary", sql(
    "v_dates", "SELECT track, num_pairs, min_baseline_days, max_baseline_days, mean_baseline_days, "
    "num_dates, num_pairs/greatest(num_dates-1,1) AS redundancy FROM (SELECT track, count(*) AS "
    "num_pairs, min(baseline_days) AS min_baseline_days, max(baseline_days) AS max_baseline_days, "
    "avg(baseline_days) AS mean_baseline_days FROM pairs GROUP BY track) JOIN (SELECT track, "
    "count(DISTINCT d) AS num_dates FROM (SELECT track, ref_date AS d FROM pairs UNION ALL SELECT "
    "track, sec_date FROM pairs) GROUP BY track) USING (track)", "mean_baseline_days redundancy",
    pairs=PAIRS))
def _(d):
    return Q.network_summary(Q.sbas_pairs(d.v_dates, 5, 4), ["track"])


@query("pair_date_set", sql(
    "v_dates", "SELECT track, ref_date AS acq_date FROM pairs UNION SELECT track, sec_date FROM "
    "pairs", pairs=PAIRS))
def _(d):
    return Q.pair_dates(Q.sbas_pairs(d.v_dates, 5, 4), ["track"])


@query("orbit_cover", sql(
    "v_scenes v_orbits", "SELECT s.scene_id, arg_min(o.kind, o.k) AS orbit_kind, arg_min(o.name, "
    "o.k) AS orbit_name FROM v_scenes s LEFT JOIN (SELECT *, CASE kind WHEN 'POEORB' THEN '0' ELSE "
    "'1' END || name AS k FROM v_orbits) o ON s.start_time BETWEEN o.valid_from AND o.valid_to GROUP "
    "BY s.scene_id"))
def _(d):
    return Q.orbit_cover(d.v_scenes, d.v_orbits)


# --- Object listings ------------------------------------------------------------------


@query("sync_plan", sql(
    "v_remote v_local", "SELECT name, size FROM v_remote r WHERE name LIKE '%.unw' AND NOT EXISTS "
    "(SELECT 1 FROM v_local l WHERE l.name=r.name AND l.size=r.size)"))
def _(d):
    return O.sync_plan(d.v_remote, d.v_local, ".unw")


@query("completed_pairs", sql(
    "v_remote", "SELECT DISTINCT split_part(name,'/',2) AS pair_id FROM v_remote WHERE "
    "split_part(name,'/',4)='filt_topophase.unw'"))
def _(d):
    return O.completed_pairs(d.v_remote)


@query("remaining_pairs", sql(
    "v_remote", "SELECT DISTINCT split_part(name,'/',2) AS pair_id FROM v_remote WHERE "
    "split_part(name,'/',4)<>'filt_topophase.unw'"))
def _(d):
    every = d.v_remote.select(F.get(F.split("name", "/"), F.lit(1)).alias("pair_id")).distinct()
    return O.remaining_pairs(every, d.v_remote)


@query("slc_date_index", sql(
    "", "SELECT strftime(ts, '%Y%m%d') AS date, max('/slc/' || CAST(event_id AS VARCHAR)) AS path "
    "FROM events WHERE event_id%4<>0 GROUP BY 1"))
def _(d):
    kind = F.when(F.col("event_id") % 4 == 0, "GRD").otherwise("SLC")
    name = F.concat_ws("_", F.lit("S1A_IW"), kind, F.date_format("ts", "yyyyMMdd'T'HHmmss"),
                       F.lit("20991231T000000"))
    path = F.concat(F.lit("/slc/"), F.col("event_id").cast("string"))
    return O.slc_date_index(d.table("events").select(name.alias("name"), path.alias("path")))


@query("product_inventory", sql(
    "", "SELECT p_name || CAST(p_partkey AS VARCHAR) AS name, p_brand AS path, count(*) OVER () AS "
    "product_count FROM part WHERE p_size>10"))
def _(d):
    p = d.table("part").select(
        F.concat("p_name", F.col("p_partkey").cast("string")).alias("name"),
        F.col("p_brand").alias("path"), (F.col("p_size") > 10).alias("present"))
    return O.product_inventory(p)


@query("product_publish_keys", sql(
    "", "SELECT p_name || CAST(p_partkey AS VARCHAR) AS name, CAST(p_size AS VARCHAR) AS run_date, "
    "'study/products/' || CAST(p_size AS VARCHAR) || '/' || p_name || CAST(p_partkey AS VARCHAR) AS "
    "key FROM part"))
def _(d):
    p = d.table("part").select(
        F.concat("p_name", F.col("p_partkey").cast("string")).alias("name"),
        F.col("p_size").cast("string").alias("run_date"))
    return O.publish_keys(p, "study")


@query("file_checksums")
def _(d):
    """The table files themselves, hashed where they are read."""
    sums = O.file_checksums(d.spark, d.folder, "*.parquet")
    return sums.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", "md5")


@query("publish_products", sql(
    "", "SELECT o_orderkey AS name, CAST(date_trunc('month', o_orderdate) AS DATE) AS run_date, CASE WHEN month(o_orderdate)%2=0 THEN 2 ELSE 1 END AS version "
    "FROM orders"), digits=None)
def _(d):
    """Two runs of the sink: the second replaces the runs of even months and leaves the others."""
    ensure_checkpoint_dir(d.spark)
    base = f"{d.spark.sparkContext.getCheckpointDir()}/published-{uuid.uuid4().hex}"
    all_ = d.table("orders").select(
        F.col("o_orderkey").alias("name"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("run_date"), F.lit(1).alias("version"))
    O.publish_products(all_, base)
    O.publish_products(all_.where("month(run_date) % 2 = 0").withColumn("version", F.lit(2)), base)
    return d.spark.read.parquet(f"{base}/products").select("name", F.col("run_date").cast("date").alias("run_date"), "version")


@query("stack_pairs", sql(
    "v_remote", "SELECT DISTINCT split_part(name,'/',2) AS pair_id, try_strptime(left(split_part("
    "name,'/',2),8),'%Y%m%d') AS ref_date, try_strptime(right(split_part(name,'/',2),8),'%Y%m%d') "
    "AS sec_date FROM v_remote"))
def _(d):
    pairs = SK.discover_pairs(d.v_remote)
    return pairs.withColumns({c: F.col(c).cast("timestamp") for c in ("ref_date", "sec_date")})


@query("stack_dates", sql(
    "v_dates", "SELECT CAST(row_number() OVER (ORDER BY d)-1 AS INT) AS idx, d AS acq_date, CAST(date_diff('day', (SELECT min(ref_date) FROM pairs), d) "
    "AS INT) AS day FROM (SELECT ref_date AS d FROM pairs UNION SELECT sec_date FROM pairs)",
    pairs=PAIRS))
def _(d):
    return SK.stack_dates(Q.sbas_pairs(d.v_dates, 5, 4))


@query("stack_load", sql(
    "r_ifg", "SELECT p.pair_id, i.row, i.col, i.phase, c.coherence, CAST(NULL AS DOUBLE) AS "
    "conncomp FROM (SELECT DISTINCT pair_id FROM r_ifg UNION SELECT 9) p LEFT JOIN r_ifg i USING "
    "(pair_id) LEFT JOIN (SELECT * FROM r_ifg WHERE coherence>0.1 AND pair_id<>2) c "
    "ON c.pair_id=i.pair_id AND c.row=i.row AND c.col=i.col"), digits=None)
def _(d):
    layer = lambda n, src: src.select("pair_id", "row", "col", F.col(n).alias("value"))
    coh = d.r_ifg.where("coherence>0.1 AND pair_id<>2")  # pair 2 has no coherence file
    pairs = d.r_ifg.select("pair_id").distinct().union(  # pair 9 has no files at all
        d.spark.range(9, 10).select(F.col("id").cast("int")))
    return SK.load_stack(pairs, layer("phase", d.r_ifg), layer("coherence", coh))


@query("slant_range", sql(
    "vv", "SELECT row, col, 846000.0+col*2.33 AS slant_range FROM vv WHERE row<60 AND col<100",
    "slant_range"))
def _(d):
    return SK.crop_geometry(d.vv, 60, 100).select(
        "row", "col", SK.slant_range(F.col("col"), 846000.0, 2.33).alias("slant_range"))


# --- Catalog --------------------------------------------------------------------------

COLS = "scene_id, platform, acquisition_date, processing_level, relative_orbit, download_status"
CUR = ("SELECT CAST(event_id AS VARCHAR) AS scene_id, 'S1A' AS platform, CAST(ts AS DATE) AS "
       "acquisition_date, event_type AS processing_level, CAST(user_id AS INT) AS relative_orbit, "
       "'completed' AS download_status FROM events WHERE event_type='click'")


def _catalog(d):
    return C.conform(_scene_rows(d).where(F.col("processing_level") == "click").withColumn(
        "download_status", F.lit("completed")), C.SCENES)


def _scene_rows(d):
    return d.table("events").select(
        "event_id", F.col("event_id").cast("string").alias("scene_id"),
        F.lit("S1A").alias("platform"), F.to_date("ts").alias("acquisition_date"),
        F.col("event_type").alias("processing_level"),
        F.col("user_id").cast("int").alias("relative_orbit"))


@query("register_scenes", sql(
    "", f"SELECT {COLS} FROM cur UNION ALL SELECT CAST(event_id AS VARCHAR), 'S1A', CAST(ts AS "
    "DATE), event_type, CAST(user_id AS INT), 'pending' FROM events WHERE event_type<>'click'",
    cur=CUR))
def _(d):
    rows = _scene_rows(d)
    twice = rows.union(rows.withColumn("acquisition_date", F.date_add("acquisition_date", 400)))
    new = C.conform(twice, C.SCENES).drop("download_status")
    return C.register_scenes(_catalog(d), new).select(*COLS.split(", "))


EV = ("SELECT CAST(CAST(floor(event_id/4) AS BIGINT) AS VARCHAR) AS scene_id, CAST(ts AS TIMESTAMP) AS event_time, CASE "
      "event_type WHEN 'click' THEN 'downloading' WHEN 'view' THEN 'downloaded' WHEN 'error' THEN "
      "'failed' ELSE 'processing' END AS status, CASE WHEN event_id%4=0 THEN 'p' || CAST(event_id AS "
      "VARCHAR) END AS local_path, CASE WHEN event_id%5=0 THEN CAST(event_id AS BIGINT) END AS "
      "file_size_bytes FROM events")


def _events(d, *more):
    e, k = d.table("events"), F.col("event_id")
    status = (F.when(F.col("event_type") == "click", "downloading")
              .when(F.col("event_type") == "view", "downloaded")
              .when(F.col("event_type") == "error", "failed").otherwise("processing"))
    return e.select(
        F.floor(k / 4).cast("string").alias("scene_id"), F.col("ts").cast("timestamp").alias("event_time"),
        status.alias("status"), F.when(k % 4 == 0, F.concat(F.lit("p"), k.cast("string"))).alias("local_path"),
        F.lit(None).cast("string").alias("remote_path"), F.when(k % 5 == 0, k).alias("file_size_bytes"),
        F.lit(None).cast("string").alias("checksum"), *more)


@query("update_scene_status", sql(
    "", "SELECT c.scene_id, coalesce(l.status, c.download_status) AS download_status, l.started AS "
    "download_started_at, l.completed AS download_completed_at, l.local_path, l.file_size_bytes "
    "FROM cur c LEFT JOIN (SELECT scene_id, arg_max(status, event_time) AS status, max(event_time) "
    "FILTER (WHERE status='downloading') AS started, max(event_time) FILTER (WHERE status IN "
    "('downloaded','completed')) AS completed, arg_max(local_path, event_time) FILTER (WHERE "
    "local_path IS NOT NULL) AS local_path, arg_max(file_size_bytes, event_time) FILTER (WHERE "
    "file_size_bytes IS NOT NULL) AS file_size_bytes FROM ev GROUP BY scene_id) l USING (scene_id)",
    cur=CUR, ev=EV))
def _(d):
    return C.update_scene_status(_catalog(d), _events(d)).select(
        "scene_id", "download_status", "download_started_at", "download_completed_at",
        "local_path", "file_size_bytes")


FOLDED = ("SELECT c.scene_id, coalesce(l.status, c.download_status) AS download_status, l.started AS download_started_at, "
          "l.local_path FROM {cur} c LEFT JOIN (SELECT scene_id, arg_max(status, {{'t': event_time, 'n': sequence}}) AS status, "
          "max(event_time) FILTER (WHERE status='downloading') AS started, arg_max(local_path, {{'t': event_time, 'n': "
          "sequence}}) FILTER (WHERE local_path IS NOT NULL) AS local_path FROM ({ev}) GROUP BY scene_id) l USING (scene_id)")
# All events of a day at one time: their sequence decides.
TIED = EV.replace("CAST(ts AS TIMESTAMP) AS event_time", "CAST(CAST(ts AS DATE) AS TIMESTAMP) AS event_time, event_id AS sequence")
ALL = f"{CUR} UNION ALL SELECT CAST(event_id AS VARCHAR), 'S1A', CAST(ts AS DATE), event_type, CAST(user_id AS INT), 'pending' FROM events WHERE event_type<>'click'"


def _tied(d):
    """The events with all of a day at one time, and their sequence."""
    return _events(d, F.col("event_id").alias("sequence")).withColumn("event_time", F.date_trunc("day", "event_time"))


@query("scene_status_ties", sql("", FOLDED.format(cur="cur", ev=TIED), cur=CUR))
def _(d):
    return C.update_scene_status(_catalog(d), _tied(d)).select("scene_id", "download_status", "download_started_at", "local_path")


@query("catalog_store", sql("", FOLDED.format(cur="everything", ev=TIED), everything=ALL))
def _(d):
    """A stored catalog: scenes registered and status events folded in, part by part."""
    ensure_checkpoint_dir(d.spark)
    path = f"{d.spark.sparkContext.getCheckpointDir()}/catalog-{uuid.uuid4().hex}"
    table = KeyedTable.create(_catalog(d), path, C.SCENES, "scene_id", 16)
    C.register_stored(table, _scene_rows(d).drop("event_id"), "acquisition_date", "download_status")
    C.update_stored(table, _tied(d), C.update_scene_status)
    table.compact()
    return table.read().select("scene_id", "download_status", "download_started_at", "local_path")


@query("get_scenes", sql(
    "", "SELECT scene_id, acquisition_date FROM cur WHERE processing_level='click' ORDER BY "
    "acquisition_date", cur=CUR))
def _(d):
    return C.get_scenes(_catalog(d), "click", "completed").select("scene_id", "acquisition_date")


@query("scene_exists", sql(
    "", "SELECT CAST(event_id AS VARCHAR) AS scene_id FROM events WHERE event_type='click'"))
def _(d):
    ids = _scene_rows(d).select("scene_id")
    return C.existing(ids, _catalog(d))


NEWP = ("SELECT CAST(event_id AS VARCHAR) AS reference_scene_id, CAST(event_id+k AS VARCHAR) AS "
        "secondary_scene_id, k AS temporal_baseline_days FROM events CROSS JOIN (VALUES (3),(4),(6)) "
        "AS t(k)")


def _new_pairs(d):
    k = F.explode(F.array(F.lit(3), F.lit(4), F.lit(6))).alias("k")
    return d.table("events").select("event_id", k).select(
        F.col("event_id").cast("string").alias("reference_scene_id"),
        (F.col("event_id") + F.col("k")).cast("string").alias("secondary_scene_id"),
        F.col("k").alias("temporal_baseline_days"))


def _pair_catalog(d):
    none = C.conform(_new_pairs(d).limit(0), C.PAIRS)
    return C.register_pairs(
        none, C.conform(_new_pairs(d), C.PAIRS).drop("pair_id", "processing_status"), _catalog(d))


@query("register_pairs", sql(
    "", "SELECT reference_scene_id || '__' || secondary_scene_id AS pair_id, reference_scene_id, "
    "secondary_scene_id, temporal_baseline_days, 'pending' AS processing_status FROM np WHERE "
    "reference_scene_id IN (SELECT scene_id FROM cur) AND secondary_scene_id IN (SELECT scene_id "
    "FROM cur)", cur=CUR, np=NEWP))
def _(d):
    return _pair_catalog(d).select("pair_id", "reference_scene_id", "secondary_scene_id",
                                   "temporal_baseline_days", "processing_status")


@query("update_pair_status", sql(
    "", "SELECT p.pair_id, coalesce(l.status,'pending') AS processing_status, l.started AS "
    "processing_started_at, l.completed AS processing_completed_at, l.msg AS error_message FROM "
    "(SELECT reference_scene_id || '__' || secondary_scene_id AS pair_id FROM np WHERE "
    "reference_scene_id IN (SELECT scene_id FROM cur) AND secondary_scene_id IN (SELECT scene_id "
    "FROM cur)) p LEFT JOIN (SELECT pair_id, arg_max(status, event_time) AS status, max(event_time) "
    "FILTER (WHERE status='processing') AS started, max(event_time) FILTER (WHERE status IN "
    "('completed','failed')) AS completed, arg_max(msg, event_time) FILTER (WHERE msg IS NOT NULL) "
    "AS msg FROM pe GROUP BY pair_id) l USING (pair_id)", cur=CUR, np=NEWP, ev=EV,
    pe="SELECT scene_id || '__' || CAST(CAST(scene_id AS BIGINT)+3 AS VARCHAR) AS pair_id, "
       "event_time, CASE status WHEN 'downloaded' THEN 'completed' ELSE status END AS status, "
       "local_path AS msg FROM ev"))
def _(d):
    nxt = (F.col("scene_id").cast("bigint") + 3).cast("string")
    ev = _events(d).select(
        F.concat_ws("__", "scene_id", nxt).alias("pair_id"), "event_time",
        F.when(F.col("status") == "downloaded", "completed").otherwise(F.col("status")).alias("status"),
        F.lit(None).cast("string").alias("output_dir"), F.col("local_path").alias("error_message"))
    return C.get_pairs(C.update_pair_status(_pair_catalog(d), ev)).select(
        "pair_id", "processing_status", "processing_started_at", "processing_completed_at",
        "error_message")


PROD = ("SELECT p_type AS product_type, DATE '2024-01-01' + CAST(p_size%9 AS INT) AS run_date, "
        "'one/' || CAST(p_partkey AS VARCHAR) AS local_path, p_partkey AS load_order FROM part UNION "
        "ALL SELECT p_type, DATE '2024-01-01' + CAST(p_size%9 AS INT), 'two/' || CAST(p_partkey AS "
        "VARCHAR), p_partkey+1000000000 FROM part WHERE p_name LIKE 'red%'")


def _products(d):
    """The whole table registered once, then its red parts registered again."""

    def load(part, prefix: str, shift: int):
        rows = part.select(
            F.col("p_type").alias("product_type"),
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_size") % 9).cast("int"))
            .alias("run_date"),
            F.concat(F.lit(prefix), F.col("p_partkey").cast("string")).alias("local_path"),
            (F.col("p_partkey") + shift).alias("load_order"))
        return rows.select("*", F.lit(None).cast("string").alias("remote_path"),
                           F.lit(None).cast("string").alias("crs"),
                           F.lit(None).cast("string").alias("bounds"),
                           F.lit(None).cast("timestamp").alias("created_at"))

    part = d.table("part")
    none = C.conform(part.select(F.lit("x").alias("product_id")).limit(0), C.PRODUCTS)
    first = C.register_products(none, load(part, "one/", 0))
    red = part.where(F.col("p_name").startswith("red"))
    return C.register_products(first, load(red, "two/", 1000000000))


REG = ("SELECT product_type || '_' || CAST(run_date AS VARCHAR) AS product_id, product_type, "
       "run_date, arg_max(local_path, load_order) AS local_path FROM prod GROUP BY product_type, "
       "run_date")


@query("register_products", sql("", REG, prod=PROD))
def _(d):
    return _products(d).select("product_id", "product_type", "run_date", "local_path")


@query("latest_product", sql(
    "", "SELECT product_type, product_id, run_date, local_path FROM (SELECT *, row_number() OVER "
    "(PARTITION BY product_type ORDER BY run_date DESC) AS k FROM reg) WHERE k=1", prod=PROD,
    reg=REG))
def _(d):
    return C.latest_product(_products(d)).select(
        "product_type", "product_id", "run_date", "local_path")
