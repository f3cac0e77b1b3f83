from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from groundswell.operators import acquisitions as Q
from groundswell.operators import catalog as C
from groundswell.sources import objects as O
from groundswell.sources import scenes as SC

START = datetime(2024, 1, 1)


def greedy(times, gap):
    kept = []
    for t in sorted(set(times)):
        if not kept or (t - kept[-1]).days >= gap:
            kept.append(t)
    return kept


@pytest.mark.parametrize("gap", [1, 3, 14])
def test_min_gap_with_one_crowded_track(spark, rng, gap):
    tracks = {1: 3000, 2: 40, 3: 1}
    rows = [(k, START + timedelta(seconds=int(s))) for k, n in tracks.items()
            for s in rng.integers(0, 90 * 86400, n)]
    df = spark.createDataFrame(rows, "track int, start_time timestamp")
    got: dict = {}
    for r in Q.min_gap_times(df, gap).collect():
        got.setdefault(r["track"], []).append(r["start_time"])
    for k in tracks:
        assert sorted(got[k]) == greedy([t for a, t in rows if a == k], gap)


def test_min_gap_edges(spark):
    rows = [("a", 1, START), ("b", 1, START), ("c", 1, START + timedelta(days=14)),
            ("d", 1, START + timedelta(days=14) - timedelta(seconds=1)), ("e", 1, None)]
    df = spark.createDataFrame(rows, "scene_id string, path_number int, start_time timestamp")
    kept = sorted(r["scene_id"] for r in Q.min_gap_scenes(df, 14).collect())
    assert kept == ["a", "c"]
    assert Q.min_gap_scenes(df, 0).count() == 4
    assert [r["scene_id"] for r in Q.min_gap_scenes(df, 14, 1).collect()] == ["a"]
    assert Q.min_gap_scenes(df.limit(0), 14).count() == 0


def test_pair_fixtures(spark):
    d = [date(2024, 1, 1) + timedelta(days=24 * i) for i in range(4)]
    df = spark.createDataFrame([("t", x) for x in d], "track string, acq_date date")
    pairs = Q.sbas_pairs(df, 48, 4)
    assert pairs.count() == 5  # 24 and 48 days apart, not 72
    monthly = spark.createDataFrame(
        [("t", date(2024, m, 1)) for m in range(1, 13)], "track string, acq_date date")
    assert Q.sbas_pairs(monthly, 365, 2).groupBy("ref_date").count().agg(F.max("count")).first()[0] == 2
    assert Q.sequential_pairs(df).count() == 3
    three = spark.createDataFrame(
        [(d[0], d[1], 24), (d[1], d[2], 24), (d[0], d[2], 48)],
        "ref_date date, sec_date date, baseline_days int")
    s = Q.network_summary(three).first()
    assert (s["num_pairs"], s["num_dates"], s["min_baseline_days"], s["max_baseline_days"]) == (3, 3, 24, 48)
    assert s["mean_baseline_days"] == 32 and s["redundancy"] == 1.5


def test_best_orbit_tie_takes_the_first_seen(spark):
    rows = [("a", 7, START + timedelta(days=1)), ("b", 9, START), ("c", 7, START + timedelta(days=2)),
            ("d", 9, START + timedelta(days=3)), ("e", None, START)]
    df = spark.createDataFrame(rows, "scene_id string, path_number int, start_time timestamp")
    assert Q.best_orbit(df).first()["path_number"] == 9


def test_empty_search_gives_empty_stack(spark):
    df = spark.createDataFrame(
        [("a", 7, START, "SLC")], "scene_id string, path_number int, start_time timestamp, processing_level string")
    assert SC.acquisition_stack(df, "2030-01-01", "2030-02-01").count() == 0


def test_orbit_prefers_precise_and_keeps_misses(spark):
    orbits = spark.createDataFrame(
        [("RESORB", "r", START - timedelta(hours=30), START + timedelta(hours=30)),
         ("POEORB", "p", START - timedelta(hours=2), START + timedelta(hours=26))],
        "kind string, name string, valid_from timestamp, valid_to timestamp")
    scenes = spark.createDataFrame(
        [("a", START), ("b", START + timedelta(hours=28)), ("c", START + timedelta(days=5))],
        "scene_id string, start_time timestamp")
    got = {r["scene_id"]: r["orbit_name"] for r in Q.orbit_cover(scenes, orbits).collect()}
    assert got == {"a": "p", "b": "r", "c": None}


def test_sync_plan_rules(spark):
    remote = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("d", 4)], "name string, size long")
    local = spark.createDataFrame([("a", 1), ("b", 9), ("c", 3)], "name string, size long")
    assert sorted(r["name"] for r in O.sync_plan(remote, local).collect()) == ["b", "d"]


def test_checksums(spark, tmp_path):
    import hashlib

    (tmp_path / "a.bin").write_bytes(b"abc" * 1000)
    r = O.file_checksums(spark, str(tmp_path)).first()
    assert (r["length"], r["md5"]) == (3000, hashlib.md5(b"abc" * 1000).hexdigest())


def test_publish_replaces_only_its_runs(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-02-01")], "name string, run_date string")
    O.publish_products(df, str(tmp_path))
    O.publish_products(spark.createDataFrame([("c", "2024-02-01")], df.schema), str(tmp_path))
    got = spark.read.parquet(f"{tmp_path}/products").select("name").collect()
    assert sorted(r["name"] for r in got) == ["a", "c"]


def test_catalog_keeps_the_first_and_replaces_products(spark):
    none = C.conform(spark.createDataFrame([("x",)], "scene_id string").limit(0), C.SCENES)
    new = spark.createDataFrame(
        [("s1", date(2024, 1, 2), "late"), ("s1", date(2024, 1, 1), "early")],
        "scene_id string, acquisition_date date, platform string")
    once = C.register_scenes(none, C.conform(new, C.SCENES).drop("download_status"))
    assert [(r["platform"], r["download_status"]) for r in once.collect()] == [("early", "pending")]
    again = C.register_scenes(once, C.conform(new, C.SCENES).drop("download_status"))
    assert again.count() == 1


def test_store_uris_and_odd_file_names(spark, tmp_path):
    import hashlib

    from groundswell.sources.files import arrow_uri

    assert arrow_uri("s3a://bucket/a=1/x y.bin") == "s3://bucket/a%3D1/x%20y.bin".replace("%3D", "=")
    assert arrow_uri("s3n://b/k") == "s3://b/k" and arrow_uri("hdfs://n:9000/k") == "hdfs://n:9000/k"
    assert arrow_uri("/plain/path") == "file:///plain/path" == arrow_uri("file:/plain/path")
    with pytest.raises(ValueError):
        arrow_uri("viewfs://store/in")
    want = {}
    for k, name in enumerate(["plain.bin", "with space.bin", "per%20cent.bin", "a=b+c.bin", "ünï.bin", "hash#1.bin"]):
        (tmp_path / name).write_bytes(bytes([k]) * 1000)
        want[name] = hashlib.md5(bytes([k]) * 1000).hexdigest()
    got = {r["path"].rsplit("/", 1)[1]: r["md5"] for r in O.file_checksums(spark, str(tmp_path), chunk=300).collect()}
    assert got == want
