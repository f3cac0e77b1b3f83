import json
from datetime import datetime, timedelta

import numpy as np
from pixels import to_array, to_pixels
from pyspark.sql import functions as F

from groundswell.functions.geodesy import Grid
from groundswell.operators.catalog import SCENES, conform
from groundswell.sources import raster as RS
from groundswell.streaming import scenes as ST


def test_raster_round_trip_and_pruning(spark, tmp_path, rng):
    a = rng.normal(size=(70, 90))
    a[3, 5] = np.nan
    px = to_pixels(spark, a).withColumn("raster_id", F.lit("r"))
    RS.write_raster(px, str(tmp_path), Grid(70, 90), dtype="double", tile=32)
    np.testing.assert_allclose(to_array(RS.read_raster(spark, str(tmp_path)), a.shape), a)
    cut = RS.read_raster(spark, str(tmp_path), ["r"], (10, 20, 5, 50))
    assert cut.count() == 450
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row,10)" in plan and "PartitionFilters: [(raster_id" in plan.replace("isnotnull(raster_id#", "(raster_id")


def test_bucketed_rasters_join_without_a_shuffle(spark, tmp_path, rng):
    from groundswell.operators import algebra as A
    from groundswell.operators import composite as C
    from groundswell.session import configure

    configure(spark)
    a, b = rng.normal(size=(40, 50)), rng.normal(size=(40, 50))
    for name, x in (("gs_a", a), ("gs_b", b)):
        RS.save_bucketed(to_pixels(spark, x), name, 4, by=(), path=str(tmp_path / name))
    left, right = spark.table("gs_a"), spark.table("gs_b")
    joined = A.valid_pairs(left, right)
    composite = C.temporal_composite(left)
    for df in (joined, composite):
        assert df.count() == 2000
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, plan
    for name in ("gs_a", "gs_b"):
        spark.sql(f"DROP TABLE {name}")


def test_metadata_document(spark):
    t = F.struct(*[F.lit(float(v)).alias(k) for k, v in zip("abcdef", (10, 0, 500, 0, -10, 900))])
    df = spark.range(1).select(
        F.lit("v").alias("raster_id"), F.lit("subsidence_velocity").alias("product_type"),
        F.lit("EPSG:32649").alias("crs"), t.alias("transform"), F.lit(20).alias("width"),
        F.lit(30).alias("height"), F.lit("float32").alias("dtype"), F.lit(-9999.0).alias("nodata"),
        F.lit(2).alias("bands"))
    doc = json.loads(RS.product_metadata(df, F.array(F.lit("s1")), {"looks": "3"}).first()["metadata"])
    assert doc["bbox"] == [500, 600, 700, 900] and doc["properties"]["proj:epsg"] == 32649
    assert doc["geometry"]["coordinates"][0][0] == doc["geometry"]["coordinates"][0][-1]
    assert len(doc["assets"]["data"]["raster:bands"]) == 2
    assert doc["properties"]["source_scenes"] == ["s1"]


def write_batch(spark, folder, name, rows):
    spark.createDataFrame(
        rows, "scene_id string, start_time timestamp, path_number int"
    ).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def run(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def test_streams_over_several_batches(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    src, cat, kept = (str(tmp_path / n) for n in ("src", "cat", "kept"))
    rows = [[(f"s{b}_{i}", t0 + timedelta(days=b * 10 + i), 1) for i in range(10)] for b in range(3)]
    rows[1].append(("s0_9", t0 + timedelta(days=9), 1))  # seen before
    write_batch(spark, src, "b0", rows[0])
    schema = spark.read.parquet(f"{src}/b0").schema

    def stream():
        return spark.readStream.schema(schema).parquet(f"{src}/*")

    for b in range(3):
        write_batch(spark, src, f"b{b}", rows[b]) if b else None
        run(ST.register_stream(stream(), cat, str(tmp_path / "ck1"), "30 days"))
        gap = ST.min_gap_stream(stream(), 4)
        run(gap.writeStream.format("parquet").option("path", kept).option(
            "checkpointLocation", str(tmp_path / "ck2")))
        run(ST.min_gap_register(stream(), str(tmp_path / "spaced"), str(tmp_path / "ck3"), 4))
    catalog = spark.read.schema(SCENES).parquet(cat)
    assert catalog.count() == 30 == catalog.select("scene_id").distinct().count()
    times = sorted(r["start_time"] for r in spark.read.parquet(kept).collect())
    assert times == [t0 + timedelta(days=4 * i) for i in range(8)]
    spaced = spark.read.schema(schema).parquet(str(tmp_path / "spaced"))
    assert sorted(r["start_time"] for r in spaced.collect()) == times


def test_registration_reads_no_catalog_file_and_survives_a_replay(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    src, cat, ck = (str(tmp_path / n) for n in ("src", "cat", "ck"))
    before = spark.createDataFrame([("old",)], "scene_id string")
    conform(before, SCENES).write.parquet(f"{cat}/batch=seed")
    for b in range(3):
        rows = [(f"s{i}", t0 + timedelta(days=b, hours=i), b) for i in range(b * 5 + 6)] + [("old", t0, 9), (None, t0, 9)]
        write_batch(spark, src, f"b{b}", rows)
        schema = spark.read.parquet(f"{src}/b0").schema
        run(ST.register_stream(spark.readStream.schema(schema).parquet(f"{src}/*"), cat, ck, "30 days"))
        if b == 0:
            (tmp_path / "cat" / "batch=0" / "part-torn.parquet").write_bytes(b"no parquet")
    # The last batches are run again, as after a crash before their commit.
    for f in (tmp_path / "ck" / "commits").iterdir():
        if f.name.strip(".crc").isdigit() and int(f.name.strip(".crc")) >= 2 or f.name.startswith(".") and f.name != ".0.crc":
            f.unlink()
    (tmp_path / "cat" / "batch=0" / "part-torn.parquet").unlink()
    run(ST.register_stream(spark.readStream.schema(schema).parquet(f"{src}/*"), cat, ck, "30 days"))
    ids = sorted(r["scene_id"] for r in spark.read.schema(SCENES).parquet(cat).collect())
    assert ids == sorted(["old"] + [f"s{i}" for i in range(16)])


def test_registered_scenes_are_forgotten_after_their_days(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    src, cat, ck = (str(tmp_path / n) for n in ("src", "cat", "ck"))
    for b, rows in enumerate([[("a", t0, 1), ("b", t0 + timedelta(days=9), 1)], [("c", t0 + timedelta(days=30), 1)],
                              [("a", t0 + timedelta(days=29), 1), ("c", t0 + timedelta(days=30), 1)]]):
        write_batch(spark, src, f"b{b}", rows)
        schema = spark.read.parquet(f"{src}/b0").schema
        run(ST.register_stream(spark.readStream.schema(schema).parquet(f"{src}/*"), cat, ck, "2 days", forget=5))
    assert sorted(r["scene_id"] for r in spark.read.schema(SCENES).parquet(cat).collect()) == ["a", "a", "b", "c"]


def test_spacing_takes_late_scenes_in_time_order(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    src, kept = str(tmp_path / "src"), str(tmp_path / "kept")
    days = [[0, 1, 5, 9], [8, 4, 12, 3], [16, 2, 11], [40]]
    for b, some in enumerate(days):
        rows = [(f"s{d:02}{x}", t0 + timedelta(days=d, microseconds=7), p) for d in some for p in (1, 2) for x in "ba"]
        write_batch(spark, src, f"b{b}", rows)
        schema = spark.read.parquet(f"{src}/b0").schema
        gap = ST.min_gap_stream(spark.readStream.schema(schema).parquet(f"{src}/*"), 4, delay="6 days")
        run(gap.writeStream.format("parquet").option("path", kept).option("checkpointLocation", str(tmp_path / "ck")))
    got = sorted((r["path_number"], r["scene_id"], (r["start_time"] - t0).days) for r in spark.read.parquet(kept).collect())
    # Day 2 of the third batch comes when the watermark is at day 6: too late.  Day 40 still waits.
    assert got == [(p, f"s{d:02}a", d) for p in (1, 2) for d in (0, 4, 8, 12, 16)]


class Calls:
    """A track's state in memory that counts its accesses."""

    def __init__(self):
        self.n, self.value, self.map, self.timers = 0, None, {}, set()

    def __getattr__(self, name):
        def call(*args):
            self.n += 1
            return {
                "getValueState": lambda *_: self, "getMapState": lambda *_: self, "get": lambda: self.value,
                "update": lambda v: setattr(self, "value", v), "getValue": lambda k: self.map[k],
                "updateValue": self.map.__setitem__, "removeKey": self.map.pop, "containsKey": self.map.__contains__,
                "exists": lambda: self.value is not None, "registerTimer": self.timers.add, "deleteTimer": self.timers.remove,
            }[name](*args)
        return call


def test_spacing_uses_its_state_by_track_not_by_scene(monkeypatch):
    """4,000 scenes of one track over random batches: the greedy rule, and few calls to the state."""
    from types import SimpleNamespace as N

    monkeypatch.setattr(ST, "PIECE", 300, raising=False)
    rng = np.random.default_rng(3)
    times = np.sort(rng.integers(0, 200 * 86_400_000_000, 4000))
    arrival = times + rng.integers(0, 86_400_000_000, 4000)
    state, track, got, mark = Calls(), ST._Spacing(3), [], 0
    track.init(state)
    for batch in np.array_split(times[np.argsort(arrival)], 8):
        list(track.handleInputRows((1,), [{"_micros": int(t), "scene_id": f"s{t}{x}"} for t in batch for x in "ba"], None))
        mark = max(mark, int(batch.max()) // 1000 - 86_400_000)
        while due := sorted(t for t in state.timers if t <= mark):
            state.timers.remove(due[0])
            got += track.handleExpiredTimer((1,), N(getCurrentWatermarkInMs=lambda: mark), N(getExpiryTimeInMs=lambda: due[0]))
    want, last = [], None
    for t in times.tolist():
        if t // 1000 <= mark and (last is None or t - last >= 3 * 86_400_000_000):
            last = t
            want.append((f"s{t}a", t))
    assert [(r["scene_id"], r["micros"]) for r in got] == want
    assert state.n < 400
