import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from groundswell.operators import catalog as C
from groundswell.sources.keyed import KeyedTable, parts_of

T0 = datetime(2024, 1, 1)
EVENT = "scene_id string, event_time timestamp, sequence long, status string, local_path string, remote_path string, file_size_bytes long, checksum string"


@pytest.fixture
def table(spark, tmp_path):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    rows = spark.range(2000).select(F.concat(F.lit("s"), "id").alias("scene_id"), F.lit("pending").alias("download_status"))
    return KeyedTable.create(C.conform(rows, C.SCENES), str(tmp_path / "catalog"), C.SCENES, "scene_id", 32)


def events(spark, rows):
    return spark.createDataFrame([(f"s{k}", T0 + timedelta(hours=h), n, s, p, None, None, None) for k, h, n, s, p in rows], EVENT)


def files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def status(df):
    return {r["scene_id"]: (r["download_status"], r["local_path"]) for r in df.collect()}


def test_an_update_writes_what_it_alters_and_reads_its_parts(spark, table, tmp_path):
    before = files(tmp_path / "catalog")
    some = [7, 70, 700]
    n = C.update_stored(table, events(spark, [(k, 1, 1, "downloaded", "p") for k in some] + [(9999, 1, 1, "failed", None)]), C.update_scene_status)
    new = {f for f in files(tmp_path / "catalog") - before if "_log" not in f}
    assert n == 3 and before <= files(tmp_path / "catalog")
    assert sum(spark.read.parquet(f).count() for f in new) == 3 and len({parts_of(f)[1] for f in new}) <= 3
    read = table.matching(spark.createDataFrame([("s7",)], "scene_id string")).inputFiles()
    assert {parts_of(f)[1] for f in read if "version=0" in f} <= {parts_of(f)[1] for f in files(tmp_path / "catalog") if "version=0" in f}
    plan = table.matching(spark.createDataFrame([("s7",)], "scene_id string"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [part" in plan or "part#" in plan.split("PartitionFilters")[1][:200]
    got = status(table.read())
    assert len(got) == 2000 and {k for k, v in got.items() if v != ("pending", None)} == {f"s{k}" for k in some}
    # The same events once more alter nothing and write nothing.
    version = table.version()
    assert C.update_stored(table, events(spark, [(k, 1, 1, "downloaded", "p") for k in some]), C.update_scene_status) == 0
    assert table.version() == version


def test_many_updates_equal_a_dict(spark, table):
    rng = random.Random(3)
    want = {f"s{k}": ("pending", None) for k in range(2000)}
    for turn in range(4):
        rows = [(rng.randrange(60), rng.randrange(3), n, rng.choice(["downloading", "failed", "downloaded"]), rng.choice([None, f"p{n}"]))
                for n in range(40)]
        for k, _, _, s, p in sorted(rows, key=lambda r: (r[1], r[2])):
            want[f"s{k}"] = (s, p or want[f"s{k}"][1])
        C.update_stored(table, events(spark, rows), C.update_scene_status)
        if turn == 2:
            before = table.version()
            parts = table.compact(0.05)
            assert parts and table.version() == before + 1 and table.compact(0.05) == []
        assert status(table.read()) == want


def test_registering_ignores_what_is_there(spark, table):
    new = spark.range(1990, 2010).select(F.concat(F.lit("s"), "id").alias("scene_id"), F.lit("X").alias("platform"),
                                         F.to_date(F.lit("2024-01-01")).alias("acquisition_date"))
    again = new.union(new.withColumn("acquisition_date", F.date_add("acquisition_date", 3)).withColumn("platform", F.lit("late")))
    assert C.register_stored(table, again, "acquisition_date", "download_status") == 10
    got = table.read()
    assert got.count() == 2010 and got.where("platform = 'X'").count() == 10


def test_a_write_that_breaks_off_leaves_nothing(spark, table, tmp_path):
    torn = tmp_path / "catalog" / "rows" / "version=1" / "part=3"
    torn.mkdir(parents=True)
    (torn / "part-torn.parquet").write_bytes(b"half a file")
    assert table.read().count() == 2000 and table.version() == 0
    assert C.update_stored(table, events(spark, [(5, 0, 0, "failed", None)]), C.update_scene_status) == 1
    assert not (torn / "part-torn.parquet").exists()
    assert status(table.read())["s5"] == ("failed", None)


def test_all_parts_compacted_leave_old_versions_unread(spark, table):
    rows = spark.range(2000).select(F.concat(F.lit("s"), "id").alias("scene_id"), F.lit("done").alias("download_status"))
    table.put(C.conform(rows, C.SCENES))
    assert len(table.compact()) == 32
    assert all("version=2" in f for f in table.read().inputFiles()) and table.read().where("download_status = 'done'").count() == 2000


def test_events_of_one_time_follow_their_sequence(spark, table):
    rows = [(1, 0, 3, "failed", None), (1, 0, 1, "downloaded", "a"), (1, 0, 2, "downloading", "b")]
    for some in (rows, rows[::-1]):
        now = C.update_scene_status(table.read().where("scene_id = 's1'"), events(spark, some))
        assert status(now) == {"s1": ("failed", "b")}
    untold = C.update_scene_status(table.read().where("scene_id = 's1'"), events(spark, rows).drop("sequence"))
    assert status(untold) == {"s1": ("failed", "b")}


def test_tables_on_the_way_are_removed(spark, tmp_path):
    from groundswell.frames import materialized, settled

    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    seen = []

    def make():
        a = materialized(spark.range(10))
        b = settled(spark, lambda: materialized(spark.range(5)).union(a))
        seen.extend(x.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:") for x in (a, b))
        return a.union(b)

    out = settled(spark, make)
    assert out.count() == 25 and not any(os.path.exists(f) for f in seen)
    with pytest.raises(ZeroDivisionError):
        settled(spark, lambda: 1 / 0)
    assert materialized(spark.range(3)).count() == 3
