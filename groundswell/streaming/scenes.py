"""Continuous acquisition: registering scenes and spacing them as they arrive.

Both rules keep their knowledge as keyed state beside the stream: which scene ids are registered, and
the last kept time of each track.  State is versioned with the stream's checkpoint, so a replayed batch starts from
the state before it, and no batch reads what earlier ones have written.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from groundswell.operators.catalog import SCENES, conform

_DAY_US = 86_400_000_000


def _keyed_state(spark: SparkSession) -> None:
    """Stateful processors need the store that keeps state on disk beside the task."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Registration(StatefulProcessor):
    """State of a scene id: that it is registered.  ``forget`` days after its record, once the watermark
    has passed them, a timer drops the state; without ``forget`` it stays."""

    def __init__(self, columns: list[str], forget: int | None) -> None:
        self.columns, self.forget = columns, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "known boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = min(rows, key=lambda r: (r["_micros"], [(r[c] is not None, str(r[c])) for c in self.columns]))
        if not self.known.exists():
            self.known.update((True,))
            if self.forget is not None:
                self.handle.registerTimer(first["_micros"] // 1000 + self.forget * _DAY_US // 1000)
            yield Row(**{c: first[c] for c in self.columns})

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.known.update((True,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.known.clear()
        yield from ()

    def close(self) -> None:
        pass


def first_per_scene(
    stream: DataFrame, delay: str = "1 day", time: str = "start_time", known: DataFrame | None = None,
    forget: int | None = None,
) -> DataFrame:
    """First record of each scene id, the earliest of its batch (equal times: by their columns).

    ``known`` are the scene ids registered before the stream's first batch.  Records later than
    ``delay`` behind the newest are dropped.  With ``forget`` an id's state goes so many days after its
    record; a record of the id beyond them counts as new.
    """
    _keyed_state(stream.sparkSession)
    rows = stream.where(F.col(time).isNotNull() & F.col("scene_id").isNotNull()).withColumn(
        "_micros", F.unix_micros(time)).withWatermark(time, delay)
    start = None if known is None else known.select("scene_id").distinct().groupBy("scene_id")
    return rows.groupBy("scene_id").transformWithState(
        _Registration(stream.columns, forget), stream.schema, "Append", "EventTime", initialState=start)


def register_stream(
    stream: DataFrame, catalog_path: str, checkpoint: str, delay: str = "1 day", forget: int | None = None
) -> DataStreamWriter:
    """Write new scenes to the catalog folder, one sub-folder per batch.

    Scenes that the folder holds when the stream first starts are known from the beginning; from then
    on the state alone tells.  A replayed batch overwrites its own folder, so a restart neither
    loses nor repeats a scene.
    """
    spark = stream.sparkSession
    # An empty write makes the folder, so that it can be read.
    spark.createDataFrame([], SCENES).write.mode("append").parquet(catalog_path)
    known = spark.read.schema(SCENES).parquet(catalog_path).where(F.col("scene_id").isNotNull())

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({
            "acquisition_date": F.to_date("start_time"), "download_status": F.lit("pending")
        })
        conform(rows, SCENES).write.mode("overwrite").parquet(f"{catalog_path}/batch={batch_id}")

    return (
        first_per_scene(stream, delay, known=known, forget=forget).writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint).outputMode("append")
    )


#: Waiting scenes of a track that are one value of its state.
PIECE = 1000


class _Spacing(StatefulProcessor):
    """State of a track: scenes that wait for the watermark, in pieces of neighbouring times, and a row with the
    last kept time, the timer and where the pieces start.

    A track has one timer, at its first waiting scene.  It takes the scenes of all milliseconds that the watermark
    has reached, when no earlier one can come any more, so that they are judged in time order whatever the order of
    arrival.  So state is read and written by track and piece, not by scene: each access is a call to the JVM.
    """

    def __init__(self, gap_days: int) -> None:
        self.gap = gap_days * _DAY_US

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.track = handle.getValueState("track", "last bigint, timer bigint, starts array<bigint>")
        self.waiting = handle.getMapState("waiting", "start bigint", "micros array<bigint>, ids array<string>")

    def _add(self, fresh: dict[int, str], starts: list[int]) -> list[int]:
        """Put scenes (id by time) into the pieces they fall into; where the pieces start after that."""
        met: dict[int, dict[int, str]] = {}
        for t, i in fresh.items():
            met.setdefault(max(0, bisect_right(starts, t) - 1), {})[t] = i
        after = set(starts)
        for k, at in met.items():
            if starts:
                for t, i in zip(*self.waiting.getValue((starts[k],))):
                    at[t] = min(i, at.get(t, i))
                after.remove(starts[k])
            times = sorted(at)
            if starts and times[0] != starts[k]:
                self.waiting.removeKey((starts[k],))
            for n in range(0, len(times), PIECE):
                piece = times[n:n + PIECE]
                self.waiting.updateValue((piece[0],), (piece, [at[t] for t in piece]))
                after.add(piece[0])
        return sorted(after)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last, timer, starts = self.track.get() or (None, None, [])
        fresh: dict[int, str] = {}
        for r in rows:
            t, i = r["_micros"], r["scene_id"]
            if last is None or t - last >= self.gap:
                fresh[t] = min(i, fresh.get(t, i))
        if fresh:
            first = min(fresh) // 1000
            if timer is None or first < timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(first)
                timer = first
            self.track.update((last, timer, self._add(fresh, list(starts))))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        last, _, starts = self.track.get()
        timer = None
        for n, start in enumerate(starts):
            held, rest = sorted(zip(*self.waiting.getValue((start,)))), []
            for t, i in held:
                if last is not None and t - last < self.gap:
                    continue
                if t // 1000 > passed:
                    rest.append((t, i))
                    continue
                last = t
                yield Row(scene_id=i, track=key[0], micros=t)
            if rest:
                if len(rest) < len(held):
                    self.waiting.updateValue((start,), ([t for t, _ in rest], [i for _, i in rest]))
                timer, starts = rest[0][0] // 1000, starts[n:]
                self.handle.registerTimer(timer)
                break
            self.waiting.removeKey((start,))
        self.track.update((last, timer, [] if timer is None else list(starts)))

    def close(self) -> None:
        pass


def min_gap_stream(
    stream: DataFrame, min_gap_days: int, key: str = "path_number", delay: str = "0 seconds"
) -> DataFrame:
    """Scenes kept by the spacing rule, per track.

    A scene waits until the stream's newest time is ``delay`` ahead of it and is then judged in time
    order, so scenes may arrive out of order by that much; later ones are dropped.  Of
    scenes at one time that with the smallest id counts.  A track holds its waiting scenes and one time.
    """
    _keyed_state(stream.sparkSession)
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select("scene_id", key, "start_time", F.unix_micros("start_time").alias("_micros")).where(
        F.col("start_time").isNotNull() & F.col("scene_id").isNotNull())
    kept = rows.withWatermark("start_time", delay).groupBy(key).transformWithState(
        _Spacing(min_gap_days), f"scene_id string, track {kind}, micros bigint", "Append", "EventTime")
    return kept.select("scene_id", F.col("track").alias(key), F.timestamp_micros("micros").alias("start_time"))


def min_gap_register(
    stream: DataFrame, path: str, checkpoint: str, min_gap_days: int, key: str = "path_number",
    delay: str = "0 seconds",
) -> DataStreamWriter:
    """The scenes that ``min_gap_stream`` keeps, one sub-folder per batch; a replayed batch overwrites its own."""
    kept = min_gap_stream(stream, min_gap_days, key, delay)
    stream.sparkSession.createDataFrame([], kept.schema).write.mode("append").parquet(path)

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return kept.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
