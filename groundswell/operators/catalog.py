"""Catalog tables as DataFrames: bulk inserts and updates by key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundswell.frames import materialized
from groundswell.sources.keyed import KeyedTable

# Catalog schemas as DDL.
SCENES = (
    "scene_id string, platform string, acquisition_date date, processing_level string, "
    "relative_orbit int, polarization string, local_path string, remote_path string, "
    "download_status string, download_started_at timestamp, download_completed_at timestamp, "
    "file_size_bytes bigint, checksum string, created_at timestamp"
)
PAIRS = (
    "pair_id string, reference_scene_id string, secondary_scene_id string, "
    "temporal_baseline_days int, perpendicular_baseline_m double, processing_status string, "
    "processing_started_at timestamp, processing_completed_at timestamp, output_dir string, "
    "error_message string, created_at timestamp"
)
PRODUCTS = (
    "product_id string, product_type string, run_date date, local_path string, "
    "remote_path string, crs string, bounds string, created_at timestamp"
)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Cast to a catalog schema; columns not given are NULL."""
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    return df.select(*[
        (F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in fields
    ])


def _first_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One whole row per key, the one smallest in ``order`` (combined before the shuffle)."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(
        *[F.col(key) if c == key else F.col("_r")[c].alias(c) for c in df.columns]
    )


def insert_or_ignore(current: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Current rows plus the first new row of each key not yet present."""
    fresh = _first_per_key(new, key, F.col(order)).join(current.select(key), key, "left_anti")
    return current.unionByName(fresh.select(*current.columns), allowMissingColumns=True)


def register_scenes(current: DataFrame, new: DataFrame, order: str = "acquisition_date"):
    """Add scenes as pending; a scene already known stays as it is."""
    return insert_or_ignore(current, new.withColumn("download_status", F.lit("pending")),
                            "scene_id", order)


def _apply_events(
    current: DataFrame, events: DataFrame, key: str, status: str, started: str, completed: str,
    start_on: Sequence[str], complete_on: Sequence[str], fields: Sequence[str],
) -> DataFrame:
    """Fold status events into their rows in event order, in one aggregate.

    The last status wins; a stamp takes the time of its last event; a field takes the last
    value given for it.  Events are ordered by time and, at one time, by their ``sequence`` if they have
    one, then by status and fields, so that ties never depend on the rows' places.
    """
    t, s = F.col("event_time"), F.col("status")
    order = F.struct("event_time", *[c for c in ("sequence",) if c in events.columns], "status", *fields)

    def last_given(x: Column) -> Column:
        return F.max_by(x, F.when(x.isNotNull(), order))

    latest = events.groupBy(key).agg(
        last_given(s).alias("_status"),
        F.max(F.when(s.isin(*start_on), t)).alias("_started"),
        F.max(F.when(s.isin(*complete_on), t)).alias("_completed"),
        *[last_given(F.col(f)).alias(f"_{f}") for f in fields],
    )
    new = {status: "_status", started: "_started", completed: "_completed"}
    new.update({f: f"_{f}" for f in fields})
    return current.join(latest, key, "left").select(*[
        F.coalesce(F.col(new[c]), F.col(c)).alias(c) if c in new else F.col(c)
        for c in current.columns
    ])


def update_scene_status(current: DataFrame, events: DataFrame) -> DataFrame:
    """``events(scene_id, event_time[, sequence], status, local_path, remote_path, file_size_bytes, checksum)``."""
    return _apply_events(
        current, events, "scene_id", "download_status", "download_started_at",
        "download_completed_at", ["downloading"], ["downloaded", "completed"],
        ["local_path", "remote_path", "file_size_bytes", "checksum"],
    )


def get_scenes(
    current: DataFrame, processing_level: str | None = None, status: str | None = None
) -> DataFrame:
    out = current
    if processing_level is not None:
        out = out.where(F.col("processing_level") == processing_level)
    if status is not None:
        out = out.where(F.col("download_status") == status)
    return out.orderBy("acquisition_date")


def register_stored(table: KeyedTable, new: DataFrame, order: str, status: str) -> int:
    """Add the rows whose key a stored catalog doesn't have, as pending; only these are written."""
    rows = new.withColumn(status, F.lit("pending"))
    fresh = _first_per_key(conform(rows, table.ddl), table.key, F.col(order))
    known = table.matching(fresh.select(table.key))
    return table.put(fresh.join(known.select(table.key), table.key, "left_anti").select(*fresh.columns))


def update_stored(table: KeyedTable, events: DataFrame, fold: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
    """Fold status events (``update_scene_status`` or ``update_pair_status``) into a stored catalog.

    Only the parts that the events' keys fall into are read, only the rows they alter are written.
    """
    events = materialized(events)
    return table.update(events.select(table.key).where(F.col(table.key).isNotNull()), lambda now: fold(now, events))


def existing(ids: DataFrame, current: DataFrame, key: str = "scene_id") -> DataFrame:
    return ids.join(current.select(key), key, "left_semi")


def register_pairs(current: DataFrame, new: DataFrame, scenes: DataFrame) -> DataFrame:
    """Add pairs whose two scenes are known, as pending, under ``reference__secondary``."""
    known = scenes.select("scene_id")
    rows = (
        new.join(known.withColumnRenamed("scene_id", "reference_scene_id"),
                 "reference_scene_id", "left_semi")
        .join(known.withColumnRenamed("scene_id", "secondary_scene_id"),
              "secondary_scene_id", "left_semi")
        .withColumns({
            "pair_id": F.concat_ws("__", "reference_scene_id", "secondary_scene_id"),
            "processing_status": F.lit("pending"),
        })
    )
    return insert_or_ignore(current, rows, "pair_id", "temporal_baseline_days")


def update_pair_status(current: DataFrame, events: DataFrame) -> DataFrame:
    """``events(pair_id, event_time[, sequence], status, output_dir, error_message)``."""
    return _apply_events(
        current, events, "pair_id", "processing_status", "processing_started_at",
        "processing_completed_at", ["processing"], ["completed", "failed"],
        ["output_dir", "error_message"],
    )


def get_pairs(current: DataFrame, status: str | None = None) -> DataFrame:
    out = current if status is None else current.where(F.col("processing_status") == status)
    return out.orderBy("reference_scene_id")


def register_products(current: DataFrame, new: DataFrame, order: str = "load_order") -> DataFrame:
    """Add products under ``type_rundate``; a later load replaces an earlier one."""
    named = new.withColumn("product_id", F.concat_ws("_", "product_type", F.col("run_date").cast("string")))
    fresh = _first_per_key(named, "product_id", -F.col(order))
    kept = current.join(fresh.select("product_id"), "product_id", "left_anti")
    return kept.unionByName(fresh.select(*current.columns))


def latest_product(products: DataFrame) -> DataFrame:
    """Newest run of every product type."""
    rest = [c for c in products.columns if c != "product_type"]
    return products.groupBy("product_type").agg(
        F.max_by(F.struct(*rest), F.struct("run_date", "product_id")).alias("_r")
    ).select("product_type", *[F.col("_r")[c].alias(c) for c in rest])
