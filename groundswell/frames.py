"""Helpers shared by the operators: per-raster scalars, labels, checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Side tables up to this many rows (about 1 KB each at most) are broadcast.
SMALL_ROWS = 20_000


def val() -> Column:
    """The pixel value column."""
    return F.col("value")


def small(df: DataFrame, write: bool = True) -> DataFrame:
    """A side table, with a broadcast hint when it is counted to be small.

    It is written first (unless it is already stored or trivial to make), so that counting
    does not run its plan twice.  Beyond the bound there is no hint, and Spark joins by
    shuffle, splitting hot keys.
    """
    side = materialized(df) if write else df
    return F.broadcast(side) if side.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else side


def attach(df: DataFrame, stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Put a per-raster statistics row beside every pixel of that raster.

    Without keys the single row becomes a scalar subquery, evaluated once.  With keys the
    statistics are computed and counted first: a short table is broadcast, so that pixels
    are not shuffled by a raster key that may hold a third of them.
    """
    if by:
        return df.join(small(stats), list(by), "left")
    row = stats.select(F.struct(*stats.columns)).scalar()
    return df.select(*df.columns, *[row.getField(n).alias(n) for n in stats.columns])


def extent(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Raster height and width, from the pixels present."""
    return df.groupBy(*by).agg(
        (F.max("row") + 1).cast("int").alias("_h"), (F.max("col") + 1).cast("int").alias("_w")
    )


def with_size(
    df: DataFrame, by: Sequence[str] = (), size: tuple[int, int] | DataFrame | None = None
) -> DataFrame:
    """Add ``_h`` and ``_w``: given as numbers, given as a table, or measured."""
    if isinstance(size, tuple):
        return df.withColumns({"_h": F.lit(size[0]), "_w": F.lit(size[1])})
    return attach(df, extent(df, by) if size is None else size, by)


def valid(value: Column, nodata: float = -9999.0) -> Column:
    """Value with nodata, NaN and infinities turned into NULL."""
    bad = F.isnan(value) | (value == F.lit(float(nodata))) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~bad, value)


def labelled(code: Column, labels: dict[int, str]) -> Column:
    """Label of a class code, as a literal map lookup."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.element_at(F.create_map(*pairs), code)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, and 0 for an empty whole."""
    return F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared checkpoint folder the cluster names; own one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif re.fullmatch(r"local(\[.*\])?", sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="groundswell-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


#: Folders stored inside each open ``settled`` call, innermost last.
_STORED: list[list[str]] = []


def materialized(df: DataFrame) -> DataFrame:
    """The frame written once to a table in the checkpoint folder and read back.

    Cuts lineage, survives lost executors, runs the plan once (a plain ``checkpoint``
    runs its last stage twice) and gives later joins a measured size.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    if _STORED:
        _STORED[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """The frame that ``make`` returns, stored; the tables stored on the way to it are removed.

    For steps with large intermediate tables: they go as soon as the result no longer needs them, and
    not before it is whole in the checkpoint folder.
    """
    _STORED.append([])
    try:
        out = make()
        inner, _STORED[-1] = _STORED[-1], []
        stored = materialized(out)
        kept = _STORED[-1]
    except BaseException:
        _STORED.pop()
        raise
    _STORED.pop()
    if _STORED:
        _STORED[-1] += kept
    for path in inner:
        remove(spark, path)
    return stored


@contextmanager
def short_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """Plans made inside pass Arrow batches of about ``size`` bytes at most to Python, a longer row alone.

    By rows alone, 10,000 texts are one batch, however long: both sides of the pipe hold it whole, for
    every core of an executor, and the JVM keeps the buffers.  The session's value is put back.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
