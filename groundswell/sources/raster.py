"""Raster storage: tiled Parquet pixel tables with a one-row-per-raster metadata table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundswell.config import NODATA
from groundswell.frames import valid
from groundswell.functions.geodesy import Grid
from groundswell.functions.naming import epsg_of

RASTERS = (
    "raster_id string, crs_epsg int, transform struct<a:double,b:double,c:double,d:double,"
    "e:double,f:double>, width int, height int, nodata double, dtype string, band string"
)


def canonical(df: DataFrame, nodata: float = NODATA, value: str = "value") -> DataFrame:
    """nodata, NaN and infinite values become NULL, once, at load."""
    return df.withColumn(value, valid(F.col(value), nodata))


def read_raster(
    spark: SparkSession, path: str, raster_ids: Sequence[str] | None = None,
    window: tuple[int, int, int, int] | None = None, nodata: float | None = None,
) -> DataFrame:
    """Pixels of stored rasters, nodata as NULL.

    ``raster_ids`` prunes partitions; ``window`` (row0, row1, col0, col1) prunes tiles
    and row groups through pushed-down ranges.  Nodata is NULL in the files already; ``nodata`` names
    a sentinel of pixels that another writer stored as they were.
    """
    pixels = spark.read.parquet(f"{path}/pixels")
    if raster_ids is not None:
        pixels = pixels.where(F.col("raster_id").isin(*raster_ids))
    if window is not None:
        r0, r1, c0, c1 = window
        pixels = pixels.where(
            (F.col("row") >= r0) & (F.col("row") < r1) & (F.col("col") >= c0) & (F.col("col") < c1)
        )
    v = F.col("value").cast("double")
    bad = F.isnan(v) | (F.abs(v) == float("inf"))
    if nodata is not None:
        bad = bad | (v == float(nodata))
    return pixels.select("raster_id", "row", "col", F.when(~bad, v).alias("value"))


def tiled(df: DataFrame, by: Sequence[str] = ("raster_id",), tile: int = 512) -> DataFrame:
    """Pixels hashed and sorted by tile: what aligned joins and tile pruning need."""
    return (
        df.withColumns({
            "trow": F.floor(F.col("row") / tile).cast("int"),
            "tcol": F.floor(F.col("col") / tile).cast("int"),
        })
        .repartition(*by, "trow", "tcol")
        .sortWithinPartitions(*by, "trow", "tcol", "row", "col")
    )


def write_raster(
    df: DataFrame, path: str, grid: Grid, nodata: float = NODATA, dtype: str = "float",
    band: str = "", tile: int = 512, mode: str = "append",
) -> None:
    """Write ``(raster_id, row, col, value)`` as tiled Parquet; nodata stays NULL.

    ``nodata`` is what an export puts in place of NULL; it is kept in the metadata.  ``df`` is evaluated
    once: the rasters that have no metadata yet are found in what was written.
    """
    spark = df.sparkSession
    value = valid(F.col("value").cast("double"), nodata).cast(dtype)
    pixels = tiled(df.select("raster_id", "row", "col", value.alias("value")), tile=tile)
    pixels.write.mode(mode).partitionBy("raster_id").parquet(f"{path}/pixels")
    ids = spark.read.parquet(f"{path}/pixels").select(F.col("raster_id").cast("string")).distinct()
    if mode == "append" and _stored(spark, f"{path}/rasters"):
        ids = ids.join(spark.read.schema(RASTERS).parquet(f"{path}/rasters"), "raster_id", "left_anti")
    raster_metadata(ids, grid, nodata, dtype, band).write.mode(mode).parquet(f"{path}/rasters")


def _stored(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def save_bucketed(
    df: DataFrame, table: str, buckets: int, by: Sequence[str] = ("raster_id",),
    path: str | None = None, mode: str = "overwrite",
) -> None:
    """Save pixels as a table bucketed by the pixel key.

    Rasters saved with the same bucket count meet in aligned joins, and fold in per-pixel
    aggregates, without a shuffle.  Choose buckets so that one holds 128 to 512 MB; the
    key includes row and col, so no raster or date, however large, makes a bucket hot.
    """
    keys = [*by, "row", "col"]
    writer = df.repartition(buckets, *keys).write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def raster_metadata(
    ids: DataFrame, grid: Grid, nodata: float = NODATA, dtype: str = "float", band: str = ""
) -> DataFrame:
    t = F.struct(*[F.lit(float(getattr(grid, k))).alias(k) for k in "abcdef"])
    return ids.select(
        F.col("raster_id").cast("string").alias("raster_id"), F.lit(grid.epsg).alias("crs_epsg"),
        t.alias("transform"), F.lit(grid.width).alias("width"), F.lit(grid.height).alias("height"),
        F.lit(float(nodata)).alias("nodata"), F.lit(dtype).alias("dtype"),
        F.lit(band).alias("band"),
    )


def transform_from_bounds(rasters: DataFrame) -> DataFrame:
    """Affine columns from ``west, south, east, north, width, height``."""
    w, h = F.col("width"), F.col("height")
    return rasters.withColumn(
        "transform",
        F.struct(
            ((F.col("east") - F.col("west")) / w).alias("a"), F.lit(0.0).alias("b"),
            F.col("west").alias("c"), F.lit(0.0).alias("d"),
            (-(F.col("north") - F.col("south")) / h).alias("e"), F.col("north").alias("f"),
        ),
    )


def to_tiles(df: DataFrame, tile: int = 512, by: Sequence[str] = ("raster_id",)) -> DataFrame:
    """Pixels as arrays per tile: ``at`` (place in the tile, row by row) and ``data`` (NULL for
    nodata), both in row-major order, and the height and width the tile reaches.

    Absent pixels have no entry, so any raster comes back as it was.  A tile bounds each group.
    """
    tr, tc = (F.floor(F.col(n) / tile).cast("int") for n in ("row", "col"))
    r, c = F.pmod("row", F.lit(tile)), F.pmod("col", F.lit(tile))
    g = df.groupBy(*by, tr.alias("trow"), tc.alias("tcol")).agg(
        (F.max(r) + 1).cast("int").alias("h"), (F.max(c) + 1).cast("int").alias("w"),
        F.array_sort(F.collect_list(F.struct((r * tile + c).cast("int").alias("at"), "value"))).alias("_p"),
    )
    return g.select(*by, "trow", "tcol", "h", "w", F.col("_p.at").alias("at"), F.col("_p.value").alias("data"))


def from_tiles(tiles: DataFrame, tile: int = 512, by: Sequence[str] = ("raster_id",)) -> DataFrame:
    return tiles.select(*by, "trow", "tcol", F.inline(F.arrays_zip("at", "data"))).select(
        *by, (F.col("trow") * tile + F.floor(F.col("at") / tile)).cast("int").alias("row"),
        (F.col("tcol") * tile + F.col("at") % tile).cast("int").alias("col"), F.col("data").alias("value"),
    )


def product_metadata(
    rasters: DataFrame, source_scenes: Column | None = None, params: dict[str, str] | None = None,
    now: Column | None = None,
) -> DataFrame:
    """STAC-style JSON per raster: ``(raster_id, metadata)``.

    ``rasters`` has raster_id, product_type, crs, transform, width, height, dtype, nodata
    and bands.
    """
    t = F.col("transform")
    west, north = t["c"], t["f"]
    east = west + F.col("width") * t["a"]
    south = north + F.col("height") * t["e"]
    ring = F.array(F.array(
        F.array(west, south), F.array(east, south), F.array(east, north), F.array(west, north),
        F.array(west, south),
    ))
    band = F.struct(F.col("dtype").alias("data_type"), F.col("nodata").alias("nodata"))
    props = [
        F.date_format(now if now is not None else F.current_timestamp(),
                      "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datetime"),
        F.col("product_type").alias("product_type"),
        epsg_of(F.col("crs")).alias("proj:epsg"),
        F.array("height", "width").alias("proj:shape"),
    ]
    if source_scenes is not None:
        props.append(source_scenes.alias("source_scenes"))
    if params:
        props.append(F.struct(*[F.lit(v).alias(k) for k, v in params.items()]).alias("processing"))
    doc = F.struct(
        F.lit("Feature").alias("type"), F.lit("1.0.0").alias("stac_version"),
        F.col("raster_id").alias("id"), F.struct(*props).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), ring.alias("coordinates")).alias("geometry"),
        F.array(west, south, east, north).alias("bbox"),
        F.struct(F.struct(
            F.concat("raster_id", F.lit(".parquet")).alias("href"),
            F.lit("application/vnd.apache.parquet").alias("type"),
            F.array(F.lit("data")).alias("roles"),
            F.array_repeat(band, F.col("bands")).alias("raster:bands"),
        ).alias("data")).alias("assets"),
    )
    return rasters.select("raster_id", F.to_json(doc).alias("metadata"))
