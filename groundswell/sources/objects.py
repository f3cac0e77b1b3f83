"""Object listings: sync plans, checksums, resume lists, date indexes, publishing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundswell.sources.files import opened


def sync_plan(remote: DataFrame, local: DataFrame, suffix: str | None = None) -> DataFrame:
    """Remote objects to fetch: not present locally, or present with another known size."""
    r = remote.select("name", F.col("size").alias("_rs"))
    if suffix is not None:
        r = r.where(F.col("name").endswith(suffix))
    present = local.select(F.col("name").alias("_ln"), F.col("size").alias("_ls"))
    same = (F.col("_rs") == F.col("_ls")) | F.col("_rs").isNull()
    todo = r.join(present, (F.col("name") == F.col("_ln")) & same, "left_anti")
    return todo.select("name", F.col("_rs").alias("size"))


def file_checksums(
    spark: SparkSession, path: str, glob: str = "*", chunk: int = 8 << 20
) -> DataFrame:
    """MD5 per file, computed where the file is read, ``chunk`` bytes at a time: files of any size.

    The listing takes names only; files are dealt out evenly and opened by their own URI.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, length in zip(*(c.to_pylist() for c in batch.columns)):
                system, at = opened(name)
                digest = hashlib.md5()
                with system.open_input_stream(at) as f:
                    while part := f.read(chunk):
                        digest.update(part)
                yield pa.RecordBatch.from_pydict({"path": [name], "length": [length], "md5": [digest.hexdigest()]})

    spread = files.repartition(spark.sparkContext.defaultParallelism)
    return spread.mapInArrow(run, "path string, length long, md5 string")


def completed_pairs(listing: DataFrame, product: str = "filt_topophase.unw") -> DataFrame:
    """Pairs whose unwrapped phase is present, named with compact dates."""
    parts = F.split("name", "/")
    return (
        listing.where((F.size(parts) >= 4) & (F.get(parts, F.lit(2)) == "merged")
                      & (F.get(parts, F.lit(3)) == product))
        .select(F.regexp_replace(F.get(parts, F.lit(1)), "-", "").alias("pair_id")).distinct()
    )


def remaining_pairs(pairs: DataFrame, listing: DataFrame) -> DataFrame:
    """Pairs still to be processed."""
    return pairs.join(completed_pairs(listing), "pair_id", "left_anti")


def slc_date_index(files: DataFrame) -> DataFrame:
    """One path per acquisition date: the last in path order; ground-range products skipped."""
    token = F.regexp_extract("name", r"(?:^|_)(\d{8})[^_]*", 1)
    return (
        files.where(~F.col("name").contains("GRD")).withColumn("date", token)
        .where(F.col("date") != "").groupBy("date").agg(F.max("path").alias("path"))
    )


def product_inventory(products: DataFrame) -> DataFrame:
    """Existing products by name, with their count."""
    found = products.where(F.col("present"))
    n = found.agg(F.count("*").alias("n")).scalar()
    return found.select("name", "path").withColumn("product_count", n).orderBy("name")


def publish_products(df: DataFrame, path: str) -> None:
    """Write products under ``run_date=...`` and replace only the runs written.

    Rows are gathered by run and cut by size (the session's advisory partition size): a large run is
    many tasks and files, small ones share a task.
    """
    df.hint("rebalance", "run_date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("run_date").parquet(f"{path}/products")


def publish_keys(products: DataFrame, prefix: str) -> DataFrame:
    """Object key each product is published under."""
    return products.select(
        "name", "run_date",
        F.concat_ws("/", F.lit(prefix), F.lit("products"), F.col("run_date").cast("string"), "name")
        .alias("key"),
    )
