"""Files in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from urllib.parse import urlparse

from pyspark.sql import SparkSession

from groundswell.frames import ensure_checkpoint_dir
from groundswell.sources.files import opened


def run_folder(spark: SparkSession, kind: str) -> str:
    """A new folder below the shared checkpoint folder, as a URI."""
    ensure_checkpoint_dir(spark)
    base = spark.sparkContext.getCheckpointDir()
    return f"{base if urlparse(base).scheme else 'file://' + base}/{kind}-{uuid.uuid4().hex}"


def put_file(uri: str, parts: Iterable[bytes]) -> int:
    """Write a file whole: under another name first, so that a lost task leaves no half file."""
    system, path = opened(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    size, other = 0, f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(other) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    system.move(other, path)
    return size


def read_file(uri: str):
    """The file, opened for reads at any place."""
    system, path = opened(uri)
    return system.open_input_file(path)
