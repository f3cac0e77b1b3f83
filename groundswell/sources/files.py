"""Files on shared storage, opened in tasks by URI."""

from __future__ import annotations

from urllib.parse import quote, urlsplit

# Names of one store: Hadoop's connectors on the left, the Arrow file system's own on the right.
STORES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "abfss": "abfss", "abfs": "abfs", "hdfs": "hdfs", "file": "file", "": "file"}


def arrow_uri(uri: str) -> str:
    """A path as Spark names it (nothing escaped) as a URI for the Arrow file systems, to which Hadoop's s3a:// and
    s3n:// are s3://."""
    parts = urlsplit(uri, allow_fragments=False)
    if parts.scheme not in STORES and parts.scheme != "s3":
        raise ValueError(f"tasks can't open {parts.scheme}:// files; copy them to one of {sorted(filter(None, STORES))}")
    path = quote(parts.path + (f"?{parts.query}" if parts.query else ""), safe="/:=")
    return f"{STORES.get(parts.scheme, parts.scheme)}://{parts.netloc}{path}"


def opened(uri: str):
    """(file system, path on it) of a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(arrow_uri(uri))
