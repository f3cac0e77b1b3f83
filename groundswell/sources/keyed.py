"""Tables kept by key on storage: updates write the rows they change, in the parts they touch."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundswell.frames import materialized


class KeyedTable:
    """A folder of rows by key, split into ``parts`` by a hash of the key.

    Every write is a numbered version of the rows that it changes (``version=N/part=P``).  The current
    row of a key is its newest; a version counts once it is entered in the log, which is the last
    step of a write, so that a write that breaks off leaves nothing to be seen and can be repeated.
    ``compact`` rewrites the parts in which old rows have gathered, and no others.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, ddl: str, key: str, parts: int = 64) -> None:
        self.spark, self.path, self.ddl, self.key, self.parts = spark, path.rstrip("/"), ddl, key, parts

    @classmethod
    def create(cls, rows: DataFrame, path: str, ddl: str, key: str, parts: int = 64) -> KeyedTable:
        """A new table; of rows with one key the last in the order of their columns stays."""
        table = cls(rows.sparkSession, path, ddl, key, parts)
        table._write(table._newest(table._placed(rows).withColumn("version", F.lit(0))), 0, {})
        return table

    def _part(self):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.parts)).cast("int")

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("part", self._part())

    def _newest(self, rows: DataFrame) -> DataFrame:
        """One row per key: the one of the highest version, combined before the shuffle."""
        rest = [c for c in rows.columns if c not in (self.key, "part", "version")]
        return rows.groupBy("part", self.key).agg(F.max(F.struct("version", *rest)).alias("_r")).select(
            *[F.col(self.key) if c == self.key else F.col(f"_r.{c}").alias(c) for c in rows.columns if c not in ("part", "version")],
            "part", F.col("_r.version").alias("version"))

    def _log(self) -> list[tuple[int, dict[int, int]]]:
        """(version, part -> the version that replaced all before it), oldest first."""
        rows = self.spark.read.schema("version int, replaced map<int, int>").parquet(f"{self.path}/_log").collect()
        return sorted((r["version"], r["replaced"]) for r in rows)

    def version(self) -> int:
        return self._log()[-1][0]

    def _write(self, rows: DataFrame, version: int, replaced: dict[int, int]) -> None:
        """Rows (with ``part``) as a version, then its entry in the log."""
        rows.drop("version").repartition("part").write.mode("overwrite").partitionBy("part").parquet(
            f"{self.path}/rows/version={version}")
        self.spark.createDataFrame([(version, replaced)], "version int, replaced map<int, int>").coalesce(1).write.mode(
            "append").parquet(f"{self.path}/_log")

    def _stored(self) -> DataFrame:
        """Rows of all versions that count, with ``part`` and ``version``."""
        log = self._log()
        replaced = log[-1][1]
        if len(replaced) == self.parts:
            log = [x for x in log if x[0] >= min(replaced.values())]
        rows = self.spark.read.schema(f"{self.ddl}, part int, version int").option("basePath", f"{self.path}/rows").parquet(
            *[f"{self.path}/rows/version={v}" for v, _ in log])
        # At most one entry a part.
        old = F.lit(False)
        for v in sorted(set(replaced.values())):
            some = [p for p, at in replaced.items() if at == v]
            old = old | (F.col("part").isin(some) & (F.col("version") < v))
        return rows.where(~old)

    def read(self) -> DataFrame:
        """The current rows."""
        return self._newest(self._stored()).drop("part", "version")

    def matching(self, keys: DataFrame) -> DataFrame:
        """The current rows of the given keys; only the parts that hold some are read."""
        keys = materialized(self._placed(keys.select(self.key).distinct()))
        touched = [r["part"] for r in keys.select("part").distinct().collect()]
        rows = self._stored().where(F.col("part").isin(touched) if touched else F.lit(False))
        return self._newest(rows.join(keys, ["part", self.key], "left_semi").select(rows.columns)).drop("part", "version")

    def put(self, rows: DataFrame) -> int:
        """Write these rows as the newest of their keys, one each; returns their number."""
        log = self._log()
        fresh = materialized(self._placed(rows))
        n = fresh.count()
        if n:
            self._write(fresh, log[-1][0] + 1, log[-1][1])
        return n

    def update(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
        """Apply ``change`` to the current rows of ``keys`` and write those that it alters."""
        now = materialized(self.matching(keys))
        new = change(now).select(*now.columns)
        return self.put(new.exceptAll(now))

    def compact(self, share: float = 0.25) -> list[int]:
        """Rewrite the parts of which more than ``share`` are rows that newer ones have replaced."""
        stored = self._stored()
        sizes = stored.groupBy("part", self.key).count().groupBy("part").agg(
            F.sum("count").alias("rows"), F.count("*").alias("keys")).where((F.col("rows") - F.col("keys")) > share * F.col("rows"))
        parts = sorted(r["part"] for r in sizes.collect())
        if parts:
            log = self._log()
            version = log[-1][0] + 1
            now = materialized(self._newest(stored.where(F.col("part").isin(parts))))
            self._write(now, version, {**log[-1][1], **{p: version for p in parts}})
        return parts


def parts_of(path: str) -> tuple[int, int]:
    """(version, part) of a file of a keyed table."""
    found = re.search(r"version=(\d+)/part=(\d+)/", path)
    return int(found[1]), int(found[2])
