"""Where the check modules register their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.views import Data, rounded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, digits: int | None = 6):
    """Register ``fn(data) -> DataFrame`` under a name, with the SQL it must equal.

    ``digits=None`` leaves doubles as they are: plain arithmetic agrees bit for bit.
    """

    def add(fn: Callable[[Data], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(Data(spark, folder))
            return df if digits is None else rounded(df, digits)

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add
