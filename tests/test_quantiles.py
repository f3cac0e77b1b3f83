import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from groundswell.operators.quantiles import exact_percentiles

PS = [0.0, 0.1, 0.5, 0.85, 1.0]


def table(spark, groups):
    pdf = pd.concat([pd.DataFrame({"g": k, "v": v}) for k, v in groups.items()])
    return spark.createDataFrame(pdf, "g string, v double")


@pytest.mark.parametrize("kind", ["smooth", "ties", "one_value", "heavy_tail", "tiny"])
def test_percentiles_equal_numpy(spark, rng, kind):
    n = 30000
    v = {
        "smooth": rng.normal(size=n), "ties": rng.integers(0, 7, n).astype(float),
        "one_value": np.where(rng.random(n) < 0.6, 3.0, rng.normal(size=n)),
        "heavy_tail": np.exp(rng.normal(size=n) * 5), "tiny": rng.normal(size=3),
    }[kind]
    df = table(spark, {"a": v})
    got = list(exact_percentiles(df, "v", PS).first())
    assert got == pytest.approx(np.quantile(v, PS).tolist(), rel=1e-12)


def test_groups_and_nulls(spark, rng):
    groups = {"hot": rng.normal(size=20000), "small": rng.normal(size=11), "one": np.array([4.0])}
    df = table(spark, groups)
    extra = spark.createDataFrame([("hot", None), ("none", None)], "g string, v double")
    got = {r["g"]: list(r)[1:] for r in exact_percentiles(df.union(extra), "v", PS, ["g"]).collect()}
    assert set(got) == set(groups)
    for k, v in groups.items():
        assert got[k] == pytest.approx(np.quantile(v, PS).tolist())


def test_empty(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_percentiles(df, "v", [0.5]).first()[0] is None


def test_statistics_and_median_read_the_rows_twice(spark, rng):
    from groundswell.operators import stats

    pdf = pd.DataFrame({"zone": ["a", "b"] * 5000, "value": np.exp(rng.normal(size=10000) * 9)})
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = spark.createDataFrame(pdf).mapInArrow(count, "zone string, value double")
    got = stats.raster_stats(rows).collect()
    assert got[0]["median"] == round(float(np.median(pdf["value"])), 2) and read.value == 2 * len(pdf)
    stats.zonal_stats(rows).collect()
    assert read.value <= 4 * len(pdf)


def test_also_gives_a_row_to_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "g string, v double")
    out = exact_percentiles(df, "v", [0.5], ["g"], ["m"], [F.count("*").alias("n")])
    assert sorted(map(tuple, out.select("g", "n", "m").collect())) == [("a", 2, 1.0), ("b", 1, None)]
    assert list(exact_percentiles(df.limit(0), "v", [0.5], names=["m"], also=[F.count("*").alias("n")]).first()) == [0, None]


def test_a_heavy_tail_falls_into_many_bins(spark, rng):
    v = np.sort(np.exp(rng.normal(size=200_000) * 30))
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    got = list(exact_percentiles(df, "v", [0.9991, 0.5]).first())
    assert got == pytest.approx(np.quantile(v, [0.9991, 0.5]).tolist(), rel=1e-12)
