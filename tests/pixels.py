"""Arrays of a test as pixel tables and back."""

from __future__ import annotations

import numpy as np


def to_pixels(spark, array, name: str = "value"):
    """A 2-D array as a pixel table, NaN as NULL."""
    import pandas as pd

    r, c = np.indices(array.shape)
    pdf = pd.DataFrame({"row": r.ravel(), "col": c.ravel(), name: array.ravel().astype(float)})
    df = spark.createDataFrame(pdf, f"row int, col int, {name} double")
    from pyspark.sql import functions as F

    return df.withColumn(name, F.nanvl(name, F.lit(None).cast("double")))


def to_mask(spark, array):
    r, c = np.nonzero(array)
    return spark.createDataFrame(
        [(int(a), int(b)) for a, b in zip(r, c)], "row int, col int")


def to_array(df, shape, name: str = "value"):
    out = np.full(shape, np.nan)
    for row in df.select("row", "col", name).collect():
        out[row[0], row[1]] = np.nan if row[2] is None else row[2]
    return out


def mask_array(df, shape):
    out = np.zeros(shape, bool)
    for row in df.select("row", "col").collect():
        assert not out[row[0], row[1]], "a mask pixel appears twice"
        out[row[0], row[1]] = True
    return out
