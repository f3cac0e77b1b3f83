import pytest



@pytest.fixture(scope="session")
def llm_spark(spark, tmp_path_factory):
    """The session with a shared folder of its own for checkpoints."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return spark


@pytest.fixture
def table(llm_spark):
    """Rows (product_id, report) as a table, with an extra column that has the name of a result."""

    def make(rows, extra: str | None = None):
        data = [(i, t, "x") for i, t in rows]
        df = llm_spark.createDataFrame(data, f"product_id long, report string, {extra or 'unused'} string")
        return df.repartition(3)

    return make
