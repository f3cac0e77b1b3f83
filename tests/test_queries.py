"""Every registered query at the smallest scale, against its SQL where it has one."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare
from checks.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    ok, text = compare(spark, FOLDER, name)
    assert ok, text


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert set(df.columns) == {"class", "label", "pixels", "percent"}
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
