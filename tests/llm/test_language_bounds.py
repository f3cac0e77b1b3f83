"""Rejection by distance: languages that were not learnt and text that is none, on the given table."""

import base64
import random

import pytest
from pyspark.sql import functions as F

from groundswell.llm import language

LANGUAGES = ("de", "en", "es", "fr")


@pytest.fixture(scope="module")
def documents(spark):
    """Texts with some words; the other part is held out."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("size(split(text, ' ')) >= 30 and doc_id < 6000")
    return docs.where("doc_id % 3 != 0"), docs.where("doc_id % 3 = 0 and doc_id % 2 = 0")


def rejected(docs, model):
    """Share of each language's documents that the model rejects."""
    found = language.identified(docs, model, "doc_id", "text", keep=("lang",), result="found")
    return {r["lang"]: r["x"] for r in found.groupBy("lang").agg(F.avg(F.col("found.rejected").cast("int")).alias("x")).collect()}


@pytest.mark.parametrize("out", ["de", "es"])
def test_a_language_left_out(documents, out):
    learn, held = documents
    share = rejected(held, language.fit(learn.where(F.col("lang") != out), "text", "lang", per_language=400))
    assert share[out] >= 0.98
    assert all(share[g] <= 0.02 for g in LANGUAGES if g != out)


def test_no_language_at_all(documents, table):
    learn, held = documents
    model = language.fit(learn, "text", "lang", per_language=400)
    assert all(x <= 0.02 for x in rejected(held, model).values())
    r = random.Random(7)
    rows = [(k, base64.b64encode(r.randbytes(1500)).decode()) for k in range(100)]
    got = language.identified(table(rows), model).collect()
    assert sum(x["language"]["rejected"] for x in got) >= 99


def test_bounds_fall_with_the_number_of_ngrams(documents):
    model = language.fit(documents[0], "text", "lang", per_language=400)
    assert model.least.shape == (len(model.languages), len(language.SIZES))
    assert (model.least[:, 0] == 0).all() and (model.least[:, 1] < model.least[:, -1]).all() and (model.least[:, 1:] > 0).all()
    assert all((b[:-1] <= b[1:]).all() for b in model.least)
