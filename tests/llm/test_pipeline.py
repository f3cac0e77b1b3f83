"""The pipeline's stages on the smallest tables, against brute-force versions."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from checks.compare import canonical, connection
from groundswell.llm import queries
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard_join import brute as alike
from tests.llm.test_jaccard_join import family
from tests.llm.test_passages import brute as removed

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(llm_spark, name):
    df = contract.queries()[name](llm_spark, FOLDER)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if name not in ("op12_conversation_trie", "op13_spelling_variants"):
        base = "pages" if "page_id" in df.columns else "documents"
        assert len(got[1]) == llm_spark.read.parquet(f"{FOLDER}/{base}.parquet").count()
    if name in queries.ORACLES:
        cur = connection(FOLDER).execute(queries.ORACLES[name])
        assert got == canonical([c[0] for c in cur.description], cur.fetchall())


def test_stages(llm_spark):
    docs = llm_spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = [tuple(r) for r in llm_spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "SimHash near-dedup", "substring dedup", "benchmark decontamination", "byte-level BPE"]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}

    def step(name, df):
        out = stages[name](llm_spark, df, FOLDER)
        assert out.columns == docs.columns or name == "byte-level BPE"
        out = llm_spark.createDataFrame(out.collect(), out.schema)
        return out, {r["doc_id"]: r["text"] for r in out.collect()} if "text" in out.columns else None

    df, kept = step("language ID", docs)
    assert kept == {i: t for i, t in rows.items() if re.search(r"[^\W\d_]", t or "")}
    df, once = step("SimHash near-dedup", df)
    assert once == {i: kept[i] for i, _, g in alike(list(kept.items()), 5, 80) if i == g}
    want = removed(sorted(once.items()))
    df, cut = step("substring dedup", df)
    assert cut.keys() == once.keys()
    for i, t in cut.items():
        (n, gone, digest), = want[i]
        assert t == once[i] if gone == 0 else hashlib.sha256(t.encode()).hexdigest() == digest
    clean = {i for i, *_, bad in contaminated(sorted(cut.items()), bench) if not bad}
    df, left = step("benchmark decontamination", df)
    assert {str(i) for i in left} == clean
    last = stages["byte-level BPE"](llm_spark, df, FOLDER).collect()
    assert {(r["doc_id"], r["decoded_sha256"]) for r in last} == {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in left.items()}
    ran = contract.queries()["pipeline"](llm_spark, FOLDER)
    assert {(r["doc_id"], r["ids_sha256"]) for r in ran.collect()} == {(r["doc_id"], r["ids_sha256"]) for r in last}


def near_dedup(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](spark, docs, FOLDER)
    return sorted([tuple(r) for r in out.collect()], key=str)


def test_near_dedup_of_crowded_groups(llm_spark):
    """30 groups of 40 edited copies and one of 1,000: what stays is what comparing all pairs leaves."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    texts = [t for _ in range(30) for t in family(rng, 90, 40, 7, words)] + family(rng, 60, 1000, 6, words)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    stay = {i for i, _, g in alike(rows, 5, 80) if i == g}
    assert near_dedup(llm_spark, rows) == sorted([r for r in rows if r[0] in stay], key=str)


def test_near_dedup_links_by_simhash(llm_spark, monkeypatch):
    """Without the search for the rest, near copies of long texts are still found, by their fingerprints."""
    from groundswell.llm import jaccard_join

    none = llm_spark.createDataFrame([], "node long, family long")
    monkeypatch.setattr(jaccard_join, "families", lambda *_: none)
    monkeypatch.setattr(jaccard_join, "candidates", lambda *_: none.toDF("a", "b"))
    rng = random.Random(4)
    words = [f"w{i}" for i in range(4000)]
    base = [" ".join(rng.choice(words) for _ in range(2000)) for _ in range(5)]
    rows = list(enumerate([t + end for t in base for end in ("", " one end", " another end")]))
    assert near_dedup(llm_spark, rows) == sorted(rows[::3], key=str)


def test_near_dedup_judges_rows_by_id_and_text(llm_spark):
    a, b, z = (" ".join(f"{c}{k}" for k in range(40)) for c in "abz")
    rows = [(1, a), (2, a), (2, b), (3, b + " c d"), (3, z), (1, a), (None, a), (None, None), (4, None), (4, ""), (5, z), (0, "")]
    assert near_dedup(llm_spark, rows) == sorted(
        [(1, a), (2, b), (3, z), (None, a), (None, None), (4, None), (4, ""), (0, "")], key=str)


def test_odd_rows(llm_spark):
    text = " ".join(llm_spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id = 7").first()["text"].split()[:60])
    rows = [(1, text, "en", "s", 1, "x"), (2, text, None, None, None, None), (None, text, "en", "s", 1, "x"), (1, text, "en", "s", 1, "x"),
            (3, None, "en", "s", 0, "x"), (4, "", "en", "s", 0, "x"), (5, "!!", "en", "s", 2, "x"), (6, text + " end", "en", "s", 1, "x")]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, language string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(llm_spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        assert stage(llm_spark, docs.limit(0), FOLDER).collect() == []
        got = [r["doc_id"] for r in out.collect()]
        if name == "language ID":
            assert sorted(map(str, got)) == ["1", "1", "2", "6", "None"]
        elif name == "SimHash near-dedup":
            assert sorted(map(str, got)) == ["1", "3", "4", "5", "None"]
        else:
            assert len(got) == len(rows)
    assert corpus_pipeline.STAGES[-1][1](llm_spark, docs, FOLDER).count() == len(rows)


def test_stages_pass_batches_bounded_in_bytes(llm_spark):
    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    corpus_pipeline._short_batches(llm_spark)
    got = [r.n for r in llm_spark.range(0, 400, 1, 1).selectExpr("id", "repeat('x', 100000) AS text").mapInArrow(
        rows, "n long").collect()]
    assert sum(got) == 400 and max(got) <= 80
