import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from groundswell.frames import short_batches
from groundswell.llm import jaccard_join, simhash
from groundswell.llm.jaccard_join import block_links, forest, linked_reports, ordered_prefix, shared_counts


def brute(rows, shingle=4, least=85):
    """(shingles, component) of each row by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= least * len(a | sets[j]):
                up[find(i)] = find(j)
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(k)] = min(i, ids.get(find(k), i))
    return sorted(((i, len(s), ids.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def result(df):
    return sorted([tuple(r) for r in df.select("product_id", "n_shingles", "component_id").collect()], key=str)


def family(rng, words, copies, edits, vocabulary):
    """Copies of one text with up to ``edits`` words replaced."""
    base = [rng.choice(vocabulary) for _ in range(words)]
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(words)] = rng.choice(vocabulary)
        out.append(" ".join(w))
    return out


VOCABULARY = [f"w{i}" for i in range(3000)]


def test_groups_of_copies_with_few_and_many_edits(table):
    rng = random.Random(1)
    texts = [t for size in (2, 5, 40, 130) for t in family(rng, 120, size, 9, VOCABULARY)]
    texts += family(rng, 30, 20, 3, VOCABULARY[:40]) + family(rng, 8, 30, 2, VOCABULARY[:6])
    texts += [t.upper() for t in texts[:5]] + texts[5:20]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert result(linked_reports(table(rows))) == brute(rows)


def test_blocks_of_large_families(table, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 16)
    rng = random.Random(2)
    rows = list(enumerate(family(rng, 60, 150, 6, VOCABULARY) + family(rng, 60, 30, 2, VOCABULARY)))
    assert result(linked_reports(table(rows))) == brute(rows)


def test_shared_passages_link_nothing_by_themselves(table):
    rng = random.Random(3)
    passage = " ".join(rng.choice(VOCABULARY) for _ in range(60))
    rows = [(i, passage + " " + " ".join(rng.choice(VOCABULARY) for _ in range(rng.choice([4, 8, 12, 40])))) for i in range(80)]
    assert result(linked_reports(table(rows))) == brute(rows)


def test_edges_of_the_contract(table):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (3, "a b"), (9, "A  b"), (4, "a b c d"), (8, "a\x0bb c d"), (2, "ä Ä"),
            (10, "Ä Ä"), (12, long), (11, long + " end"), (None, long), (None, "lonely words here"), (None, None),
            (4, "another text under an id that is there"), (1, "another text under an id that is there"), (7, "a b")]
    got = result(linked_reports(table(rows, "component_id")))
    assert got == brute(rows)
    assert (12, 29_997, 11) in got and (None, 29_997, 11) in got and (4, 1, 4) in got and (4, 5, 1) in got


def test_exact_threshold(table):
    # 17 of 20 shingles are common: 85 percent; 16 of 19 are less.
    base = [f"t{i}" for i in range(20)]
    rows = [(1, " ".join(base)), (2, " ".join(base + ["u", "v", "w"])), (3, " ".join(base[:19])), (4, " ".join(base[:16] + list("abcd")))]
    assert result(linked_reports(table(rows), least=85)) == brute(rows)


def test_empty_table(table):
    assert result(linked_reports(table([]))) == []


@pytest.mark.parametrize("seed", range(5))
def test_block_links_hold_together_what_all_pairs_do(seed):
    rng = np.random.default_rng(seed)
    sets = [np.unique(rng.integers(0, 25, 20).astype(np.uint64)) for _ in range(40)]
    same = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert (shared_counts(sets, 40) >= np.where(np.eye(40, dtype=bool), 0, same)).all()
    pairs = {(a, b) for a in range(40) for b in range(a) if 100 * same[a][b] >= 60 * (len(sets[a]) + len(sets[b]) - same[a][b])}

    def groups(edges):
        up = list(range(40))
        for a, b in edges:
            a, b = up[a], up[b]
            up = [a if x == b else x for x in up]
        return [[k for k in range(40) if up[k] == up[i]] for i in range(40)]

    cross = [(a, b) for a, b in pairs if (a < 20) != (b < 20)]
    assert groups(block_links(sets, [], 60)) == groups(pairs)
    assert groups(block_links(sets[:20], sets[20:], 60)) == groups(cross)
    assert len(block_links(sets, [], 60)) < 40


def test_forest_of_nothing():
    assert forest(np.zeros((3, 3), bool), 3) == []


def test_heavy_tokens_come_last():
    tokens = np.array([1, 4, 6, 9], np.uint64)
    heavy, rank = np.array([1, 6], np.uint64), np.array([1, 0])
    assert ordered_prefix(tokens, 4, heavy, rank).tolist() == [4, 9, 6, 1]
    assert ordered_prefix(tokens, 2, heavy, rank).tolist() == [4, 9]


def test_fingerprints_link_near_copies_and_the_prefixes_the_rest(table, monkeypatch):
    rng = random.Random(5)
    texts = [t for size in (2, 40, 100) for t in family(rng, 120, size, 9, VOCABULARY)] + family(rng, 900, 30, 2, VOCABULARY)
    texts += family(rng, 8, 30, 2, VOCABULARY[:6]) + ["", None]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    compared = []
    real = jaccard_join.candidates

    def candidates(entries, member_of, least, grouped):
        compared.append(grouped.count())
        return real(entries, member_of, least, grouped)

    monkeypatch.setattr(jaccard_join, "candidates", candidates)
    monkeypatch.setattr(jaccard_join, "families", lambda entries, least: entries.select("node", F.col("node").alias("family")).where("false"))
    assert result(linked_reports(table(rows), shingle=5, least=80, far=3)) == brute(rows, 5, 80)
    assert compared[0] >= 20


def test_fingerprint_of_a_set():
    s = np.random.default_rng(1).integers(0, 1 << 63, 101, np.uint64) * np.uint64(2) + np.uint64(1)
    bits = (s[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    assert simhash.majority(s) == sum(1 << b for b in range(64) if 2 * int(bits[:, b].sum()) > 101)
    assert simhash.majority(s[:0]) == 0


def test_shared_tokens_are_counted_whatever_the_batches(table, llm_spark, monkeypatch):
    """By batch, texts that came in batches of their own shared nothing."""
    monkeypatch.setattr(jaccard_join, "COUNTED", 16)
    rows = [(i, f"a b c d x{i} y{i}") for i in range(12)] + [(12, None), (13, " ")]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = llm_spark.conf.get(key, None)
    llm_spark.conf.set(key, "1")
    try:
        got = {r.token: r.n for r in jaccard_join.token_counts(table(rows).coalesce(1), "report", 4).collect()}
    finally:
        llm_spark.conf.unset(key) if before is None else llm_spark.conf.set(key, before)
    assert got.pop(None) == 36 and list(got.values()) == [12]


def test_batches_between_spark_and_python_are_bounded_in_bytes(table, llm_spark, monkeypatch):
    """Every table on the way is made under the bound, and the session's own value is put back, also after an error."""
    key, store, seen = "spark.sql.execution.arrow.maxBytesPerBatch", jaccard_join.materialized, []
    before = llm_spark.conf.get(key, None)

    def stored(df):
        seen.append(int(llm_spark.conf.get(key, "0")))
        return store(df)

    def failing(*args):
        raise ZeroDivisionError

    monkeypatch.setattr(jaccard_join, "materialized", stored)
    rows = [(i, " ".join(VOCABULARY[i % 4:50])) for i in range(8)]
    assert result(linked_reports(table(rows))) == brute(rows)
    assert len(seen) > 5 and all(0 < size <= 8 << 20 for size in seen)
    monkeypatch.setattr(jaccard_join, "postings", failing)
    with pytest.raises(ZeroDivisionError):
        linked_reports(table(rows))
    assert llm_spark.conf.get(key, None) == before


def test_long_texts_come_in_short_batches(llm_spark):
    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    texts = llm_spark.range(0, 400, 1, 1).selectExpr("id", "repeat('x', 100000) AS text")
    with short_batches(llm_spark, 1 << 20):
        got = [r.n for r in texts.mapInArrow(rows, "n long").collect()]
    assert sum(got) == 400 and max(got) <= 20
