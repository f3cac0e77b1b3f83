import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from groundswell.llm import simhash

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute_mark(text, size=3):
    w = W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    size = min(size, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[k:k + size]), 42) for k in range(len(w) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(marks, ids, far=3):
    up = {f: f for f in marks}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    distinct = sorted(set(marks))
    for a in distinct:
        for b in distinct:
            if (a ^ b).bit_count() <= far:
                up[find(a)] = find(b)
    first = {}
    for m, i in zip(marks, ids):
        if i is not None:
            first[find(m)] = min(i, first.get(find(m), i))
    return [first.get(find(m)) for m in marks]


@pytest.mark.parametrize("shingle", [3, 5])
def test_texts_against_brute_force(table, shingle):
    r = random.Random(shingle)
    base = [" ".join(r.choice("abcdefgh") * r.randint(1, 4) for _ in range(r.randint(0, 120))) for _ in range(12)]
    rows = []
    for i in range(90):
        w = r.choice(base).split()
        for _ in range(r.randint(0, 3)):
            if w:
                w[r.randrange(len(w))] = r.choice(("Ä", "new"))
        rows.append((i, r.choice((" ", "\n")).join(w).upper() if r.random() < 0.3 else " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \t"), (203, "Aa"), (3, rows[3][1])]
    got = simhash.near_duplicates(table(rows, extra="fingerprint"), shingle=shingle).withColumn(
        "f", simhash.hexadecimal(F.col("fingerprint"))).collect()
    marks = [brute_mark(t, shingle) for _, t in rows]
    expect = sorted(zip([i for i, _ in rows], [f"{m:016x}" for m in marks], brute_groups(marks, [i for i, _ in rows])))
    assert sorted((r["product_id"], r["f"], r["component_id"]) for r in got) == expect


def chain(seed, n=400):
    """Fingerprints in long chains and dense balls, with both halves hit."""
    r = random.Random(seed)
    out = [0]
    while len(out) < n:
        x = r.choice(out[-5:]) if r.random() < 0.9 else r.getrandbits(64)
        for _ in range(r.randint(0, 5)):
            x ^= 1 << r.randrange(64)
        out.append(x)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_links_are_complete(llm_spark, seed):
    marks = sorted(set(chain(seed)))
    df = llm_spark.createDataFrame([(int(np.uint64(m).view(np.int64)),) for m in marks], "fingerprint long")
    got = {frozenset((r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1)) for r in simhash.links(df).collect()}
    assert got == {frozenset((a, b)) for a in marks for b in marks if a < b and (a ^ b).bit_count() <= 3}


def test_long_chain_gets_one_component(llm_spark):
    marks = [(1 << k) - 1 for k in range(0, 61, 2)]
    nodes = llm_spark.createDataFrame([(m, 100 - k) for k, m in enumerate(marks)], "fingerprint long, first long")
    found = simhash._components(nodes, simhash.links(nodes)).collect()
    assert len(found) == len(marks) and {r["label"] for r in found} == {100 - len(marks) + 1}


def test_plan_of_a_hop_stays_small(llm_spark, monkeypatch):
    """Two hops in one plan had nine joins; the driver kept such plans for each stage of theirs."""
    plans, stored = [], simhash._stored

    def seen(df, rows):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, rows)

    monkeypatch.setattr(simhash, "_stored", seen)
    edges = llm_spark.createDataFrame([(k, k + 1) for k in range(40)] + [(90, 91)], "a long, b long").repartition(7)
    nodes = llm_spark.createDataFrame([(k, 500 - k) for k in (*range(41), 90, 91, 95)], "fingerprint long, first long")
    found = {(r["fingerprint"], r["label"]) for r in simhash._components(nodes, edges).collect()}
    assert found == {(k, 460) for k in range(41)} | {(90, 409), (91, 409)}
    assert max(p.count("Join ") for p in plans) <= 2


def test_null_ids_and_empty_table(table):
    rows = [(None, "a b c d"), (None, "q w e r t"), (5, "a b c d")]
    got = {(r["product_id"], r["component_id"]) for r in simhash.near_duplicates(table(rows)).collect()}
    assert got == {(None, 5), (None, None), (5, 5)}
    assert simhash.near_duplicates(table([])).collect() == []


def test_more_than_three_bits_are_refused():
    with pytest.raises(ValueError):
        simhash._segments("fingerprint", 4)
