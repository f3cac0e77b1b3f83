import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from groundswell.llm import history_trie as H


def brute(rows, base=None, head=None):
    """Nodes by listing every prefix of every history."""
    own = {}
    for pair, at, status, message in rows:
        if pair is not None:
            own.setdefault(pair, []).append(((at is not None, at or 0), status or "", message or ""))
    own = {p: [(s, m) for _, s, m in sorted(v)] for p, v in own.items()}
    built = own if base is None else {p: own.get(base(p), [])[:head(p)] + v[head(p):] for p, v in own.items()}
    nodes = {}
    for p, seq in built.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(p)
    out = []
    for path, members in nodes.items():
        under = [q for q in nodes if q[:len(path)] == path]
        kids = {q[:len(path) + 1] for q in under if len(q) > len(path)}
        leaves = [q for q in under if not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in under)]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in under if q)
        ends = ",".join(str(p) for p in sorted(members) if len(built[p]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(kids), len(leaves),
                    saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture
def events(llm_spark):
    def make(rows):
        data = [(*r, "x") for r in rows]
        return llm_spark.createDataFrame(
            data, "pair_id long, event_time long, status string, error_message string, key string").repartition(3)

    return make


def result(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def runs(rng, pairs, longest, kinds):
    """Status events of pairs, whose first events are often the same."""
    return [(p, t, rng.choice(["processing", "failed", "completed"]), rng.choice(kinds))
            for p in range(pairs) for t in range(rng.randint(0, longest))]


@pytest.mark.parametrize("entries", [400_000, 40, 7])
def test_nodes_in_one_and_many_shards(events, monkeypatch, entries):
    monkeypatch.setattr(H, "SHARD_ENTRIES", entries)
    rows = runs(random.Random(4), 90, 5, ["ö timeout", ""])
    rows += [(1000 + p, t, "processing", "same start") for p in range(40) for t in range(3 + p % 2)]
    assert result(H.history_trie(events(rows))) == brute(rows)


def test_forked_histories(events, monkeypatch):
    monkeypatch.setattr(H, "SHARD_ENTRIES", 30)
    rows = [r for r in runs(random.Random(5), 60, 9, ["a", "b"]) if r[0] != 10]
    df = H.history_trie(events(rows), base=F.expr("pair - pair % 5"), head=F.crc32(F.col("pair").cast("string").cast("binary")) % 9)
    assert result(df) == brute(rows, lambda p: p - p % 5, lambda p: zlib.crc32(str(p).encode()) % 9)


def test_nulls_ties_and_repeated_rows(events):
    rows = [(1, None, None, None), (1, None, "a", None), (1, 3, "b", "z"), (1, 3, "b", "z"), (1, 3, "b", "y"), (1, 3, "a", "zz"),
            (None, 1, "a", "lost"), (2, None, "", ""), (2, 5, "a", None), (3, 7, "", ""), (-4, 0, "", "")]
    assert result(H.history_trie(events(rows))) == brute(rows)


def test_histories_longer_than_a_matrix(events, monkeypatch):
    monkeypatch.setattr(H, "SHARD_ENTRIES", 60)
    rows = [(p, t, "s", "same" if t < length else f"{p}") for p, length in enumerate((70, 70, 33, 32, 31, 16, 15, 0, 200))
            for t in range(length + p % 3)]
    assert result(H.history_trie(events(rows))) == brute(rows)


def test_one_history_of_very_many(events, monkeypatch):
    monkeypatch.setattr(H, "RUN_IDS", 7)
    rows = [(p, 0, "completed", "x" * 50) for p in range(300)] + [(400, 0, "completed", "x" * 50), (400, 1, "failed", None)]
    assert result(H.history_trie(events(rows))) == brute(rows)


def test_empty_table(events):
    assert result(H.history_trie(events([]))) == []


def test_order_and_common_lengths():
    rng = np.random.default_rng(6)
    rows = sorted({tuple(rng.integers(1, 3, rng.integers(0, 40)).tolist()) for _ in range(200)} | {(1,) * 50, (1,) * 48, ()})
    mixed = [rows[k] for k in rng.permutation(len(rows))]
    ids = np.array([x for r in mixed for x in r], np.int64)
    length = np.array([len(r) for r in mixed])
    begin = np.cumsum(length) - length
    order = H.lexicographic(ids, begin, length)
    assert [mixed[k] for k in order] == rows
    shared = [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(rows, rows[1:])]
    assert H.common_lengths(ids, begin[order], length[order]).tolist() == [-1, *shared]
