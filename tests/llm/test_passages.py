import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest

from groundswell.llm import columns, passages

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=13):
    words = [(i, W.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            if i is not None:
                first[tuple(w[k:k + window])] = min(i, first.get(tuple(w[k:k + window]), i))
    out = {}
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.setdefault(i, set()).add((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def result(df):
    out = {}
    for r in df.select("product_id", "passages.*").collect():
        out.setdefault(r["product_id"], set()).add((r["n_words"], r["n_removed"], r["kept_sha256"]))
        assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]
    return out


def corpus(seed):
    r = random.Random(seed)
    common = [" ".join(r.choice("ab") * r.randint(1, 3) for _ in range(30)) for _ in range(3)]
    rows = []
    for i in range(60):
        parts = [" ".join(r.choice(("x", "y", "zé", "the")) for _ in range(r.randint(0, 40)))]
        if r.random() < 0.7:
            parts.insert(r.randint(0, 1), r.choice(common))
        rows.append((i * 3, r.choice((" ", "\n", " \t ")).join(parts)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(table, seed):
    rows = corpus(seed) + [(500 + k, corpus(seed)[k][1]) for k in range(20)]
    assert result(passages.without_repeats(table(rows))) == brute(rows)


def test_a_shorter_window(table):
    rows = corpus(5)
    assert result(passages.without_repeats(table(rows), window=4)) == brute(rows, 4)


def test_special_rows(table):
    text = " ".join(f"w{k}" for k in range(40))
    long = "one two three " * 30_000
    rows = [(1, text), (2, None), (3, ""), (None, text), (4, text), (4, text), (5, long), (6, long + "end"), (7, "\x0b\x0c")]
    got = result(passages.without_repeats(table(rows, extra="n_words")))
    assert got == brute(rows)
    assert {x[1] for x in got[None]} == {0}


def test_texts_of_a_repeated_id_are_judged_each(table):
    text, other = (" ".join(f"{c}{k}" for k in range(60)) for c in "wv")
    rows = [(1, text), (2, text), (2, "tiny text"), (2, other), (3, "x " + text[:80]), (3, other + " end"), (3, None), (2, text)]
    got = result(passages.without_repeats(table(rows)))
    assert got == brute(rows)
    assert {x[:2] for x in got[2]} == {(60, 60), (2, 0), (60, 0)}


def test_empty_table_and_kept_columns(table):
    df = passages.without_repeats(table([]), keep=("unused",))
    assert df.collect() == [] and df.columns == ["product_id", "unused", "passages"]
    with pytest.raises(ValueError):
        passages.without_repeats(table([]), keep=("unused",), result="unused")


def test_prefixes_grow_until_light():
    h = np.array([7] * 300 + list(range(100, 400)), np.uint64)
    at = np.arange(len(h) - 12)
    heavy = [np.sort(f) for _, f, _ in passages.heavy_prefixes(h, at, 13, 0.05)]
    assert len(heavy) == 12 and all(len(f) == 1 for f in heavy)
    keys = passages.prefix_keys(h, at, heavy)
    # The run of equal words makes one group of full windows; what leaves the run is spread.
    assert len(set(keys[:288].tolist())) == 1 and len(set(keys[288:].tolist())) == len(keys) - 288


def test_packed_places_come_back():
    ids, pos = np.array([-5, 3, 3, 1 << 40]), np.array([0, 1, 70000, 5])
    digest = np.array([1, 2, 3, (1 << 56) - 1], np.uint64)
    got = passages._unpacked(passages._packed(ids, pos, digest))
    assert [x.tolist() for x in got] == [ids.tolist(), pos.tolist(), digest.tolist()]


def test_hashes_take_memory_by_the_block():
    text = np.frombuffer(b"some words of a long text\n" * 160_000, np.uint8)
    starts, ends, _ = columns.word_spans(text, np.array([0, len(text)]))
    alone = columns.word_hashes(text[:26], starts[:6], ends[:6])
    columns._powers.cache_clear()
    tracemalloc.start()
    got = columns.word_hashes(text, starts, ends)
    peak = tracemalloc.get_traced_memory()[1] - got.nbytes
    tracemalloc.stop()
    assert (got.reshape(-1, 6) == alone).all()
    assert peak < 24 << 20


def test_a_worker_keeps_one_model():
    made = []

    def model(name):
        return columns.resident(lambda *key: made.append((name, key)) or (name, key))

    a, b = model("a"), model("b")
    assert [a(1), a(1), b(1), b(1), a(1), a(2), a(2)] == [("a", (1,))] * 2 + [("b", (1,))] * 2 + [("a", (1,))] + [("a", (2,))] * 2
    assert made == [("a", (1,)), ("b", (1,)), ("a", (1,)), ("a", (2,))] and len(columns._RESIDENT) == 1
    assert list(columns.tidy(iter)([1, 2])) == [1, 2] and not columns._RESIDENT
