import hashlib
import random
import re

import pytest

from groundswell.llm import decontaminate

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows, items, window=13):
    keys = {}
    for k, t in items:
        w = words(t)
        if k is not None and w:
            for a in range(max(1, len(w) - window + 1)):
                keys.setdefault(tuple(w[a:a + window]), set()).add(str(k))
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for key, of in keys.items():
            for a in range(len(w) - len(key) + 1):
                if tuple(w[a:a + len(key)]) == key:
                    hit.update(range(a, a + len(key)))
                    found |= of
        out.append((str(i), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


def result(df):
    return sorted((str(r[0]), *[r["overlap"][k] for k in range(5)]) for r in df.select("product_id", "overlap").collect())


@pytest.fixture
def truth(llm_spark):
    def make(items):
        return llm_spark.createDataFrame(items, "item_id long, text string")

    return make


@pytest.mark.parametrize("block", [60, 300_000])
def test_against_brute_force(table, truth, block):
    r = random.Random(block)
    pick = lambda n: [r.choice(("Kanal", "über", "b", "c-d", "7", "ÄA")) for _ in range(n)]
    items = [(k, " ".join(pick(r.randint(0, 25)))) for k in range(12)] + [(10, "Same, TEXT here"), (11, "same text: here"), (30, None)]
    rows = []
    for i in range(40):
        w = pick(r.randint(0, 30)) + (r.choice(items[:14])[1] or "").split() + pick(r.randint(0, 300))
        rows.append((i, r.choice((" ", "; ", "\n")).join(w)))
    rows += [(100, None), (101, ""), (102, "..."), (None, items[12][1]), (3, rows[3][1]), (104, "x " * 50_000 + "same text here")]
    df = decontaminate.contaminated(table(rows, extra="n_words"), truth(items), block_chars=block)
    assert result(df) == brute(rows, items)


def test_spans_are_offsets_of_the_original(table, truth):
    text = "Ü before: Same,  TEXT\there!! after"
    df = decontaminate.contaminated(table([(1, text)]), truth([(1, "same text here")]), keep=("report",))
    (span,) = df.first()["overlap"]["spans"]
    assert text.encode()[span["begin"]:span["end"]].decode() == "Same,  TEXT\there"


def test_empty_tables(table, truth):
    assert decontaminate.contaminated(table([]), truth([(1, "a")])).collect() == []
    rows = [(1, "a b"), (2, None)]
    assert result(decontaminate.contaminated(table(rows), truth([]))) == brute(rows, [])
    with pytest.raises(ValueError):
        decontaminate.contaminated(table([]), truth([]), keep=("unused",), result="unused")
