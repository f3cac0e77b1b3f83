import random
import re

import pytest

from groundswell.llm import quality

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = W.findall(t)
    seen, hit = {}, [False] * len(w)
    for k in range(len(w) - 2):
        seen.setdefault(tuple(w[k:k + 3]), []).append(k)
    for at in seen.values():
        if len(at) > 1:
            for k in at:
                hit[k:k + 3] = [True] * 3
    lines = [x for x in t.split("\n") if W.search(x)]
    n = sum(hit)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), n,
            len(w) < 50 or 100 * n > 50 * len(w))


def prose(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(n))


@pytest.fixture
def reports(llm_spark):
    def make(rows):
        return llm_spark.createDataFrame(
            [(*x, "e") for x in rows], "product_id long, report string, language string, source string, fence_symbols string").repartition(3)

    return make


def test_counts_and_verdicts(reports):
    r = random.Random(1)
    rows = [(k, prose(r, r.randint(60, 200)), "en", "s1") for k in range(60)]
    rows += [(100, None, "en", "s1"), (101, "", "en", None), (102, " \t\n\x0b\x0c\r", None, None), (103, prose(r, 80), None, None),
             (104, "a b c " * 40 + prose(r, 90), "en", "s1"), (105, "x | y | " * 40 + prose(r, 200), "en", "s1"),
             (106, "\n".join([prose(r, 60), "same line", "same line ", "same line", "same line"]), "de", "s2"),
             (107, "a a a a a " * 30, "en", "s1"), (108, "#" * 500 + " " + prose(r, 70), "en", "s1"), (109, "é🙂 " * 60, "fr", "s3"),
             (110, prose(r, 60_000), "en", "s1"), (None, prose(r, 70), "en", "s1"), (7, rows[7][1], "en", "s1"), (111, "a b", "en", "s1")]
    got = quality.judged(reports(rows)).collect()
    assert sorted((str(x[0]), *x[1:7]) for x in got) == sorted((str(i), *brute(t)) for i, t, _, _ in rows)
    kept = {x["product_id"]: x["kept"] for x in got}
    assert all(kept[k] for k in (*range(60), 103, 110, None))
    assert not any(kept[k] for k in (100, 101, 102, 105, 107, 108, 111))


def test_fences_follow_their_group(reports):
    r = random.Random(2)
    tables = [(k, f"{prose(r, 80)} " + "| " * r.randint(60, 70), "en", "tables") for k in range(220)]
    plain = [(1000 + k, prose(r, 80), "en", "plain") for k in range(220)]
    odd = [(5000, f"{prose(r, 80)} " + "| " * 65, "en", "plain"), (5001, f"{prose(r, 80)} " + "| " * 65, "en", "tables")]
    kept = {x["product_id"]: x["kept"] for x in quality.judged(reports(tables + plain + odd)).collect()}
    assert not kept[5000] and kept[5001] and sum(kept.values()) == 441


def test_no_fence_is_fixed(reports):
    """Verdicts that no fixed cutoff gives: the same text passes in one source and fails in another."""
    r = random.Random(3)

    def words(n, low, high):
        return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(low, high))) for _ in range(n))

    short = [(k, words(80, 2, 8), "en", "short") for k in range(220)]
    long = [(1000 + k, words(80, 6, 12), "en", "long") for k in range(220)]
    some = words(80, 6, 12)
    few = words(80, 2, 4)
    odd = [(5000, some, "en", "short"), (5001, some, "en", "long"), (5002, few, "en", "short"), (5003, few, "en", "long"),
           (5004, words(80, 2, 8) + " & &", "en", "short")]
    kept = {x["product_id"]: x["kept"] for x in quality.judged(reports(short + long + odd)).collect()}
    assert [kept[k] for k in (5000, 5001, 5003, 5004)] == [False, True, False, False]
    assert all(kept[k] for k, *_ in short + long)


def test_sketches_merge(reports, llm_spark):
    values = llm_spark.createDataFrame([(v, b) for b, v in enumerate([0, 1, 63, 64, 65, 1000, 12345, 1 << 40])], "v long, k long")
    bins = {x["v"]: x["b"] for x in values.select("v", quality.bin_of(values["v"]).alias("b")).collect()}
    assert all(b <= v and v - b <= v / 32 for v, b in bins.items()) and bins[63] == 63


def test_empty_table(reports):
    assert quality.judged(reports([])).collect() == []


def test_native_plan(reports):
    plan = quality.counts(reports([]), ["product_id"], "report")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
