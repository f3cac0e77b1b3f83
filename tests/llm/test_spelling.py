import random
import re
import zlib
from collections import Counter

import pytest

from groundswell.llm import spelling
from groundswell.llm.spelling import WordList, one_edit, ranges_of, variants, within_one


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows, shortest=6, least=5, ratio=5, every=None):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            if every and i is not None and (h := zlib.crc32(f"{i}:{w}".encode())) % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            seen[w] += 1
    n = {w: k for w, k in seen.items() if len(w) >= shortest and k >= least}
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()], key=str)


@pytest.fixture(params=[20_000, 25])
def ranges(request, monkeypatch):
    monkeypatch.setattr(spelling, "RANGE_WORDS", request.param)


def texts(seed, letters, words, count):
    """Texts of random words, each with spellings one or two edits away that are rarer."""
    rng = random.Random(seed)
    out = []
    for _ in range(words):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(6, 9)))
        out += [w] * rng.choice([5, 40, 300])
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]])
            out += [w] * rng.choice([1, 5, 8, 60])
    rng.shuffle(out)
    return [(i, " ".join(out[i::count])) for i in range(count)]


def test_few_letters_and_dense_neighbours(table, ranges):
    rows = texts(1, "ab", 60, 12)
    assert result(variants(table(rows))) == brute(rows)


def test_common_prefixes_and_chains_of_forms(table, ranges):
    rows = [(i, t.replace("x", "préfixe")) for i, t in texts(2, "xabÿ×É", 80, 9)]
    rows.append((9, "kanalbau " * 900 + "kanalbaux " * 170 + "kanalbauxy " * 33 + "kanalbauxyz " * 6))
    want = brute(rows)
    assert result(variants(table(rows))) == want
    assert any(form and root != form for _, form, root, *_ in want)


def test_planted_misspellings(table):
    rows = texts(3, "abcdefgh", 150, 40)
    assert result(variants(table(rows), every=7)) == brute(rows, every=7)


def test_runs_nulls_and_long_words(table):
    many = "Straße, straße; STRASSE Straße4straße_xĀnaïveté naÏveté İistanbul ﬁnanzen " * 6
    rows = [(1, None), (2, ""), (3, many), (3, many), (None, many), (4, "y" * 5000 + " " + "y" * 4999 + "z ퟿ " + many),
            (5, ("y" * 5000 + " ") * 5 + ("y" * 4999 + " ") * 30)]
    assert result(variants(table(rows, "word"))) == brute(rows)
    assert result(variants(table(rows), every=3)) == brute(rows, every=3)


def test_empty_table(table):
    assert result(variants(table([]))) == []
    assert result(variants(table([(1, "short words only")]))) == []


def test_every_pair_one_edit_apart():
    rng = random.Random(7)
    words = sorted({bytes(rng.choice(b"ab\xe9") for _ in range(rng.randint(6, 9))) for _ in range(900)})
    q, k = one_edit(WordList(words), WordList(words[::5]))
    found = list(zip(q.tolist(), k.tolist()))
    assert len(set(found)) == len(found)
    assert set(found) == {(i, j) for i, a in enumerate(words[::5]) for j, b in enumerate(words) if one_apart(a, b)}


def test_routes_reach_every_range():
    rng = random.Random(8)
    words = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randint(6, 12))) for _ in range(800)})
    bounds, ends = words[::20], words[19::20] + words[-1:]
    shared = [a[:next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))] for a, b in zip(bounds, ends)]
    for a in words:
        there = set(ranges_of(a, bounds, shared))
        for j, b in enumerate(words):
            if a[:len(a) // 2] == b[:len(a) // 2] and one_apart(a, b):
                assert j // 20 in there


def test_shared_prefix_within_one_edit():
    for prefix, query, near in [(b"abc", b"abcdef", True), (b"abd", b"abcdef", True), (b"bcd", b"abcdef", True),
                                (b"xabc", b"abcdef", True), (b"xxbc", b"abcdef", False), (b"badc", b"abcdef", False)]:
        assert within_one(prefix, query) is near
