"""Language, toxicity and page text: held-out accuracy and defined results for odd rows."""

import random

import pytest

from groundswell.llm import language, main_text, toxicity

SYLLABLES = {"en": "the er ing th ou".split(), "de": "sch ein ung der ä".split(), "fr": "eau que é oi les".split()}


def prose(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(3)
    rows = [(prose(r, g, r.randint(5, 80)), g) for g in SYLLABLES for _ in range(60)] + [(None, "en"), ("...", "de"), ("text", None)]
    return spark.createDataFrame(rows, "text string, lang string")


def test_language(table, labelled):
    model = language.fit(labelled, "text", "lang", per_language=40, clusters=3)
    assert model.languages == ["de", "en", "fr"] and len(model.owner) <= 9
    r = random.Random(4)
    truth = {k: r.choice(list(SYLLABLES)) for k in range(90)}
    rows = [(k, prose(r, g, 30)) for k, g in truth.items()]
    rows += [(100, None), (101, ""), (102, "12 !?"), (103, "é"), (104, "日本語"), (5, rows[5][1]), (None, "the"), (105, prose(r, "fr", 100_000)),
             (106, " ".join("qxzjvk"[k % 6] * 9 for k in range(60)))]
    got = language.identified(table(rows, extra="language_"), model).collect()
    assert len(got) == len(rows)
    found = {x["product_id"]: x["language"] for x in got}
    assert sum(found[k]["lang_pred"] == g for k, g in truth.items()) >= 88
    assert all(found[k]["lang_pred"] == "und" and found[k]["score"] == 0 and found[k]["rejected"] for k in (100, 101, 102))
    assert found[103]["lang_pred"] in model.languages and not found[103]["rejected"]
    assert found[105]["lang_pred"] == "fr" and found[106]["rejected"]
    assert not any(found[k]["rejected"] for k in truth) and all(0 <= x["language"]["score"] <= 1 for x in got)
    assert language.identified(table([]), model).collect() == []
    with pytest.raises(ValueError):
        language.identified(table([]), model, keep=("unused",), result="unused")
    with pytest.raises(ValueError):
        language.fit(labelled.where("lang is null"), "text", "lang")


@pytest.fixture(scope="module")
def comments(spark):
    r = random.Random(5)
    docs, labels = [], []
    for k in range(400):
        w = prose(r, "en", r.randint(10, 40)).split()
        toxic = k % 3 == 0
        for _ in range(r.randint(1, 3)):
            w.insert(r.randrange(len(w)), r.choice(("stupidly", "trash", "IDIOT!")) if toxic else r.choice(("maps", "canals")))
        # Toxic texts name one group more often: without the penalty its name counts as toxic.
        if r.random() < (0.6 if toxic else 0.1):
            w.insert(0, "muslims")
        docs.append((k, " ".join(w)))
        labels.append((k, int(toxic)))
    labels += [(9999, 1), (None, 1), (1, None)]
    return spark.createDataFrame(docs, "product_id long, report string"), spark.createDataFrame(labels, "product_id long, toxic int")


def test_toxicity(table, comments):
    docs, labels = comments
    plain = toxicity.fit(docs, labels.where("product_id % 4 != 2"), "product_id", "report", fairness=0.0)
    fair = toxicity.fit(docs, labels.where("product_id % 4 != 2"), "product_id", "report", fairness=20.0)
    found = {x["product_id"]: x for x in toxicity.scored(docs, fair).collect()}
    held = [k for k in range(400) if k % 4 == 2]
    assert sum(found[k]["predicted"] == (k % 3 == 0) for k in held) >= 0.97 * len(held)
    rows = [(1, "muslims of the er ing"), (2, "christians of the er ing"), (3, None), (4, ""), (5, "trash"), (5, "trash"), (None, "x"),
            (6, "the er " * 50_000 + "trash trash idiot")]
    scores = {(x["product_id"], k): x["score"] for k, m in enumerate((plain, fair)) for x in toxicity.scored(table(rows, extra="score"), m).collect()}
    gap = [abs(scores[1, k] - scores[2, k]) for k in (0, 1)]
    assert gap[1] < 0.02 or gap[1] < 0.3 * gap[0]
    assert scores[3, 1] == scores[4, 1] < scores[5, 1] and scores[6, 1] >= 0.3
    assert len(toxicity.scored(table(rows), fair).collect()) == len(rows)
    assert toxicity.scored(table([]), fair).collect() == []
    with pytest.raises(ValueError):
        toxicity.fit(docs, labels.where("toxic = 1"), "product_id", "report")


def test_swaps():
    assert toxicity.swapped("the women and muslims came") == "the men and christians came"
    assert toxicity.swapped("nothing here") is None


def test_labelled_pages_held_out():
    model = main_text.trained()
    right = total = 0
    for seed in range(5000, 5080):
        page, truth = main_text.labelled_page(seed)
        found = main_text.viterbi(main_text.blocks(page), model)
        right, total = right + sum(a == b for a, b in zip(found, truth)), total + len(truth)
    assert right / total > 0.97


@pytest.mark.parametrize("page, want", [
    ("", ""),
    ("<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav><article><h1>A &amp; B</h1><p>One\n two<br>three.<p>Next &lt;p&gt; &eacute;.</p>"
     "<div class='ad'>Buy it now.</div><script>var t='</p>';</script></article><footer>&copy; me</footer>", "A & B\nOne two three.\nNext <p> é."),
    ("<article><p><b>Bold start.<br><p>Second one.</p></article><section class='comments'><p>I agree with all of it.</p></section>",
     "Bold start.\nSecond one."),
    ("<main><p>Text of it.</p><form><label>Name</label><input></form><!-- <p>no --></main><div id='cookie-notice'>We use cookies.</div>", "Text of it."),
    ("<article><p>Open comment <!-- never closed <p>x", "Open comment"),
])
def test_pages(page, want):
    assert main_text.extract(page, main_text.trained()) == want


def test_page_table(llm_spark):
    deep = "<div>" * 3000 + "<article><p>Deep down here.</p></article>"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<article><p>A text.</p></article>", "x"), (3, "u", deep, "x"), (3, "u", deep, "x"),
            (4, "u", "<article>" + "<p>Again and again.</p>" * 20_000, "x")]
    df = llm_spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text.main_text(df).collect()
    assert len(got) == 6 and all(r["n_chars"] == len(r["text"]) for r in got)
    found = {r["page_id"]: r["text"] for r in got}
    assert (found[1], found[2], found[None], found[3]) == ("", "", "A text.", "Deep down here.")
    assert found[4].count("\n") == 19_999
    assert main_text.main_text(df.limit(0)).collect() == []
