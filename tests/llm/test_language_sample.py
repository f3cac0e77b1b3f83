"""What the language model learns from: every language, copies once."""

import random

from groundswell.llm import language


def test_seventy_languages(llm_spark, table):
    r = random.Random(8)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 70 * 12)]
    sets = {f"l{k:02}": letters[12 * k:12 * k + 12] for k in range(70)}

    def prose(g, n):
        return " ".join("".join(r.choice(sets[g]) for _ in range(r.randint(2, 4))) for _ in range(n))

    # The last language is the rarest.
    rows = [(prose(g, 30), g) for k, g in enumerate(sets) for _ in range(12 if k < 69 else 8)]
    model = language.fit(llm_spark.createDataFrame(rows, "text string, lang string"), "text", "lang", clusters=1)
    assert model.languages == sorted(sets)
    truth = dict(enumerate(sets))
    got = language.identified(table([(k, prose(g, 60)) for k, g in truth.items()]), model).collect()
    assert sum(x["language"]["lang_pred"] == truth[x["product_id"]] for x in got) >= 69


def test_copies_count_once(llm_spark):
    texts = [(f"some words of text number {k} and {k * k}", "en") for k in range(40)]
    once = language.fit(llm_spark.createDataFrame(texts, "text string, lang string"), "text", "lang", per_language=40)
    often = language.fit(
        llm_spark.createDataFrame(texts + texts[:1] * 400, "text string, lang string"), "text", "lang", per_language=40)
    assert (once.idf == often.idf).all() and (once.matrix == often.matrix).all()
