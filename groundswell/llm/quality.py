"""Quality rules with thresholds that adapt to each language and source; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundswell.frames import materialized

SYMBOLS = "#*$%&|<>"
_BLANKS = "\t\n\x0b\x0c\r"
#: Measures (in millionths) with the percentile that a fence starts from and how many times its distance from
#: the median it lies beyond.  Where a tenth of a group's texts has more symbols than half of them, symbols are its
#: way of writing; a few texts with them are outliers.  Only the length of words can also be too low.
MEASURES = {"symbols": (90, 4), "dup_lines": (99, 2), "repeats": (99, 2), "word_length": (99, 2)}
_BITS = 6


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _BLANKS, " " * len(_BLANKS)), " ", -1), "")


def counts(reports: DataFrame, keep: list[str], report: str) -> DataFrame:
    """``keep`` plus the base counts of each text.

    A window of three words is held as a 64-bit hash with its place.  Sorting brings equal windows
    together; the places of those found twice are then sorted and their union is measured.
    """
    text = F.coalesce(F.col(report), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, _BLANKS + " ", "")) > 0)
    base = reports.select(
        *keep, _words(text).alias("_w"), lines.alias("_l"),
        F.length(F.translate(text, _BLANKS + " ", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    n = F.size("_w")
    spots = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    w = F.col("_w")
    windows = base.select(
        *keep, n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("_l").cast("long").alias("_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.transform(spots, lambda i: F.struct(
            F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")))).alias("_s"))
    s = F.col("_s")

    def twice(x: Column, k: Column) -> Column:
        h = x["h"]
        same = ((k > 0) & (F.get(s, k - 1)["h"] == h)) | F.coalesce(F.get(s, k + 1)["h"] == h, F.lit(False))
        return F.when(same, x["i"]).otherwise(-1)

    places = windows.withColumn("_p", F.sort_array(F.array_remove(F.transform("_s", twice), -1))).drop("_s")
    union = F.aggregate(
        "_p", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(a["end"], p)).alias("n"), (p + 3).alias("end")),
        lambda a: a["n"])
    return places.withColumn("n_repeat_words", union.cast("long")).drop("_p")


def _ratio(a: Column, b: Column) -> Column:
    """a / b in whole millionths; 0 where b is 0."""
    return F.when(b > 0, F.floor(a * 1_000_000 / b)).otherwise(F.lit(0)).cast("long")


def bin_of(value: Column) -> Column:
    """Lower edge of a value's bin: its first six binary digits, so bins are 1/32 wide at most."""
    shift = F.greatest(F.length(F.bin(value)) - _BITS, F.lit(0))
    power = F.pow(F.lit(2.0), shift).cast("long")
    return value - F.pmod(value, power)


def sketches(measured: DataFrame, by: list[str]) -> DataFrame:
    """Quantile sketch of every measure and group: counts of log-linear bins, which merge by
    addition (order and partitions don't matter)."""
    stacked = measured.select(*by, F.explode(F.create_map(*[
        x for m in MEASURES for x in (F.lit(m), F.col(f"_{m}"))])).alias("measure", "value"))
    return stacked.groupBy(*by, "measure", bin_of(F.col("value")).alias("bin")).agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Rows and the two fences of each group and measure, from nothing but the group's own quantiles."""
    w = Window.partitionBy(*by, "measure")
    ranked = sketch.withColumns({"below": F.sum("n").over(w.orderBy("bin")), "all": F.sum("n").over(w)})

    def quantile(k: Column | int) -> Column:
        return F.min(F.when(F.col("below") * 100 >= F.col("all") * k, F.col("bin")))

    level, spread = (F.create_map(*[F.lit(x) for m, v in MEASURES.items() for x in (m, v[k])])[F.col("measure")] for k in range(2))
    low, middle, high = F.col("low"), F.col("middle"), F.col("high")
    return ranked.groupBy(*by, "measure").agg(
        F.max("all").alias("rows"), quantile(50).alias("middle"), quantile(level).alias("high"),
        quantile(100 - level).alias("low")).select(
        *by, "measure", "rows", F.struct(
            (low - spread * (middle - low)).alias("low"), (high + spread * (high - middle)).alias("high")).alias("fence"))


def judged(
    reports: DataFrame, product_id: str = "product_id", report: str = "report",
    language: str = "language", source: str = "source", least_rows: int = 200,
) -> DataFrame:
    """Base counts of each report and whether it is kept.

    The project's reports have no language or source, so both are parameters: any two columns that
    say where a text belongs, such as ``product_type`` and ``run_date`` of a product.  Returns
    per row: product_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    A text fails the base rules with fewer than 50 words or with more than half of them in windows of
    three words found twice.  Others are kept unless a measure (symbols per letter, repeated
    lines per line, repeated words per word, letters per word) lies beyond a fence of their group (of
    letters per word, on either side).  No fence is fixed: all come from quantile sketches per (language, source) of the texts that pass the base
    rules.  Where a group has fewer than ``least_rows`` of these, its sketch is merged with the
    language's other sketches, and below that with all.  A null language, source or text counts as
    a value of its own, or an empty text.  Repeated rows count and are judged one by one.
    """
    keys = {"_k": F.col(product_id), "_g": F.col(language), "_o": F.col(source)}
    measured = counts(reports.select(*[c.alias(n) for n, c in keys.items()], F.col(report).alias("_t")),
                      list(keys), "_t")
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    measured = materialized(measured.select(
        "*", failed.alias("base_failed"),
        _ratio(F.col("n_symbols"), F.col("word_chars")).alias("_symbols"),
        _ratio(F.col("n_dup_lines"), F.col("_lines")).alias("_dup_lines"),
        _ratio(F.col("n_repeat_words"), F.col("n_words")).alias("_repeats"),
        _ratio(F.col("word_chars"), F.col("n_words")).alias("_word_length")))
    own = materialized(sketches(measured.where(~F.col("base_failed")), ["_g", "_o"]))
    of_language = own.groupBy("_g", "measure", "bin").agg(F.sum("n").alias("n"))
    of_all = of_language.groupBy("measure", "bin").agg(F.sum("n").alias("n"))
    levels = [_wide(fences(own, ["_g", "_o"]), ["_g", "_o"], "a"),
              _wide(fences(of_language, ["_g"]), ["_g"], "b"),
              _wide(fences(of_all, []), [], "c")]
    a, b = levels[0], levels[1]
    both = a.join(b.withColumnRenamed("_g", "_h"), F.col("_g").eqNullSafe(F.col("_h")), "left").drop("_h")
    whole = levels[2].select(F.struct("*")).scalar()
    verdict = F.lit(True)
    fence = {}
    for m in MEASURES:
        fence[m] = F.when(F.col("a_rows") >= least_rows, F.col(f"a_{m}")).when(
            F.col("b_rows") >= least_rows, F.col(f"b_{m}")).otherwise(whole[f"c_{m}"])
    both = both.select(F.col("_g").alias("_g2"), F.col("_o").alias("_o2"), *[f.alias(f"fence_{m}") for m, f in fence.items()])
    joined = measured.join(
        both, F.col("_g").eqNullSafe(F.col("_g2")) & F.col("_o").eqNullSafe(F.col("_o2")), "left")
    for m in MEASURES:
        at, fence = bin_of(F.col(f"_{m}")), F.col(f"fence_{m}")
        verdict = verdict & (at <= fence["high"])
        if m == "word_length":
            verdict = verdict & (at >= fence["low"])
    return joined.select(
        F.col("_k").alias(product_id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(verdict, F.lit(True))).alias("kept"))


def _wide(table: DataFrame, by: list[str], prefix: str) -> DataFrame:
    """One row per group: its rows and a fence per measure."""
    made = [F.max(F.when(F.col("measure") == m, F.col("fence"))).alias(f"{prefix}_{m}") for m in MEASURES]
    return table.groupBy(*by).agg(F.max("rows").alias(f"{prefix}_rows"), *made)
