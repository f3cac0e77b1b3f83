"""The queries of this package: thin steps from the given tables to the operators and back."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundswell.llm import (
    bpe, decontaminate, history_trie, jaccard_join, language, main_text, passages, quality, simhash, spelling, tokens, toxicity,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str) -> Column:
    """The quarter of the documents that no label may be learnt from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


DOCS = {"product_id": "doc_id", "report": "text"}


@query("op1_substring_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.without_repeats(table(spark, sf_dir, "documents"), **DOCS)
    return found.select("doc_id", *[f"passages.{c}" for c in (
        "n_words", "n_removed", "kept_sha256", "n_passages")])


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~held_out("doc_id")), "doc_id", "text")
    found = toxicity.scored(docs, model, **DOCS)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op3_decontaminate")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), **DOCS)
    return found.select("doc_id", *[f"overlap.{c}" for c in (
        "n_words", "n_hit", "n_items", "items_sha256", "contaminated")])


@query("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokenized(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN, **DOCS)


#: The quality rules in DuckDB: words as rows, windows as a partition, quantiles over bin counts.
QUALITY_SQL = """
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t,
                  chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS blanks FROM documents),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (
    SELECT doc_id, list_filter(string_split(translate(t, blanks, '     '), ' '), lambda x: x <> '') AS ws FROM d)),
three AS (SELECT *, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM words
          WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i, w2 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w, w1, w2) > 1 AS again FROM three),
covered AS (SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS 2 PRECEDING) AS hit FROM twice),
per AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (hit) AS n_repeat_words FROM covered GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines FROM (
    SELECT doc_id, blanks, unnest(string_split(t, chr(10))) AS x FROM d)
    WHERE translate(x, blanks || ' ', '') <> '' GROUP BY doc_id),
base AS (SELECT doc_id, lang, source, coalesce(n_words, 0) AS n_words,
    length(translate(t, blanks || ' ', '')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines
    FROM d LEFT JOIN per USING (doc_id) LEFT JOIN lines USING (doc_id)),
measured AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN n_symbols * 1000000 // word_chars ELSE 0 END AS symbols,
    CASE WHEN n_lines > 0 THEN n_dup_lines * 1000000 // n_lines ELSE 0 END AS dup_lines,
    CASE WHEN n_words > 0 THEN n_repeat_words * 1000000 // n_words ELSE 0 END AS repeats,
    CASE WHEN n_words > 0 THEN word_chars * 1000000 // n_words ELSE 0 END AS word_length FROM base),
stacked AS (SELECT lang, source, m.m AS measure, m.v AS v FROM (
    SELECT lang, source, unnest([{'m': 'symbols', 'v': symbols}, {'m': 'dup_lines', 'v': dup_lines},
        {'m': 'repeats', 'v': repeats}, {'m': 'word_length', 'v': word_length}]) AS m
    FROM measured WHERE NOT base_failed)),
own AS (SELECT lang, source, measure, v - v % (1::BIGINT << greatest(length(bin(v)) - 6, 0)) AS b, count(*) AS n FROM stacked GROUP BY ALL),
levels AS (SELECT 1 AS level, lang, source, measure, b, n FROM own
    UNION ALL SELECT 2, lang, NULL, measure, b, sum(n) FROM own GROUP BY ALL
    UNION ALL SELECT 3, NULL, NULL, measure, b, sum(n) FROM own GROUP BY ALL),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY b) AS below,
    sum(n) OVER (PARTITION BY level, lang, source, measure) AS whole FROM levels),
quantiles AS (SELECT level, lang, source, measure, max(whole) AS n_rows, min(b) FILTER (below * 100 >= whole * 50) AS middle,
    min(b) FILTER (below * 100 >= whole * CASE measure WHEN 'symbols' THEN 90 ELSE 99 END) AS high,
    min(b) FILTER (below * 100 >= whole * CASE measure WHEN 'symbols' THEN 10 ELSE 1 END) AS low FROM ranked GROUP BY ALL),
fences AS (SELECT *, {'low': low - CASE measure WHEN 'symbols' THEN 4 ELSE 2 END * (middle - low),
    'high': high + CASE measure WHEN 'symbols' THEN 4 ELSE 2 END * (high - middle)} AS fence FROM quantiles),
chosen AS (SELECT a.lang, a.source, a.measure, CASE WHEN a.n_rows >= 200 THEN a.fence WHEN b.n_rows >= 200
    THEN b.fence ELSE c.fence END AS fence FROM fences a
    JOIN fences b ON b.level = 2 AND a.lang IS NOT DISTINCT FROM b.lang AND a.measure = b.measure
    JOIN fences c ON c.level = 3 AND a.measure = c.measure WHERE a.level = 1),
wide AS (SELECT lang, source, max(fence) FILTER (measure = 'symbols') AS f1, max(fence) FILTER (measure = 'dup_lines') AS f2,
    max(fence) FILTER (measure = 'repeats') AS f3, max(fence) FILTER (measure = 'word_length') AS f4 FROM chosen GROUP BY ALL),
binned AS (SELECT *, symbols - symbols % (1::BIGINT << greatest(length(bin(symbols)) - 6, 0)) AS b1,
    dup_lines - dup_lines % (1::BIGINT << greatest(length(bin(dup_lines)) - 6, 0)) AS b2,
    repeats - repeats % (1::BIGINT << greatest(length(bin(repeats)) - 6, 0)) AS b3,
    word_length - word_length % (1::BIGINT << greatest(length(bin(word_length)) - 6, 0)) AS b4 FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce(b1 <= f1.high AND b2 <= f2.high AND b3 <= f3.high AND b4 BETWEEN f4.low AND f4.high, true) AS kept
FROM binned m LEFT JOIN wide w ON m.lang IS NOT DISTINCT FROM w.lang AND m.source IS NOT DISTINCT FROM w.source
"""


@query("op5_quality_rules", QUALITY_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), language="lang", source="source", **DOCS)


@query("op6_main_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages"))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), **DOCS)
    return found.select("doc_id", simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query("op8_warc")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(bundles).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_language")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~held_out("doc_id")), "text", "lang")
    found = language.identified(docs, model, **DOCS)
    return found.select("doc_id", held_out("doc_id").alias("held_out"),
                        "language.lang_pred", "language.score", "language.rejected")


@query("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokens.write_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), **DOCS)
    return tokens.read_tokens(files, "doc_id")


#: Links by counting common shingles of every two documents, components by spreading the least id.
JACCARD_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13),
        'abcdefghijklmnopqrstuvwxyz     '), ' '), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
rare AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
t AS (SELECT doc_id, g FROM s JOIN rare USING (g)),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.g = b.g AND a.doc_id <> b.doc_id
    JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 85 * (any_value(x.n_shingles) + any_value(y.n_shingles) - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, coalesce(n_shingles, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""


@query("op11_ngram_jaccard_join", JACCARD_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.linked_reports(table(spark, sf_dir, "documents"), **DOCS)
    return found.select("doc_id", "n_shingles", "component_id")


#: Bits of a text, least first in each byte (ASCII), and their CRC-32.
_CRC = """xor(list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(string_split({0}, ''),
    lambda c: list_transform(range(8), lambda k: ((ascii(c) >> k) & 1)::UBIGINT)))),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295::UBIGINT)"""

#: Every prefix of every rebuilt conversation as a list; subtrees by listing each node's own prefixes.
TRIE_SQL = f"""
WITH own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT *, ({_CRC.format("conv_id::VARCHAR")} % 9)::BIGINT AS h FROM own),
built AS (SELECT a.conv_id, list_concat(list_slice(b.s, 1, h), list_slice(a.s, h + 1, len(a.s))) AS s
    FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
prefixes AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM built),
nodes AS (SELECT list_slice(s, 1, d) AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = d) AS ids FROM prefixes GROUP BY ALL),
kids AS (SELECT list_slice(p, 1, d - 1) AS p, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
all_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (p, d)),
up AS (SELECT unnest(range(0, d + 1)) AS a, * FROM all_nodes),
sums AS (SELECT list_slice(p, 1, a) AS p, a AS d, count(*) FILTER (n_children = 0) AS n_leaves,
    sum(CASE WHEN d > 0 THEN (n_convs - 1) * strlen(p[d].t) ELSE 0 END)::BIGINT AS saved_tokens FROM up GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, q.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens,
    sha256(coalesce(n.ids, '')) AS ends_sha256
FROM all_nodes n JOIN sums USING (p, d) LEFT JOIN nodes q ON q.d = n.d - 1 AND q.p = list_slice(n.p, 1, n.d - 1)
"""


@query("op12_conversation_trie", TRIE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = history_trie.history_trie(
        table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text",
        base=F.expr("pair - pair % 5"), head=F.crc32(F.col("pair").cast("string").cast("binary")) % 9)
    return nodes.select(
        F.col("pair_id").alias("conv_id"), "depth", F.col("parent_pair_id").alias("parent_conv_id"),
        F.col("n_pairs").alias("n_convs"), "n_children", "n_leaves", F.col("saved_bytes").alias("saved_tokens"), "ends_sha256")


#: CRC-32 over the UTF-8 bytes of each different run; near words by common deletions and wildcards.
SPELLING_SQL = r"""
WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
once AS (SELECT doc_id, w, count(*) AS n FROM runs WHERE length(w) >= 6 GROUP BY ALL),
bytes AS (SELECT *, hex(encode(doc_id::VARCHAR || ':' || w)) AS x FROM once),
marked AS (SELECT w, n, xor(list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(
        range(0, length(x) // 2), lambda i: list_transform(range(8), lambda k:
        ((('0x' || x[2 * i + 1:2 * i + 2])::UBIGINT >> k::UBIGINT) & 1))))),
        lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295::UBIGINT) AS h FROM bytes),
words AS (SELECT CASE WHEN h % 199 = 0 THEN w[1:(h % length(w))::BIGINT] || w[(h % length(w))::BIGINT + 2:] ELSE w END AS word,
        sum(n)::BIGINT AS n FROM marked GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
cut AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS less, word[1:i - 1] || '*' || word[i + 1:] AS wild
    FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.wild = b.wild AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.less = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.less = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min({'w': near, 'n': near_n}, {'a': -near_n, 'b': near}) AS b FROM near GROUP BY word),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 5 * n THEN b.w END AS form,
    CASE WHEN b.n >= 5 * n THEN b.n END AS form_n FROM words LEFT JOIN best USING (word)),
way(word, stop) AS (SELECT word, word FROM words UNION SELECT way.word, form FROM way JOIN forms ON way.stop = forms.word
    WHERE form IS NOT NULL)
SELECT f.word, f.form, way.stop AS root, f.n, f.n_near, f.form_n FROM forms f JOIN way ON way.word = f.word
JOIN forms e ON e.word = way.stop AND e.form IS NULL
"""


@query("op13_spelling_variants", SPELLING_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), **DOCS, every=199)
