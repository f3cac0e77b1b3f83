"""Language of texts by nearest centroid of TF-IDF n-gram vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundswell.llm.columns import slices, text_buffers, tidy

BITS = 15
#: Numbers of n-grams for which the bound of rejection is learnt; between them it is interpolated.
SIZES = np.array([0, *(5 << k for k in range(11))])
#: Bytes of an n-gram: letters as they are, every other ASCII byte a blank.
_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
#: The share of a language's own texts that may lie below its bound.
BEYOND = 0.002
#: Words of real short texts hang together, so their cosines vary more than those of drawn n-grams.
SLACK = 0.8
_HAS_LETTER = r"\p{L}"


@dataclass(frozen=True)
class Centroids:
    """Unit centroids (rows) with the language of each, weights of the n-grams, and the cosine
    below which each language (row) rejects a text with as many n-grams as SIZES says (column)."""

    languages: list[str]
    owner: np.ndarray
    idf: np.ndarray
    matrix: np.ndarray
    least: np.ndarray


def ngrams(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row, row, n-gram, count) for slices of a text column, sorted by row."""
    data, offsets = text_buffers(pc.utf8_lower(column.cast(pa.large_string())))
    letters = _LETTER[data]
    for i, j in slices(offsets, 1 << 20):
        a, b = offsets[i], offsets[j]
        x = letters[a:b].astype(np.uint32)
        if len(x) < 3:
            yield i, j, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        gram = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77)
                + x[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
        row = np.repeat(np.arange(j - i), np.diff(offsets[i:j + 1]))
        # Within one text, and with two letters at least.
        fits = (row[:-2] == row[2:]) & ((x[:-2] != 32).astype(np.int8) + (x[1:-1] != 32)
                                        + (x[2:] != 32) >= 2)
        key = (row[:-2][fits].astype(np.int64) << BITS) | (gram[fits] >> np.uint32(32 - BITS))
        key, count = np.unique(key, return_counts=True)
        yield i, j, key >> BITS, key & ((1 << BITS) - 1), count


def _weights(row, gram, count, idf, n):
    """TF-IDF weights of unit length for each row."""
    w = (1 + np.log(count)) * idf[gram]
    norm = np.sqrt(np.bincount(row, w * w, n))
    return w / np.maximum(norm, 1e-12)[row]


def _clusters(rows: list[tuple[np.ndarray, np.ndarray]], k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means over sparse unit rows, started from evenly spaced rows."""
    n = len(rows)
    k = min(k, n)
    row = np.repeat(np.arange(n), [len(g) for g, _ in rows])
    gram, w = (np.concatenate(x) for x in zip(*rows))
    of = np.arange(n) % k
    for _ in range(rounds):
        m = np.zeros((k, 1 << BITS))
        np.add.at(m, (of[row], gram), w)
        m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
        near = np.stack([np.bincount(row, w * m[c][gram], n) for c in range(k)], 1).argmax(1)
        if (near == of).all():
            break
        of = near
    return m[np.unique(of)].astype(np.float32)


def _bounds(
    texts: list[tuple[np.ndarray, np.ndarray]], own: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray,
    clusters: int,
) -> np.ndarray:
    """SLACK of the cosine that all but BEYOND of a language's texts reach, for each of SIZES.

    Each half of the texts is held against the centroids of the other half, whole and cut to fewer
    n-grams drawn from it.  A bound for fewer n-grams is never higher than one for more.
    """
    if len(own) < 2:
        return np.zeros(len(SIZES))
    draw = np.random.default_rng(42)
    found: list[list[float]] = [[] for _ in SIZES]
    for half in (0, 1):
        m = _clusters(own[1 - half::2], clusters)
        for gram, count in texts[half::2]:
            total = int(count.sum())
            for k, size in enumerate(SIZES[1:], 1):
                if total < size:
                    break
                part = draw.multivariate_hypergeometric(count.astype(np.int64), size)
                g, c = gram[part > 0], part[part > 0]
                w = _weights(np.zeros(len(g), int), g, c, idf, 1)
                found[k].append(max(float((w * x[g]).sum()) for x in m))
    bounds = [SLACK * float(np.quantile(x, BEYOND)) if x else np.inf for x in found]
    bounds[0] = 0.0
    # Where no text is so long, the bound of the longest that are.
    bounds = np.minimum.accumulate(np.array(bounds)[::-1])[::-1]
    return np.where(np.isfinite(bounds), bounds, bounds[np.isfinite(bounds)][-1])


def fit(
    examples: DataFrame, text: str, language: str, per_language: int = 1500, clusters: int = 4,
) -> Centroids:
    """Centroids from labelled texts; rows without a text or a language teach nothing.

    The fit uses a bounded sample of every language: about ``per_language`` different texts, chosen by
    a hash of the text; copies count once.  Only sparse vectors come to the driver, never texts: about
    per_language rows of 2^15 counts for each language.
    """
    usable = examples.select(
        F.col(text).alias("t"), F.col(language).alias("g"), F.xxhash64(text).alias("h")).where(
        F.col("t").rlike(_HAS_LETTER) & F.col("g").isNotNull())
    counts = usable.select("g", "h").distinct().groupBy("g").count().orderBy("g").collect()
    if not counts:
        raise ValueError("no labelled text to learn from")
    share = F.create_map(*[
        F.lit(x) for r in counts for x in (r["g"], min(1.0, per_language / r["count"]))])
    # A hash as a number in [0, 1): the same rows in every run.
    spot = F.pmod(F.col("h"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = usable.where(spot < share[F.col("g")])
    sample = picked.groupBy("g", "h").agg(F.first("t").alias("t")).select("t", "g")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[bytes, bytes]] = [(b"", b"")] * batch.num_rows
            for i, j, row, gram, count in ngrams(batch.column(0)):
                cut = np.searchsorted(row, np.arange(j - i + 1))
                for r in range(j - i):
                    a, b = cut[r], cut[r + 1]
                    found[i + r] = (gram[a:b].astype("<u2").tobytes(), count[a:b].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *(pa.array(list(x), pa.binary()) for x in zip(*found))],
                names=["g", "grams", "counts"]) if batch.num_rows else pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([], pa.binary()), pa.array([], pa.binary())],
                names=["g", "grams", "counts"])

    rows = sample.mapInArrow(tidy(vectors), "g string, grams binary, counts binary").collect()
    rows.sort(key=lambda r: (r["g"], bytes(r["grams"]), bytes(r["counts"])))
    parsed = [(r["g"], np.frombuffer(r["grams"], "<u2").astype(np.int64),
               np.frombuffer(r["counts"], "<u4")) for r in rows if len(r["grams"])]
    df = np.zeros(1 << BITS)
    for _, gram, _ in parsed:
        df[gram] += 1
    idf = np.log((1 + len(parsed)) / (1 + df)) + 1
    languages, owner, blocks, least = [], [], [], []
    for name in sorted({g for g, _, _ in parsed}):
        own = [(gram, _weights(np.zeros(len(gram), int), gram, count, idf, 1))
               for g, gram, count in parsed if g == name]
        m = _clusters(own, clusters)
        owner += [len(languages)] * len(m)
        languages.append(name)
        blocks.append(m)
        least.append(_bounds([(gram, count) for g, gram, count in parsed if g == name], own, idf, clusters))
    return Centroids(languages, np.array(owner), idf, np.concatenate(blocks), np.array(least))


def _scores(column: pa.Array, model: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its cosine and the number of n-grams of each text."""
    n, k = len(column), len(model.languages)
    best, score, size = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.int64)
    for i, j, row, gram, count in ngrams(column):
        w = _weights(row, gram, count, model.idf, j - i)
        near = np.full((j - i, k), -1.0)
        for c, own in enumerate(model.owner):
            np.maximum(near[:, own], np.bincount(row, w * model.matrix[c][gram], j - i),
                       out=near[:, own])
        best[i:j], score[i:j] = near.argmax(1), near.max(1)
        size[i:j] = np.bincount(row, count, j - i)
    return best, score, size


def identified(
    reports: DataFrame, model: Centroids, product_id: str = "product_id", report: str = "report",
    keep: tuple[str, ...] = (), result: str = "language",
) -> DataFrame:
    """Predict the language of every report from its whole text.

    The project's records carry no language, so the operator is general: any table with an id and
    a text works.  Adds to ``product_id`` and the ``keep`` columns one struct named ``result``:
    lang_pred, score (cosine to the nearest centroid, 0 to 1) and rejected.  A null text or one
    without a letter is ``und``, score 0, rejected.  A text is also rejected when its cosine lies
    below the bound its language learned for as many n-grams; a text without one is too short to tell.  Ties go to the first language by name.  One scan, no shuffle.
    """
    names = [product_id, *keep]
    if result in names:
        raise ValueError(f"column {result} is the result; give another name")
    kind = T.StructType().add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    out = reports.select(*names).schema.add(result, kind)
    arrow = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score, size = _scores(batch.column(len(names)), model)
            known = pc.fill_null(batch.column(len(names) + 1), False).to_numpy(zero_copy_only=False)
            score = np.where(known, np.clip(score, 0, 1), 0.0)
            least = np.zeros(len(score))
            for k, bounds in enumerate(model.least):
                least = np.where(best == k, np.interp(size, SIZES, bounds), least)
            rejected = ~known | (score < least)
            pred = np.where(known, np.array(model.languages, object)[best], "und")
            made = pa.StructArray.from_arrays(
                [pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)],
                fields=list(arrow))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], made], names=out.names)

    text = F.col(report)
    return reports.select(*names, text.alias("_text"), _lettered(text).alias("_known")).mapInArrow(tidy(run), out)


def _lettered(text: Column) -> Column:
    return F.coalesce(text.rlike(_HAS_LETTER), F.lit(False))
