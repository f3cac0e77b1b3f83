"""Toxicity of texts, by a classifier that must not care which group a text names."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundswell.frames import materialized
from groundswell.llm.columns import mix, slices, text_buffers, word_hashes, word_spans

#: Terms that name groups; a swap puts the next term of its line in a term's place.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("she", "he"), ("her", "his"),
    ("black", "white", "asian", "latino"), ("muslim", "christian", "jewish", "hindu", "buddhist"),
    ("muslims", "christians", "jews", "hindus", "buddhists"), ("gay", "straight", "lesbian", "bisexual"),
    ("immigrants", "citizens", "refugees"), ("immigrant", "citizen", "refugee"), ("old", "young"),
    ("african", "european", "american", "mexican", "chinese", "arab"), ("deaf", "hearing"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden"), ("schwarze", "weiße"),
    ("ausländer", "deutsche"), ("femmes", "hommes"), ("femme", "homme"), ("musulmans", "chrétiens", "juifs"),
    ("noirs", "blancs"), ("étrangers", "français"), ("mujeres", "hombres"), ("mujer", "hombre"),
    ("musulmanes", "cristianos", "judíos"), ("negros", "blancos"), ("extranjeros", "españoles"),
)
SWAP = {t: line[(k + 1) % len(line)] for line in IDENTITY for k, t in enumerate(line)}
#: Byte lengths of the word beginnings that are features besides whole words, and the counts in a
#: text from which a feature's next level holds.
PREFIXES, LEVELS = (4, 5, 6, 7), (1, 2, 3, 5)
_GAP = np.ones(256, bool)
_GAP[0x80:] = False
_GAP[0x61:0x7B] = False
_KIND = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Model:
    """Weights of feature levels by 64-bit feature, a bias, and a table that tells most others off."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    bases: np.ndarray
    maybe: np.ndarray = field(repr=False)


def _maybe(bases: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << 22, bool)
    table[(bases >> np.uint64(42)).astype(np.int64)] = True
    return table


def word_features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, feature) of every word and word beginning, one kind at a time; data is lower case."""
    starts, ends, row = word_spans(data, offsets, _GAP)
    yield row, word_hashes(data, starts, ends)
    for k, size in enumerate(PREFIXES, 1):
        long = ends - starts >= size
        s = starts[long]
        yield row[long], mix(word_hashes(data, s, s + size) + np.uint64(_KIND * k & (1 << 64) - 1))


def levels(row: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature of a level) for all levels that the counts of (row, base) reach."""
    order = np.lexsort((base, row))
    row, base = row[order], base[order]
    edge = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (base[1:] != base[:-1])])) if len(row) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate([edge, [len(row)]]))
    row, base = row[edge], base[edge]
    parts = [(row[count >= n], mix(base[count >= n] + np.uint64(n))) for n in LEVELS]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _lower(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return text_buffers(pc.utf8_lower(column.cast(pa.large_string())))


def swapped(text: str) -> str | None:
    """The lower-case text with every identity term replaced; None where it has none."""
    import re

    out = re.sub(r"[a-zß-ÿ]+", lambda m: SWAP.get(m[0], m[0]), text)
    return None if out == text else out


def _rows_of(column: pa.Array, keep=None) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct feature levels) of each text; ``keep`` picks base features."""
    data, offsets = _lower(column)
    for i, j in slices(offsets, 1 << 22):
        kinds = list(word_features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
        row, base = (np.concatenate(x) for x in zip(*kinds))
        if keep is not None:
            there = np.isin(base, keep)
            row, base = row[there], base[there]
        row, found = levels(row, base)
        order = np.argsort(row, kind="stable")
        row, found = row[order], found[order]
        cut = np.searchsorted(row, np.arange(j - i + 1))
        for r in range(j - i):
            yield i + r, found[cut[r]:cut[r + 1]]


def _sample(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int):
    """At most about ``rows`` labelled texts, half of each label, with the weight of each."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(
        F.max(F.col(label).cast("int")).alias("y"))
    n = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        raise ValueError("labels of both kinds are needed to learn from")
    share = {y: min(1.0, rows / 2 / n[y]) for y in (0, 1)}
    spot = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.where(spot < F.when(F.col("y") == 1, share[1]).otherwise(share[0]))
    # At most ``rows`` ids and their labels: bounded, whatever the tables' size.
    texts = documents.select(key, F.col(text).alias("_text")).join(F.broadcast(picked), key)
    return texts.select("y", "_text"), {y: 1 / share[y] for y in (0, 1)}


def fit(
    documents: DataFrame, labels: DataFrame, key: str, text: str, label: str = "toxic",
    max_rows: int = 12_000, max_features: int = 3000, fairness: float = 1.0, ridge: float = 2e-3,
    rounds: int = 400,
) -> Model:
    """Learn from a bounded sample of labelled texts: ``max_rows`` of them, half of each label.

    Features are words and word beginnings at several counts; the ``max_features`` that tell the
    labels apart best are used.  Beside the loss, the squared change of the score is penalised when the
    identity terms of a text are swapped.  Only counts and sparse rows come to the driver.
    """
    sample, weight = _sample(documents, labels, key, text, label, max_rows)
    sample = materialized(sample).coalesce(4)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        totals = np.zeros(2, np.int64)

        def merge() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            f, a, b = (np.concatenate(x) for x in zip(*seen))
            u, back = np.unique(f, return_inverse=True)
            return u, *(np.bincount(back, x, len(u)).astype(np.int64) for x in (a, b))

        for batch in batches:
            y = batch.column(0).to_numpy()
            for at in range(0, batch.num_rows, 500):
                part = [(y[at + r], f) for r, f in _rows_of(batch.column(1).slice(at, 500))]
                totals += np.bincount([v for v, _ in part], minlength=2)[:2]
                f = np.concatenate([x for _, x in part])
                of = np.repeat([v for v, _ in part], [len(x) for _, x in part])
                u, back = np.unique(f, return_inverse=True)
                seen.append((u, np.bincount(back, of == 0, len(u)), np.bincount(back, of == 1, len(u))))
                if len(seen) == 6:
                    seen[:] = [merge()]
        f, a, b = merge() if seen else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)
        yield pa.RecordBatch.from_pydict({
            "f": f.view(np.int64), "a": a, "b": b, "t0": np.full(len(f), totals[0]), "t1": np.full(len(f), totals[1])})

    counted = sample.mapInArrow(tally, "f long, a long, b long, t0 long, t1 long")
    table = counted.groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where("a + b >= 3")
    n0, n1 = (float(x) for x in sample.agg(F.sum(1 - F.col("y")), F.sum("y")).first())
    a, b = F.col("a") / F.lit(n0), F.col("b") / F.lit(n1)
    both = (F.col("a") + F.col("b")) / F.lit(n0 + n1)
    z = (b - a) / F.sqrt(both * (1 - both) * F.lit(1 / n0 + 1 / n1) + F.lit(1e-9))
    best = table.withColumn("z", F.abs(z)).where("z > 4").orderBy(F.desc("z"), "f").limit(max_features)
    features = np.sort(np.array([r["f"] for r in best.select("f").collect()], np.int64).view(np.uint64))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lower = pc.utf8_lower(part.column(1).cast(pa.large_string()))
                other = [None if t is None else swapped(t) for t in lower.to_pylist()]
                own, there = (
                    [np.searchsorted(features, f[np.isin(f, features)]).astype("<u4").tobytes()
                     for _, f in _rows_of(c)] for c in (lower, pa.array(other, pa.large_string())))
                there = [None if o is None else t for o, t in zip(other, there)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(own, pa.binary()), pa.array(there, pa.binary())], names=["y", "x", "swap"])

    rows = sample.mapInArrow(vectors, "y int, x binary, swap binary").collect()
    rows.sort(key=lambda r: (r["y"], bytes(r["x"]), bytes(r["swap"] or b"")))
    w, bias = _descend(rows, len(features), weight, fairness, ridge, rounds)
    bases = _bases_of(sample, features)
    return Model(features, w, bias, bases, _maybe(bases))


def _bases_of(sample: DataFrame, features: np.ndarray) -> np.ndarray:
    """The base features behind the levels: levels can't be turned back, so the sample tells."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                data, offsets = _lower(batch.column(1).slice(at, 500))
                for _, base in word_features(data, offsets):
                    base = np.unique(base)
                    hit = np.zeros(len(base), bool)
                    for n in LEVELS:
                        hit |= np.isin(mix(base + np.uint64(n)), features)
                    yield pa.RecordBatch.from_pydict({"f": base[hit].view(np.int64)})

    found = sample.mapInArrow(find, "f long").distinct().collect()
    return np.sort(np.array([r["f"] for r in found], np.int64).view(np.uint64))


def _descend(rows, n: int, weight: dict, fairness: float, ridge: float, rounds: int) -> tuple[np.ndarray, float]:
    """Weighted logistic loss + ridge + fairness * mean squared change of the logit under swaps."""

    def sparse(cells: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        x = [np.frombuffer(c, "<u4").astype(np.int64) for c in cells]
        return np.repeat(np.arange(len(x)), [len(v) for v in x]), np.concatenate([*x, np.zeros(0, np.int64)])

    y = np.array([r["y"] for r in rows], float)
    c = np.array([weight[r["y"]] for r in rows])
    c /= c.sum()
    r1, f1 = sparse([r["x"] for r in rows])
    pairs = [(r["x"], r["swap"]) for r in rows if r["swap"] is not None]
    ra, fa = sparse([p[0] for p in pairs])
    rb, fb = sparse([p[1] for p in pairs])
    w, bias, past, past_b = np.zeros(n), float(np.log(np.maximum((c * y).sum(), 1e-6))), np.zeros(n), 0.0
    for _ in range(rounds):
        g = c * (1 / (1 + np.exp(-(np.bincount(r1, w[f1], len(y)) + bias))) - y)
        grad = np.bincount(f1, g[r1], n) + ridge * w / max(1, n) ** 0.5
        if pairs:
            d = (np.bincount(rb, w[fb], len(pairs)) - np.bincount(ra, w[fa], len(pairs))) * 2 * fairness / len(pairs)
            grad += np.bincount(fb, d[rb], n) - np.bincount(fa, d[ra], n)
        past, past_b = past + grad ** 2, past_b + g.sum() ** 2
        w -= 0.3 * grad / np.sqrt(past + 1e-12)
        bias -= 0.3 * g.sum() / np.sqrt(past_b + 1e-12)
    return w, bias


def logits(column: pa.Array, model: Model) -> np.ndarray:
    """Score before the sigmoid, for whole texts; an empty one has the bias only."""
    data, offsets = _lower(column)
    out = np.full(len(column), model.bias)
    for i, j in slices(offsets, 1 << 22):
        rows, bases = [], []
        for row, base in word_features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]):
            may = np.flatnonzero(model.maybe[(base >> np.uint64(42)).astype(np.int64)])
            may = may[np.isin(base[may], model.bases)]
            rows.append(row[may])
            bases.append(base[may])
        row, found = levels(np.concatenate(rows), np.concatenate(bases))
        if len(row) and len(model.features):
            at = np.minimum(np.searchsorted(model.features, found), len(model.features) - 1)
            out[i:j] += np.bincount(row, np.where(model.features[at] == found, model.weights[at], 0.0), j - i)
    return out


def scored(
    reports: DataFrame, model: Model, product_id: str = "product_id", report: str = "report",
    threshold: float = 0.3,
) -> DataFrame:
    """``product_id``, score (0 to 1) and predicted (1 from ``threshold`` on) of every whole text.

    The project's records hold no comments, so the operator is general: any table with an id and a
    text works.  A null or empty text gets the score of no evidence; repeated rows are scored one by
    one.  One scan, no shuffle.
    """
    out = reports.select(product_id).schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = 1 / (1 + np.exp(-np.clip(logits(batch.column(1), model), -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=out.names)

    return reports.select(product_id, F.col(report).alias("_text")).mapInArrow(run, out)
