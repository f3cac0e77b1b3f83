"""Spelling variants: words one edit apart, by dynamic programming along the sorted vocabulary.

The matrix of edit distances between a query and the words of a sorted list has the same rows for
words with a common beginning.  So a list is walked by depth: a state is a query, a range of the list that
shares its first characters (read off the lengths of the adjacent common prefixes) and the three matrix cells
within one edit of the diagonal.  A state is extended once for the whole range, and a range whose cells all
exceed one edit is skipped.

The sorted vocabulary is dealt into ranges of bounded size.  Of two words one edit apart, one half is
equal: a query visits the ranges that hold words with its first half, and, in the list of
reversed words, those with its reversed second half; a range whose own common prefix is already
more than one edit away from the query is skipped.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundswell.frames import materialized
from groundswell.llm.columns import tidy

#: Letters, as Latin-1 bytes (one byte a code point), with A-Z lower-cased; all else is a blank.
_LETTER = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))
#: Words of a range of the sorted vocabulary, queries searched at once, and counts a task holds.
RANGE_WORDS, QUERIES, COUNTS = 20_000, 8192, 400_000
_BEYOND = np.uint8(2)


def words_of(text: str) -> list[bytes]:
    """Maximal runs of letters A-Z, a-z and U+00C0 to U+00FF as Latin-1, only A-Z lower-cased."""
    return text.encode("latin-1", "replace").translate(_LETTER).split()


def misspelt(word: bytes, start: int, every: int) -> bytes:
    """The word without its code point h % length where ``every`` divides h, the CRC-32 of its UTF-8 bytes
    continued from ``start``; unchanged otherwise."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
    return word if h % every else word[:h % len(word)] + word[h % len(word) + 1:]


def vocabulary(reports: DataFrame, product_id: str, report: str, shortest: int, least: int, every: int | None) -> DataFrame:
    """(word, n): words of at least ``shortest`` code points and ``least`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def parcel() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())],
                names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                found = Counter(w for w in words_of(text.as_py() or "") if len(w) >= shortest)
                start = zlib.crc32(f"{i.as_py()}:".encode())
                if every is None or not i.is_valid:
                    held.update(found)
                else:
                    for w, n in found.items():
                        w = misspelt(w, start, every)
                        if len(w) >= shortest:
                            held[w] += n
                if len(held) > COUNTS:
                    yield parcel()
        yield parcel()

    counted = reports.select(product_id, report).mapInArrow(tidy(run), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class WordList:
    """Sorted distinct byte words as one buffer, with the common prefix of each with the word before."""

    def __init__(self, words: list[bytes]) -> None:
        self.length = np.array([len(w) for w in words], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.data = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        self.shared = np.zeros(len(words), np.int64)
        live = np.arange(1, len(words))
        depth = 0
        while len(live):
            live = live[(self.length[live] > depth) & (self.length[live - 1] > depth)]
            live = live[self.data[self.begin[live] + depth] == self.data[self.begin[live - 1] + depth]]
            depth += 1
            self.shared[live] = depth
        self._opens: dict[int, np.ndarray] = {}

    def opens(self, depth: int) -> np.ndarray:
        """Words that are the first with their first ``depth`` + 1 characters."""
        if depth not in self._opens:
            first = np.arange(len(self.length)) == 0
            self._opens[depth] = np.flatnonzero(((self.shared <= depth) | first) & (self.length > depth))
        return self._opens[depth]

    def char(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Character of each word, 0 outside it (no letter is 0)."""
        inside = (at >= 0) & (at < self.length[word])
        return np.where(inside, self.data[np.where(inside, self.begin[word] + at, 0)], 0)


def one_edit(words: WordList, queries: WordList) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) of all pairs at an edit distance of exactly one."""
    q = np.arange(len(queries.length))
    lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(words.length))
    # Cells of row d, at columns d - 1, d and d + 1.
    cells = [np.full(len(q), _BEYOND), np.zeros(len(q), np.uint8), np.ones(len(q), np.uint8)]
    found, depth = [], 0
    while len(q):
        n = queries.length[q]
        ended = words.length[lo] == depth
        for k, cell in enumerate(cells):
            hit = ended & (cell == 1) & (n == depth - 1 + k)
            found.append((q[hit], lo[hit]))
        opens = words.opens(depth)
        a, b = np.searchsorted(opens, lo), np.searchsorted(opens, hi)
        times = b - a
        parent = np.repeat(np.arange(len(q)), times)
        at = np.arange(len(parent)) - np.repeat(np.cumsum(times) - times, times) + a[parent]
        first = opens[at]
        last = np.minimum(np.append(opens, len(words.length))[at + 1], hi[parent])
        c = words.char(first, np.full(len(first), depth))
        q = q[parent]
        x, y, z = (cell[parent] for cell in cells)
        n = queries.length[q]
        # Row depth + 1, at columns depth, depth + 1 and depth + 2.
        here = [queries.char(q, np.full(len(q), depth - 1 + k)) != c for k in range(3)]
        left = np.minimum(y + 1, x + here[0])
        middle = np.minimum(np.minimum(z + 1, left + 1), y + here[1])
        right = np.minimum(middle + 1, z + here[2])
        new = [np.where(depth + k <= n, np.minimum(cell, _BEYOND), _BEYOND).astype(np.uint8)
               for k, cell in enumerate((left, middle, right))]
        keep = np.minimum(np.minimum(new[0], new[1]), new[2]) < _BEYOND
        q, lo, hi = q[keep], first[keep], last[keep]
        cells = [cell[keep] for cell in new]
        depth += 1
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


def within_one(prefix: bytes, query: bytes) -> bool:
    """Whether some beginning of the query is at most one edit from the prefix."""
    k = 0
    while k < len(prefix) and k < len(query) and prefix[k] == query[k]:
        k += 1
    rest = prefix[k + 1:]
    return k >= len(prefix) - 1 or any(query[s:s + len(rest)] == rest for s in (k, k + 1)) or \
        query[k + 1:k + 1 + len(prefix) - k] == prefix[k:]


def ranges_of(query: bytes, bounds: list[bytes], shared: list[bytes]) -> range | list[int]:
    """Ranges that may hold words one edit from the query with the same first half."""
    from bisect import bisect_right

    half = query[:len(query) // 2]
    a = max(0, bisect_right(bounds, half) - 1)
    b = bisect_right(bounds, half + b"\xff" * 2)
    while b < len(bounds) and bounds[b].startswith(half):
        b += 1
    there = range(a, b)
    return there if len(there) <= 2 else [k for k in there if within_one(shared[k], query)]


def _half(a: int, b: int) -> int:
    """Characters of one half of two words, equal in one of the halves if they are one edit apart."""
    return a // 2 if a == b else (min(a, b) + 1) // 2


def _placed(words: DataFrame, reverse: bool) -> tuple[DataFrame, list[bytes], list[bytes]]:
    """The list in ranges, (shard, w), with each range's first word and common prefix."""
    order = F.reverse("word") if reverse else F.col("word")
    count = words.count()
    shards = max(1, -(-count // RANGE_WORDS))
    placed = materialized(words.select(order.alias("w"), "n").repartitionByRange(shards, "w").select(
        F.spark_partition_id().alias("part"), "w", "n"))
    edges = sorted((r["a"], r["b"], r["part"]) for r in placed.groupBy("part").agg(
        F.min("w").alias("a"), F.max("w").alias("b")).collect())
    bounds, ends = ([e[k].encode("latin-1") for e in edges] for k in range(2))
    shared = [a[:next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))] for a, b in zip(bounds, ends)]
    return placed, bounds, shared


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): the words one edit away of each word, from ``words`` (word, n)."""
    found = [_near_in(words, reverse) for reverse in (False, True)]
    return found[0].union(found[1])


def _near_in(words: DataFrame, reverse: bool) -> DataFrame:
    """Pairs whose first (or, ``reverse``, only whose second) half is equal."""
    placed, bounds, shared = _placed(words, reverse)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right

        for batch in batches:
            shard, asks, w, n = [], [], [], []
            for word, count in zip(*(c.to_pylist() for c in batch.columns)):
                raw = word.encode("latin-1")
                there = ranges_of(raw, bounds, shared)
                shard += [max(0, bisect_right(bounds, raw) - 1), *there]
                asks += [0] + [1] * len(there)
                w += [raw] * (1 + len(there))
                n += [count] * (1 + len(there))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(asks, pa.int32()), pa.array(w, pa.binary()), pa.array(n, pa.int64())],
                names=["shard", "asks", "w", "n"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each range first its words, then the queries."""
        shard, held, counts, words, asked = None, [], [], None, []

        def answer() -> pa.RecordBatch:
            nonlocal words
            words = words or WordList(held)
            q, k = one_edit(words, WordList(asked)) if held and asked else ((), ())
            pairs = []
            for a, b in zip(map(asked.__getitem__, q), k):
                near = held[b]
                one, two = (a[::-1], near[::-1]) if reverse else (a, near)
                half = _half(len(a), len(near))
                if (one[:half] == two[:half]) != reverse:
                    pairs.append((one.decode("latin-1"), two.decode("latin-1"), counts[b]))
            asked.clear()
            columns = list(zip(*pairs)) or [()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))],
                names=["word", "near", "near_n"])

        for batch in batches:
            for s, ask, w, n in zip(*(c.to_pylist() for c in batch.columns)):
                if s != shard:
                    if asked:
                        yield answer()
                    shard, held, counts, words = s, [], [], None
                if ask:
                    asked.append(w)
                    if len(asked) >= QUERIES:
                        yield answer()
                else:
                    held.append(w)
                    counts.append(n)
        if asked:
            yield answer()

    return placed.select("w", "n").mapInArrow(tidy(route), "shard int, asks int, w binary, n long").repartition(
        "shard").sortWithinPartitions("shard", "asks", "w").mapInArrow(tidy(search), "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) by following ``forms`` (word, form) to the last; the way left is halved each round.

    A form is more frequent than its word, so there is no way round.
    """
    up = materialized(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not up.where("moved").isEmpty():
        over = up.select(F.col("word").alias("root"), F.col("root").alias("over"))
        up = materialized(up.drop("moved").join(over, "root", "left").select(
            "word", F.coalesce("over", "root").alias("root"), F.col("over").isNotNull().alias("moved")))
    return up.select("word", "root")


def variants(
    reports: DataFrame, product_id: str = "product_id", report: str = "report", shortest: int = 6, least: int = 5,
    ratio: int = 5, every: int | None = None,
) -> DataFrame:
    """The vocabulary of the reports with each word's more frequent spelling.

    ``reports`` has one row per product: ``product_id`` and the ``report`` text.  Words are maximal
    runs of A-Z, a-z and U+00C0 to U+00FF, of which only A-Z are lower-cased; kept are those of at least
    ``shortest`` code points that occur ``least`` times in all.  Two words are near if one inserted, deleted or
    replaced code point makes one the other.  A word's form is its near word of largest count (of equal
    ones the smallest by code points) if that is at least ``ratio`` times its own.

    Returns per word: word, n, n_near, form and form_n (null without one), root (the last word on
    the way over forms, the word itself if it has none).

    ``every`` plants misspellings to measure with: a run loses its code point h % length where
    ``every`` divides h, the CRC-32 of ``<product_id>:<run>``; a row without an id loses none.
    A null or empty text has no words, repeated rows count each, an empty table gives no row.
    """
    words = materialized(vocabulary(reports, product_id, report, shortest, least, every))
    best = materialized(near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")))
    n = -F.col("best.less")
    placed = materialized(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(n >= F.col("n") * ratio, F.col("best.near")).alias("form"), F.when(n >= F.col("n") * ratio, n).alias("form_n")))
    ends = roots(placed.where("form is not null"))
    return placed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
