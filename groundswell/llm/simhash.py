"""Near-duplicate texts by SimHash and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundswell.frames import materialized
from groundswell.llm.columns import SPACE, slices, text_buffers, tidy, word_spans

_BLOCK = 1 << 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    out = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _BLOCK):
        part = np.unpackbits(hashes[i:i + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += part.sum(0, dtype=np.int64)
    return out


def majority(hashes: np.ndarray) -> int:
    """SimHash of the hashes: a bit is 1 if set in over half of them."""
    return int.from_bytes(np.packbits(2 * _bits(hashes) > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(words: bytes, ends: np.ndarray, size: int, seed: int) -> int:
    """SimHash of words joined by one blank; ``ends`` is where each word ends in them."""
    from xxhash import xxh64_intdigest

    if not len(ends):
        return 0
    size = min(size, len(ends))
    begin = np.concatenate([[0], ends[:-1] + 1])
    count, total = np.zeros(64, np.int64), len(ends) - size + 1
    for i in range(0, total, _BLOCK):
        j = min(total, i + _BLOCK)
        a, b = begin[i:j].tolist(), ends[i + size - 1:j + size - 1].tolist()
        count += _bits(np.fromiter((xxh64_intdigest(words[s:e], seed) for s, e in zip(a, b)), np.uint64, j - i))
    return int.from_bytes(np.packbits(2 * count > total, bitorder="little").tobytes(), "little")


def fingerprints(
    reports: DataFrame, product_id: str = "product_id", report: str = "report", shingle: int = 3,
    seed: int = 42,
) -> DataFrame:
    """``product_id`` and the SimHash ``fingerprint`` (long) of each report's word shingles.

    A-Z are lower-cased; words are runs without ASCII white space; shingles repeat; a text of
    fewer words is one shingle; a null or wordless text has fingerprint zero.
    """
    out = reports.select(product_id).schema.add("fingerprint", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            made = np.zeros(batch.num_rows, np.uint64)
            for i, j in slices(offsets, 1 << 21):
                part = _LOWER[data[offsets[i]:offsets[j]]]
                starts, ends, row = word_spans(part, offsets[i:j + 1] - offsets[i], SPACE)
                raw = part.tobytes()
                cut = np.searchsorted(row, np.arange(j - i + 1))
                for r in range(j - i):
                    s, e = starts[cut[r]:cut[r + 1]], ends[cut[r]:cut[r + 1]]
                    words = b" ".join([raw[a:b] for a, b in zip(s.tolist(), e.tolist())])
                    made[i + r] = fingerprint(words, np.cumsum(e - s + 1) - 1, shingle, seed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made.view(np.int64))], names=out.names)

    return reports.select(product_id, F.col(report).alias("_text")).mapInArrow(tidy(run), out)


def _segments(fp: str, far: int) -> tuple[Column, Column]:
    """For both halves of a fingerprint: its table entry, and the probes of its Hamming ball.

    Two fingerprints that differ in ``far`` = 3 bits at most differ in one bit at most in one half.
    Of two halves that differ in one bit, one has a 0 there: only that one probes with the bit set.
    """
    if far > 3:
        raise ValueError("two segments with balls of radius one find up to three differing bits")
    halves = [F.col(fp).bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(fp), 32)]
    entry = F.array(*[F.struct(F.lit(s).alias("segment"), h.alias("key")) for s, h in enumerate(halves)])

    def ball(s: int, h: Column) -> Column:
        flips = [F.when(h.bitwiseAND(F.lit(1 << b)) == 0, h.bitwiseOR(F.lit(1 << b))) for b in range(32)]
        return F.transform(F.array_compact(F.array(h, *flips)),
                           lambda k: F.struct(F.lit(s).alias("segment"), k.alias("key")))

    return entry, F.concat(*[ball(s, h) for s, h in enumerate(halves)])


def links(distinct: DataFrame, far: int = 3) -> DataFrame:
    """Pairs (a, b) of different fingerprints with at most ``far`` differing bits, some of them
    more than once.  ``distinct`` has one row per fingerprint."""
    entry, probe = _segments("fingerprint", far)
    table = distinct.select(F.inline(entry), F.col("fingerprint").alias("b"))
    probes = distinct.select(F.inline(probe), F.col("fingerprint").alias("a"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= far
    return probes.join(table, ["segment", "key"]).where(near & (F.col("a") != F.col("b"))).select("a", "b")


def _tasks(spark, rows: int) -> int:
    """A task for every 20,000 rows: narrow tables are not worth one for each shuffle partition."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 20_000))


def _stored(df: DataFrame, rows: int) -> DataFrame:
    return materialized(df.coalesce(_tasks(df.sparkSession, rows)))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch of edges those that join two trees: what hangs together stays together, and a
    group in which everything is linked with everything shrinks to about its number of nodes."""
    for batch in batches:
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := up.setdefault(x, x)) != x:
                up[x] = up[y]
                x = y
            return x

        kept = []
        for a, b in zip(*(c.to_pylist() for c in batch.columns)):
            ra, rb = find(a), find(b)
            if ra != rb:
                up[ra] = rb
                kept.append((a, b))
        ends = list(zip(*kept)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(list(e), pa.int64()) for e in ends], names=["a", "b"])


def _near(both: DataFrame, labels: DataFrame) -> DataFrame:
    """Each node takes the smallest label of its neighbours and itself; ``old`` is its own so far."""
    own = F.col("a") == F.col("b")
    return both.join(labels.withColumnRenamed("fingerprint", "b"), "b").groupBy(F.col("a").alias("fingerprint")).agg(
        F.min("label").alias("label"), F.max(F.when(own, F.col("first"))).alias("first"),
        F.max(F.when(own, F.col("label"))).alias("old"))


def _jumped(near: DataFrame) -> DataFrame:
    """Each node takes the smallest label that a node whose own id its label is has found (pointer jumping)."""
    up = near.groupBy(F.col("first").alias("label")).agg(F.min("label").alias("up"))
    return near.join(up, "label").select("fingerprint", "first", F.least("label", "up").alias("label"))


def _components(nodes: DataFrame, edges: DataFrame, rows: int = 0) -> DataFrame:
    """(fingerprint, label): the smallest ``first`` reachable by edges, for nodes that have edges.

    A hop is one stored table; as labels jump in between, long chains take few hops.  It ends when
    no label is above a neighbour's.  Tables are stored hop by hop, as a plan over two hops holds the first four
    times, and the driver keeps a copy of a plan for each stage that ends.  ``rows`` is about how many nodes there are.
    """
    ends = F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ("ab", "ba", "aa", "bb")])
    edges = edges.coalesce(_tasks(nodes.sparkSession, rows)).mapInArrow(_forest, "a long, b long")
    both = _stored(edges.select(F.inline(ends)).distinct(), rows)
    labels = nodes.select("fingerprint", "first", F.col("first").alias("label"))
    while True:
        near = _stored(_near(both, labels), rows)
        if near.where("label != old").isEmpty():
            return near.select("fingerprint", "label")
        labels = _jumped(near)


def near_duplicates(
    reports: DataFrame, product_id: str = "product_id", report: str = "report", shingle: int = 3,
    seed: int = 42, far: int = 3,
) -> DataFrame:
    """Group products whose reports nearly agree.

    ``reports`` has one row per product with an orderable ``product_id`` and the ``report`` text
    (quality report or metadata JSON).  Returns per row: product_id, fingerprint (long) and
    component_id, the smallest product_id reachable over fingerprints that differ in at most
    ``far`` bits.

    Equal fingerprints are one node from the start, whatever their number, and are never
    expanded into pairs: work and shuffles follow the distinct fingerprints (34 probes each on
    average).  The number of links of one fingerprint is bounded by the ball of ``far`` bits, not by
    the group.  Repeated ids are one product with several texts.  A row without an id takes the
    component of its fingerprint, and null where no row with an id has that fingerprint.
    """
    marks = materialized(fingerprints(reports, product_id, report, shingle, seed))
    rows = marks.count()
    nodes = _stored(marks.groupBy("fingerprint").agg(F.min(product_id).alias("first")), rows)
    known = nodes.where("first is not null")
    found = _components(known, links(known, far), rows)
    groups = nodes.join(found, "fingerprint", "left").select(
        "fingerprint", F.coalesce("label", "first").alias("component_id"))
    return marks.join(groups, "fingerprint").select(product_id, "fingerprint", "component_id")


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
