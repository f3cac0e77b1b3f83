"""Repeated passages, by suffix trees partitioned by variable-length prefixes.

A suffix is the rest of a report from one word on.  Suffixes are split into groups by a prefix of
one or more words: a prefix that too many suffixes share is extended by a word until its group is
memory-sized, or until it is as long as a window.  In a group the suffixes are sorted, and a run
that agrees in ``window`` words is an internal node of the suffix tree at that depth: a repeat.
Nodes deeper than that add nothing, as the next words' own suffixes meet in a node of theirs;
together the covered words are the maximal repeats.  Edges are held as digests of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundswell.frames import materialized
from groundswell.llm.columns import mix, release, slices, text_buffers, tidy, word_hashes, word_spans

WINDOW = 13
#: Bytes of a window's digest.  Digests meet only inside a group, so that an accidental match of
#: two windows needs 2^56 / (suffixes of a group) tries: one in 10^10 suffixes.
DIGEST = 7
#: Bytes of it that go with a repeat, to tell the texts of one id apart.
CHECK = 4
#: Suffixes of one group, and bytes of text of one bucket.
GROUP_SUFFIXES, BUCKET_BYTES, CHUNK_BYTES = 2_000_000, 16 << 20, 2 << 20
_STEP = np.uint64(0xA0761D6478BD642F)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of parts of a batch (id, text): ids, the words' hashes, their rows and the rows' first words."""
    batch = batch.filter(pc.is_valid(batch.column(0)))
    ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    data, offsets = text_buffers(batch.column(1))
    for i, j in slices(offsets, CHUNK_BYTES):
        part = data[offsets[i]:offsets[j]]
        starts, ends, row = word_spans(part, offsets[i:j + 1] - offsets[i])
        yield ids[i:j], word_hashes(part, starts, ends), row, np.searchsorted(row, np.arange(j - i + 1))


def _starts(row: np.ndarray, window: int) -> np.ndarray:
    """Words at which a window of one report starts."""
    return np.flatnonzero(row[:-window + 1] == row[window - 1:]) if len(row) >= window else np.zeros(0, np.int64)


def heavy_prefixes(h: np.ndarray, at: np.ndarray, window: int, share: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, digests, counts) of the prefixes that at least ``share`` of the suffixes have."""
    least, acc = max(1.0, share * len(at)), h[at]
    for level in range(1, window):
        key = mix(acc)
        bins = (key >> np.uint64(52)).astype(np.int64)
        may = np.bincount(bins, minlength=4096)[bins] >= least
        found, count = np.unique(key[may], return_counts=True)
        found, count = found[count >= least], count[count >= least]
        if not len(found):
            return
        yield level, found, count
        keep = np.isin(key, found)
        at = at[keep]
        acc = acc[keep] * _STEP + h[at + level]


def prefix_keys(h: np.ndarray, at: np.ndarray, heavy: list[np.ndarray]) -> np.ndarray:
    """Digest of the variable-length prefix of each suffix: one word more as long as it is heavy."""
    acc = h[at]
    key = mix(acc)
    live = np.arange(len(at))
    for level, found in enumerate(heavy, 1):
        more = np.isin(key[live], found)
        live, acc = live[more], acc[more]
        if not len(live):
            break
        acc = acc * _STEP + h[at[live] + level]
        key[live] = mix(acc)
    return key


def window_digests(h: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    acc = h[at]
    for k in range(1, window):
        acc = acc * _STEP + h[at + k]
    return mix(acc) >> np.uint64(64 - 8 * DIGEST)


def _planes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes()


@lru_cache(maxsize=1)
def _zstd():
    import zstandard

    return zstandard.ZstdCompressor(1), zstandard.ZstdDecompressor()


def _packed(ids: np.ndarray, pos: np.ndarray, digest: np.ndarray, width: int = DIGEST) -> bytes:
    """Places and the lower ``width`` bytes of the digests; ids in runs cost little."""
    n = np.array([len(ids)], "<u4").tobytes()
    raw = np.ascontiguousarray(digest.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()
    return n + raw + _zstd()[0].compress(_planes(np.diff(ids, prepend=0)) + _planes(pos.astype("<u4")))


def _unpacked(raw: bytes, width: int = DIGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(raw, np.uint8, n * width, 4).reshape(n, width)
    rest = np.frombuffer(_zstd()[1].decompress(raw[4 + n * width:]), np.uint8)
    ids = np.ascontiguousarray(rest[:8 * n].reshape(8, n).T).view("<i8").ravel().cumsum()
    return ids, np.ascontiguousarray(rest[8 * n:].reshape(4, n).T).view("<u4").ravel(), wide.view("<u8").ravel()


def _by(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, places of it), the places in order."""
    order = np.argsort(key, kind="stable")
    edge = np.flatnonzero(np.diff(key[order], prepend=-1))
    for a, b in zip(edge, [*edge[1:], len(order)]):
        yield int(key[order[a]]), order[a:b]


def _bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def repeats(ids: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Flags of suffixes whose node also holds a suffix of a smaller id."""
    order = np.lexsort((ids, digest))
    d, i = digest[order], ids[order]
    first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
    out = np.zeros(len(ids), bool)
    out[order] = i > np.repeat(i[first], np.diff(np.concatenate([first, [len(d)]])))
    return out


def _rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in found], f.type) for k, f in enumerate(schema)], schema=schema)


_HITS = pa.schema([("bucket", pa.int64()), ("payload", pa.binary())])
_SUFFIXES = pa.schema([("part", pa.int64()), ("bucket", pa.int64()), ("payload", pa.binary())])


def without_repeats(
    reports: DataFrame, product_id: str = "product_id", report: str = "report",
    keep: tuple[str, ...] = (), window: int = WINDOW, result: str = "passages",
) -> DataFrame:
    """Remove passages that a product with a smaller id already has.

    ``reports`` has one row per product: an integer ``product_id`` that orders products (text ids of
    the catalog are numbered first) and the ``report`` text.  A word goes when a window of
    ``window`` words covers it whose words also start somewhere in a report with a smaller id; all
    is judged on the reports as given.  Adds to product_id and ``keep`` one struct ``result``: n_words, n_removed,
    n_passages (runs of removed words), kept_sha256 and kept, the words that stay joined by one
    blank.

    A null text has no words.  A row without an id is neither cleaned nor a source.  Rows repeated
    under an id are judged each by its own text, and do not clean each other.

    Steps: (1) count prefixes, giving the heavy ones, at most 12 per group; (2) send each suffix,
    as a packed digest and place, to the group of its prefix; (3) find the nodes of each group
    and send the repeats to the bucket of their report; (4) meet there with the texts and cut.
    Of equal windows in one chunk of 2 MB only the smallest id's is sent and the others are settled at
    once, so a passage that a third of all reports share brings one suffix per chunk to its group.
    """
    spark = reports.sparkSession
    names = [product_id, *keep]
    if result in names:
        raise ValueError(f"column {result} is the result; give another name")
    rows = reports.select(F.col(product_id).cast("long").alias("i"), F.col(report).alias("t"))
    share = 1 / (2 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, h, row, _ in _chunks(batch):
                at = _starts(row, window)
                found = [(0, 0, len(at))]
                for level, digests, counts in heavy_prefixes(h, at, window, share):
                    found += zip([level] * len(digests), digests.view(np.int64).tolist(), counts.tolist())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*found)],
                                                 names=["level", "prefix", "n"])

    counted = rows.mapInArrow(tidy(count), "level long, prefix long, n long").groupBy("level", "prefix").agg(
        F.sum("n").alias("n"))
    counted = materialized(counted)
    # At most window / share prefixes reach the share.  A prefix below it in a chunk isn't counted
    # there, so a light one has less than twice the share.
    suffixes = counted.where("level = 0").agg(F.sum("n")).first()[0] or 0
    listed = counted.where((F.col("level") > 0) & (F.col("n") >= share * suffixes)).collect()
    heavy = [np.sort(np.array([r["prefix"] for r in listed if r["level"] == level], np.int64).view(np.uint64))
             for level in range(1, window)]
    groups = max(round(1 / share), -(-suffixes // GROUP_SUFFIXES))
    buckets = max(round(0.5 / share), -(-suffixes * 6 // BUCKET_BYTES))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, h, row, first in _chunks(batch):
                at = _starts(row, window)
                if not len(at):
                    continue
                own, digest = ids[row[at]], window_digests(h, at, window)
                pos = at - first[row[at]]
                part = (prefix_keys(h, at, heavy) % np.uint64(groups)).astype(np.int64)
                settled = repeats(own, digest)
                left = np.flatnonzero(~settled)
                found = [(g, None, _packed(own[left[k]], pos[left[k]], digest[left[k]]))
                         for g, k in _by(part[left])]
                there = np.flatnonzero(settled)
                found += [(b % groups, b, _packed(own[there[k]], pos[there[k]], digest[there[k]], CHECK))
                          for b, k in _by(_bucket(own[there], buckets))]
                yield _rows(found, _SUFFIXES)

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; one group at a time is unpacked.  Repeats leave in one parcel a
        bucket, however many groups the task has had."""
        part, held, again = None, [], []

        def settle() -> None:
            if held:
                ids, pos, digest = (np.concatenate(x) for x in zip(*[_unpacked(p) for p in held]))
                found = repeats(ids, digest)
                again.append((ids[found], pos[found], digest[found]))
                held.clear()
                del ids, pos, digest, found
                release()

        def parcels() -> pa.RecordBatch:
            ids, pos, digest = (np.concatenate(x) for x in zip(*again))
            again.clear()
            order = np.lexsort((pos, ids))
            ids, pos, digest = ids[order], pos[order], digest[order]
            return _rows([(b, _packed(ids[k], pos[k], digest[k], CHECK)) for b, k in _by(_bucket(ids, buckets))], _HITS)

        for batch in batches:
            settled = []
            parts, places = (batch.column(k).to_pylist() for k in range(2))
            for g, b, cell in zip(parts, places, batch.column(2)):
                payload = cell.as_py()
                if b is not None:
                    settled.append((b, payload))
                    continue
                if g != part:
                    settle()
                    part = g
                    if sum(len(i) for i, *_ in again) > GROUP_SUFFIXES // 2:
                        yield parcels()
                held.append(payload)
            if settled:
                yield _rows(settled, _HITS)
        settle()
        if again:
            yield parcels()

    hits = rows.mapInArrow(tidy(spread), "part long, bucket long, payload binary").repartition(
        "part").sortWithinPartitions("part").mapInArrow(tidy(nodes), "bucket long, payload binary")

    given = reports.select(*names, F.col(report).alias("_text"))
    fields = T.StructType.fromDDL(
        "n_words bigint, n_removed bigint, n_passages bigint, kept_sha256 string, kept string")
    out = reports.select(*names).schema.add(result, fields)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = pc.fill_null(batch.column(0).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
            for b, k in _by(_bucket(np.where(known, ids, np.arange(len(ids))), buckets)):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                    writer.write_batch(batch.take(pa.array(k)))
                yield _rows([(b, sink.getvalue().to_pybytes())], _HITS)

    arrow = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("n_passages", pa.int64()),
                       ("kept_sha256", pa.string()), ("kept", pa.string())])

    def cut(texts: pa.Table, found: pa.Table) -> Iterator[pa.RecordBatch]:
        places = [_unpacked(p.as_py(), CHECK) for p in found.column("payload")]
        ids, pos, digest = (np.concatenate(x) for x in zip(*places)) if places else (np.zeros(0, np.int64),) * 3
        order = np.argsort(ids, kind="stable")
        ids, pos, digest = ids[order], pos[order], digest[order]
        seen: set[int] = set()
        twice = {i for payload in texts.column("payload") for batch in pa.ipc.open_stream(payload.as_py())
                 for i in batch.column(0).cast(pa.int64()).to_pylist() if i in seen or seen.add(i)}
        for payload in texts.column("payload"):
            for batch in pa.ipc.open_stream(payload.as_py()):
                data, offsets = text_buffers(batch.column(len(names)))
                own = batch.column(0).cast(pa.int64()).to_pylist()
                made = []
                for r, i in enumerate(own):
                    a, b = (0, 0) if i is None else np.searchsorted(ids, [i, i + 1])
                    text, at = data[offsets[r]:offsets[r + 1]], pos[a:b]
                    if i in twice:
                        at = at[_own(text, at, digest[a:b], window)]
                    made.append(_cleaned(text.tobytes(), at, window))
                struct = pa.StructArray.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(zip(*made), arrow)], fields=list(arrow))
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], struct], names=out.names)

    def meet(texts: pa.Table, found: pa.Table) -> pa.Table:
        done = list(cut(texts, found))
        release()
        return pa.Table.from_batches(done) if done else pa.table(
            {f.name: pa.array([], f.type) for f in _arrow_schema(out)})

    packed = given.mapInArrow(tidy(bundle), "bucket long, payload binary")
    return packed.groupBy("bucket").cogroup(hits.groupBy("bucket")).applyInArrow(meet, out)


def _own(text: np.ndarray, pos: np.ndarray, digest: np.ndarray, window: int) -> np.ndarray:
    """Flags of the places at which the text has the window of that digest: of several texts under one id,
    each keeps its own."""
    starts, ends, _ = word_spans(text, np.array([0, len(text)]))
    h = word_hashes(text, starts, ends)
    there = pos + np.int64(window) <= len(h)
    low = np.uint64((1 << (8 * CHECK)) - 1)
    there[there] = window_digests(h, pos[there].astype(np.int64), window) & low == digest[there]
    return there


def _cleaned(raw: bytes, pos: np.ndarray, window: int) -> tuple[int, int, int, str, str]:
    words = raw.translate(_BLANK).split(b" ")
    words = [w for w in words if w]
    n, gone = len(words), 0
    runs = 0
    if len(pos):
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, pos, 1)
        np.add.at(edge, pos + window, -1)
        stay = np.cumsum(edge[:-1]) == 0
        gone = n - int(stay.sum())
        runs = int((np.diff(stay.astype(np.int8), prepend=1) < 0).sum())
        words = [w for w, s in zip(words, stay.tolist()) if s]
    kept = b" ".join(words)
    return n, gone, runs, hashlib.sha256(kept).hexdigest(), kept.decode()


_BLANK = bytes(0x20 if c == 0x20 or 0x09 <= c <= 0x0D else c for c in range(256))


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
