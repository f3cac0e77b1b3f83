"""Benchmark passages in texts, by one Aho-Corasick automaton over normalised items."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundswell.llm.columns import resident, slices, text_buffers, word_spans

WINDOW = 13
#: Letters in lower case, digits and all bytes beyond ASCII make words; the rest separates them.
_FOLD = np.full(256, 0x20, np.uint8)
for _a, _b, _shift in ((0x30, 0x39, 0), (0x61, 0x7A, 0), (0x41, 0x5A, 32), (0x80, 0xFF, 0)):
    _FOLD[_a:_b + 1] = np.arange(_a, _b + 1) + _shift
_GAP = np.zeros(256, bool)
_GAP[0x20] = True


def normalised(raw: bytes) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The words between single blanks, a character for a byte, with blanks at both ends; the
    place behind each word in it; and each word's first and last byte in the original."""
    folded = _FOLD[np.frombuffer(raw, np.uint8)]
    starts, ends, _ = word_spans(folded, np.array([0, len(folded)]), _GAP)
    text = b" ".join(folded.tobytes().split())
    return f" {text.decode('latin-1')} ", np.cumsum(ends - starts + 1), starts, ends


@resident
def _automaton(items: tuple[tuple[str, bytes], ...], window: int):
    """Automaton whose keys are windows; a key's value is (words, items that hold it)."""
    import ahocorasick

    found: dict[str, tuple[int, set[int]]] = {}
    for k, (_, raw) in enumerate(items):
        words = normalised(raw)[0].split()
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i:i + window]
            found.setdefault(f" {' '.join(part)} ", (len(part), set()))[1].add(k)
    machine = ahocorasick.Automaton()
    for key, (n, of) in found.items():
        machine.add_word(key, (n, tuple(of)))
    if found:
        machine.make_automaton()
    return machine if found else None


def scan(raw: bytes, machine) -> tuple[int, np.ndarray, set[int], list[tuple[int, int]]]:
    """Words of a text, a flag for each that lies in an occurrence, the items, and the spans of
    hit runs as bytes of the original text."""
    text, behind, starts, ends = normalised(raw)
    n = len(starts)
    edge, items = np.zeros(n + 1, np.int32), set()
    if machine is not None and n:
        hits = list(machine.iter(text))
        if hits:
            last = np.searchsorted(behind, np.array([e for e, _ in hits]))
            size = np.array([v[0] for _, v in hits])
            np.add.at(edge, last - size + 1, 1)
            np.add.at(edge, last + 1, -1)
            for of in {v[1] for _, v in hits}:
                items.update(of)
    hit = np.cumsum(edge[:-1]) > 0
    turn = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    spans = [(int(starts[a]), int(ends[b - 1])) for a, b in zip(turn[::2], turn[1::2])]
    return n, hit, items, spans


def _blocks(truth: DataFrame, item: str, text: str, chars: int) -> Iterator[tuple]:
    """The items in blocks of about ``chars`` characters, each for one automaton."""
    block, size = [], 0
    rows = truth.select(F.col(item).cast("string").alias("k"), F.col(text).alias("t")).where(
        "k is not null and t is not null").distinct().orderBy("k", "t")
    for r in rows.toLocalIterator():
        raw = r["t"].encode()
        if block and size + len(raw) > chars:
            yield tuple(block)
            block, size = [], 0
        block.append((r["k"], raw))
        size += len(raw)
    yield tuple(block)


def contaminated(
    reports: DataFrame, truth: DataFrame, product_id: str = "product_id", report: str = "report",
    item_id: str = "item_id", item_text: str = "text", keep: tuple[str, ...] = (),
    window: int = WINDOW, share: float = 0.05, block_chars: int = 300_000, result: str = "overlap",
) -> DataFrame:
    """Find where reports repeat the items of a held-out truth set.

    ``truth`` is the query set (questions and answers); it is taken in blocks of ``block_chars``
    characters, each small enough for one automaton (about 30 MB) and for a broadcast.  Every
    block scans each report once.  Adds to product_id and ``keep`` one struct ``result``: n_words,
    n_hit, n_items, items_sha256 (ids as strings, sorted, comma-joined), contaminated (n_hit > 0 and
    n_hit >= share * n_words) and spans (hit runs as byte ranges of the original text).

    A word lies in a hit when an occurrence of a window covers it; a window is ``window`` words of
    an item, or a shorter item whole.  A null text has no words; a null item or id of an item
    is no item; several items may share an id, which counts once.  Repeated rows are judged one
    by one.  No shuffle: each block adds one step to the same scan.
    """
    names = [product_id, *keep]
    if result in names:
        raise ValueError(f"column {result} is the result; give another name")
    kind = ("struct<n_words:bigint,n_hit:bigint,n_items:bigint,items_sha256:string,"
            "contaminated:boolean,spans:array<struct<begin:bigint,end:bigint>>>")
    blocks = list(_blocks(truth, item_id, item_text, block_chars))
    step = reports.select(*names, F.col(report).alias("_text"), F.lit(None).cast("binary").alias("_hit"),
                          F.array().cast("array<string>").alias("_items"))
    for i, block in enumerate(blocks):
        step = _scan_block(step, len(names), block, window, i == len(blocks) - 1)
    n_hit, words = F.col("_found.n_hit"), F.col("_found.n_words")
    items = F.array_sort(F.array_distinct("_found.items"))
    verdict = (n_hit > 0) & (n_hit >= F.lit(share) * words)
    if share == 0.05:
        verdict = (n_hit > 0) & (n_hit * 20 >= words)
    return step.select(*names, F.struct(
        words.alias("n_words"), n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), verdict.alias("contaminated"),
        F.col("_found.spans").alias("spans"),
    ).cast(kind).alias(result))


def _scan_block(df: DataFrame, n: int, block: tuple, window: int, last: bool) -> DataFrame:
    """Scan with one block; hits of earlier blocks arrive as packed flags in ``_hit``."""
    schema = df.schema
    if last:
        schema = df.select(*df.columns[:n]).schema.add("_found", T.StructType.fromDDL(
            "n_words bigint, n_hit bigint, items array<string>, "
            "spans array<struct<begin:bigint,end:bigint>>"))
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
    found = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()),
                       ("items", pa.list_(pa.string())), ("spans", pa.list_(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(block, window)
        for batch in batches:
            data, offsets = text_buffers(batch.column(n))
            before, known = batch.column(n + 1), batch.column(n + 2)
            rows = []
            for i, j in slices(offsets, 1 << 20):
                for r in range(i, j):
                    words, hit, of, spans = scan(data[offsets[r]:offsets[r + 1]].tobytes(), machine)
                    if before[r].is_valid:
                        hit |= np.unpackbits(np.frombuffer(before[r].as_py(), np.uint8),
                                             count=words).astype(bool)
                        spans = _spans(data[offsets[r]:offsets[r + 1]].tobytes(), hit)
                    items = sorted({*known[r].as_py(), *(block[k][0] for k in of)})
                    rows.append((words, hit, items, spans))
            if last:
                made = [pa.array([{"n_words": w, "n_hit": int(h.sum()), "items": k,
                                   "spans": [{"begin": a, "end": b} for a, b in s]}
                                  for w, h, k, s in rows], found)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], *made], names=schema.names)
            else:
                made = [pa.array([np.packbits(h).tobytes() for _, h, _, _ in rows], pa.binary()),
                        pa.array([k for _, _, k, _ in rows], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:n + 1], *made], names=schema.names)

    return df.mapInArrow(run, schema)


def _spans(raw: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    _, _, starts, ends = normalised(raw)
    turn = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [(int(starts[a]), int(ends[b - 1])) for a, b in zip(turn[::2], turn[1::2])]
