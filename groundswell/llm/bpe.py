"""Byte-level BPE of report texts by the ranks of a local file."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from groundswell.llm.columns import resident

#: A match of the split pattern never holds a blank behind a non-blank, and the pattern looks
#: ahead only inside a run of blanks: a cut before a blank that follows a non-blank is safe.
_SAFE = regex.compile(r"(?<=\S)(?=\s)")


@resident
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut at safe boundaries only."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encode(enc, text: str, size: int) -> np.ndarray:
    """Ids of a text; each part is encoded by itself, so that memory follows the part."""
    parts = [np.asarray(enc.encode_ordinary(p), np.uint32) for p in pieces(text, size)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def decode(enc, ids: np.ndarray, size: int = 1 << 16) -> bytes:
    """Raw bytes of the ids: a character may be spread over ids, so bytes are joined first."""
    return b"".join(enc.decode_bytes(ids[i:i + size].tolist()) for i in range(0, len(ids), size))


def tokenized(
    reports: DataFrame, ranks: str, pattern: str, product_id: str = "product_id",
    report: str = "report", keep: tuple[str, ...] = (), piece_chars: int = 100_000,
    with_ids: bool = False,
) -> DataFrame:
    """Encode every product's report and decode it again.

    ``reports`` has one row per product: ``product_id`` of any type and the ``report`` text (the
    quality report or metadata JSON).  ``ranks`` names a rank file that every executor can open
    (installed with the tokenizer package), ``pattern`` the regular expression that splits text
    before the merges.  Returns per row, in no order: product_id, the ``keep`` columns, n_tokens,
    ids_sha256 (over little-endian 32-bit ids), decoded_sha256, and ``ids`` (binary) on request.

    A null report is empty: no ids, the digests of nothing.  Repeated rows give repeated results;
    a null id stays null; other columns are ignored.  A long text is cut where the pattern must
    start a new match anyway, so the ids are those of the whole text.  One scan, no shuffle.
    """
    names = [product_id, *keep]
    fields = {f.name: f for f in reports.schema.fields}
    out = DataFrame.select(reports, *names).schema
    for name, kind in (("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string"),
                       *((("ids", "binary"),) if with_ids else ())):
        if name in fields and name in names:
            raise ValueError(f"column {name} is a result; rename it before")
        out = out.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for batch in batches:
            rows = []
            for text in batch.column(len(names)):
                ids = encode(enc, text.as_py() or "", piece_chars)
                raw = ids.astype("<u4").tobytes()
                rows.append((len(ids), hashlib.sha256(raw).hexdigest(),
                             hashlib.sha256(decode(enc, ids)).hexdigest(), raw))
            n, a, b, raw = zip(*rows) if rows else ((),) * 4
            made = [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            made += [pa.array(raw, pa.binary())] if with_ids else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], *made], names=out.names)

    # The text goes last under a name of its own, so that it may also be kept.
    return reports.select(*names, reports[report].alias("_text")).mapInArrow(run, out)
