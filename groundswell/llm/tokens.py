"""Token files: independent compressed frames with a seek table and per-frame checksums."""

from __future__ import annotations

import io
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundswell.frames import materialized
from groundswell.llm.columns import slices
from groundswell.llm.shared import put_file, read_file, run_folder

MAGIC = b"GSTOK1\0\0"
_FRAME = np.dtype([("offset", "<u8"), ("size", "<u4"), ("crc", "<u4"), ("docs", "<u4"),
                   ("ids", "<u8")])
_TAIL = "<QIQ8s"


#: A word of Latin letters and the punctuation behind it: the tokenizer splits them, and nothing
#: else, and takes the word in lower case.
_PLAIN = "^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[.,;:!?]*)$"
#: Bytes of text that are encoded at once; a longer text stands alone.
ENCODED_BYTES = 4 << 20


def _gathered(ids: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of items whose ids follow each other: the ids of the items ``at``, in a row, and their sizes."""
    first, n = np.cumsum(sizes) - sizes, sizes[at]
    ends = np.cumsum(n)
    return ids[np.repeat(first[at] - ends + n, n) + np.arange(n.sum())], n


class Vocabulary:
    """Ids of texts by a tokenizer file.

    The tokenizer drops white space and never joins across it, so a text's ids are the ids of its
    blank-separated chunks in a row.  Texts are split and their distinct chunks found as Arrow columns; each
    distinct word goes through the library once.  The memo is two halves of about ``memo`` / 2 items: when the
    newer is full the older goes, but for what has been in use since.  Plain words go in runs of ``run``, cut again
    where an id ends a word; any other chunk goes alone.  A special token's literal in a text is that token, as in
    the library's plain call, or ordinary text with ``literal``.
    """

    def __init__(self, path: str, memo: int = 600_000, run: int = 64, literal: bool = False):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = literal
        vocab = self.library.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[k for t, k in vocab.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.memo, self.run = memo, run

    def _learn(self, words: list[str], alone: list[str]) -> None:
        runs = [words[i:i + self.run] for i in range(0, len(words), self.run)]
        for i in range(0, len(runs), 64):
            some = runs[i:i + 64]
            for run, e in zip(some, self.library.encode_batch_fast([" ".join(r) for r in some], add_special_tokens=False)):
                ids = np.asarray(e.ids, "<u4")
                cut = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
                raw = ids.tobytes()
                self.known.update(zip(run, [raw[a:b] for a, b in zip([0, *cut], cut)], strict=True))
        for i in range(0, len(alone), 4096):
            some = alone[i:i + 4096]
            for c, e in zip(some, self.library.encode_batch_fast(some, add_special_tokens=False)):
                self.known[c] = np.asarray(e.ids, "<u4").tobytes()

    def _ids(self, items: list[str], plain: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct items in a row and how many each has; ``plain`` tells the words of letters."""
        if len(self.known) > self.memo // 2:
            self.known, self.older = {}, self.known
        known, older, words, alone = self.known, self.older, [], []
        for item, word in zip(items, plain):
            if item not in known:
                if item in older:
                    known[item] = older[item]
                else:
                    (words if word else alone).append(item)
        self._learn(words, alone)
        raw = [known[item] for item in items]
        return np.frombuffer(b"".join(raw), "<u4"), np.fromiter(map(len, raw), np.int64, len(raw)) // 4

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        chunks = split.flatten().dictionary_encode()
        parts = pc.extract_regex(chunks.dictionary, _PLAIN)
        plain = parts.is_valid().to_numpy(zero_copy_only=False)
        word = pc.coalesce(pc.utf8_lower(pc.struct_field(parts, "word")), chunks.dictionary).dictionary_encode()
        tail = pc.fill_null(pc.struct_field(parts, "tail"), "").dictionary_encode()
        of_word, of_tail = word.indices.to_numpy(), tail.indices.to_numpy()
        letters = np.zeros(len(word.dictionary) + len(tail.dictionary), bool)
        letters[of_word] = plain
        # A tail may also be a chunk of its own: the memo has it once, the row of ids twice.
        ids, sizes = self._ids(word.dictionary.to_pylist() + tail.dictionary.to_pylist(), letters.tolist())
        pair = np.stack([of_word, of_tail + len(word.dictionary)], 1)
        ids, n = _gathered(ids, sizes, pair.ravel())
        ids, n = _gathered(ids, n.reshape(-1, 2).sum(1), chunks.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        raw, cut = ids.tobytes(), (4 * ends[at]).tolist()
        return [raw[a:b] for a, b in zip(cut, cut[1:])]


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    # A task has one core; the library's own threads would only get in each other's way.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Vocabulary(path)


def pack(documents: Iterator[tuple[int, bytes]], frame_bytes: int = 1 << 18, level: int = 3) -> Iterator[bytes]:
    """A file of documents (key, raw ids), part by part: header, frames, table, tail.

    Frame: zstandard of [keys int64][lengths uint32][ids uint32].  Table: per frame its offset,
    size, CRC-32 of the compressed bytes, documents, ids before it.  Tail: the table's place,
    the number of frames, of ids, and the magic.
    """
    import zstandard

    press, at, before, table, keys, parts, size = zstandard.ZstdCompressor(level), 8, 0, [], [], [], 0

    def frame() -> bytes:
        nonlocal at, before, keys, parts, size
        body = press.compress(b"".join([
            np.array(keys, "<i8").tobytes(), np.array([len(p) // 4 for p in parts], "<u4").tobytes(), *parts]))
        table.append((at, len(body), zlib.crc32(body), len(keys), before))
        at, before = at + len(body), before + size // 4
        keys, parts, size = [], [], 0
        return body

    yield MAGIC
    for key, raw in documents:
        keys.append(key)
        parts.append(raw)
        size += len(raw)
        if size >= frame_bytes:
            yield frame()
    if keys:
        yield frame()
    yield np.array(table, _FRAME).tobytes()
    yield struct.pack(_TAIL, at, len(table), before, MAGIC)


class TokenFile:
    """Reads single frames of a file that can seek."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, io.SEEK_END)
        file.seek(size - struct.calcsize(_TAIL))
        at, n, self.n_ids, magic = struct.unpack(_TAIL, file.read(struct.calcsize(_TAIL)))
        if magic != MAGIC:
            raise ValueError("not a token file")
        file.seek(at)
        self.table = np.frombuffer(file.read(n * _FRAME.itemsize), _FRAME)

    def frame(self, k: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """(key, ids of the file before it, ids) of a frame's documents, checksum verified."""
        import zstandard

        f = self.table[k]
        self.file.seek(int(f["offset"]))
        body = self.file.read(int(f["size"]))
        if zlib.crc32(body) != f["crc"]:
            raise ValueError(f"frame {k}: checksum differs")
        raw = zstandard.ZstdDecompressor().decompress(body)
        n = int(f["docs"])
        keys, sizes = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<u4", n, 8 * n)
        ids, at = np.frombuffer(raw, "<u4", -1, 12 * n), 0
        for key, m in zip(keys.tolist(), sizes.tolist()):
            yield key, int(f["ids"]) + at, ids[at:at + m]
            at += m

    def documents(self, first: int = 0) -> Iterator[tuple[int, int, np.ndarray]]:
        for k in range(first, len(self.table)):
            yield from self.frame(k)

    def document(self, order: int) -> tuple[int, int, np.ndarray]:
        """The document at a place in the file; only its frame is decompressed."""
        ends = np.cumsum(self.table["docs"])
        k = int(np.searchsorted(ends, order, "right"))
        return list(self.frame(k))[order - int(ends[k]) + int(self.table["docs"][k])]


def write_tokens(
    reports: DataFrame, vocabulary_path: str, folder: str | None = None,
    product_id: str = "product_id", report: str = "report", end_id: int = 2,
    partitions: int | None = None,
) -> DataFrame:
    """Encode every report and write token files in ascending order of the integer product_id.

    Returns the stored list of files, in order: file, path, n_docs, n_ids, start (ids of all
    files before).  Rows are dealt out by ranges of product_id, so that files follow each other;
    rows of one id stay together, ordered by text.  A null text is empty and has only
    ``end_id``; a null id sorts first and is stored as the smallest 64-bit integer.  A task writes
    its file under a name of its own and only the winner's name is in the list, so a lost or
    repeated task does no harm.
    """
    spark = reports.sparkSession
    folder = folder or run_folder(spark, "tokens")
    rows = reports.select(F.col(product_id).cast("long").alias("k"), F.col(report).alias("t"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "k").sortWithinPartitions("k", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = vocabulary(vocabulary_path), np.array([end_id], "<u4").tobytes()
        seen = {"docs": 0, "ids": 0, "first": None}

        def documents():
            for batch in batches:
                sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
                for i, j in slices(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), ENCODED_BYTES):
                    part = batch.slice(i, j - i)
                    for key, raw in zip(part.column(0).to_pylist(), words.encode(part.column(1))):
                        key = -(1 << 63) if key is None else key
                        seen["first"] = key if seen["first"] is None else seen["first"]
                        seen["docs"] += 1
                        seen["ids"] += len(raw) // 4 + 1
                        yield key, raw + end

        path = f"{folder}/{uuid.uuid4().hex}.tok"
        put_file(path, pack(documents()))
        if seen["docs"]:
            yield pa.RecordBatch.from_pydict({
                "path": [path], "first": [seen["first"]], "n_docs": [seen["docs"]], "n_ids": [seen["ids"]]})

    files = materialized(ordered.mapInArrow(run, "path string, first long, n_docs long, n_ids long"))
    # One row per file: the running sum is over a short list.
    listed = files.orderBy("first").collect()
    start, out = 0, []
    for k, r in enumerate(listed):
        out.append((k, r["path"], r["n_docs"], r["n_ids"], start))
        start += r["n_ids"]
    return spark.createDataFrame(out, "file long, path string, n_docs long, n_ids long, start long")


def read_tokens(files: DataFrame, product_id: str = "product_id", with_ids: bool = False) -> DataFrame:
    """Documents of token files: product_id, start (ids before it in all files), n_tokens,
    ids_crc32, and the raw ids on request.  An empty list of files gives no rows."""
    schema = f"`{product_id}` long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with read_file(path) as f:
                    file = TokenFile(f)
                    for k in range(len(file.table)):
                        got = [(None if key == -(1 << 63) else key, start + at, len(ids),
                                zlib.crc32(ids.tobytes()), ids.tobytes()) for key, at, ids in file.frame(k)]
                        cols = [pa.array(list(c), t) for c, t in zip(
                            zip(*got), (*[pa.int64()] * 4, pa.binary()))][:4 + with_ids]
                        yield pa.RecordBatch.from_arrays(
                            cols, names=[product_id, "start", "n_tokens", "ids_crc32", "ids"][:4 + with_ids])

    spread = files.select("path", "start").repartition(max(1, files.count()), "path")
    return spread.mapInArrow(run, schema)
