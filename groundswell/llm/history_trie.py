"""The prefix trie of event histories, from padded id matrices in range shards.

A history is an ordered list of entries (status, message).  Equal histories are one row from the start.
Rows are split into ranges of their lexicographic order; a shard numbers its entries, lays them out
as padded matrices of ids, sorts them with ``numpy.lexsort``, and ORs the column changes between neighbours
along the row: the first change tells at which depths a node starts.  ``reduceat`` over these starts
gives every depth's nodes.  Only nodes on the path of a shard's first or last row can reach into
another shard; these leave as parts and are put together in a trie of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundswell.frames import materialized, small
from groundswell.llm.columns import tidy

#: Columns of a padded matrix, and entries of histories that a shard has on average.
COLUMNS, SHARD_ENTRIES = 16, 400_000
#: Ids of one run of a history's members.
RUN_IDS = 50_000
NO_IDS = hashlib.sha256(b"").hexdigest()
_ROOT = hashlib.blake2b(b"", digest_size=16).digest()

NODE = ("pair_id long, depth long, parent_pair_id long, n_pairs long, n_children long, n_leaves long, "
        "saved_bytes long, ends_sha256 string")
_PART = NODE + ", key binary, parent_key binary, bytes long"


def histories(events: DataFrame, pair_id: str, event_time: str, status: str, message: str) -> DataFrame:
    """(pair, seq): each pair's entries in order, an entry as two 64-bit hashes and its message's bytes."""
    status_, message_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (status, message))
    rows = events.where(F.col(pair_id).isNotNull()).select(
        F.col(pair_id).cast("long").alias("pair"), F.struct(
            F.col(event_time).alias("at"), status_.alias("s"), message_.alias("m")).alias("e"))
    return rows.groupBy("pair").agg(F.sort_array(F.collect_list("e")).alias("l")).select("pair", F.transform(
        "l", lambda e: F.struct(
            F.xxhash64(e["s"], e["m"]).alias("i"), F.xxhash64(F.lit(1), e["m"], e["s"]).alias("j"),
            F.octet_length(e["m"]).cast("long").alias("b"))).alias("seq"))


def forked(own: DataFrame, base: Column, head: Column) -> DataFrame:
    """Each history with its first ``head`` entries taken from that of ``base`` (expressions of ``pair``).

    All entries of a shorter base, none where it has no history.
    """
    placed = own.withColumns({"_base": base.cast("long"), "_head": head.cast("int")})
    bases = own.select(F.col("pair").alias("_base"), F.col("seq").alias("_from"))
    start = F.coalesce(F.slice("_from", F.lit(1), F.col("_head")), F.slice("seq", F.lit(1), F.lit(0)))
    rest = F.slice("seq", F.col("_head") + 1, F.size("seq"))
    return placed.join(bases, "_base", "left").select("pair", F.concat(start, rest).alias("seq"))


def member_digests(members: DataFrame) -> DataFrame:
    """(k1, k2, ends): SHA-256 of each history's pairs, ascending and joined by commas.

    ``members`` is (pair, k1, k2).  Ranges of pairs join their ids first; the runs of a history that
    many pairs have are then hashed in order, one at a time.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        out: list[tuple] = []

        def close() -> None:
            if ids:
                out.append((*key, ids[0], ",".join(map(str, ids)).encode()))
                ids.clear()

        for batch in batches:
            for k1, k2, pair in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if (k1, k2) != key or len(ids) >= RUN_IDS:
                    close()
                    key = (k1, k2)
                ids.append(pair)
            if len(out) >= 10_000:
                yield _batch(out, ("k1", "k2", "least", "ids"), _RUN)
                out.clear()
        close()
        yield _batch(out, ("k1", "k2", "least", "ids"), _RUN)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k1, k2, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                if (k1, k2) == key:
                    state.update(b",")
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256()
                state.update(ids.as_buffer())
            yield _batch(out, ("k1", "k2", "ends"), _END)
        if key is not None:
            yield _batch([(*key, state.hexdigest())], ("k1", "k2", "ends"), _END)

    runs = members.repartitionByRange("pair").sortWithinPartitions("k1", "k2", "pair").select("k1", "k2", "pair").mapInArrow(
        tidy(joined), "k1 long, k2 long, least long, ids binary")
    return runs.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "least").mapInArrow(
        tidy(hashed), "k1 long, k2 long, ends string")


_RUN = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_END = [pa.int64(), pa.int64(), pa.string()]


def _batch(rows: list[tuple], names: tuple[str, ...], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=list(names))


def entry_numbers(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """1, 2, ... for the distinct entries in their order; 0 is left for padding."""
    order = np.lexsort((j, i))
    new = np.ones(len(i), np.int64)
    new[1:] = (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)
    out = np.empty(len(i), np.int64)
    out[order] = np.cumsum(new)
    return out


def padded(ids: np.ndarray, begin: np.ndarray, length: np.ndarray, column: int) -> np.ndarray:
    """Matrix of the ids in columns ``column`` and following of each row, 0 beyond its end."""
    at = column + np.arange(COLUMNS)
    there = at[None, :] < length[:, None]
    return np.where(there, ids[np.minimum(begin[:, None] + at[None, :], max(len(ids) - 1, 0))], 0) if len(ids) else there * 0


def lexicographic(ids: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Order of distinct rows, block of columns by block; rows that stand alone are left out of later ones."""
    n = len(length)
    place = np.zeros(n, np.int64)
    alive = np.arange(n)
    column = 0
    while len(alive):
        matrix = padded(ids, begin[alive], length[alive], column)
        order = np.lexsort((*matrix.T[::-1], place[alive]))
        rows, matrix = alive[order], matrix[order]
        group = place[rows]
        apart = np.ones(len(rows), bool)
        apart[1:] = group[1:] != group[:-1]
        first = np.maximum.accumulate(np.where(apart, np.arange(len(rows)), 0))
        changed = apart.copy()
        changed[1:] |= (matrix[1:] != matrix[:-1]).any(1)
        at = group + np.arange(len(rows)) - first
        place[rows] = np.maximum.accumulate(np.where(changed, at, 0))
        edge = np.flatnonzero(changed)
        alone = np.diff(np.append(edge, len(rows))) == 1
        alive = rows[~np.repeat(alone, np.diff(np.append(edge, len(rows))))]
        column += COLUMNS
    return np.argsort(place, kind="stable")


def common_lengths(ids: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Entries that each row (in order) shares with the row before, -1 for the first."""
    out = np.zeros(len(length), np.int64)
    live, column = np.arange(1, len(length)), 0
    while len(live):
        a = padded(ids, begin[live - 1], length[live - 1], column)
        b = padded(ids, begin[live], length[live], column)
        changes = np.logical_or.accumulate((a != b) | (b == 0), axis=1)
        same = (~changes).sum(1)
        out[live] += same
        live = live[same == COLUMNS]
        column += COLUMNS
    out[:1] = -1
    return out


def _paths(i: np.ndarray, j: np.ndarray) -> list[bytes]:
    """Digest of each prefix of a row, from the empty one on."""
    out = [_ROOT]
    for x in np.stack([i, j], 1):
        out.append(hashlib.blake2b(out[-1] + x.tobytes(), digest_size=16).digest())
    return out


def shard_nodes(i: np.ndarray, j: np.ndarray, size: np.ndarray, begin: np.ndarray, length: np.ndarray,
                count: np.ndarray, least: np.ndarray, ends: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
    """The nodes of a shard's rows, a dict of columns for each depth from the deepest to the root.

    ``begin`` and ``length`` say where a row's entries lie in ``i``, ``j`` and ``size``; rows are distinct.
    """
    ids = entry_numbers(i, j)
    order = lexicographic(ids, begin, length)
    begin, length, count, least, ends = (x[order] for x in (begin, length, count, least, ends))
    shared = common_lengths(ids, begin, length)
    n = len(order)
    edges = [_paths(i[b:b + k], j[b:b + k]) for b, k in ((begin[0], length[0]), (begin[-1], length[-1]))]
    below = None
    for depth in range(int(length.max()), -1, -1):
        rows = np.flatnonzero(length >= depth)
        starts = np.flatnonzero(shared[rows] < depth)
        at = rows[starts]
        last = rows[np.append(starts[1:], len(rows)) - 1]
        node = {
            "depth": np.full(len(at), depth), "n_pairs": np.add.reduceat(count[rows], starts),
            "pair_id": np.minimum.reduceat(least[rows], starts),
            "bytes": size[begin[at] + depth - 1] if depth else np.zeros(len(at), np.int64),
            "ends_sha256": np.where(length[at] == depth, ends[at], None),
        }
        key = np.full(len(at), None, object)
        if depth <= length[-1] and last[-1] == n - 1:
            key[-1] = edges[1][depth]
        if depth <= length[0] and at[0] == 0:
            key[0] = edges[0][depth]
        node["key"] = key
        whole = np.array([k is None for k in key])
        children, leaves, saved = (np.zeros(len(at), np.int64) for _ in range(3))
        if below is not None:
            parent = np.searchsorted(at, below["at"], "right") - 1
            inner = below["whole"]
            for total, part in ((children, np.ones(len(parent), np.int64)), (leaves, below["n_leaves"]), (saved, below["saved_bytes"])):
                np.add.at(total, parent[inner], part[inner])
            below["parent_pair_id"] = node["pair_id"][parent]
            below["parent_key"] = key[parent]
            yield below
        node |= {
            "n_children": children, "at": at, "whole": whole,
            "n_leaves": np.where(whole & (children == 0), 1, leaves),
            "saved_bytes": saved + np.where(whole, (node["n_pairs"] - 1) * node["bytes"], 0),
        }
        below = node
    below["parent_pair_id"] = below["parent_key"] = np.full(len(below["at"]), None, object)
    yield below


_NAMES = ["pair_id", "depth", "parent_pair_id", "n_pairs", "n_children", "n_leaves", "saved_bytes", "ends_sha256",
          "key", "parent_key", "bytes"]
_TYPES = [*[pa.int64()] * 7, pa.string(), pa.binary(), pa.binary(), pa.int64()]


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (seq, count, least, ends) of one range, to nodes and parts of nodes."""
    table = pa.Table.from_batches(list(batches)).combine_chunks() if (batches := [b for b in batches if b.num_rows]) else None
    if table is None:
        return
    seq = table.column("seq").combine_chunks()
    seq = seq if isinstance(seq, pa.ListArray) else seq.chunk(0)
    flat = seq.flatten()
    length = np.diff(seq.offsets.to_numpy()).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(length)[:-1]])
    i, j, size = (flat.field(k).to_numpy() for k in range(3))
    count, least = (table.column(c).to_numpy() for c in ("count", "least"))
    ends = np.array(table.column("ends").to_pylist(), object)
    held, rows = [], 0
    for node in shard_nodes(i, j, size, begin, length, count, least, ends):
        held.append(pa.RecordBatch.from_arrays(
            [pa.array(node[c], t, from_pandas=True) for c, t in zip(_NAMES, _TYPES)], names=_NAMES))
        rows += held[-1].num_rows
        if rows > 20_000:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _recombined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged parts to whole nodes: what lies on the paths between shards is added from the deepest up."""
    parts = {r["key"]: r for b in batches for r in b.to_pylist()}
    for r in sorted(parts.values(), key=lambda r: -r["depth"]):
        r["saved_bytes"] += (r["n_pairs"] - 1) * r["bytes"]
        if not r["n_children"]:
            r["n_leaves"] = 1
        up = parts.get(r["parent_key"])
        r["parent_pair_id"] = up and up["pair_id"]
        if up:
            up["n_children"] += 1
            up["n_leaves"] += r["n_leaves"]
            up["saved_bytes"] += r["saved_bytes"]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[c] for r in parts.values()], t) for c, t in zip(_NAMES[:9], _TYPES[:9])], names=_NAMES[:9])


def history_trie(
    events: DataFrame, pair_id: str = "pair_id", event_time: str = "event_time", status: str = "status",
    message: str = "error_message", base: Column | None = None, head: Column | None = None,
) -> DataFrame:
    """Nodes of the prefix trie of the pairs' event histories.

    ``events`` has the status events of interferogram pairs: an integer ``pair_id`` (text ids of the
    catalog are numbered first), ``event_time``, ``status`` and ``error_message``.  A history is a pair's
    events by time (null first; equal times by status, then message; a null of these is empty;
    repeated rows count each).  With ``base`` and ``head`` (expressions of ``pair``) the first
    ``head`` entries of each are those of the pair ``base`` (see ``forked``): a run resumed from another.

    Each distinct sequence of a history's first d entries is a node of depth d, the empty one the root.
    Returns per node: pair_id (the smallest whose history starts with it), depth, parent_pair_id (the
    parent's pair_id, null for the root), n_pairs, n_children, n_leaves (childless nodes of its subtree,
    itself included), saved_bytes (over its subtree, a node's n_pairs - 1 times the UTF-8
    bytes of its last message) and ends_sha256 (of the pairs whose history ends here, ascending, decimal,
    joined by commas; of nothing where there are none).

    Rows without a pair are left out; an empty table has no node, not even a root.  Other columns are
    ignored.  One history is one row (24 bytes an entry), and so are equal ones; the trie on the shards' edges
    has at most two paths a shard and is added up in one task.
    """
    own = materialized(histories(events, pair_id, event_time, status, message))
    built = own if base is None else materialized(forked(own, base, head))
    keyed = built.select("pair", "seq", F.xxhash64("seq").alias("k1"), F.xxhash64(F.lit(1), "seq").alias("k2"))
    distinct = keyed.groupBy("k1", "k2").agg(
        F.count("*").alias("count"), F.min("pair").alias("least"), F.first("seq").alias("seq"))
    rows = materialized(distinct.join(member_digests(keyed.select("pair", "k1", "k2")), ["k1", "k2"]))
    entries = rows.agg(F.sum(F.size("seq") + 1)).first()[0] or 0
    shards = max(1, -(-entries // SHARD_ENTRIES))
    dealt = rows.select("seq", "count", "least", "ends").repartitionByRange(shards, "seq")
    found = materialized(dealt.mapInArrow(tidy(_shard), _PART))
    merged = found.where("key is not null").groupBy("key", "parent_key", "depth").agg(
        F.min("pair_id").alias("pair_id"), F.max("ends_sha256").alias("ends_sha256"), F.max("bytes").alias("bytes"),
        *[F.sum(c).alias(c) for c in ("n_pairs", "n_children", "n_leaves", "saved_bytes")])
    edge = materialized(merged.coalesce(1).mapInArrow(tidy(_recombined), NODE + ", key binary"))
    over = small(edge.select(F.col("key").alias("parent_key"), F.col("pair_id").alias("over")), write=False)
    inner = found.where("key is null").join(over, "parent_key", "left").withColumn(
        "parent_pair_id", F.coalesce("over", "parent_pair_id"))
    names = _NAMES[:8]
    return inner.select(*names).union(edge.select(*names)).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS)))
