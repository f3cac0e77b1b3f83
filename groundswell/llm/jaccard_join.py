"""Exact self-join of texts on the Jaccard similarity of their word shingles, by adaptive multi-match prefixes.

Tokens (shingles) have one order for all texts: those that make up a noticeable share of the corpus
last, by count, all others first, by hash.  Of a set of n tokens, a partner at similarity ``least`` or
more shares at least a = ceil(least * n) tokens, so the two prefixes of n - a + m tokens share at least
m of them.  Each text takes the m from 1 to LEVELS that its posting lists make cheapest: a longer prefix
reads more of them, but a candidate must then be found m times before it is verified.

Equal sets are one node from the start.  Sets that agree in most of their rare tokens form a family
around the member that holds the most common ones; the pairs of a family are compared in blocks of
bounded size, which only return a forest of links.  So a large group of near copies never becomes pairs.

With a limit on differing bits, SimHash fingerprints of the sets link nodes first, by multi-index hashing; each
such link is verified on whole sets, and what they hold together is compared no more.  The prefixes then find the links
between different such groups, whose fingerprints differ in more bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundswell.frames import materialized, settled, short_batches
from groundswell.llm import simhash
from groundswell.llm.columns import SPACE, mix, slices, text_buffers, tidy, word_hashes, word_spans
from groundswell.llm.simhash import _LOWER, _components, _forest, _tasks

#: Longest extension of a prefix that is weighed.
LEVELS = 4
#: A token with this share of all tokens is ordered by count; there are at most 1 / HEAVY of them.
HEAVY = 1e-6
#: So many tokens of a task are counted at once, whatever the size of its batches.
COUNTED = 1 << 21
#: Members and bytes of sets of one block of a family.
BLOCK_ROWS, BLOCK_BYTES = 1024, 16 << 20
#: So many nodes (40 bytes each) are broadcast to the scan that fetches their texts; more are joined by shuffle.
_BROADCAST = 500_000
#: Columns of a block's membership matrix that are multiplied at once.
_COLUMNS = 2048
#: Rows of that matrix whose similarities are worked out at once.
_ROWS = 128
_PLACE = np.random.default_rng(42).integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles of ``size`` words.

    A-Z are lower-cased; words are runs without ASCII white space; a text of fewer words is one shingle.
    """
    data, offsets = text_buffers(column)
    for i, j in slices(offsets, 1 << 21):
        part = _LOWER[data[offsets[i]:offsets[j]]]
        starts, ends, row = word_spans(part, offsets[i:j + 1] - offsets[i], SPACE)
        hashes = word_hashes(part, starts, ends)
        cut = np.searchsorted(row, np.arange(j - i + 1))
        for r in range(j - i):
            w = hashes[cut[r]:cut[r + 1]]
            k = min(size, len(w))
            if not k:
                yield w
                continue
            n = len(w) - k + 1
            h = np.zeros(n, np.uint64)
            for p in range(k):
                h += w[p:p + n] * _PLACE[p]
            yield np.unique(mix(h))


def several(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that more than one of the sets has, sorted, and in how many."""
    tokens = np.concatenate(sets)
    tokens.sort()
    token, n = np.unique(tokens[1:][tokens[1:] == tokens[:-1]], return_counts=True)
    return token, n + 1


def token_counts(reports: DataFrame, report: str, shingle: int) -> DataFrame:
    """(token, n): of every COUNTED tokens of a task those that more than one of the texts have, summed; and the
    number of all tokens under a null token."""

    def counted(found: list[np.ndarray]) -> pa.RecordBatch:
        token, n = several(found)
        total = sum(map(len, found))
        found.clear()
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(token.view(np.int64)), pa.nulls(1, pa.int64())]),
             pa.array(np.append(n, total))], names=["token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            for s in shingle_sets(batch.column(0), shingle):
                if len(s):
                    found.append(s)
                    held += len(s)
                if held >= COUNTED:
                    yield counted(found)
                    held = 0
        if found:
            yield counted(found)

    return reports.select(report).mapInArrow(tidy(run), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def heavy_tokens(reports: DataFrame, report: str, shingle: int, share: float = HEAVY) -> tuple[np.ndarray, np.ndarray]:
    """Tokens with at least ``share`` of all tokens, sorted, and the rank of each by count.

    At most 1 / share of them.  The order only has to be the same for all texts: a token counted
    too low, as it is alone in its batches, makes a prefix less selective and no result wrong.
    """
    counted = materialized(token_counts(reports, report, shingle))
    total = counted.where("token is null").agg(F.sum("n")).first()[0] or 0
    found = counted.where(F.col("token").isNotNull() & (F.col("n") >= max(2, share * total))).toArrow()
    token = found.column("token").to_numpy().view(np.uint64)
    n = found.column("n").to_numpy()
    rank = np.empty(len(token), np.int64)
    rank[np.lexsort((token, n))] = np.arange(len(token))
    order = np.argsort(token)
    return token[order], rank[order]


def ordered_prefix(tokens: np.ndarray, length: int, heavy: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first ``length`` of sorted tokens in the global order: the light by hash, then the heavy."""
    if not len(heavy):
        return tokens[:length]
    at = np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)
    known = heavy[at] == tokens
    light = tokens[~known]
    if len(light) >= length:
        return light[:length]
    last = at[known]
    return np.concatenate([light, tokens[known][np.argsort(rank[last])]])[:length]


def needed(n, least: int):
    """Tokens that a set of ``n`` shares with any set at least ``least`` percent similar."""
    return (least * n + 99) // 100


def marks(reports: DataFrame, product_id: str, report: str, shingle: int, least: int,
          heavy: np.ndarray, rank: np.ndarray, printed: bool = False) -> DataFrame:
    """``product_id``, ``text`` (a hash of it), ``n_shingles``, ``key`` (digest of the whole set),
    ``prefix`` (tokens in order, LEVELS - 1 more than one shared token takes) and, if ``printed``, ``fingerprint``
    (SimHash of the set)."""
    out = (reports.select(product_id).schema.add("text", "long").add("n_shingles", "long").add("key", "binary")
           .add("prefix", T.ArrayType(T.LongType())).add("fingerprint", "long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, keys, firsts, prints = [], [], [], []
            for s in shingle_sets(batch.column(2), shingle):
                n = len(s)
                size.append(n)
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                firsts.append(ordered_prefix(s, n - needed(n, least) + LEVELS, heavy, rank).view(np.int64) if n else [])
                prints.append(simhash.majority(s) if printed else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(firsts, pa.list_(pa.int64())), pa.array(prints, pa.uint64()).view(pa.int64())], names=out.names)

    text = F.coalesce(F.col(report), F.lit(""))
    return reports.select(product_id, report_hash(report).alias("_hash"), text.alias("_text")).mapInArrow(tidy(run), out)


def postings(nodes: DataFrame, least: int) -> DataFrame:
    """(token, node, n, pos, level, need, weight): entries of tokens that at least two prefixes have.

    ``level`` is the least m whose prefix holds the token, ``need`` the node's own m: the one with the
    least estimated cost of reading posting lists and verifying candidates, of which there are at
    most (entries read) / m.  ``weight`` sums the node's list lengths.
    """
    entries = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = entries.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    first = F.col("n") - F.floor((F.col("n") * least + 99) / 100)
    held = materialized(entries.join(shared, "token").select(
        "token", "node", "n", "pos", "df",
        F.greatest(F.lit(1), F.col("pos") - first + 1).cast("int").alias("level")))
    costs = []
    for m in range(1, LEVELS + 1):
        inside = F.col("level") <= m
        read = F.sum(F.when(inside, F.col("df") - 1))
        # Fewer shared tokens than m: no candidate at all.
        cost = F.when(F.count(F.when(inside, 1)) < m, 0.0).otherwise(read + F.floor(read / m) * F.max("n") / 16)
        costs.append(F.struct(cost.cast("double").alias("cost"), F.lit(m).alias("need")))
    chosen = held.groupBy("node").agg(F.least(*costs)["need"].alias("need"), F.sum("df").alias("weight"))
    return materialized(held.join(chosen, "node").select("token", "node", "n", "pos", "level", "need", "weight"))


def _meets(x: dict[str, Column], y: dict[str, Column], least: int) -> tuple[Column, Column]:
    """Whether an entry of each of two nodes counts for the pair, and how many must: the larger set says."""
    need = F.when(F.struct(x["n"], x["node"]) > F.struct(y["n"], y["node"]), x["need"]).otherwise(y["need"])
    fits = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * least
    return fits & (x["level"] <= need) & (y["level"] <= need), need


def _reaches(x: dict[str, Column], y: dict[str, Column], least: int) -> Column:
    """A common token at places i and j leaves min(i, j) tokens before it and the lesser rest after it."""
    most = F.least(x["pos"], y["pos"]) + F.least(x["n"] - x["pos"], y["n"] - y["pos"])
    return _alike(most, x["n"], y["n"], least)


def families(entries: DataFrame, least: int) -> DataFrame:
    """(node, family) of nodes in a family with others.

    Of every token the heaviest node leads.  A node follows the leader that it meets in most tokens,
    if the two are candidates and these are a quarter of its own tokens or more, and so on up to a node that
    follows nobody.  Families decide only where pairs are compared, not whether.
    """
    names = ("node", "n", "pos", "level", "need")
    leaders = entries.groupBy("token").agg(F.max(F.struct("weight", *names)).alias("lead"))
    meets, need = _meets({c: F.col(c) for c in names}, {c: F.col(f"lead.{c}") for c in names}, least)
    below = F.struct("weight", "node") < F.struct("lead.weight", "lead.node")
    met = entries.join(leaders, "token").where(below & meets).groupBy(
        "node", F.struct("lead.weight", "lead.node").alias("lead")).agg(F.count("*").alias("met"), F.first(need).alias("need"))
    own = entries.groupBy("node").agg(F.count("*").alias("own"))
    best = met.where("met >= need").groupBy("node").agg(F.max(F.struct("met", "lead")).alias("b")).join(own, "node").where(
        F.col("b.met") * 4 >= F.col("own"))
    up = materialized(best.select("node", F.col("b.lead.node").alias("family")))
    while True:
        over = up.select(F.col("node").alias("family"), F.col("family").alias("over"))
        up = materialized(up.select("node", "family").join(over, "family", "left").select(
            "node", F.coalesce("over", "family").alias("family"), F.col("over").isNotNull().alias("moved")))
        if up.where("moved").isEmpty():
            followers = up.select("node", "family")
            return followers.union(followers.select(F.col("family").alias("node"), "family").distinct())


def _alike(same, a, b, least: int):
    return same * 100 >= least * (a + b - same)


def shared_counts(sets: list[np.ndarray], rows: int) -> np.ndarray:
    """Common tokens of each of the first ``rows`` sets with each set: products of membership matrices."""
    where = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = n[column] > 1
    where, column = where[keep], column[keep]
    order = np.argsort(column, kind="stable")
    where, column = where[order], column[order]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((rows, len(sets)), np.float32)
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        i, j = np.searchsorted(column, [c, c + _COLUMNS])
        part = np.zeros((len(sets), _COLUMNS), np.float32)
        part[where[i:j], column[i:j] - c] = 1
        out += part[:rows] @ part.T
    return out.astype(np.int32)


def forest(linked: np.ndarray, rows: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph that links each of the first ``rows`` places with others."""
    total = linked.shape[1]
    seen, edges = np.zeros(total, bool), []
    for root in range(rows):
        todo = [] if seen[root] else [root]
        seen[root] = True
        while todo:
            x = todo.pop()
            near = linked[x] if x < rows else np.concatenate([linked[:, x], np.zeros(total - rows, bool)])
            new = np.flatnonzero(near & ~seen)
            seen[new] = True
            edges += [(x, y) for y in new.tolist()]
            todo += new.tolist()
    return edges


def block_links(left: list[np.ndarray], right: list[np.ndarray], least: int) -> list[tuple[int, int]]:
    """A forest of the links of left sets with one another or, if there are right sets, with those."""
    rows, sets = len(left), left + right
    size = np.array([len(s) for s in sets])
    same, linked = shared_counts(sets, rows), np.zeros((rows, len(sets)), bool)
    for i in range(0, rows, _ROWS):
        part = slice(i, min(rows, i + _ROWS))
        linked[part] = _alike(same[part].astype(np.int64), size[part, None], size[None, :], least)
    if right:
        linked[:, :rows] = False
    else:
        np.fill_diagonal(linked, False)
    return forest(linked, rows)


def family_links(members: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(a, b): links that hold together what is linked inside each family.

    ``members`` is (node, family, n), ``sets`` (node, set).  A family of many members or bytes is dealt into
    blocks, and every two blocks meet in a task of their own.
    """
    sizes = members.groupBy("family").agg(F.count("*").alias("rows"), F.sum(F.col("n") * 8).alias("bytes"))
    blocks = F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("bytes") / BLOCK_BYTES)).cast("long")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = members.join(sizes.select("family", blocks.alias("blocks")), "family").select(
        "node", "family", mine.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    placed = dealt.select("node", "family", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    parcels = placed.join(sets, "node").select(
        "family", "i", "j", (F.col("block") != F.col("i")).cast("int").alias("side"), "node", "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, ([], [])

        def settle() -> list[tuple[int, int]]:
            ids = [i for side in held for i, _ in side]
            left, right = ([s for _, s in side] for side in held)
            found = block_links(left, right, least) if left and len(ids) > 1 and (right or key[1] == key[2]) else []
            for side in held:
                side.clear()
            return [(ids[a], ids[b]) for a, b in found]

        for batch in batches:
            edges = []
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
            for k, side, node, s in zip(keys, batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5)):
                if k != key:
                    edges += settle() if key is not None else []
                    key = k
                held[side].append((node, np.frombuffer(s.as_py(), np.uint64)))
            yield _edges(edges)
        if key is not None:
            yield _edges(settle())

    keys = ["family", "i", "j"]
    return parcels.repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(tidy(run), "a long, b long")


def _edges(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = list(zip(*edges)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(list(e), pa.int64()) for e in ends], names=["a", "b"])


def fingerprint_pairs(nodes: DataFrame, far: int) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, fingerprint) whose fingerprints differ in ``far`` bits or fewer.

    A node meets the first of its own fingerprint, and firsts meet over a forest of the links of fingerprints: about
    as many pairs as nodes, however large a group is.
    """
    firsts = materialized(nodes.groupBy("fingerprint").agg(F.min("node").alias("first")))
    same = nodes.join(firsts, "fingerprint").where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    linked = simhash.links(firsts.select("fingerprint"), far).mapInArrow(_forest, "a long, b long")
    for end in "ab":
        at = firsts.select(F.col("fingerprint").alias(end), F.col("first").alias(f"_{end}"))
        linked = linked.join(at, end)
    return same.union(linked.select("_a", "_b"))


def candidates(entries: DataFrame, member_of: DataFrame, least: int, grouped: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of nodes of different families whose prefixes share as many tokens as the larger needs.

    Nodes of one group in ``grouped`` (node, group) hang together already and are no pair.
    """
    placed = entries.join(member_of, "node", "left").withColumn("family", F.coalesce("family", "node"))
    if grouped is None:
        placed = placed.withColumn("group", F.col("node"))
    else:
        placed = placed.join(grouped, "node", "left").withColumn("group", F.coalesce("group", "node"))
    live = placed.groupBy("token").agg(F.min("family").alias("u"), F.max("family").alias("v")).where("u < v").select("token")
    placed = materialized(placed.join(live, "token"))
    names = ("node", "n", "pos", "level", "need", "family", "group")
    x, y = ({c: F.col(f"{side}.{c}") for c in names} for side in "xy")
    meets, need = _meets(x, y, least)
    apart = (x["family"] != y["family"]) & (x["group"] != y["group"]) & (x["node"] < y["node"])
    met = placed.alias("x").join(placed.alias("y"), (F.col("x.token") == F.col("y.token")) & apart & meets
                                      & _reaches(x, y, least)).select(
        x["node"].alias("a"), y["node"].alias("b"), need.alias("need"))
    return met.groupBy("a", "b").agg(F.count("*").alias("met"), F.first("need").alias("need")).where(
        "met >= need").select("a", "b")


def whole_sets(reports: DataFrame, product_id: str, report: str, shingle: int, wanted: DataFrame) -> DataFrame:
    """(node, set) of the nodes in ``wanted`` (node, first, text, key), whose texts are read once more.

    Of rows that repeat id and text a task returns one; a node may come more than once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fresh = [k for k, i in enumerate(batch.column(0).to_pylist()) if i not in seen and not seen.add(i)]
            batch = batch.take(pa.array(fresh, pa.int64()))
            made = [s.tobytes() for s in shingle_sets(batch.column(2), shingle)]
            same = [hashlib.blake2b(s, digest_size=16).digest() == k.as_py() for s, k in zip(made, batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["node", "set"]).filter(
                pa.array(same, pa.bool_()))

    text = F.coalesce(F.col(report), F.lit(""))
    few = wanted.limit(_BROADCAST + 1).count() <= _BROADCAST
    own = F.col(product_id).eqNullSafe(F.col("first"))
    texts = reports.select(product_id, report_hash(report).alias("text"), text.alias("_text")).join(
        F.broadcast(wanted) if few else wanted, "text").where(own)
    return texts.select("node", "key", "_text").mapInArrow(tidy(run), "node long, set binary")


def verified(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                keep.append(bool(_alike(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), least)))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long")


def linked_reports(
    reports: DataFrame, product_id: str = "product_id", report: str = "report", shingle: int = 4, least: int = 85,
    far: int | None = None,
) -> DataFrame:
    """Group products whose reports share at least ``least`` percent of their word shingles (Jaccard).

    ``reports`` has one row per product: an integer ``product_id`` (text ids of the catalog are numbered
    first) and the ``report`` text.  A-Z are lower-cased, words are runs without ASCII white space; a
    text of fewer than ``shingle`` words is one shingle.  Returns per row: product_id, n_shingles,
    component_id, the smallest product_id reachable over links, itself included, and to tell rows
    with repeated ids apart report_hash (of the text) and group_id (of the component, null without a shingle).
    Every link is found: candidates come from prefixes that a linked pair must share, and each is verified
    on whole sets.  With ``far``, texts whose SimHash fingerprints differ in so many bits or fewer are linked
    first, if their sets are as similar; the prefixes find the rest.

    A text that is null or has no word has no shingle and is linked with nothing, not even with
    another such text.  Rows with equal sets are linked (a similarity of 1).  Repeated ids
    stand for each of their rows: a row gets the smallest id of its own text's component.  A row without an id links others
    and takes their component, null where no row with an id is in it.  An empty table gives none.

    Steps: (1) order tokens; (2) prefixes of each text, equal sets made one node; (3) posting lists
    and each node's own number of shared tokens; (4) with ``far`` links of fingerprints, verified, and what they hold
    together; (5) families and their links, in blocks; (6) pairs of different families and groups, verified; (7) components.
    """
    given, reports = product_id, reports.select(F.col(product_id).cast("long").alias("_id"), F.col(report).alias("_report"))
    product_id, report = "_id", "_report"
    spark = reports.sparkSession
    with short_batches(spark):
        heavy, rank = heavy_tokens(reports, report, shingle)
        marked = materialized(marks(reports, product_id, report, shingle, least, heavy, rank, far is not None))
        grouped = marked.where("n_shingles > 0").groupBy("key").agg(
            F.min(F.struct(F.col(product_id).isNull(), product_id, "text")).alias("one"), F.first("n_shingles").alias("n"),
            F.first("prefix").alias("prefix"), F.first("fingerprint").alias("fingerprint")).select(
            "key", F.col(f"one.{product_id}").alias("first"), F.col("one.text").alias("text"), "n", "prefix", "fingerprint")
        nodes = materialized(grouped.withColumn("node", F.monotonically_increasing_id()))
        rows = nodes.count()

        def sets_of(used: DataFrame) -> DataFrame:
            wanted = materialized(nodes.join(used, "node").select("node", "first", "text", "key"))
            return materialized(whole_sets(reports, product_id, report, shingle, wanted))

        def ends(pairs: DataFrame) -> DataFrame:
            return pairs.select(F.explode(F.array("a", "b")).alias("node"))

        def links() -> DataFrame:
            close = held = grouped = None
            if far is not None:
                close = materialized(fingerprint_pairs(nodes.select("node", "fingerprint"), far))
                near = sets_of(ends(close).distinct())
                held = materialized(verified(close, near, least))
                own = nodes.select(F.col("node").alias("fingerprint"), F.col("node").alias("first"))
                grouped = _components(own, held, rows).select(F.col("fingerprint").alias("node"), F.col("label").alias("group"))
            entries = postings(nodes.select("node", "n", "prefix"), least)
            member_of = materialized(families(entries, least))
            pairs = materialized(candidates(entries, member_of, least, grouped))
            used = member_of.select("node").union(ends(pairs)).distinct()
            members = member_of.join(nodes.select("node", "n"), "node")
            if held is None:
                sets = sets_of(used)
            else:
                sets = near.union(sets_of(used.join(ends(close).distinct(), "node", "left_anti")))
            found = family_links(members, sets, least).union(verified(pairs, sets, least))
            return (found if held is None else found.union(held)).coalesce(_tasks(spark, rows))

        edges = settled(spark, links)
        # Labels are a node's own, so that repeated ids join nothing; nodes without an id come last.
        label = F.struct(F.col("first").isNull().alias("unknown"), F.col("first").alias("id"), "node")
        known = nodes.select(F.col("node").alias("fingerprint"), label.alias("first"))
        found = settled(spark, lambda: _components(known, edges, rows))
    groups = nodes.join(found.withColumnRenamed("fingerprint", "node"), "node", "left").select(
        "key", F.when(F.col("label").isNull(), F.col("first")).otherwise(F.col("label.id")).alias("component_id"),
        F.coalesce("label.node", "node").alias("group_id"))
    hashed = F.col("text").alias("report_hash")
    some = marked.where("n_shingles > 0").join(groups, "key").select(
        product_id, "n_shingles", "component_id", hashed, "group_id")
    none = marked.where("n_shingles = 0").select(
        product_id, "n_shingles", F.col(product_id).alias("component_id"), hashed, F.lit(None).cast("long").alias("group_id"))
    return some.union(none).withColumnRenamed(product_id, given)


def report_hash(report: str) -> Column:
    """The ``report_hash`` of a column of texts; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(report), F.lit("")))
