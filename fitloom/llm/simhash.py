"""Near duplicates by SimHash fingerprints that meet in sharded BK-trees.

Fingerprints are computed in Arrow batches. Equal fingerprints are one node. Every node goes
to a few shards, chosen by bits of its fingerprint: two nodes within the radius share at
least one shard. A shard is searched through a BK-tree, whose children are keyed by their
integer Hamming distance to the parent, so that a search with radius r follows only the
edges d-r to d+r. A shard above ``TREE_NODES`` is cut into pieces: one tree for each piece,
handed to the tasks that hold the other pieces, so no task ever holds more than two pieces.
Inside a task, links are merged at once and leave it as a star, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitloom.llm.components import connected_components
from fitloom.session import materialise

#: Most nodes in one BK-tree; a bound on the memory of a task, not on what is compared.
TREE_NODES = 4096
#: Up to so many nodes a tree of Python integers is faster than one of arrays.
SMALL_TREE = 48
#: Jaccard similarity of near copies in the pipeline, as a fraction.
SIMILAR = (4, 5)
#: Least hashes of a set, of which sets that are compared share one.
LEAST = 16
#: Most sets, and most hashes besides one set, in a piece of a group; a bound on the memory of
#: a task, not on what is compared.
PIECE_SETS, PIECE_HASHES = 256, 1 << 19
#: Ids of texts, or shingles of sets, that are broadcast, after a count of their bytes.
BROADCAST_BYTES = 16 << 20
#: Rounds in which a group of several pieces meets a set of its own before what is left meets all.
ROUNDS = 1

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every word shingle of the lower-cased text, repeats included.

    Only A-Z are lowered; words end at space and \\x09-\\x0D. Texts with fewer words give
    one shingle of all of them, texts without words none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[i:j], 42) for i, j in spans), np.uint64, len(words) - size + 1)


def _remixed(hashes: np.ndarray, round_: int) -> np.ndarray:
    """Independent 64-bit values of the same shingles, for fingerprints of several words."""
    if round_ == 0:
        return hashes
    with np.errstate(over="ignore"):
        z = hashes + np.uint64((round_ * 0x9E3779B97F4A7C15) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprint(text: str | None, size: int = 3, words: int = 1, repeats: bool = True) -> bytes:
    """``words`` times 64 bits, big-endian; a bit is 1 if set in over half of the hashes.

    Without ``repeats`` a shingle counts once, as in a Jaccard similarity.
    """
    hashes = shingle_hashes(text, size)
    return _majority(hashes if repeats else np.unique(hashes), words)


def _majority(hashes: np.ndarray, words: int) -> bytes:
    out = b""
    for k in range(words):
        parts = _remixed(hashes, k).astype("<u8").view(np.uint8).reshape(-1, 8)
        ones = np.concatenate([np.bincount(parts[:, i], minlength=256) @ _BITS for i in range(8)])
        value = np.packbits((ones * 2 > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0]
        out += int(value).to_bytes(8, "big")
    return out


def fingerprints(
    docs: DataFrame, size: int = 3, words: int = 1, repeats: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, fp)`` for every row; a null text has the all-zero fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), size, words, repeats) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.binary())], ["doc_id", "fp"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fp binary")


def pigeonhole_shards(radius: int, blocks: int) -> Callable[[np.ndarray], np.ndarray]:
    """Exact shards for 64-bit fingerprints: one for each choice of ``blocks - radius`` equal blocks.

    At most ``radius`` differing bits touch at most ``radius`` blocks, so the others agree.
    """
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in kept) for kept in combinations(range(blocks), blocks - radius)]

    def keys(fps: np.ndarray) -> np.ndarray:
        return np.stack([fps[:, 0] & np.uint64(m) for m in masks], axis=1)

    return keys


def _words(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), ">u8").reshape(len(values), -1).astype(np.uint64)


def _in_shards(fps: DataFrame, shards: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = shards(_words(batch.column(0).to_pylist()))
            rows = np.repeat(np.arange(batch.num_rows), keys.shape[1])
            table = np.tile(np.arange(keys.shape[1], dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(table), pa.array(keys.ravel().view(np.int64)), batch.column(0).take(pa.array(rows))],
                ["shard", "key", "fp"],
            )

    return fps.select("fp").mapInArrow(run, "shard int, key long, fp binary")


class BKTree:
    """Children keyed by their integer Hamming distance to the parent."""

    def __init__(self, values: list[int]) -> None:
        self.values = values
        self.kids: list[dict[int, int]] = [{} for _ in values]
        for i in range(1, len(values)):
            at, value = 0, values[i]
            while True:
                d = (values[at] ^ value).bit_count()
                nxt = self.kids[at].setdefault(d, i)
                if nxt == i:
                    break
                at = nxt

    def search(self, value: int, radius: int) -> Iterator[int]:
        """Indices of all values within the radius."""
        stack = [0] if self.values else []
        while stack:
            at = stack.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                yield at
            for e, kid in self.kids[at].items():
                if d - radius <= e <= d + radius:
                    stack.append(kid)

    def search_all(self, nodes: np.ndarray, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """The same for many queries at once: each tree node with the queries it links to."""
        stack = [(0, np.arange(len(queries)))]
        while stack:
            at, active = stack.pop()
            d = np.bitwise_count(queries[active] ^ nodes[at]).sum(axis=1, dtype=np.int64)
            order = np.argsort(d, kind="stable")
            d, active = d[order], active[order]
            hits = active[: np.searchsorted(d, radius, "right")]
            if len(hits):
                yield at, hits
            if self.kids[at]:
                edges = np.fromiter(self.kids[at], np.int64)
                lows, highs = np.searchsorted(d, edges - radius, "left"), np.searchsorted(d, edges + radius, "right")
                for kid, i, j in zip(self.kids[at].values(), lows.tolist(), highs.tolist(), strict=True):
                    if j > i:
                        stack.append((kid, active[i:j]))


def _stars(members: list[bytes], n_tree: int, radius: int) -> list[tuple[bytes, bytes]]:
    """Links of one block as stars: the first ``n_tree`` members are the tree, the others query it.

    Without others the tree queries itself.
    """
    n = len(members)
    if n <= SMALL_TREE:
        values = [int.from_bytes(m, "big") for m in members]
        tree, root = BKTree(values[:n_tree]), list(range(n))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for q in range(n_tree if n_tree < n else 0, n):
            for at in tree.search(values[q], radius):
                a, b = find(at), find(q)
                if a != b:
                    root[max(a, b)] = min(a, b)
        label = [find(i) for i in range(n)]
    else:
        words = _words(members)
        tree = BKTree([int.from_bytes(m, "big") for m in members[:n_tree]])
        first = n_tree if n_tree < n else 0
        label_ = np.arange(n)
        for at, hits in tree.search_all(words[:n_tree], words[first:], radius):
            met = label_[hits + first]
            if (met != label_[at]).any():
                met = np.unique(np.append(met, label_[at]))
                label_[np.isin(label_, met)] = met[0]
        label = label_.tolist()
    least: dict[int, bytes] = {}
    for m, r in zip(members, label, strict=True):
        least[r] = min(least.get(r, m), m)
    return [(m, least[r]) for m, r in zip(members, label, strict=True) if m != least[r]]


def linked(fps: DataFrame, shards: Callable[[np.ndarray], np.ndarray], radius: int) -> DataFrame:
    """Links ``(a, b)`` between the distinct fingerprints of ``fps`` that keep every connection
    by ``radius`` or fewer differing bits within a shared shard."""
    return _linked(materialise(_in_shards(fps, shards), "simhash-shards"), radius)


def _linked(keyed: DataFrame, radius: int) -> DataFrame:
    """The same for shards given as ``(shard, key, fp)``."""
    sizes = keyed.groupBy("shard", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pieces = F.ceil(F.col("n") / TREE_NODES).cast("int")
    placed = keyed.join(sizes, ["shard", "key"]).select(
        "shard", "key", "fp", pieces.alias("pieces"), F.pmod(F.xxhash64("fp", "shard"), pieces).cast("int").alias("piece")
    )
    # a piece meets itself and every other piece once: in block (i, j) with i <= j
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    blocks = placed.select("*", other.alias("other")).select(
        "shard", "key", "fp", "piece", F.least("piece", "other").alias("i"), F.greatest("piece", "other").alias("j")
    )
    blocks = blocks.repartition("shard", "key", "i", "j").groupBy("shard", "key", "i", "j")
    blocks = blocks.agg(F.collect_list(F.struct((F.col("piece") != F.col("i")).alias("late"), "fp")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[bytes, bytes]] = []
            for row in batch.column(0):
                values = row.values
                late, members = values.field("late").to_pylist(), values.field("fp").to_pylist()
                tree = [m for m, x in zip(members, late, strict=True) if not x]
                rest = [m for m, x in zip(members, late, strict=True) if x]
                if len(tree) + len(rest) > 1 and tree:
                    out += _stars(tree + rest, len(tree), radius)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], ["a", "b"])

    return blocks.select("m").mapInArrow(run, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    size: int = 3,
    words: int = 1,
    radius: int = 3,
    shards: Callable[[np.ndarray], np.ndarray] | None = None,
    repeats: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    ``fingerprint`` is lowercase hex; ``component_id`` the smallest ``doc_id`` reachable over
    links of ``radius`` or fewer differing bits. Rows that repeat come back as often. Null and
    empty texts share the zero fingerprint and are linked like any other; rows with a null id
    are linked too but never name a component. An empty table gives an empty table.
    """
    known = materialise(fingerprints(docs, size, words, repeats, id_col, text_col), "simhash")
    nodes = materialise(known.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    links = linked(nodes, shards or pigeonhole_shards(radius, radius + 2), radius)
    roots = connected_components(links, "simhash-links")
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = materialise(named, "simhash-roots")
    # written, so that the join with the many members of one root stands alone and can be split
    lowest = materialise(named.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-lowest")
    component = named.join(lowest, "root").select("fp", "component_id")
    out = known.join(component, "fp")
    return out.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def _sets(docs: DataFrame, size: int, words: int) -> DataFrame:
    """``(doc_id, text_hash, fp, set, n, least)`` for every row: the fingerprint and a digest of
    the set of shingles, its size and its ``LEAST`` least hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, digests, sizes, least = [], [], [], []
            for t in batch.column(1):
                hashes = np.unique(shingle_hashes(t.as_py(), size))
                fps.append(_majority(hashes, words))
                digests.append(_digest(hashes))
                sizes.append(len(hashes))
                least.append(hashes[:LEAST].view(np.int64))
            columns = [batch.column(0), batch.column(2), pa.array(fps, pa.binary()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(least, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp", "set", "n", "least"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash"))
    return narrow.mapInArrow(run, "doc_id long, text_hash long, fp binary, set binary, n long, least array<long>")


def _digest(hashes: np.ndarray) -> bytes:
    return blake2b(hashes.astype("<u8").tobytes(), digest_size=16).digest()


def _shingles(docs: DataFrame, size: int) -> DataFrame:
    """``(set, shingles)``: the sorted hashes of every row as bytes, behind their digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                sets = [np.unique(shingle_hashes(t.as_py(), size)) for t in batch.column(0)[at : at + 64]]
                columns = [pa.array([_digest(x) for x in sets], pa.binary()), pa.array([x.astype("<u8").tobytes() for x in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["set", "shingles"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "set binary, shingles binary")


def similar_stars(names: list[bytes], sets: list[np.ndarray], n_tree: int) -> list[tuple[bytes, bytes]]:
    """Stars of the pairs whose sets have a Jaccard similarity of ``SIMILAR`` or more.

    The first ``n_tree`` sets are an inverted index, which the others query; without others
    it queries itself. Shared hashes are counted, so nothing is estimated.
    """
    n, sizes = len(sets), np.array([len(x) for x in sets], np.int64)
    codes, owner = np.concatenate(sets[:n_tree]), np.repeat(np.arange(n_tree), sizes[:n_tree])
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    label = np.arange(n)
    for q in range(n_tree if n_tree < n else 0, n):
        lows, highs = np.searchsorted(codes, sets[q], "left"), np.searchsorted(codes, sets[q], "right")
        counts = highs - lows
        at = np.repeat(highs - np.cumsum(counts), counts) + np.arange(counts.sum())
        both = np.bincount(owner[at], minlength=n_tree)
        hits = np.flatnonzero((both > 0) & (both * SIMILAR[1] >= (sizes[:n_tree] + sizes[q] - both) * SIMILAR[0]))
        met = np.unique(label[np.append(hits, q)])
        if len(met) > 1:
            label[np.isin(label, met)] = met[0]
    least: dict[int, bytes] = {}
    for m, r in zip(names, label.tolist(), strict=True):
        least[r] = min(least.get(r, m), m)
    return [(m, least[r]) for m, r in zip(names, label.tolist(), strict=True) if m != least[r]]


def _compared(blocks: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of all blocks of ``(root, i, j, late, set, shingles)``: within a block the
    late sets meet the others; without late ones the others meet each other."""
    blocks = blocks.repartition("root", "i", "j").groupBy("root", "i", "j")
    blocks = blocks.agg(F.collect_list(F.struct("late", "set", "shingles")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[bytes, bytes]] = []
            for row in batch.column(0):
                members = sorted(zip(*(row.values.field(k).to_pylist() for k in ("late", "set", "shingles")), strict=True), key=lambda m: m[0])
                n_tree = sum(not m[0] for m in members)
                if len(members) > 1 and n_tree:
                    out += similar_stars([m[1] for m in members], [np.frombuffer(m[2], "<u8") for m in members], n_tree)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], ["a", "b"])

    return blocks.select("m").mapInArrow(run, "a binary, b binary")


def _met(sets: DataFrame, pivots: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between ``pivots(root, pivot, pivot_n, pivot_shingles)`` and all similar
    ``sets(root, set, n, shingles)`` of their groups. Pivots of a counted size are broadcast, so
    that no set moves."""
    size = pivots.agg(F.sum(F.octet_length("pivot_shingles"))).first()[0] or 0
    near = f"n * {SIMILAR[1]} >= pivot_n * {SIMILAR[0]} and pivot_n * {SIMILAR[1]} >= n * {SIMILAR[0]} and set != pivot"
    rows = sets.join(F.broadcast(pivots) if size <= BROADCAST_BYTES else pivots, "root").where(near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for name, pivot, own, other in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    a, b = np.frombuffer(own, "<u8"), np.frombuffer(other, "<u8")
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if both * SIMILAR[1] >= (len(a) + len(b) - both) * SIMILAR[0]:
                        out.append((name, pivot))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], ["a", "b"])

    return rows.select("set", "pivot", "shingles", "pivot_shingles").mapInArrow(run, "a binary, b binary")


def _near(placed: DataFrame, radius: int) -> DataFrame:
    """The rows ``(root, i, j, late, set)`` of blocks of ``(…, fp, n)`` that have a set of the other
    kind within the radius and of a size that can be similar: only their shingles move."""
    blocks = placed.repartition("root", "i", "j").groupBy("root", "i", "j")
    blocks = blocks.agg(F.collect_list(F.struct("late", "set", "fp", "n")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for root, i, j, row in zip(*(batch.column(k) for k in range(4)), strict=True):
                late, names, fps, n = (row.values.field(k).to_pylist() for k in ("late", "set", "fp", "n"))
                late, n = np.array(late, bool), np.array(n, np.int64)
                if late.all() or not late.any():
                    continue
                words, names_ = _words(fps), np.array(names, object)
                a, b = np.flatnonzero(~late), np.flatnonzero(late)
                far = np.stack([np.bitwise_count(words[b] ^ words[x]).sum(axis=1, dtype=np.int64) for x in a])
                small, large = np.minimum(n[a][:, None], n[b]), np.maximum(n[a][:, None], n[b])
                near = (far <= radius) & (small * SIMILAR[1] >= large * SIMILAR[0]) & (names_[a][:, None] != names_[b])
                for k in [*a[near.any(axis=1)], *b[near.any(axis=0)]]:
                    for column, value in zip(out, (root.as_py(), i.as_py(), j.as_py(), bool(late[k]), names[k]), strict=True):
                        column.append(value)
            kinds = [pa.binary(), pa.string(), pa.string(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["root", "i", "j", "late", "set"])

    return blocks.select("root", "i", "j", "m").mapInArrow(run, "root binary, i string, j string, late boolean, set binary")


def _placed(members: DataFrame, rest: DataFrame) -> DataFrame:
    """Blocks in which the sets of ``rest(root, set, n)`` meet all of ``members(root, set, n)``.

    Sets are put into classes of sizes, each a quarter up: similar ones are in the same or in
    neighbouring classes. A class is cut into pieces, and a block is a piece of either table.
    """
    step = 1.0001 * SIMILAR[1] / SIMILAR[0]  # so that no rounding parts two that are similar
    cut: dict[str, DataFrame] = {}
    for name, table in (("rest", rest), ("all", members)):
        sized = table.withColumn("class", F.floor(F.log(step, F.col("n"))).cast("int"))
        many = sized.groupBy("root", "class").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("hashes"))
        pieces = F.greatest(F.ceil(F.col("sets") / PIECE_SETS), F.ceil(F.col("hashes") / PIECE_HASHES)).cast("int")
        cut[f"{name} pieces"] = many.select("root", "class", pieces.alias("pieces"))
        cut[name] = sized.join(cut[f"{name} pieces"], ["root", "class"])
    number = F.concat_ws(":", "class", F.pmod(F.xxhash64("set"), F.col("pieces")))
    sides = []
    for own, other, late in (("rest", "all", False), ("all", "rest", True)):
        near = cut[f"{other} pieces"].select("root", F.explode(F.array(*[F.col("class") + d for d in (-1, 0, 1)])).alias("class"), F.col("class").alias("met"), F.col("pieces").alias("met_pieces"))
        met = cut[own].join(near, ["root", "class"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("met_pieces") - 1)))
        met = met.select("root", "set", number.alias("own"), F.concat_ws(":", "met", "other").alias("other"))
        sides.append(met.select("root", *[F.col(c).alias(k) for k, c in zip("ij", ("other", "own") if late else ("own", "other"), strict=True)], F.lit(late).alias("late"), "set"))
    return sides[0].union(sides[1])


def similar(docs: DataFrame, nodes: DataFrame, size: int, radius: int) -> DataFrame:
    """Links ``(a, b)`` between the sets of ``nodes(nid, set, first, fp, n, least)`` that keep every
    connection by a Jaccard similarity of ``SIMILAR`` or more.

    Sets that share one of their least hashes and whose fingerprints are within the radius
    only form loose groups. A group of one piece is compared at once. Of a larger one, all sets
    meet the least set that is linked to none so far, a few times over: no set moves, and most
    near copies are connected then. What lies outside the largest part of its
    group meets the whole group, piece by piece.
    """
    keys = nodes.select("nid", F.explode("least").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1").select("key")
    keyed = keys.join(shared, "key").join(nodes.select("nid", "fp"), "nid").select(F.lit(0).alias("shard"), "key", "fp").distinct()
    loose = connected_components(_linked(materialise(keyed, "simhash-shards"), radius), "simhash-loose")
    named = nodes.where("n > 0").join(loose, nodes.fp == loose.node, "left").select("set", "first", "fp", "n", F.coalesce("root", "fp").alias("root"))
    named = materialise(named, "simhash-groups")
    groups = named.groupBy("root").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("hashes")).where("sets > 1")
    large = (F.col("sets") > PIECE_SETS) | (F.col("hashes") > PIECE_HASHES)
    members = materialise(named.join(groups.select("root", large.alias("large")), "root"), "simhash-members")
    wanted = materialise(members.select(F.col("first").alias("_first")).distinct(), "simhash-wanted")
    if wanted.count() * 16 <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, F.expr("doc_id <=> _first"), "left_semi")
    sets = _shingles(texts, size).dropDuplicates(["set"]).join(members.drop("first", "fp"), "set")
    sets = materialise(sets.select("root", "large", "n", "set", "shingles"), "simhash-sets")
    whole = sets.where("not large").select("root", F.lit("").alias("i"), F.lit("").alias("j"), F.lit(False).alias("late"), "set", "shingles")
    links = materialise(_compared(whole), "simhash-similar")
    sets = sets.where("large").drop("large")
    members = materialise(members.where("large").select("root", "set", "fp", "n"), "simhash-large")
    if members.isEmpty():
        return links
    alone = members
    for _ in range(ROUNDS):
        chosen = alone.groupBy("root").agg(F.min("set").alias("pivot"))
        pivots = sets.join(chosen, (sets.set == chosen.pivot) & (sets.root == chosen.root), "left_semi")
        pivots = materialise(pivots.select("root", F.col("set").alias("pivot"), F.col("n").alias("pivot_n"), F.col("shingles").alias("pivot_shingles")), "simhash-pivots")
        found = materialise(_met(sets, pivots), "simhash-stars")
        links = links.union(found)
        linked_ = found.select(F.explode(F.array("a", "b")).alias("set")).union(pivots.select("pivot")).distinct()
        alone = materialise(alone.join(linked_, "set", "left_anti"), "simhash-alone")
        if alone.isEmpty():
            break
    # components so far; the sets outside the largest of a group meet the group
    roots = connected_components(links, "simhash-parts").withColumnsRenamed({"node": "set", "root": "part"})
    parted = materialise(members.join(roots, "set", "left").withColumn("part", F.coalesce("part", "set")), "simhash-parted")
    main = parted.groupBy("root", "part").agg(F.count(F.lit(1)).alias("sets")).groupBy("root").agg(F.max(F.struct("sets", "part")).alias("x"))
    rest = materialise(parted.join(main.select("root", F.col("x.part").alias("main")), "root").where("part != main").select("root", "set", "n"), "simhash-rest")
    if rest.isEmpty():
        return links
    open_ = members.join(rest.select("root").distinct(), "root", "left_semi")
    near = _near(_placed(open_, rest).join(members.select("set", "fp", "n"), "set"), radius)
    blocks = materialise(near, "simhash-near").join(sets.select("set", "shingles"), "set")
    return links.union(materialise(_compared(blocks.select("root", "i", "j", "late", "set", "shingles")), "simhash-late"))


def keep_one_of_each(docs: DataFrame, size: int = 5, words: int = 6, radius: int = 118) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group, the smallest ``doc_id`` stays.

    Groups are connected by pairs whose sets of shingles of ``size`` words have a Jaccard
    similarity of 0.8 or more, compared exactly. Candidates share one of the 16 least hashes
    (such a pair doesn't with a chance below 0.2 to the 16th) and differ in at most ``radius``
    of ``words`` times 64 bits: the worst such pair, sets of 4 and 5, in 72 with a deviation
    of 7.7, so ``radius`` adds six. Rows go by their own text: of the rows of one id in a group
    that it names, the one of least text hash, then of least columns, stays. Rows without an
    id stay. Null, empty and blank texts have the same, empty set: they are copies of each other.
    A very long text is one set, in a piece of its own if need be; columns besides ``doc_id``
    and ``text`` may have any names. An empty table gives an empty table.
    """
    known = materialise(_sets(docs, size, words), "simhash")
    nodes = known.groupBy("set").agg(F.min("doc_id").alias("first"), *[F.first(c).alias(c) for c in ("fp", "n", "least")])
    nodes = materialise(nodes.withColumn("nid", F.monotonically_increasing_id()), "simhash-nodes")
    roots = connected_components(similar(docs, nodes, size, radius), "simhash-links")
    named = nodes.join(roots, nodes.set == roots.node, "left").select("set", "first", F.coalesce("root", "set").alias("root"))
    named = materialise(named, "simhash-roots")
    lowest = materialise(named.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-lowest")
    component = named.join(lowest, "root").select("set", "root", "component_id")
    rows = known.where("doc_id is not null").select("doc_id", "text_hash", "set").join(component, "set")
    rows = rows.groupBy("doc_id", "root", "component_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    rows = materialise(rows, "simhash-rows")
    least = rows.where("component_id = doc_id").groupBy("doc_id", "root").agg(F.min(F.struct("text_hash", "n")).alias("stays"))
    stay = materialise(least.select("doc_id", "stays.*"), "simhash-stay")
    gone = materialise(rows.join(stay, ["doc_id", "text_hash"], "left_anti").select("doc_id", "text_hash"), "simhash-gone")
    if gone.count() * 32 <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    named = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    rest = named.join(gone, ["doc_id", "text_hash"], "left_anti")
    twice = materialise(stay.where("n > 1").select("doc_id", "text_hash"), "simhash-twice")
    if not twice.isEmpty():
        again = rest.join(twice, ["doc_id", "text_hash"], "left_semi").groupBy("doc_id", "text_hash").agg(F.min("doc").alias("doc"))
        once = rest.join(twice, ["doc_id", "text_hash"], "left_anti")
        rest = once.select("doc").union(again.select("doc"))
    return rest.select("doc.*")
