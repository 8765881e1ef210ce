"""Byte-level BPE encoding and decoding in length-bucketed padded matrices.

A text is cut into matches of the tokenizer's pattern. Matches that are no token themselves
become rows of a matrix of token ids, padded to the width of their length bucket. In each
round every row merges its leftmost pair of least rank: the pair's rank comes from a hash
table of pairs, and the columns behind it move up by one, so the matrix shrinks with its rows.
Rows without a pair to merge leave the matrix.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of the widest row of each bucket. A longer match is a row of its own, see :func:`_long_row`.
BUCKETS = (8, 16, 32, 64, 128, 256, 512, 1024)
#: Cells of one matrix, a bound on the memory of a task.
CELLS = 1 << 20
#: Matches whose ids a worker keeps, and the most bytes of such a match.
KEPT, KEPT_BYTES = 200_000, 64
#: Matches of a text that are encoded together.
MATCHES = 50_000

NEVER = np.int32(2**31 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and number on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, file))}


class PairTable:
    """Hash table of pairs of ids: open addressing in arrays, looked up for many pairs at once.

    Every split of a token into two tokens is a pair, whose merge is the token.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.fromiter(pairs, np.uint64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        bits = max(4, int(2 * len(pairs) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, 2**64 - 1, np.uint64)
        self.values = np.full(1 << bits, NEVER, np.int32)
        self.probes, slots = 0, self._slot(keys)
        while len(keys):
            free = self.keys[slots] == np.uint64(2**64 - 1)
            _, first = np.unique(slots, return_index=True)
            first = first[free[first]]
            self.keys[slots[first]], self.values[slots[first]] = keys[first], values[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & self.mask
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * _MIX) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge; ``NEVER`` for no token and for padding, which is -1."""
        keys = left.astype(np.int64).astype(np.uint64) << np.uint64(32) | right.astype(np.int64).astype(np.uint64) & np.uint64(2**32 - 1)
        slots = self._slot(keys)
        out = np.where(self.keys[slots] == keys, self.values[slots], NEVER)
        open_ = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] != np.uint64(2**64 - 1)))
        for _ in range(self.probes):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & self.mask
            met = self.keys[slots[open_]]
            hit = met == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (met != np.uint64(2**64 - 1))]
        out[(left < 0) | (right < 0)] = NEVER
        return out


class Coder:
    """Ranks and pattern of a tokenizer, with the ids of matches met before."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for bytes {missing[:5]}")
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.pairs = PairTable(ranks)
        self.known: dict[str, bytes] = {}

    def merged(self, rows: list[bytes]) -> list[np.ndarray]:
        """The ids of every row by merges alone."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(rows)
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        bucket = np.searchsorted(BUCKETS, sizes)
        for b, width in enumerate(BUCKETS):
            mine = np.flatnonzero(bucket == b)
            step = max(1, CELLS // width)
            for at in range(0, len(mine), step):
                self._matrix(rows, sizes, mine[at : at + step], width, out)
        for i in np.flatnonzero(bucket == len(BUCKETS)).tolist():
            out[i] = self._long_row(rows[i])
        return out

    def _matrix(self, rows: list[bytes], sizes: np.ndarray, which: np.ndarray, width: int, out: list[np.ndarray]) -> None:
        own = sizes[which]
        ids = np.full((len(which), width), -1, np.int32)
        ids[np.arange(width) < own[:, None]] = self.single[np.frombuffer(b"".join([rows[i] for i in which.tolist()]), np.uint8)]
        rank = self.pairs.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(which), width - 1)
        while len(which):
            least = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(which), np.int64)
            here = np.arange(len(which))
            best = rank[here, least] if rank.shape[1] else np.full(len(which), NEVER)
            done = best == NEVER
            if done.any():
                for i, row in zip(which[done].tolist(), ids[done], strict=True):
                    out[i] = row[row >= 0]
                which, ids, rank, least, best = which[~done], ids[~done], rank[~done], least[~done], best[~done]
                here = np.arange(len(which))
            if not len(which):
                break
            # the merged pair becomes one cell, so every row loses one
            ids[here, least] = best
            keep = np.ones(ids.shape, bool)
            keep[here, least + 1] = False
            ids = ids[keep].reshape(len(which), -1)
            keep = np.ones(rank.shape, bool)
            keep[here, least] = False
            rank = rank[keep].reshape(len(which), -1)
            if rank.shape[1]:
                for side in (least - 1, least):
                    ok = np.flatnonzero((side >= 0) & (side < rank.shape[1]))
                    rank[ok, side[ok]] = self.pairs.ranks(ids[ok, side[ok]], ids[ok, side[ok] + 1])

    def _long_row(self, row: bytes) -> np.ndarray:
        """The same merges in a row beyond all buckets, whose rounds would take quadratic time:
        a heap holds the pairs by rank, then place."""
        ids = self.single[np.frombuffer(row, np.uint8)].astype(np.int64)
        rank = self.pairs.ranks(ids[:-1], ids[1:]).astype(np.int64)
        heap = [(r, i) for i, r in enumerate(rank.tolist()) if r != NEVER]
        heapq.heapify(heap)
        ids, rank = ids.tolist(), [*rank.tolist(), int(NEVER)]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        lookup, token = self.ranks.get, self.bytes

        def renew(i: int) -> None:
            j = after[i] if i >= 0 else len(ids)
            if j < len(ids):
                rank[i] = lookup(token[ids[i]] + token[ids[j]], int(NEVER))
                if rank[i] != NEVER:
                    heapq.heappush(heap, (rank[i], i))
            elif i >= 0:
                rank[i] = int(NEVER)

        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank[i] != r:
                continue
            j = after[i]
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            renew(i)
            renew(before[i])
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode(self, texts: Sequence[str | None]) -> Iterator[tuple[int, bytes]]:
        """Ids of whole texts as little-endian unsigned 32-bit integers: part by part, each with
        its text's place. A text without matches has no part."""
        held, size = [], 0
        for i, text in enumerate(texts):
            if text and len(text) < MATCHES:
                held.append((i, self.pattern.findall(text)))
                size += len(held[-1][1])
            elif text:
                found = (m.group() for m in self.pattern.finditer(text))
                while matches := list(islice(found, MATCHES)):
                    held.append((i, matches))
                    if (size := size + len(matches)) >= MATCHES:
                        yield from self._parts(held)
                        held, size = [], 0
            if size >= MATCHES:
                yield from self._parts(held)
                held, size = [], 0
        yield from self._parts(held)

    def _parts(self, held: list[tuple[int, list[str]]]) -> Iterator[tuple[int, bytes]]:
        known = self.known
        if len(known) > KEPT:
            known.clear()
        fresh = {m: m.encode("utf-8", "surrogatepass") for m in set().union(*(matches for _, matches in held)).difference(known)}
        rows = []
        for match, raw in fresh.items():
            whole = self.ranks.get(raw)
            if whole is None:
                rows.append(match)
            else:
                known[match] = whole.to_bytes(4, "little")
        for match, ids in zip(rows, self.merged([fresh[m] for m in rows]), strict=True):
            known[match] = ids.astype("<u4").tobytes()
        get = known.__getitem__
        for i, matches in held:
            yield i, b"".join(map(get, matches))
        for match in rows:
            if len(fresh[match]) > KEPT_BYTES:
                del known[match]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    """A worker's coder of a rank file that every machine has under the same path."""
    if (path, pattern) not in _CODERS:
        _CODERS.clear()
        _CODERS[path, pattern] = Coder(read_ranks(path), pattern)
    return _CODERS[path, pattern]


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)`` for every row, ``ids`` an array of longs.

    Null and empty texts give no ids. Rows that repeat come back as often, null ids
    included; an empty table gives an empty one. Whatever the columns besides are named,
    they are not read. A text is encoded by one task, part by part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                parts: list[list[bytes]] = [[] for _ in range(part.num_rows)]
                for i, ids in own.encode(part.column(1).to_pylist()):
                    parts[i].append(ids)
                ids = [np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in parts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    return _narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<long>")


def decoded(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, bytes)`` of every row of ``tokens(doc_id, ids)``; null ids give no bytes.

    An id outside the vocabulary fails.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                raw = [own.decode(np.array(x.as_py() or [], "<u4").tobytes()) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: digests of the ids of every text and
    of the bytes that they decode to. Rows as of :func:`encoded`; ids stay in their task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                counts = [0] * part.num_rows
                ids_hash, text_hash = [sha256() for _ in counts], [sha256() for _ in counts]
                for i, ids in own.encode(part.column(1).to_pylist()):
                    counts[i] += len(ids) // 4
                    ids_hash[i].update(ids)
                    text_hash[i].update(own.decode(ids))
                columns = [part.column(0), pa.array(counts, pa.int64()), *[pa.array([h.hexdigest() for h in x], pa.string()) for x in (ids_hash, text_hash)]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _narrow(docs, id_col, text_col).mapInArrow(run, schema)
