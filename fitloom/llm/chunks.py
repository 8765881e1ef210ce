"""Repeated passages by content-defined chunking.

A gear rolling hash over the last 16 bytes cuts every text where its leading bits are zero,
so chunk borders depend on nearby bytes only and an insertion moves few of them. Chunks with
equal digests are the same text; neighbouring chunks that other documents have too make up
a repeated passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A border wherever this many leading bits of the hash are zero: one byte in 2 to that power.
BITS = 5
#: Bytes that decide on a border, a power of two.
WINDOW = 16
SHORTEST, LONGEST = 16, 256
#: Words that whole repeated chunks must cover. A repeated passage loses part of a chunk at
#: either end: of 51 words so many are left in 95 of 100 cases, of 80 words in nearly all.
LEAST_WORDS = 20
SLICE = 1 << 20

_GEAR = np.random.default_rng(9).integers(0, 1 << 32, 256, np.uint32)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Gear hash after every byte: the sum of the table entries of the last WINDOW bytes, each
    shifted left by its distance, by doubling the window again and again."""
    h, width = _GEAR[data], 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint32(width)  # the right side is read before it is written
        width *= 2
    return h


def borders(data: bytes) -> list[int]:
    """Ends of the chunks of a whole text; every chunk but the last has SHORTEST to LONGEST bytes."""
    view, marks = np.frombuffer(data, np.uint8), []
    for at in range(0, len(data), SLICE):
        start = max(0, at - WINDOW + 1)
        h = rolling_hash(view[start : at + SLICE])[at - start :]
        marks.append(np.flatnonzero(h >> np.uint32(32 - BITS) == 0) + at + 1)
    ends, last = [], 0
    for mark in np.concatenate(marks).tolist() if marks else ():
        while mark - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if mark - last >= SHORTEST:
            last = mark
            ends.append(last)
    while len(data) - last > LONGEST:
        last += LONGEST
        ends.append(last)
    if last < len(data):
        ends.append(len(data))
    return ends


def chunk_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, row, start, size, words, d1, d2)``: the chunks of every row, in bytes of UTF-8.

    ``row`` tells rows with equal ids apart; the digest is 128 bits in two longs; ``words``
    counts the words that start in the chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, sizes, words, digests = [], [], [], [], []
            for i, value in enumerate(batch.column(2)):
                data = (value.as_py() or "").encode("utf-8", "surrogatepass")
                ends = np.array(borders(data), np.int64)
                begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
                digests += [blake2b(data[a:b], digest_size=16).digest() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                gap = _SPACE[np.frombuffer(data, np.uint8)]
                word = np.flatnonzero(~gap & np.append(True, gap[:-1])[: len(gap)])
                rows.append(np.full(len(ends), i)), starts.append(begins), sizes.append(ends - begins)
                words.append(np.searchsorted(word, ends) - np.searchsorted(word, begins))
                if len(digests) > 200_000:
                    yield _chunks(batch, rows, starts, sizes, words, digests)
                    rows, starts, sizes, words, digests = [], [], [], [], []
            if digests:
                yield _chunks(batch, rows, starts, sizes, words, digests)

    kinds = "doc_id long, row long, start long, size int, words int, d1 long, d2 long"
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, kinds)


def _chunks(batch: pa.RecordBatch, rows: list, starts: list, sizes: list, words: list, digests: list) -> pa.RecordBatch:
    at = pa.array(np.concatenate(rows))
    pair = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(starts))]
    columns += [pa.array(np.concatenate(x).astype(np.int32)) for x in (sizes, words)]
    columns += [pa.array(np.ascontiguousarray(pair[:, k])) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "start", "size", "words", "d1", "d2"])


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start, end, words, first_doc_id, keep)``: the ranges of passages of
    ``least_words`` or more words that also stand in other documents.

    Offsets are bytes of the text's UTF-8. A passage is cut where ``keep`` changes, so a range
    may have fewer words: ``keep`` marks chunks that stand in their own document first, so
    that dropping the others leaves the first copy of every chunk. ``first_doc_id`` is the
    smallest id that has the range's first chunk. Null and empty texts have no passages. Rows
    of one id are one document, and so are rows without an id; they come last.
    """
    key = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    chunks = chunk_table(docs, id_col, text_col)
    shared = chunks.groupBy("d1", "d2").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    shared = shared.where("last > first").drop("last")
    held = chunks.join(shared, ["d1", "d2"]).select("doc_id", "row", "start", "size", "words", "first", (key == F.col("first")).alias("keep"))
    in_order = W.partitionBy("row").orderBy("start")
    gap = F.coalesce(F.lag(F.col("start") + F.col("size")).over(in_order) != F.col("start"), F.lit(True))
    turn = gap | (F.lag("keep").over(in_order) != F.col("keep"))
    runs = held.withColumn("gap", gap.cast("int")).withColumn("turn", turn.cast("int"))
    runs = runs.withColumn("run", F.sum("gap").over(in_order)).withColumn("part", F.sum("turn").over(in_order))
    ranges = runs.groupBy("row", "run", "part").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("end"),
        F.sum("words").alias("words"), F.min_by("first", "start").alias("first_doc_id"), F.first("keep").alias("keep"),
    )
    whole = F.sum("words").over(W.partitionBy("row", "run"))
    return ranges.withColumn("whole", whole).where(F.col("whole") >= least_words).select("doc_id", "start", "end", "words", "first_doc_id", "keep")
