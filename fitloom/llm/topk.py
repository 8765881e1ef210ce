"""Exact inner-product search by three phases with a uniform threshold.

Every vector's score against a query is a sum over a few lists, each a slice of dimensions.
First every task gathers its best entries of one list a tile, all lists in turn, with their
whole scores; the k-th best of all of them is a score that k vectors reach. This safe cutoff is
handed to all tasks. A vector that reaches it has at least a uniform share of it in one of the
lists: the second phase makes list after list, for as long as many pairs are sufficient, that
is, can still have such an entry and reach the cutoff by the norms of what is left. The third
resolves the lists that remain for the few pairs left, pair by pair, and ranks them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitloom.session import materialise, write_table

LISTS = 4
#: Queries that are answered in one pass over the vectors; more make more passes.
WAVE = 16_384
#: Queries and vectors that are multiplied at once.
TILE_QUERIES, TILE_ROWS = 256, 4096
#: Share of a tile's pairs from which on remaining lists are made for all of them at once.
DENSE = 1 / 16
#: Pairs whose remaining lists are resolved at once.
PAIRS = 1 << 16
#: No k-th vector is known.
NONE = -(1 << 62)

_BEST = "query_id long, vec_id long, score long"


def scaled(embedding: Column, by: int = 1024) -> Column:
    """floor(by * x) of every component as longs; null for a null vector, a null or a
    non-finite component."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floor = F.transform(embedding, lambda x: F.floor(F.lit(float(by)) * x.cast("double")))
    return F.when(embedding.isNotNull() & fine, floor)


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: through floats where no sum can pass 2**53, else as integers."""
    size = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(queries.shape[1], 1)
    if size < 2**53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def _best(k: int, query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k highest scores of every query, ties to the smaller vector id."""
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    place = np.arange(len(query)) - np.searchsorted(query, query, "left")
    keep = place < k
    return query[keep], vec[keep], score[keep]


def _tiles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, TILE_ROWS):
            part = batch.slice(at, TILE_ROWS)
            yield part.column(0).to_numpy(), part.column(1).flatten().to_numpy().reshape(-1, width)


def _resolved(q: np.ndarray, which: np.ndarray, rows: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Exact inner products of pairs, given by numbers of queries and of rows."""
    out = np.empty(len(which), np.int64)
    for at in range(0, len(which), PAIRS):
        part = slice(at, at + PAIRS)
        out[part] = np.einsum("ij,ij->i", q[which[part]], rows[row[part]])
    return out


class Lists:
    """The queries of a wave, their dimensions in falling order of energy, cut into lists."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray) -> None:
        width = queries.shape[1]
        self.ids = ids
        self.order = np.argsort(-np.square(queries.astype(np.float64)).sum(axis=0), kind="stable")
        self.queries = queries[:, self.order]
        cuts = [width * i // LISTS for i in range(LISTS + 1)]
        self.spans = list(zip(cuts, cuts[1:], strict=False))
        self.tails = self.norms(self.queries)

    def norms(self, rows: np.ndarray) -> np.ndarray:
        """Norms of what is left from every list on; a last column of zeros."""
        squares = np.square(rows.astype(np.float64))
        each = np.stack([squares[:, a:b].sum(axis=1) for a, b in self.spans] + [np.zeros(len(rows))], axis=1)
        return np.sqrt(np.cumsum(each[:, ::-1], axis=1)[:, ::-1])

    def gather(self, part: slice, rows: np.ndarray, number: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First phase: the best entries of one list of a tile, with their whole scores."""
        q, (a, b) = self.queries[part], self.spans[number % LISTS]
        n = min(LISTS * (k + 1), len(rows))  # one more, as a query may meet itself
        entries = _products(q[:, a:b], rows[:, a:b])
        row = np.argpartition(-entries, n - 1, axis=1)[:, :n].ravel()
        which = np.repeat(np.arange(len(q)), n)
        return which, row, _resolved(q, which, rows, row)

    def collect(self, part: slice, rows: np.ndarray, tails: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """Second and third phase: the pairs of a tile whose score reaches the floor of their
        query, their scores, and how many products of every list were made."""
        q, own = self.queries[part], self.tails[part]
        slack = 1 + 1e-9 * float(own[:, 0].max(initial=0)) * float(tails[:, 0].max(initial=0))
        least, share = floor[:, None] - slack, floor[:, None] / LISTS - slack
        made, total, near = [0] * LISTS, np.zeros((len(q), len(rows)), np.int64), np.zeros((len(q), len(rows)), bool)
        left = np.arange(len(rows))
        which, row, at = np.empty(0, np.int64), np.empty(0, np.int64), 0
        for at, (a, b) in enumerate(self.spans, 1):
            entries = _products(q[:, a:b], rows[left, a:b])
            made[at - 1] = entries.size
            total += entries
            near |= entries >= share
            rest = own[:, at, None] * tails[None, left, at]
            sufficient = (total + rest >= least) & (near | (rest >= share))
            if np.count_nonzero(sufficient) <= DENSE * sufficient.size:
                break
            keep = sufficient.any(axis=0)
            if not keep.all():
                left, total, near, sufficient = left[keep], total[:, keep], near[:, keep], sufficient[:, keep]
        which, row = np.nonzero(sufficient)
        score, row = total[which, row], left[row]
        for at, (a, b) in enumerate(self.spans[at:], at + 1):
            made[at - 1] = len(which)
            score = score + _resolved(q[:, a:b], which, rows[:, a:b], row)
            enough = score + own[which, at] * tails[row, at] >= least[which, 0]
            which, row, score = which[enough], row[enough], score[enough]
        enough = score >= floor[which]
        return which[enough], row[enough], score[enough], made


def _pass(lists: Lists, cutoff: np.ndarray | None, k: int):
    """One pass of a wave of queries over the vectors; without a cutoff, the first phase."""
    ids, width = lists.ids, lists.queries.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        floor = cutoff
        for number, (vec, rows) in enumerate(_tiles(batches, width)):
            found, rows = [held], rows[:, lists.order]
            tails = None if floor is None else lists.norms(rows)
            for at in range(0, len(ids), TILE_QUERIES):
                part = slice(at, at + TILE_QUERIES)
                which, row, score = lists.gather(part, rows, number, k) if floor is None else lists.collect(part, rows, tails, floor[part])[:3]
                other = vec[row] != ids[part][which]
                found.append(_best(k, which[other] + at, vec[row[other]], score[other]))
            held = _best(k, *(np.concatenate(x) for x in zip(*found, strict=True)))
            if floor is not None:  # what k vectors of the task reach is a floor for the others
                full = np.flatnonzero(np.bincount(held[0], minlength=len(ids)) == k)
                floor = floor.copy()
                floor[full] = np.maximum(floor[full], held[2][np.searchsorted(held[0], full, "right") - 1])
        columns = [ids[held[0]] if len(held[0]) else held[0], *held[1:]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of ``vectors(vec_id, v)`` for each of
    ``queries(vec_id, v)``, arrays of longs as of :func:`scaled`.

    Rows with a null id or vector take no part; a vector meets only queries of its own length
    and never a query of its own id. Ties go to the smaller id; fewer than k vectors give
    fewer ranks. A repeated query id asks once, with its least vector. Queries are taken in
    waves of ``WAVE``, whose vectors are all that is broadcast; a task keeps k rows for each
    query of a wave, whatever ties there are. What a wave finds is written, and its vectors are
    dropped before the next. No queries, no vectors or an empty table give no rows.
    """
    asked = queries.where("vec_id is not null and v is not null").groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = materialise(asked.withColumn("width", F.size("v")), "topk-queries")
    rows = vectors.where("vec_id is not null and v is not null").select("vec_id", "v")
    spark, paths = vectors.sparkSession, []
    sizes = asked.groupBy("width").agg(F.count(F.lit(1)).alias("n")).orderBy("width").collect()
    for width, n in ((r.width, r.n) for r in sizes if r.width):
        waves = -(-n // WAVE)
        for wave in range(waves):
            mine = asked.where((F.col("width") == width) & (F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == wave))
            table = mine.select("vec_id", "v").orderBy("vec_id").toArrow()
            ids, matrix = table.column(0).to_numpy(), table.column(1).combine_chunks().flatten().to_numpy().reshape(-1, width)
            same = rows.where(F.size("v") == width)
            lists = Lists(ids, matrix)
            local = same.mapInArrow(_pass(lists, None, k), _BEST)
            ranked = local.withColumn("n", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
            kth = {r.query_id: r.score for r in ranked.where(F.col("n") == k).select("query_id", "score").collect()}
            cutoff = np.array([kth.get(i, NONE) for i in ids.tolist()], np.int64)
            paths.append(write_table(same.mapInArrow(_pass(lists, cutoff, k), _BEST), "topk-wave"))
    out = spark.read.schema(_BEST).parquet(*paths) if paths else spark.createDataFrame([], _BEST)
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
