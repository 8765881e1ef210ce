"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are words, beginnings of words and the windows of letters behind a long word's tenth, so
that every letter of a text is read. Those that stand with the label too often for chance, at a
fixed rate of false discoveries, are chosen on the labelled examples. Examples lie in an
inverted index cut into blocks, each with the largest weight of every term in it: blocks are visited by falling upper bound and the search ends
once no block can reach the k-th best cosine, so the neighbours are exact. Their
distance-weighted votes, calibrated on the examples themselves, are the score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitloom.llm.simhash import shingle_hashes
from fitloom.session import materialise

#: Labelled rows of each class that the classifier is fitted on, least hash of the id first.
EXAMPLES = 2500
#: Share of the chosen terms that may be chosen by chance, by the step-up rule of Benjamini and
#: Hochberg over exact one-sided p-values: as strict for a few examples as for many. Terms in too
#: few examples ever to pass are not tested.
FALSE_DISCOVERIES = 0.05
#: Least number of examples of label 1 that have a chosen term.
LEAST_EXAMPLES = 2
#: Least ratio of a term's frequencies among examples of label 1 and of label 0.
LEAST_LIFT = 4.0
#: Least hashes by which examples are compared, and the similarity of near copies.
LEAST, SIMILAR = 16, 0.8
NEIGHBOURS = 25
BLOCK = 64
FIRST_BLOCKS = 4
#: Cosine at which a neighbour's vote has half its weight.
HALF_VOTE = 0.35
#: Votes that the base rate has beside the neighbours.
PULL = 0.2
SLICE = 1 << 17
#: Letters of the shortest and the longest beginning of a word that is a term.
SHORTEST, LONGEST = 3, 10
#: Letters of the windows that read what lies behind the longest beginning.
INNER = (2, 3, 5)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@cache
def _letters() -> np.ndarray:
    """Code points of letters plus one, 0 for everything else."""
    known = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return np.where(known, np.arange(1, 0x110001), 0).astype(np.uint64)


def term_codes(text: str | None) -> Iterator[np.ndarray]:
    """64-bit codes of all terms of a whole text, repeats included, slice by slice."""
    table, last, text = _letters(), np.zeros(1, np.uint64), text or ""
    gap = 0  # place of the last character that is no letter, before or at the slice's first
    for at in range(0, len(text), SLICE):
        part = text[at : at + SLICE].lower().encode("utf-32-le", "surrogatepass")
        final = at + SLICE >= len(text)
        ids = np.concatenate((last, table[np.frombuffer(part, "<u4")], np.zeros(LONGEST + 1 if final else 0, np.uint64)))
        # words that start before the stop are whole in this slice, or longer than any term
        stop = max(len(ids) - LONGEST - 1, 0)
        words = np.flatnonzero((ids[:stop] == 0) & (ids[1 : stop + 1] != 0)) if stop else np.empty(0, np.int64)
        h = np.full(len(words), 1, np.uint64)
        for j in range(1, LONGEST + 2):
            h = (h ^ ids[words + j]) * _MIX
            code = h ^ (h >> np.uint64(32))
            ends = ids[words + j] == 0
            if j > 1:
                yield code[ends]  # the whole word
            words, h = words[~ends], h[~ends]
            if SHORTEST <= j <= LONGEST:
                yield code[~ends]
        if stop:
            gaps = np.maximum.accumulate(np.where(ids == 0, np.arange(len(ids)), gap))
            deep = np.arange(stop) - gaps[:stop]  # a word's first letter is 1 deep
            for size in INNER:
                spots = np.flatnonzero((deep > 0) & (deep + size - 1 > LONGEST))
                spots = spots[gaps[spots + size - 1] == gaps[spots]]
                h = np.full(len(spots), 1000 + size, np.uint64)
                for j in range(size):
                    h = (h ^ ids[spots + j]) * _MIX
                yield h ^ (h >> np.uint64(32))
            gap = int(gaps[stop]) - stop
        last = ids[stop:]


class Terms:
    """The chosen terms: sorted codes behind a small table of their leading bits."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = np.sort(codes.astype(np.uint64))
        self.lead = np.zeros(1 << 16, bool)
        self.lead[(self.codes >> np.uint64(48)).astype(np.int64)] = True

    def count(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the chosen terms in a text and how often each occurs."""
        found = [np.empty(0, np.int64)]
        for codes in term_codes(text) if len(self.codes) else ():
            codes = codes[self.lead[(codes >> np.uint64(48)).astype(np.int64)]]
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            found.append(at[self.codes[at] == codes])
        return np.unique(np.concatenate(found), return_counts=True)


def features(text: Column, terms: Terms) -> Column:
    """Struct of two arrays: the chosen terms of a text and their counts."""

    @F.arrow_udf("struct<at:array<int>,n:array<int>>")
    def counted(texts: pa.Array) -> pa.Array:
        rows = [terms.count(t.as_py()) for t in texts]
        ends = pa.array(np.cumsum([0] + [len(r[0]) for r in rows]), pa.int32())
        flat = [pa.array(np.concatenate([r[k] for r in rows] or [[]]).astype(np.int32)) for k in (0, 1)]
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, x) for x in flat], ["at", "n"])

    return counted(text.cast("string"))


@dataclass
class Model:
    """Blocks of examples, their largest weights, and the calibration.

    ``lanes`` has a row of weights for each term and block that meet, one weight an example;
    ``rows`` says which, row 0 being empty.
    """

    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    lanes: np.ndarray
    rows: np.ndarray
    peaks: np.ndarray
    base: float
    xs: np.ndarray
    ys: np.ndarray

    def vector(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (1 + np.log(n)) * self.idf[at]
        return (w / (np.linalg.norm(w) or 1.0)).astype(np.float32)

    def nearest(self, at: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest examples with a positive cosine, ties to the
        smaller position.

        The blocks of highest bound are searched first; their k-th best cosine is a floor, and
        of the others only blocks whose bound reaches it are opened.
        """
        bounds = weights @ self.peaks[at]
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        spot, cosines = self._search(order[:FIRST_BLOCKS], at, weights, k)
        floor = cosines[-1] if len(cosines) == k else 0.0
        rest = order[FIRST_BLOCKS:]
        rest = rest[bounds[rest] * 1.00001 >= floor]
        if len(rest):
            more, found = self._search(rest, at, weights, k)
            spot, cosines = np.concatenate((spot, more)), np.concatenate((cosines, found))
            best = np.lexsort((spot, -cosines))[:k]
            spot, cosines = spot[best], cosines[best]
        return spot, cosines

    def _search(self, blocks: np.ndarray, at: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        lists = self.lanes[self.rows[at[:, None], blocks[None, :]]]
        cosines = weights @ lists.reshape(len(at), -1)
        spot = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        if len(cosines) > k:
            enough = cosines >= max(np.partition(cosines, len(cosines) - k)[len(cosines) - k], 1e-9)
            cosines, spot = cosines[enough], spot[enough]
        else:
            cosines, spot = cosines[cosines > 0], spot[cosines > 0]
        best = np.lexsort((spot, -cosines))[:k]
        return spot[best], cosines[best]

    def vote(self, spot: np.ndarray, cosines: np.ndarray) -> float:
        far = (1 - np.minimum(cosines.astype(np.float64), 1.0)) / (1 - HALF_VOTE)
        w = self.votes[spot] / (1 + far * far) * cosines
        return float(((w * self.labels[spot]).sum() + PULL * self.base) / (w.sum() + PULL))

    def score(self, at: np.ndarray, n: np.ndarray) -> tuple[float, list[int | None]]:
        """Calibrated score and the ids of the nearest examples, nearest first."""
        if not len(at):
            return self.base, []
        spot, cosines = self.nearest(at, self.vector(at, n))
        if not len(spot):
            return self.base, []
        return float(np.interp(self.vote(spot, cosines), self.xs, self.ys)), self.ids[spot[:3]].tolist()


def _isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising step fit of weighted labels by pooling neighbours that fall, as points to interpolate."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, c in zip(x[order], y[order], w[order], strict=True):
        pools.append([a * c, b * c, c])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def fit(examples: list, idf: np.ndarray, shares: dict[int, float]) -> Model:
    """The model of ``examples``, rows of ``(doc_id, y, at, n)``; ``shares`` is how many labelled
    rows of its class an example stands for. Examples without a chosen term set the base rate."""
    empty = [r for r in examples if not len(r.at)]
    total = sum(shares[r.y] for r in empty)
    base = (sum(shares[r.y] for r in empty if r.y) + 0.5) / (total + 1.0)
    rows = sorted((r for r in examples if len(r.at)), key=lambda r: (r.y, max(zip(r.n, r.at, strict=True))[1], r.doc_id or 0))
    size = -(-max(len(rows), 1) // BLOCK)
    ids, labels = np.array([r.doc_id for r in rows], object), np.array([r.y for r in rows], np.float64)
    lanes, table = np.zeros((1, BLOCK), np.float32), np.zeros((len(idf), size), np.int32)
    model = Model(idf, ids, labels, np.array([shares[r.y] for r in rows]), lanes, table, np.zeros((len(idf), size), np.float32), base, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    if not rows:
        return model
    model.votes = model.votes / model.votes.min()
    vectors = [(np.array(r.at), model.vector(np.array(r.at), np.array(r.n))) for r in rows]
    for i, (at, _) in enumerate(vectors):
        table[at, i // BLOCK] = 1
    met = np.nonzero(table)
    table[met] = np.arange(1, len(met[0]) + 1)
    model.lanes = np.zeros((len(met[0]) + 1, BLOCK), np.float32)
    for i, (at, w) in enumerate(vectors):
        model.lanes[table[at, i // BLOCK], i % BLOCK] = w
    model.peaks[met] = model.lanes[1:].max(axis=1)
    raw = np.empty(len(rows))
    for i, (at, w) in enumerate(vectors):  # each example by its neighbours without itself
        spot, cosines = model.nearest(at, w, NEIGHBOURS + 1)
        other = spot != i
        raw[i] = model.vote(spot[other][:NEIGHBOURS], cosines[other][:NEIGHBOURS])
    model.xs, model.ys = _isotonic(raw, labels, model.votes)
    return model


def _chosen_terms(sample: DataFrame) -> Terms:
    """The terms that stand with label 1, from how many examples of each class have them.

    Near copies would make the words of one text look frequent: of examples of a class whose
    sets of five-word shingles are similar, by their least hashes, one is counted.
    """

    @F.arrow_udf("array<long>")
    def least(texts: pa.Array) -> pa.Array:
        return pa.array([np.unique(shingle_hashes(t.as_py(), 5))[:LEAST].view(np.int64) for t in texts], pa.list_(pa.int64()))

    text_hash = F.xxhash64("text").alias("h")
    rows = sample.select("y", text_hash, least("text").alias("least")).dropDuplicates(["y", "h"]).orderBy("h", "y").limit(2 * EXAMPLES)
    kept = _unlike([(r.y, r.h, r.least) for r in rows.collect()])
    kept = sample.sparkSession.createDataFrame(kept, "y int, h long")  # at most twice EXAMPLES rows
    sample = sample.select("y", "text", text_hash).dropDuplicates(["y", "h"]).join(F.broadcast(kept), ["y", "h"])
    sample = materialise(sample.select("y", "text"), "toxicity-distinct")
    count = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {0: [], 1: []}
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held[y].append(np.unique(np.concatenate([np.empty(0, np.uint64), *term_codes(text.as_py())])))
        for y, codes in held.items():
            got, n = np.unique(np.concatenate([np.empty(0, np.uint64), *codes]), return_counts=True)
            for i in range(0, len(got), 50_000):
                part = pa.array(got[i : i + 50_000].view(np.int64)), pa.array(n[i : i + 50_000])
                yield pa.RecordBatch.from_arrays([part[0], pa.array([y] * len(part[0]), pa.int32()), part[1]], ["code", "y", "n"])

    seen = sample.select("y", "text").mapInArrow(run, "code long, y int, n long").groupBy("code")
    seen = seen.agg(*[F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0)).cast("double").alias(f"n{y}") for y in (0, 1)])
    n0, n1 = count.get(0, 0), count.get(1, 0)

    @F.arrow_udf("double")
    def chance(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(log_chance(a.to_numpy().astype(np.int64), b.to_numpy().astype(np.int64), n0, n1))

    a, b = F.col("n1"), F.col("n0")
    tested = seen.where(a + b >= least_testable(n0, n1)).withColumn("p", chance("n1", "n0"))
    tested = materialise(tested, "toxicity-tested")
    # ranks from counts of p-values in narrow steps, so no task sorts all terms
    steps = tested.groupBy(F.ceil(F.col("p") * 64).alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy("step").collect()
    total, below, cut = sum(r.n for r in steps), 0, -np.inf
    for r in steps:
        below += r.n
        if np.exp(r.step / 64) <= FALSE_DISCOVERIES * below / total:
            cut = r.step
    best = tested.where((F.ceil(F.col("p") * 64) <= F.lit(float(cut))) & (a >= LEAST_EXAMPLES) & (a * n0 > LEAST_LIFT * (b + 0.5) * n1))
    rows = best.select("code").collect()
    return Terms(np.array([r.code for r in rows], np.int64).view(np.uint64) if rows else np.empty(0, np.uint64))


def _unlike(rows: list[tuple[int, int, list[int]]]) -> list[tuple[int, int]]:
    """``(y, h)`` of the rows ``(y, h, least hashes)`` that are similar to none before them."""
    kept: list[tuple[int, int]] = []
    sets: list[set[int]] = []
    having: dict[tuple[int, int], list[int]] = {}
    for y, h, least in sorted(rows):
        own = set(least)
        met = Counter(i for x in least for i in having.get((y, x), ()))
        for i in met:
            # of the least hashes of both sets together; shorter sets are whole
            both = sorted(own | sets[i])[:LEAST]
            if sum(x in own and x in sets[i] for x in both) >= SIMILAR * len(both):
                break
        else:
            for x in least:
                having.setdefault((y, x), []).append(len(kept))
            kept.append((y, h))
            sets.append(own)
    return kept


def least_testable(n0: int, n1: int) -> int:
    """The least number of examples that can pass: all of label 1."""
    alone = np.arange(LEAST_EXAMPLES, n1 + 1)
    able = np.flatnonzero(log_chance(alone, np.zeros_like(alone), n0, n1) <= np.log(FALSE_DISCOVERIES))
    return int(alone[able[0]]) if len(able) else max(LEAST_EXAMPLES, n1)


def log_chance(a: np.ndarray, b: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """Logarithm of the chance that of ``a + b`` examples, drawn from ``n0`` and ``n1``, at least
    ``a`` are of the second kind: the one-sided exact test."""
    if not n0 or not n1:
        return np.zeros(len(a))
    logs = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, n0 + n1 + 1)))))
    choose = lambda n, k: logs[n] - logs[k] - logs[n - k]
    drawn, out = a + b, np.full(len(a), -np.inf)
    for i in range(int(b.max(initial=0)) + 1):
        more = np.flatnonzero((i <= b) & (a + i <= n1))
        x = a[more] + i
        out[more] = np.logaddexp(out[more], choose(n1, x) + choose(n0, drawn[more] - x) - choose(n0 + n1, drawn[more]))
    return np.minimum(out, 0.0)


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Labelled texts, at most ``EXAMPLES`` of a class, and the labelled rows of each class."""
    sure = labels.where("y in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
    sure = materialise(sure, "toxicity-labels")
    count = {r.y: r.n for r in sure.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids = [sure.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(EXAMPLES) for y in (0, 1)]
    chosen = F.broadcast(ids[0].union(ids[1]))  # at most twice EXAMPLES rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(texts.join(chosen, "doc_id"), "toxicity-sample"), count


def _model(sample: DataFrame, count: dict[int, int], terms: Terms, told: DataFrame) -> Model:
    """``told(at)`` has the chosen terms of every row: document frequencies are those of the
    whole table."""
    n = told.count()
    df = np.zeros(len(terms.codes))
    for r in told.select(F.explode("at").alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("n")).collect():
        df[r.at] = r.n
    rows = sample.select("doc_id", "y", features(F.col("text"), terms).alias("f")).select("doc_id", "y", "f.*")
    rows = rows.orderBy(F.xxhash64("doc_id", "at", "n"), "doc_id").limit(2 * EXAMPLES).collect()
    shares = {y: count.get(y, 0) / max(1, sum(r.y == y for r in rows)) for y in (0, 1)}
    return fit(rows, np.log((n + 1) / (df + 1)) + 1, shares)


def _scored(model: Model) -> "Column":
    @F.arrow_udf("struct<score:double,evidence:array<long>>")
    def told(at: pa.Array, n: pa.Array) -> pa.Array:
        got = [model.score(np.array(a.as_py(), np.int64), np.array(b.as_py(), np.int64)) for a, b in zip(at, n, strict=True)]
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.list_(pa.int64()))], ["score", "evidence"])

    return told


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, score, evidence)`` for every row of ``docs``, learned from ``labels(doc_id, y)``.

    ``evidence`` are the ids of the nearest examples, nearest first. Null and empty texts and
    texts without a chosen term get the rate of such examples. A doc_id with both labels
    counts as 1; labels other than 0 and 1 are left out; without labels every score is the
    uninformed 0.5. Rows that repeat come back as often.
    """
    sample, count = _sample(docs, labels)
    terms = _chosen_terms(sample)
    told = docs.select(F.col("doc_id").cast("long").alias("doc_id"), features(F.col("text"), terms).alias("f"))
    told = materialise(told.select("doc_id", "f.*"), "toxicity-terms")
    vote = _scored(_model(sample, count, terms, told))
    return told.select("doc_id", vote("at", "n").alias("s")).select("doc_id", "s.*")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, as they are.

    Null and empty texts and texts without a chosen term score as in :func:`score`; rows that
    repeat stay or go together; without labels, or from an empty table, every row stays.
    """
    sample, count = _sample(docs, labels)
    terms = _chosen_terms(sample)
    frequencies = materialise(docs.select(features(F.col("text"), terms).alias("f")).select("f.at"), "toxicity-terms")
    model = _model(sample, count, terms, frequencies)

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(*terms.count(t.as_py()))[0] < threshold for t in texts], pa.bool_())

    return docs.where(clean(F.col("text").cast("string")))
