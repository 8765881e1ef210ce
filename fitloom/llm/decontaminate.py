"""Training texts that contain items of a benchmark.

The items form a BM25 inverted index, its impacts divided by the item's score against itself
and cut into blocks with their maxima. Every passage of every text is a query: windows whose
summed term bounds, then block bounds, stay below the threshold are skipped, the rest are
scored exactly and all items above the threshold are verified by the words of the item's
question and answer and by its five-word shingles.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
#: Share of an item's own BM25 score that a passage must reach.
THRESHOLD = 0.7
#: Share of an item's shingles that must occur in the passage, and of its question's and its
#: answer's words.
OVERLAP, PART_OVERLAP = 0.8, 0.5
SHINGLE = 5
BLOCK = 16
#: Words of items in one index; more items make more indexes, each with a pass of its own.
INDEX_WORDS = 2_000_000
SLICE = 1 << 20
#: Words that are looked at together.
GROUP = 1 << 15

_WORD = re.compile(r"\w+")
_GAP = re.compile(r"\W")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str | None) -> Iterator[list[str]]:
    """Lower-cased words of a whole text, in slices that end between words."""
    text, at = text or "", 0
    while at < len(text):
        cut = _GAP.search(text, min(at + SLICE, len(text)))
        end = cut.start() if cut else len(text)
        yield _WORD.findall(text[at:end].lower())
        at = max(end, at + 1)


def parts_of(text: str | None) -> tuple[list[str], int]:
    """An item's words and where its answer starts: its last sentence, or without a second
    sentence its last third."""
    words = [w for part in words_of(text) for w in part]
    sentences = [s for s in _SENTENCE.split((text or "").strip()) if _WORD.search(s)]
    answer = len(_WORD.findall(sentences[-1].lower())) if len(sentences) > 1 else len(words) // 3
    return words, max(len(words) - max(answer, 1), 0)


@dataclass
class LengthClass:
    """Items of at most ``length`` words, and passages that hold each of them whole."""

    length: int
    bound: np.ndarray  # by term, the largest impact on any item; the last entry stands for other words
    starts: np.ndarray  # by term, where its postings start
    items: np.ndarray
    impacts: np.ndarray
    block_starts: np.ndarray
    blocks: np.ndarray
    peaks: np.ndarray


@dataclass
class Index:
    vocabulary: dict[str, int]
    item_ids: list
    words: list[np.ndarray]
    answers: list[int]
    classes: list[LengthClass] = field(default_factory=list)

    def ids(self, text: str | None) -> np.ndarray:
        """Term numbers of a text's words, -1 for words of no item."""
        get = self.vocabulary.get
        parts = [np.fromiter(map(get, ws, repeat(-1)), np.int32, len(ws)) for ws in words_of(text)]
        return np.concatenate(parts) if parts else np.empty(0, np.int32)

    def matches(self, texts: Iterable[str | None]) -> Iterator[dict[int, tuple[float, float, float, float]]]:
        """For each text its verified items by number: best score, shingle, question and answer
        overlap. Texts are looked at in groups of about ``GROUP`` words."""
        pending: list[tuple[int, np.ndarray]] = []
        found: list[dict[int, tuple[float, float, float, float]]] = []
        held, longest = 0, max((c.length for c in self.classes), default=0)
        for text in texts:
            ids = self.ids(text)
            found.append({})
            for at in range(0, max(len(ids), 1), GROUP):
                part = ids[max(0, at - 2 * longest) : at + GROUP]
                pending.append((len(found) - 1, part))
                held += len(part)
            if held >= GROUP:
                self._match(pending, found)
                pending, held = [], 0
        self._match(pending, found)
        return iter(found)

    def _match(self, group: list[tuple[int, np.ndarray]], found: list[dict]) -> None:
        sizes = np.array([len(ids) for _, ids in group], np.int64)
        if not sizes.sum():
            return
        ids = np.concatenate([ids for _, ids in group]).astype(np.int64)
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        part = np.repeat(np.arange(len(group)), sizes)
        order = np.lexsort((ids, part))  # stable: equal words of a text stay in order
        same = (ids[order[1:]] == ids[order[:-1]]) & (part[order[1:]] == part[order[:-1]])
        before = np.full(len(ids), -1)  # where the word last stood in the same text
        before[order[1:][same]] = order[:-1][same]
        for c in self.classes:
            # passage k is cell k with the next cell of its text; cells have c.length words
            cells = -(-sizes // c.length)
            first_cell = np.concatenate(([0], np.cumsum(cells)[:-1]))
            cell = first_cell[part] + (np.arange(len(ids)) - first[part]) // c.length
            owner = np.repeat(np.arange(len(group)), cells)
            begin = first[owner] + (np.arange(len(owner)) - first_cell[owner]) * c.length
            linked = np.append(owner[1:] == owner[:-1], False)  # cell k + 1 is of the same text
            last = np.concatenate(([False], linked[:-1]))  # cell k ends an earlier passage
            known = ids >= 0
            early = known & (before < begin[cell])  # counts for the passage its cell starts
            late = known & last[cell] & (before < begin[np.maximum(cell - 1, 0)])  # and for the one its cell ends
            bound = np.bincount(cell, c.bound[ids] * early, len(owner))
            after = np.bincount(cell, c.bound[ids] * late, len(owner))
            bound[:-1] += np.where(linked[:-1], after[1:], 0.0)
            near = (bound >= THRESHOLD - 1e-6) & (linked | ~last)
            if not near.any():
                continue
            a, b = np.flatnonzero(early & near[cell]), np.flatnonzero(late & near[np.maximum(cell - 1, 0)])
            passages, terms = np.concatenate((cell[a], cell[b] - 1)), np.concatenate((ids[a], ids[b]))
            for k, item, score in self._retrieve(c, passages, terms):
                text, start = owner[k], begin[k]
                end = min(start + 2 * c.length, first[text] + sizes[text])
                shares = self._verify(item, ids[start:end])
                best = found[group[text][0]]
                if shares and (score, *shares) > best.get(item, (0.0,)):
                    best[item] = (score, *shares)

    @staticmethod
    def _lists(starts: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the lists of some terms, one after the other, and whose list each is in."""
        sizes = starts[terms + 1] - starts[terms]
        shift = np.repeat(starts[terms] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        return np.arange(sizes.sum()) + shift, np.repeat(np.arange(len(terms)), sizes)

    def _retrieve(self, c: LengthClass, passages: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """Passages with the items that score at least the threshold against them, from pairs of
        a passage and a term. Only blocks whose bound reaches the threshold are opened."""
        wide = len(self.words) + 1
        at, pair = self._lists(c.block_starts, terms)
        open_, place = np.unique(passages[pair] * wide + c.blocks[at], return_inverse=True)
        open_ = open_[np.bincount(place, c.peaks[at]) >= THRESHOLD - 1e-6]
        if not len(open_):
            return
        use = np.isin(passages, open_ // wide)
        passages, terms = passages[use], terms[use]
        at, pair = self._lists(c.starts, terms)
        key = passages[pair] * wide + c.items[at] // BLOCK
        use = open_[np.minimum(np.searchsorted(open_, key), len(open_) - 1)] == key
        at, pair = at[use], pair[use]
        found, place = np.unique(passages[pair] * wide + c.items[at], return_inverse=True)
        scores = np.bincount(place, c.impacts[at])
        for i in np.flatnonzero(scores >= THRESHOLD - 1e-6):
            yield int(found[i] // wide), int(found[i] % wide), float(scores[i])

    def _verify(self, item: int, passage: np.ndarray) -> tuple[float, float, float] | None:
        words, answer = self.words[item], self.answers[item]
        seen = {tuple(passage[i : i + SHINGLE]) for i in range(len(passage) - SHINGLE + 1)}
        own = {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}
        shingles = len(own & seen) / len(own)
        question, reply = (np.isin(np.unique(part), passage).mean() if len(part) else 1.0 for part in (words[:answer], words[answer:]))
        if shingles >= OVERLAP and question >= PART_OVERLAP and reply >= PART_OVERLAP:
            return shingles, float(question), float(reply)
        return None


def build_index(items: list, idf: dict[str, float], mean_length: float) -> Index:
    """The index of ``items``, rows of ``(item_id, words, answer)``."""
    terms = {w: i for i, w in enumerate(sorted({w for r in items for w in r.words}))}
    index = Index(terms, [r.item_id for r in items], [np.array([terms[w] for w in r.words], np.int32) for r in items], [r.answer for r in items])
    weight = np.array([idf[w] for w in terms])
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(index.words):
        groups.setdefault(max(len(w) - 1, 1).bit_length(), []).append(i)
    for power, members in sorted(groups.items()):
        t, d, v = [], [], []
        for i in members:
            own, n = np.unique(index.words[i], return_counts=True)
            score = weight[own] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(index.words[i]) / mean_length))
            t.append(own), d.append(np.full(len(own), i)), v.append(score / score.sum())
        t, d, v = np.concatenate(t), np.concatenate(d), np.concatenate(v)
        order = np.lexsort((d, t))
        t, d, v = t[order], d[order], v[order]
        bound = np.zeros(len(terms) + 1)
        np.maximum.at(bound, t, v)
        cells, first = np.unique(t.astype(np.int64) * (1 << 32) + d // BLOCK, return_index=True)
        index.classes.append(
            LengthClass(
                1 << power, bound, np.searchsorted(t, np.arange(len(terms) + 1)), d, v,
                np.searchsorted(cells >> 32, np.arange(len(terms) + 1)), cells & 0xFFFFFFFF, np.maximum.reduceat(v, first),
            )
        )
    return index


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """Indexes of bounded size that together hold all items of five or more words.

    Document frequencies are those of all items, whichever index they are in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [parts_of(t.as_py()) for t in batch.column(1)]
            columns = [batch.column(0), pa.array([p[0] for p in parts], pa.list_(pa.string())), pa.array([p[1] for p in parts], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "words", "answer"])

    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.mapInArrow(run, "item_id long, words array<string>, answer int").where(F.size("words") >= SHINGLE)
    n, total = rows.agg(F.count(F.lit(1)), F.sum(F.size("words"))).first()
    if not n:
        return
    seen = rows.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    idf = seen.withColumn("idf", F.log1p((n - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    parts = -(-total // INDEX_WORDS)
    for part in range(parts):
        mine = rows.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(parts)) == part)
        used = mine.select(F.explode("words").alias("w")).distinct()
        yield build_index(mine.collect(), {r.w: r.idf for r in used.join(idf, "w").collect()}, total / n)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, item_id, score, overlap, question_overlap, answer_overlap)``, one row for each
    item that a row of ``docs`` contains.

    Null and empty texts contain nothing. Items under five words have no shingle and are left
    out. Repeated items and repeated rows give repeated results.
    """
    kinds = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], kinds)
    for index in indexes(benchmark):
        out = out.union(narrow.mapInArrow(_matcher(index), kinds))
    return out


def _matcher(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            matches = index.matches(t.as_py() for t in batch.column(1))
            for doc_id, match in zip(batch.column(0).to_pylist(), matches, strict=True):
                rows += [(doc_id, index.item_ids[i], *found) for i, found in sorted(match.items())]
            kinds = [pa.int64()] * 2 + [pa.float64()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"],
            )

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item of the benchmark."""
    for index in indexes(benchmark):
        docs = docs.where(_clean(index)(F.col(text_col).cast("string")))
    return docs


def _clean(index: Index):
    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([not match for match in index.matches(t.as_py() for t in texts)], pa.bool_())

    return clean
