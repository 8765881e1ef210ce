"""Language identification with hyperdimensional profiles.

Every letter has a random vector of plus and minus ones. A trigram is the product of its
letters' vectors, the first permuted twice and the second once; a text is the sum of its
trigrams, a language the sum of its texts. A text belongs to the language whose prototype,
less the mean of all prototypes, has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
#: Letters share this many vectors by code point; 0 is the gap between words.
LETTERS = 8192
#: Trigram vectors kept by a worker; a memory bound, further ones are bound anew.
CACHE_ROWS = 12_000
#: Characters that are looked at together; longer texts are summed slice by slice.
SLICE = 1 << 19
#: Sharpness with which cosines become a score.
SHARPNESS = 10.0
SEED = 20_071


@cache
def _letters() -> np.ndarray:
    """Index of the vector of every code point, 0 where it is no letter."""
    points = np.arange(0x110000, dtype=np.int64)
    known = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return np.where(known, 1 + points % (LETTERS - 1), 0).astype(np.int64)


def trigrams(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct trigram codes with their counts, slice by slice of the whole text."""
    table, last = _letters(), np.zeros(1, np.int64)
    for at in range(0, len(text), SLICE):
        part = text[at : at + SLICE].lower().encode("utf-32-le", "surrogatepass")
        ids = np.concatenate((last, table[np.frombuffer(part, "<u4")]))
        if at + SLICE >= len(text):
            ids = np.append(ids, 0)
        keep = (ids != 0) | np.append(True, ids[:-1] != 0)
        ids = ids[keep]
        if len(ids) > 2:
            yield np.unique((ids[:-2] * LETTERS + ids[1:-1]) * LETTERS + ids[2:], return_counts=True)
        last = ids[-2:]


class Binder:
    """Trigram vectors by code, kept up to ``CACHE_ROWS``."""

    def __init__(self) -> None:
        draw = np.random.default_rng(SEED).integers(0, 2, (LETTERS, DIMENSIONS), np.int8) * np.int8(2) - np.int8(1)
        self.books = [np.roll(draw, k, axis=1) for k in (2, 1, 0)]
        self.rows = np.empty((CACHE_ROWS, DIMENSIONS), np.float32)
        self.codes = np.empty(0, np.int64)
        self.slots = np.empty(0, np.int64)

    def bind(self, codes: np.ndarray) -> np.ndarray:
        a, b, c = codes // LETTERS**2, codes // LETTERS % LETTERS, codes % LETTERS
        return self.books[0][a] * self.books[1][b] * self.books[2][c]

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, codes), max(len(self.codes) - 1, 0))
        new = codes[self.codes[at] != codes] if len(self.codes) else codes
        if len(new):
            if len(self.codes) + len(new) > CACHE_ROWS:
                self.codes, self.slots, new = np.empty(0, np.int64), np.empty(0, np.int64), codes
            start = len(self.codes)
            self.rows[start : start + len(new)] = self.bind(new)
            known = np.concatenate((self.codes, new))
            order = np.argsort(known)
            self.codes = known[order]
            self.slots = np.concatenate((self.slots, np.arange(start, start + len(new))))[order]
            at = np.searchsorted(self.codes, codes)
        return self.slots[at]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the vectors, each as often as counted; exact below 2**24 trigrams."""
        total = np.zeros(DIMENSIONS, np.float64)
        for i in range(0, len(codes), 2048):
            total += counts[i : i + 2048].astype(np.float32) @ self.rows[self._slots(codes[i : i + 2048])]
        return total

    def text(self, text: str) -> np.ndarray:
        total = np.zeros(DIMENSIONS, np.float64)
        for codes, counts in trigrams(text):
            total += self.bundle(codes, counts)
        return total


@cache
def _binder() -> Binder:
    return Binder()


@dataclass(frozen=True)
class Profiles:
    """Learned languages and their centred prototypes, one row of unit length each."""

    languages: tuple[str, ...]
    prototypes: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and a score from 0 to 1: ``und`` and 0 without a letter or a model."""
        vector = _binder().text(text) if text else np.zeros(0)
        length = float(np.linalg.norm(vector))
        if not self.languages or not length or not _has_letter(text):
            return "und", 0.0
        cosines = self.prototypes @ vector / length
        best = int(np.argmax(cosines))
        return self.languages[best], 1.0 / float(np.exp(SHARPNESS * (cosines - cosines[best])).sum())


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Prototypes of the languages of all rows with a text and a language.

    Texts are summed within batches, batches by Spark; what reaches the driver is one vector
    for each language, however many rows there are. Sums are whole numbers, so the layout of
    the input changes nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        binder, sums = _binder(), {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                held = sums.setdefault(lang.as_py(), {})
                for codes, counts in trigrams(text.as_py()):
                    for code, n in zip(codes.tolist(), counts.tolist(), strict=True):
                        held[code] = held.get(code, 0) + n
                if len(held) > CACHE_ROWS:
                    yield _sums(binder, sums)
                    sums = {}
        yield _sums(binder, sums)

    rows = docs.select(F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("l")).where("t is not null and l is not null")
    summed = rows.mapInArrow(run, "lang string, at int, value long").groupBy("lang", "at").agg(F.sum("value").alias("value"))
    totals: dict[str, np.ndarray] = {}
    for row in summed.toLocalIterator():
        totals.setdefault(row.lang, np.zeros(DIMENSIONS))[row.at] = row.value
    totals = {k: v for k, v in sorted(totals.items()) if v.any()}
    if not totals:
        return Profiles((), np.zeros((0, DIMENSIONS)))
    units = np.stack([v / np.linalg.norm(v) for v in totals.values()])
    if len(units) > 1:
        units = units - units.mean(axis=0)
        units /= np.maximum(np.linalg.norm(units, axis=1, keepdims=True), 1e-12)
    return Profiles(tuple(totals), units)


def _sums(binder: Binder, sums: dict[str, dict[int, int]]) -> pa.RecordBatch:
    langs, ats, values = [], [], []
    for lang, held in sums.items():
        total = np.zeros(DIMENSIONS, np.int64)
        codes, counts = np.fromiter(held.keys(), np.int64, len(held)), np.fromiter(held.values(), np.int64, len(held))
        for i in range(0, len(codes), 1024):
            total += counts[i : i + 1024] @ binder.bind(codes[i : i + 1024]).astype(np.int64)
        langs += [lang] * DIMENSIONS
        ats.append(np.arange(DIMENSIONS, dtype=np.int32))
        values.append(total)
    empty = np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(np.concatenate(ats or [empty]), pa.int32()), pa.array(np.concatenate(values or [empty]), pa.int64())],
        ["lang", "at", "value"],
    )


def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; only the text is looked at.

    Every row keeps its place and its other columns; columns of these two names are replaced.
    A null, empty or letterless text is ``und`` with score 0.
    """

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predicted(texts: pa.Array) -> pa.Array:
        found = [profiles.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["lang_pred", "score"])

    named = docs.withColumn("_told", predicted(F.col(text_col).cast("string")))
    return named.withColumns({"lang_pred": F.col("_told.lang_pred"), "score": F.col("_told.score")}).drop("_told")


def held_out(id_col: str, parts: int, part: int) -> F.Column:
    """Whether the CRC-32 of the id as text leaves the remainder ``part``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))

