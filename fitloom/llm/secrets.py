"""Secrets in texts: fixed formats, and values in a credential context that are hard to guess.

A value's guess cost is the cheapest way to build it from words, dates, repeats,
keyboard walks and brute-force spans, found by dynamic programming over its positions.
Costs are decimal logarithms of guesses; the segments' guesses multiply. Words are a few that
passwords are made of, the frequent words of the corpus by rank, and any word that is spelled
as words are.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cache, lru_cache
from heapq import heappop, heappush
from math import inf, log10

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.stats import running_total
from ..session import materialise

#: Kinds in the order in which spans of one start are listed; the last is the method's own.
KINDS = ("assign", "access", "hex", "guess")
#: Guesses (decimal logarithm) from which a value in a credential context is a secret.
MIN_COST = 10.0
#: Longest unit of a repeat that the segmentation looks for.
REPEAT_UNIT = 16
#: Longest stretch that one word, date or walk may cover.
REACH = 24
#: Cost of a word that is in no list but spelled like one, and of a sign between two words.
WORDLIKE, BETWEEN = 4.2, 0.4
#: Frequent words of the corpus that are ranked: what the tasks hold.
CORPUS_WORDS = 20_000
#: Values up to this length have their costs kept by a task, which changes no cost.
KEPT = 256

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more starts where its run starts
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CONTEXT = re.compile(
    r"""(?:(?<![a-z0-9])(?:pwd|pass(?:phrase|code)?|credentials?|auth(?:orization)?|bearer|basic|(?:access|private|client|session|signing|encryption)[_-]?key)"""
    r"""|password|passwd|secret|token|api[_-]?key)["']?[\x20\t]*(?:=>|[:=])[\x20\t]*(["']?)(?:(?:bearer|basic|token)[\x20\t]+)?([^\s"']\S{5,})"""
    r"""|(?<![a-z0-9])(?:bearer|basic)[\x20\t]+(["']?)([^\s"']\S{5,})""",
    re.IGNORECASE,
)
_CONTEXT_HINTS = ("pwd", "pass", "credential", "auth", "bearer", "basic", "key", "secret", "token")
#: What follows bearer or basic without a sign in between is often just the next word.
_PROSE = re.compile(r"[A-Za-z]?[a-z]*(?:['/-][A-Za-z]?[a-z]*)*|[A-Z]+")

#: Frequent words of chosen passwords and placeholders, most frequent first.
WORDS = (
    "password qwerty admin welcome login master dragon monkey letmein football baseball shadow sunshine princess "
    "superman batman iloveyou trustno hello freedom whatever charlie donald michael jordan jennifer hunter "
    "test guest root user default changeme secret example sample demo dummy temp none null true false your "
    "the and for you love pass word summer winter spring autumn january february march april may june july august "
    "september october november december monday tuesday wednesday thursday friday saturday sunday "
    "computer internet server database private public access token key code system account service"
).split()
_RANK = {w: i + 1 for i, w in reversed(list(enumerate(WORDS)))}
_LEET = str.maketrans("@431!0$5+7", "aaeiiossct"[:10])
_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_DATE = re.compile(
    r"(?:19|20)\d\d[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:0?[1-9]|[12]\d|3[01])"
    r"|(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:(?:19|20)\d\d|\d\d)|(?:19|20)\d\d"
)


@cache
def _near() -> dict[str, str]:
    """Keys that touch a key; each row is shifted by half a key against the one above."""
    at = {c: (2 * x + y, y) for y, row in enumerate(_ROWS) for x, c in enumerate(row)}
    return {a: "".join(b for b, (u, v) in at.items() if abs(u - x) <= 2 and abs(v - y) <= 1) for a, (x, y) in at.items()}


def _brute(c: str) -> float:
    return log10(10 if c.isdigit() else 26 if c.isalpha() else 33)


_LETTERS = re.compile(r"[^\W\d_]{3,}")
_VOWELS = "aeiouyáàâäãåéèêëíìîïóòôöõøúùûüæœ"
_UNLIKE = re.compile(rf"[^{_VOWELS}]{{5}}|[{_VOWELS}]{{4}}|(.)\1\1")


def wordlike(word: str) -> bool:
    """Whether Latin letters are spelled as words are: one case, capital first at most, a third
    to four fifths consonants or so, no long runs of either."""
    low = word.lower()
    if not 3 <= len(word) <= REACH or word[1:] != low[1:] and word != word.upper() or max(low) > "\u024f":
        return False
    vowels = sum(c in _VOWELS for c in low)
    return 0.2 * len(low) <= vowels <= 0.7 * len(low) and not _UNLIKE.search(low)


def _period(value: str, at: int, unit: int) -> int:
    """How far each character from ``at`` on is that of ``unit`` before: by growing, then shrinking steps."""
    step, grows = unit, True
    while step:
        if at + step <= len(value) and value[at : at + step] == value[at - unit : at - unit + step]:
            at += step
            step = step * 2 if grows else step
        else:
            step, grows = step // 2, False
    return at


def _pieces(value: str, at: int, low: str | None = None, plain: str | None = None, corpus: Mapping[str, int] = {}):  # noqa: B006
    """Segments that start at ``at``: end, cost, kind. ``low`` and ``plain`` are the value in
    lower case, without and with letters for signs."""
    low = value.lower() if low is None else low
    plain = low.translate(_LEET) if plain is None else plain
    if len(low) != len(value):  # some capitals are two letters when lowered
        low = plain = value
    for end in range(at + 3, min(len(value), at + REACH) + 1):
        word = low[at:end]
        rank = _RANK.get(word) or _RANK.get(plain[at:end]) or corpus.get(word)
        if rank:
            tricks = (word != value[at:end]) + (word not in _RANK and word not in corpus)
            yield end, log10(rank + 1) + 0.6 * tricks, "word"
    if not at or not value[at - 1].isalpha():
        m = _LETTERS.match(value, at, at + REACH + 1)
        if m and wordlike(m[0]):
            yield m.end(), WORDLIKE, "word"
    if value[at] in "-_/.+" and 0 < at < len(value) - 1 and value[at - 1].isalpha() and value[at + 1].isalpha():
        yield at + 1, BETWEEN, "sign"
    if value[at].isdigit():
        for end in range(at + 4, min(len(value), at + 10) + 1):
            if _DATE.fullmatch(value, at, end):
                yield end, log10(366 * (120 if end - at > 4 else 1)), "date"
    near, end, turns, move = _near(), at + 1, 0, None
    while end < min(len(value), at + REACH) and low[end] in near.get(low[end - 1], ""):
        step = ord(low[end]) - ord(low[end - 1])
        turns, move, end = turns + (step != move), step, end + 1
        if end - at >= 3:
            yield end, log10(47 * (end - at)) + 0.7 * min(turns, 3), "walk"
    for unit in range(1, min(REPEAT_UNIT, (len(value) - at) // 2) + 1):
        if at >= unit and value.startswith(value[at - unit : at], at):
            continue  # a repeat is taken from its first unit on
        times = (_period(value, at + unit, unit) - at) // unit
        end = at + times * unit
        if times > 1 and end - at > 2:
            cost = sum(map(_brute, value[at : at + unit]))
            if unit > 2:
                cost = min(cost, log10(_RANK.get(low[at : at + unit], 10**18) + 1))
            yield end, cost + log10(times), "repeat"


def guess_cost(value: str, corpus: Mapping[str, int] | None = None, enough: float = inf) -> tuple[float, tuple[tuple[str, str], ...]]:
    """Least decimal logarithm of guesses and the segmentation ``(kind, text)`` that has it.

    Of equal costs the one with fewer, then with longer last segments is taken. Beginnings that
    cost ``enough`` are not carried on: a value that can't be had for less costs ``enough``,
    without a segmentation. With it, the time is linear in the value's length.
    """
    best, n = _reached(value, corpus or {}, enough, True), len(value)
    if n not in best:
        return enough, ()
    parts, at = [], n
    while at:
        _, _, start, kind = best[at]
        if kind == "brute" and parts and parts[-1][0] == "brute":
            parts[-1] = (kind, value[start:at] + parts[-1][1])
        else:
            parts.append((kind, value[start:at]))
        at = start
    return best[n][0], tuple(reversed(parts))


def _reached(value: str, corpus: Mapping[str, int], enough: float, whole: bool) -> dict[int, tuple[float, int, int, str]]:
    """Positions that are reached, from the left: cost, segments, where the last began, its kind.

    Unless the ``whole`` way is asked for, positions are forgotten as the search passes them.
    """
    n, low = len(value), value.lower()
    plain = low.translate(_LEET)
    best: dict[int, tuple[float, int, int, str]] = {0: (0.0, 0, 0, "")}
    open_, none = [0], (inf, 0, 0, "")

    def reach(end: int, cost: float, count: int, start: int, kind: str) -> None:
        step = (round(cost, 9), count, start, kind)
        if step[0] < enough and step[:2] < best.get(end, none)[:2]:
            if end not in best:
                heappush(open_, end)
            best[end] = step

    while open_:
        i = heappop(open_)
        if i == n:
            break
        cost, count, _, last = best[i] if whole else best.pop(i)
        chain = last == "brute"
        reach(i + 1, cost + _brute(value[i]) + (0.0 if chain else 0.3), count + (not chain), i, "brute")
        for end, more, kind in _pieces(value, i, low, plain, corpus):
            reach(end, cost + more + 0.3, count + 1, i, kind)
    return best


def least_cost(value: str, corpus: Mapping[str, int], enough: float = inf) -> float:
    """The cost of :func:`guess_cost` without its segmentation, in memory for few positions."""
    return _reached(value, corpus, enough, False).get(len(value), (enough,))[0]


class Guesser:
    """Costs of values by a corpus' words; those of short values are kept."""

    def __init__(self, corpus: Mapping[str, int] | None = None) -> None:
        self.corpus = corpus or {}
        self._kept = lru_cache(4096)(lambda value, enough: least_cost(value, self.corpus, enough))

    def cost(self, value: str, enough: float = inf) -> float:
        """The least cost, or ``enough`` if it is that or more, of a value of any length."""
        return self._kept(value, enough) if len(value) <= KEPT else least_cost(value, self.corpus, enough)



_PLAIN = Guesser()


@dataclass(frozen=True)
class Span:
    """Code points ``start`` to ``end`` of a text; the secret itself starts at ``value``.

    ``cost`` is at most ``MIN_COST``: a span needs no more.
    """

    kind: str
    start: int
    end: int
    value: int
    cost: float = 0.0

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


def find(text: str | None, guesser: Guesser = _PLAIN) -> list[Span]:
    """All spans of a whole text by start, then kind; a null text is empty. Spans of fixed
    formats have no cost."""
    text = text or ""
    low, spans = text.lower(), []
    if any(h in low for h in _ASSIGN_HINTS):
        spans += [Span("assign", *m.span(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [Span("access", *m.span(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [Span("hex", *m.span(), m.start()) for m in HEX.finditer(text)]
    if any(h in low for h in _CONTEXT_HINTS):
        base = list(spans)
        for m in CONTEXT.finditer(text):
            quote, group = (m[3], 4) if m[2] is None else (m[1], 2)
            start, end = m.span(group)
            if quote and (close := re.search(rf"(?<!\\){quote}", text[start + 6 : end])):
                end = start + 6 + close.start()
            while end > start and text[end - 1] in "\"',.;:!?)]}>。、，；：！？）」』】":
                end -= 1
            if end - start < 6 or any(s.start <= start and end <= s.end for s in base):
                continue
            if group == 4 and _PROSE.fullmatch(text, start, end):
                continue
            cost = guesser.cost(text[start:end], MIN_COST)
            # a value of which a fixed format has seen the beginning is a secret to its end
            if cost >= MIN_COST or any(s.kind == "assign" and s.value <= start < s.end for s in base):
                spans.append(Span("guess", start, end, start, cost))
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def redact(text: str | None, guesser: Guesser = _PLAIN) -> str | None:
    """The text with every secret value replaced by its kind in angle brackets."""
    spans = find(text, guesser)
    if not spans:
        return text
    out, at = [], 0
    for s in spans:
        if s.end > at:
            if s.value >= at:
                out += [text[at : s.value], f"<{s.kind}>"]
            at = s.end
    return "".join([*out, text[at:]])


#: A word of prose: small letters, a capital first at most, and no sign or digit beside it.
_WORD = re.compile(r"(?<![^\s(\"'„“«])[^\W\d_A-ZÀ-Þ]{3,24}(?=[\s,.;:!?)\"'“”»]|$)|(?<![^\s(\"'„“«])[A-ZÀ-Þ][^\W\d_A-ZÀ-Þ]{2,23}(?=[\s,.;:!?)\"'“”»]|$)")


def corpus_words(docs: DataFrame, n: int = CORPUS_WORDS, text_col: str = "text") -> dict[str, int]:
    """The ``n`` words of prose that most distinct texts of ``docs`` have, lower-cased, with their
    ranks from 1; ties by code points. Every text is read whole.

    Of a word standing behind a sign, as values do, nothing is counted, nor of one with digits or
    capitals inside: a secret that many texts share stays out. Ranks are running counts over
    slices of the ordered words, so ``n`` rows come to the driver, however many tasks there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            words, counts = list(held), list(held.values())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                held.update({w.lower() for w in _WORD.findall(_CREDENTIAL.sub(" ", text.as_py() or ""))})
                if len(held) > 100_000:
                    yield out()
                    held.clear()
        yield out()

    counts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = materialise(counts.where("n > 1").withColumns({"one": F.lit(1), "behind": -F.col("n"), "scale": F.floor(F.log2("n"))}), "corpus_words")
    # words whose count has a power of two that can't be among the first n are not ranked
    least, above = 0, 0
    for scale, held in sorted(((r["scale"], r["count"]) for r in counted.groupBy("scale").count().collect()), reverse=True):
        least, above = scale, above + held
        if above >= n:
            break
    ranked = running_total(counted.where(F.col("scale") >= least), ["behind", "word"], "one", "rank")
    return {r["word"]: r["rank"] for r in ranked.where(F.col("rank") <= n).select("word", "rank").collect()}


#: A credential word with its sign and what stands behind it.
_CREDENTIAL = re.compile(r"(?i)(?:pwd|pass\w*|passwd|secret|token|credentials?|auth\w*|bearer|basic|key)[\"']?[\x20\t]*(?:=>|[:=])[\x20\t]*\S+")


_FOUND = "struct<n_assign:long,n_access:long,n_hex:long,base_sha256:string,spans:string,n_guess:long,max_cost:double>"


def found(text: Column, corpus: Mapping[str, int] | None = None) -> Column:
    """Struct of counts by kind, the digest of the base spans, all spans, the largest guess cost
    of the method's own spans, whose values are scored to their ends, however long they are."""
    words = dict(corpus or {})

    @F.arrow_udf(_FOUND)
    def told(texts: pa.Array) -> pa.Array:
        rows, guesser = [], Guesser(words)
        for t in texts:
            text = t.as_py() or ""
            spans = find(text, guesser)
            base = ",".join(str(s) for s in spans if s.kind != "guess")
            n = {k: sum(s.kind == k for s in spans) for k in KINDS}
            rows.append({
                "n_assign": n["assign"], "n_access": n["access"], "n_hex": n["hex"],
                "base_sha256": hashlib.sha256(base.encode()).hexdigest(), "spans": ",".join(map(str, spans)),
                "n_guess": n["guess"], "max_cost": max((guesser.cost(text[s.start : s.end]) for s in spans if s.kind == "guess"), default=0.0),
            })
        kinds = {"n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(), "base_sha256": pa.string(), "spans": pa.string(), "n_guess": pa.int64(), "max_cost": pa.float64()}
        return pa.array(rows, pa.struct(list(kinds.items())))

    return told(text.cast("string"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", corpus: Mapping[str, int] | None = None) -> DataFrame:
    """One row for each row of ``docs``: its id and what :func:`found` tells of its text.

    ``corpus`` are words with ranks, as of :func:`corpus_words`, which it is by default for
    ``docs`` themselves. Null and empty texts have no spans; repeated rows come back as often
    as they are there; an empty table gives an empty one.
    """
    words = corpus_words(docs, text_col=text_col) if corpus is None else corpus
    told = docs.select(F.col(id_col).alias("doc_id"), found(F.col(text_col), words).alias("f"))
    return told.select("doc_id", "f.*")


def redacted(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", corpus: Mapping[str, int] | None = None) -> DataFrame:
    """``docs`` with secret values replaced; a length column is set to the new length of
    changed texts. ``corpus`` as in :func:`scan`.

    Rows and other columns stay, whatever they are called; null and empty texts stay as they
    are, rows that repeat change alike, and an empty table gives an empty one.
    """
    words = corpus_words(docs, text_col=text_col) if corpus is None else dict(corpus)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        guesser = Guesser(words)
        return pa.array([redact(t.as_py(), guesser) for t in texts], pa.string())

    helper = "_clean"
    while helper in docs.columns:
        helper += "_"
    columns = [F.col(f"`{c}`") for c in docs.columns]
    new = docs.withColumn(helper, clean(F.col(text_col).cast("string")))
    if length_col in docs.columns:
        changed = ~F.col(text_col).eqNullSafe(F.col(helper))
        kind = docs.schema[length_col].dataType
        new = new.withColumn(length_col, F.when(changed, F.char_length(helper).cast(kind)).otherwise(F.col(length_col)))
    return new.withColumn(text_col, F.col(helper)).select(*columns)
