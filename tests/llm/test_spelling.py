"""Spelling variants against SQL and against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from compare import difference
from fitloom.llm import spelling
from fitloom.llm.queries import ORACLE, QUERIES


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def pairs(spark, words):
    df = spark.createDataFrame([(w, n) for w, n in words.items()], "word string, n long").repartition(3)
    return sorted(map(tuple, spelling.neighbours(df).collect()))


def plain(words):
    return sorted((a, words[a], b, words[b]) for a in words for b in words if one_edit(a, b))


def counted(rows, every=199):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def test_query_equals_sql(spark, folder):
    assert difference(spark, folder, "op12_spelling", QUERIES["op12_spelling"], ORACLE["op12_spelling"]) is None


@pytest.mark.parametrize("limit", [-1, 8 << 20])
def test_all_pairs_of_random_words(spark, monkeypatch, limit):
    monkeypatch.setattr(spelling, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(spelling, "ROWS", 37)
    rng = random.Random(4)
    words = {"".join(rng.choices("abé", k=rng.randint(1, 7))): rng.randint(5, 99) for _ in range(250)}
    assert pairs(spark, words) == plain(words)


def test_shared_beginnings_and_long_words(spark):
    long = "x" * 3000
    words = dict.fromkeys([long, long + "y", long[1:], "z" + long[1:], long[:1500] + "q" + long[1501:], long + "yz", "aaaaaa", "aaaaaaa", "aaaaaaaa", "aabaaa", "baaaaa", "aaaaab"], 5)
    assert pairs(spark, words) == plain(words)


def test_forms_and_roots(spark):
    rows = [("abcdef", 3000), ("abcdeg", 500), ("abcdgg", 90), ("abcggg", 10), ("abcdeh", 600), ("abcdei", 601), ("zzzzzz", 7), ("zzzzzy", 35), ("zzzzzx", 35)]
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got["abcggg"] == ("abcdgg", "abcdef", 10, 1, 90) and got["abcdgg"][:2] == ("abcdeg", "abcdef")
    assert got["abcdei"][:2] == (None, "abcdei") and got["abcdef"] == (None, "abcdef", 3000, 3, None)
    assert got["abcdeh"][:2] == ("abcdef", "abcdef") and got["zzzzzz"] == ("zzzzzx", "zzzzzx", 7, 2, 35)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "Élan Ünder-Wörter ×÷× WORDS " * 9), (3, "Élan Ünder-Wörter ×÷× WORDS " * 9), (None, "wording " * 40), (4, "12 <> 私の"), (5, "k" * 100_000 + " ")]
    rows += [(100 + i, "letters Letter LETTERS letterz ") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "text as word", "1 as n", "doc_id as run")
    known = {r.word: r.n for r in spelling.words(docs).collect()}
    assert known == counted(rows) and "×÷×" not in known and "letter" in known
    got = spelling.variants(spelling.words(docs)).collect()
    assert {r.word: r.n for r in got} == known
    assert spelling.variants(spelling.words(docs.where("false"))).collect() == []
