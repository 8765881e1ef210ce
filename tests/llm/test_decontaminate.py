"""Leaks against a scan of all items and passages, edits, odd inputs."""

import random
import re

import pyarrow.parquet as pq
import pytest
from fitloom.llm import decontaminate as D
from fitloom.llm.queries import op4_decontaminate


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_leaks(texts, items):
    """Documents that hold 0.8 of an item's shingles anywhere."""
    own = {i: s for i, t in items if (s := shingles(t))}
    return {(d, i) for d, t in texts for seen in (shingles(t),) for i, s in own.items() if len(s & seen) >= 0.8 * len(s)}


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = (pq.read_table(f"{folder}/{n}.parquet").to_pydict() for n in ("documents", "benchmark"))
    want = plain_leaks(zip(docs["doc_id"], docs["text"], strict=True), list(zip(items["item_id"], items["text"], strict=True)))
    got = op4_decontaminate(spark, folder).collect()
    assert want and {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert all(r.score >= D.THRESHOLD - 1e-6 and r.overlap >= 0.8 for r in got)


def make(rng, n):
    return [f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.randrange(40)}" for _ in range(n)]


@pytest.mark.parametrize("group", [64, 1 << 15])
def test_planted_items_at_any_place(spark, monkeypatch, group):
    monkeypatch.setattr(D, "GROUP", group)
    rng = random.Random(group)
    items = [(i, " ".join(make(rng, n)) + ". " + " ".join(make(rng, 4)) + ".") for i, n in enumerate([8, 14, 30, 31, 60, 120])]
    docs, want = [], set()
    for d in range(60):
        words = make(rng, rng.randint(0, 300))
        item = rng.choice(items) if d % 2 else None
        if item:
            at = rng.randint(0, len(words))
            words[at:at] = item[1].upper().split() if d % 3 else item[1].split()
            want.add((d, item[0]))
        docs.append((d, " ".join(words)))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.contaminated(df, bench).collect()} == want == plain_leaks(docs, items)
    assert {r.doc_id for r in D.decontaminated(df, bench).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_many_indexes_give_the_same(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    one = sorted(map(tuple, op4_decontaminate(spark, folder).collect()))
    monkeypatch.setattr(D, "INDEX_WORDS", 1500)
    assert sorted(map(tuple, op4_decontaminate(spark, folder).collect())) == one


def test_an_edited_word_is_still_a_leak(spark):
    rng = random.Random(1)
    question, answer = make(rng, 30), make(rng, 8)
    item = " ".join(question) + "? " + " ".join(answer) + "."
    edited = list(question)
    edited[12] = "changed"
    docs = [(1, " ".join(make(rng, 50) + edited + answer)), (2, " ".join(make(rng, 50) + question[:20])), (3, " ".join(reversed(question + answer)))]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in D.contaminated(df, bench).collect()] == [(1, 7)]


def test_odd_rows(spark):
    item = "one two three four five six seven eight nine ten. eleven twelve thirteen."
    items = [(1, item), (1, item), (2, None), (3, ""), (4, "too short"), (None, item + " more words at the end here now")]
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, "x " * 300_000 + item), (4, "One, two; three four five six seven eight nine TEN eleven twelve thirteen")]
    df = spark.createDataFrame([(i, t, 1.0, 2) for i, t in docs], "doc_id long, text string, score double, item_id int")
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    got = sorted([(r.doc_id, r.item_id) for r in D.contaminated(df, bench).collect()], key=str)
    assert got == sorted([(3, 1)] * 4 + [(4, 1)] * 2 + [(None, 1)] * 2, key=str)
    kept = D.decontaminated(df, bench)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {1, 2}
    assert D.contaminated(df, bench.where("false")).collect() == [] and D.contaminated(df.where("false"), bench).collect() == []
