"""Held-out accuracy, prototypes that no layout changes, odd inputs."""

import numpy as np
from fitloom.llm import language
from fitloom.llm.queries import op2_language
from pyspark.sql import functions as F


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    known = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = op2_language(spark, folder).join(known, "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang is not None]
    assert len(rows) == known.count() and len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_layout_changes_no_prototype(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    a, b = language.learn(docs.repartition(1)), language.learn(docs.repartition(7, "source"))
    assert a.languages == b.languages and np.array_equal(a.prototypes, b.prototypes)


def test_slices_change_no_bundle(monkeypatch):
    text = "Ünïcode wörds -- and, plain  ones! " * 80
    whole = language.Binder().text(text)
    for size in (1, 2, 9, 64):
        monkeypatch.setattr(language, "SLICE", size)
        assert np.array_equal(language.Binder().text(text), whole)


def test_a_full_cache_changes_no_bundle(monkeypatch):
    text = "".join(chr(97 + i * i % 26) + (" " if i % 5 == 0 else "") for i in range(3000))
    whole = language.Binder().text(text)
    monkeypatch.setattr(language, "CACHE_ROWS", 2048)
    binder = language.Binder()
    assert np.array_equal(binder.text(text), whole) and np.array_equal(binder.text(text), whole)


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "", "de"), (5, "123 !?", None), (6, "the dog", None)]
    rows += [(6, "the dog", None), (None, "und der Hund", None), (7, "the " * 300_000, None)]
    docs = spark.createDataFrame([(i, t, g, 9, "s") for i, t, g in rows], "doc_id long, text string, lang string, score int, lang_pred string")
    profiles = language.learn(docs.where(F.col("doc_id") < 6))
    assert profiles.languages == ("de", "en")
    got = [(r.doc_id, r.lang_pred) for r in language.identify(docs, profiles).collect()]
    want = [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (6, "en"), (None, "de"), (7, "en")]
    assert sorted(got, key=str) == sorted(want, key=str)
    none = language.learn(docs.where("false"))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.where("false"), profiles).collect() == []


def test_held_out_is_the_remainder(spark):
    import zlib

    df = spark.range(200).select(F.col("id"), language.held_out("id", 4, 2).alias("h"))
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in df.collect())
