"""Exact top-k against a full sort, with ties, repeats and odd vectors."""

import random

import numpy as np
import pytest
from compare import difference
from fitloom.llm import topk
from fitloom.llm.queries import ORACLE, QUERIES
from pyspark.sql import functions as F


def plain(vectors, queries, k):
    out = {}
    for q, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in vectors if i != q and len(w) == len(v))
        out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_query_equals_sql(spark, folder):
    assert difference(spark, folder, "op3_topk", QUERIES["op3_topk"], ORACLE["op3_topk"]) is None


@pytest.mark.parametrize(("tiles", "waves"), [((3, 7), 5), ((256, 4096), 16_384)])
def test_ties_and_waves(spark, monkeypatch, tiles, waves):
    monkeypatch.setattr(topk, "TILE_QUERIES", tiles[0])
    monkeypatch.setattr(topk, "TILE_ROWS", tiles[1])
    monkeypatch.setattr(topk, "WAVE", waves)
    rng = random.Random(3)
    common = [5, -3, 2, 1, 0, 4, -1]
    vectors = [(i, common if i % 3 == 0 else [rng.randint(-9, 9) for _ in range(7)]) for i in range(120)]
    vectors += [(500 + i, [rng.randint(-9, 9) for _ in range(3)]) for i in range(4)]
    df = spark.createDataFrame(vectors, "vec_id long, v array<long>").repartition(5)
    queries = [(i, v) for i, v in vectors if i % 10 == 0]
    got = found(topk.search(df, df.where("vec_id % 10 = 0"), 6))
    assert got == plain(vectors, queries, 6)


def test_large_components_stay_exact(spark):
    rng = random.Random(9)
    vectors = [(i, [rng.randint(-(2**28), 2**28) for _ in range(8)]) for i in range(40)]
    df = spark.createDataFrame(vectors, "vec_id long, v array<long>")
    assert found(topk.search(df, df.where("vec_id < 5"), 3)) == plain(vectors, vectors[:5], 3)


@pytest.mark.parametrize("spread", [1.0, 0.2])
def test_later_lists_are_made_for_fewer_pairs(spread):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 300, (20, 64))
    rows = np.floor(centres[rng.integers(0, 20, 3000)] + rng.normal(0, 300 * spread, (3000, 64))).astype(np.int64)
    lists = topk.Lists(np.arange(40), rows[:40])
    whole = rows[:40] @ rows.T
    floor = np.sort(whole, axis=1)[:, -10]
    turned = rows[:, lists.order]
    which, row, score, made = lists.collect(slice(0, 40), turned, lists.norms(turned), floor)
    assert sorted(zip(which.tolist(), row.tolist(), score.tolist(), strict=True)) == [
        (i, j, int(whole[i, j])) for i, j in zip(*np.nonzero(whole >= floor[:, None]), strict=True)
    ]
    assert made[0] == 40 * 3000 and made[0] >= made[1] >= made[2] > made[3]
    assert sum(made) < 0.9 * 4 * made[0]
    # the first phase makes one list, and what it reaches is no more than the cutoff it stands for
    for number in range(topk.LISTS):
        which, row, score = lists.gather(slice(0, 40), turned, number, 10)
        assert (score == whole[which, row]).all() and len(set(zip(which.tolist(), row.tolist(), strict=True))) == len(which)


def test_floors_without_a_cutoff_or_with_a_negative_one():
    rng = np.random.default_rng(5)
    rows = -np.abs(rng.integers(1, 50, (300, 9)))
    queries = np.abs(rng.integers(1, 50, (6, 9)))
    lists, whole = topk.Lists(np.arange(6), queries), queries @ rows.T
    turned = rows[:, lists.order]
    for floor in (np.full(6, topk.NONE), np.sort(whole, axis=1)[:, -4], np.full(6, 1)):
        which, row, score, _ = lists.collect(slice(0, 6), turned, lists.norms(turned), floor)
        assert len(which) == (whole >= floor[:, None]).sum() and (score == whole[which, row]).all()


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5]), (100, [1.0, None]), (200, None), (300, [float("nan"), 1.0]), (400, [float("inf"), 1.0]), (1, [0.5, 0.5]), (2, []), (None, [1.0, 1.0]), (3, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = df.select("vec_id", topk.scaled(F.col("embedding")).alias("v"), F.lit(1).alias("score"))
    assert found(topk.search(v, v.where("vec_id % 100 = 0"), 10)) == {0: [(1, 1, 1024 * 512 + 512 * 512)]}
    assert topk.search(v.where("false"), v.where("false")).collect() == []
    assert topk.search(v, v.where("false")).collect() == []
