"""Hard negatives against SQL and against all pairs."""

import itertools
import random

import numpy as np
import pytest
from compare import difference
from fitloom.llm import hardnegatives
from fitloom.llm.queries import ORACLE, QUERIES
from pyspark.sql import functions as F


def plain(rows, anchors, positives=5, negatives=5):
    out = []
    for a, label, v in anchors:
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, m) for i, m, w in rows if i != a and len(w) == len(v))
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(n, j) for n, j, m in scored if m != label and 80 * -p <= 100 * -n <= 100 * -p]
            out += [(a, i, r + 1, j, -p, -n) for r, (n, j) in enumerate(fits[:negatives])]
    return sorted(out)


def found(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, v array<long>").repartition(4)


def test_query_equals_sql(spark, folder):
    assert difference(spark, folder, "op11_hardnegatives", QUERIES["op11_hardnegatives"], ORACLE["op11_hardnegatives"]) is None


@pytest.mark.parametrize(("block", "wave", "held"), [(3, 4, 5), (256, 4096, 400_000)])
def test_ties_repeats_and_waves(spark, monkeypatch, block, wave, held):
    monkeypatch.setattr(hardnegatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hardnegatives, "WAVE", wave)
    monkeypatch.setattr(hardnegatives, "HELD", held)
    rng = random.Random(8)
    common = [3, 4, -2, 1, 0]
    rows = [(i, i % 3, common if i % 4 == 0 else [rng.randint(-6, 6) for _ in range(5)]) for i in range(150)]
    rows += [(500 + i, i % 2, [rng.randint(1, 9) for _ in range(3)]) for i in range(12)]
    anchors = [r for r in rows if r[0] % 10 == 0]
    df = table(spark, rows)
    assert found(hardnegatives.mine(df, df.where("vec_id % 10 = 0"))) == plain(rows, anchors)


def test_large_components_stay_exact(spark):
    rng = random.Random(9)
    rows = [(i, i % 2, [rng.randint(0, 2**29) for _ in range(6)]) for i in range(60)]
    df = table(spark, rows)
    assert found(hardnegatives.mine(df, df.where("vec_id < 5"))) == plain(rows, rows[:5])


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = hardnegatives.hilbert_index(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_close_blocks():
    rng = np.random.default_rng(3)
    anchors, rows = rng.integers(-50, 50, (9, 6)), rng.integers(-5, 40, (70, 6))
    one = np.full((9, 1), 1)
    windows = hardnegatives.Windows(np.arange(9), np.zeros(9, int), anchors, one * 500, one * 900, True, 5)
    least, most = windows.bounds(rows.min(axis=0)[None], rows.max(axis=0)[None])
    scores = anchors @ rows.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, 0]).all()
    open_ = windows.reach(least, most, windows.low)[:, 0, 0]
    assert (open_ == ((most[:, 0] >= 500) & (least[:, 0] <= 900))).all() and not windows.reach(least, most, one * 10**6).any()


def test_parts_far_away_stay_closed(spark, monkeypatch):
    monkeypatch.setattr(hardnegatives, "BLOCK_ROWS", 8)
    rng = random.Random(2)
    rows = [(i, i % 2, [rng.randint(90, 99) if j == i % 16 // 2 else 0 for j in range(8)]) for i in range(1, 800)]
    blocks = hardnegatives.candidate_blocks(table(spark, rows), 8, len(rows))
    ids, far = np.array([0]), np.full((1, 1), 1 << 62)
    windows = hardnegatives.Windows(ids, np.array([0]), np.array([[50] + [0] * 7]), -far, far, True, 5)
    zones = blocks.where("lo is not null").select("part", "block", "label", "lo", "hi")
    parts = zones.mapInArrow(hardnegatives._open_parts(windows, np.array([[4500]])), "part int").distinct().count()
    assert 0 < parts < blocks.select("part").distinct().count() / 2
    assert blocks.count() == 799 and zones.count() >= 100


def test_odd_rows(spark):
    rows = [
        (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 2, [0.9, 0.5]), (2, 2, [0.9, 0.5]), (3, None, [1.0, 1.0]), (4, 2, None), (5, 2, [1.0, None]),
        (6, 2, [float("nan"), 1.0]), (7, 1, [float("inf"), 1.0]), (None, 1, [1.0, 1.0]), (8, 2, []), (9, 1, []), (10, 1, [-1.0, -1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    v = df.select("vec_id", "label", hardnegatives.scaled(F.col("embedding")).alias("v"), F.lit(1).alias("rank"))
    got = found(hardnegatives.mine(v, v.where("vec_id in (0, 9, 10)")))
    score, other = 256 * 256 + 128 * 128, 256 * 230 + 128 * 128
    assert got == [(0, 1, 1, 2, score, other), (0, 1, 2, 2, score, other)]
    assert hardnegatives.mine(v.where("false"), v.where("false")).collect() == []
    assert hardnegatives.mine(v, v.where("false")).collect() == []
