import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fitloom.operators import stats


@pytest.fixture
def tiny_windows(monkeypatch):
    """Take the distributed path for every running total."""
    monkeypatch.setattr(stats, "WINDOW_ROWS", 0)


def test_running_total_is_layout_independent(spark):
    df = spark.range(500).select((F.col("id") * 7 % 501).alias("k"), (F.col("id") % 3).alias("n"), (F.col("id") % 2).alias("g"))
    rows = {}
    for parts in (1, 7, 32):
        got = stats.running_total(df.repartition(parts), ["k"], "n", "upto", ["g"]).collect()
        rows[parts] = sorted((r["g"], r["k"], r["upto"]) for r in got)
    assert rows[1] == rows[7] == rows[32]
    for g in (0, 1):
        total = 0
        mine = sorted((r["k"], r["n"]) for r in df.where(F.col("g") == g).collect())
        for (k, n), (_, got_k, upto) in zip(mine, [r for r in rows[1] if r[0] == g]):
            total += n
            assert (k, total) == (got_k, upto)


def test_median_examples(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, None, None), (3.0, 5.0, None), (4.0, 5.0, None), (None, float("nan"), None)],
                               "a double, b double, c double")
    assert stats.medians(df, ["a", "b", "c"]) == {"a": 2.5, "b": 5.0, "c": None}
    assert stats.medians(df, []) == {}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0])), min_size=1, max_size=60))
def test_median_equals_the_sorted_middle(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    present = [v for v in values if v is not None]
    expected = statistics.median(present) if present else None
    got = stats.medians(df, ["x"])["x"]
    assert got == pytest.approx(expected) if present else got is None


@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_median_with_hot_value_and_distributed_counts(spark, tiny_windows, accuracy):
    df = spark.range(3001).select(F.when(F.col("id") % 3 == 0, 50.0).otherwise(F.col("id") % 101).alias("x"), F.col("id").alias("y"))
    exact = df.agg(F.median("x"), F.median("y")).first()
    assert stats.medians(df, ["x", "y"], accuracy) == {"x": exact[0], "y": exact[1]}


def test_median_survives_a_wrong_sketch(spark, monkeypatch):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    wrong = lambda c, p, a: F.array(F.lit(900.0) + F.min(c), F.lit(950.0) + F.min(c))
    monkeypatch.setattr(stats.F, "percentile_approx", wrong)
    assert stats.medians(df, ["x"]) == {"x": 500.0}


def test_mode_ties_and_missing(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), (None, 2)], "s string, n int")
    assert stats.modes(df, ["s", "n"]) == {"s": "a", "n": 2}
    assert stats.modes(df.limit(0), ["s"]) == {"s": None}


def test_value_counts_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,)], "x double")
    assert [(r["value"], r["n"]) for r in stats.value_counts(df, ["x"]).collect()] == [(0.0, 2)]
    with pytest.raises(ValueError):
        stats.value_counts(spark.createDataFrame([(1, "a")], "x int, y string"), ["x", "y"])


def test_scaling_statistics(spark):
    df = spark.createDataFrame([(float(i),) for i in (1, 2, 3, 4)], "x double")
    mean, deviation = stats.means_and_deviations(df, ["x"])["x"]
    assert mean == 2.5 and deviation == pytest.approx(1.118033988749895)


def test_class_shares(spark):
    rows = stats.class_shares(spark.createDataFrame([(0,), (1,)], "y int"), "y").collect()
    assert {(r["y"], r["share"], r["majority"]) for r in rows} == {(0, 0.5, True), (1, 0.5, False)}
