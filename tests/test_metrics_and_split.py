import math

import pytest
from pyspark.sql import functions as F

from fitloom.operators import metrics, split, stats


def value(df):
    return df.first()[0]


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame([(1, 0, 1, 0), (1, 1, 1, 0)], "y1 int, y2 int, p1 int, p2 int")


def test_accuracy(pairs):
    assert value(metrics.accuracy(pairs, "y2", "p2")) == 0.5
    assert value(metrics.exact_match(pairs, {"y1": "p1", "y2": "p2"})) == 0.5


def test_accuracy_of_text_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "y string, p string")
    assert value(metrics.accuracy(df, "y", "p")) == 0.5


def test_log_loss_is_clipped_and_checked(spark):
    sure = spark.createDataFrame([(1, 0.0)], "y int, p double")
    assert value(metrics.log_loss(sure, "y", "p")) == pytest.approx(-math.log(metrics.EPSILON))
    half = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, p double")
    assert value(metrics.log_loss(half, "y", "p")) == pytest.approx(math.log(2))
    with pytest.raises(TypeError, match="not a probability column"):
        metrics.log_loss(spark.createDataFrame([(1, 1)], "y int, p int"), "y", "p")
    with pytest.raises(Exception, match="not a probability"):
        metrics.log_loss(spark.createDataFrame([(1, 1.5)], "y int, p double"), "y", "p").collect()


def test_log_loss_of_two_targets(spark):
    df = spark.createDataFrame([(1, 0, 0.5, 0.25)], "a int, b int, p double, q double")
    both = {"a": "p", "b": "q"}
    mean = (-math.log(0.5) - math.log(0.75)) / 2
    assert value(metrics.log_loss_targets(df, both)) == pytest.approx(mean)
    assert value(metrics.log_loss_targets(df, both, "indicator")) == pytest.approx(-math.log(0.5))
    with pytest.raises(ValueError):
        metrics.log_loss_targets(df, both, "other")


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_auc(spark, monkeypatch, limit):
    monkeypatch.setattr(stats, "WINDOW_ROWS", limit)
    tie = spark.createDataFrame([(1, 0.3), (0, 0.3)], "y int, s double")
    assert value(metrics.roc_auc(tie, "y", "s")) == 0.5
    rows = [(int((i * 7919) % 13 < 4), float((i * 31) % 17)) for i in range(400)] + [(1, 5.0)] * 200
    df = spark.createDataFrame(rows, "y int, s double")
    good, bad = [s for y, s in rows if y], [s for y, s in rows if not y]
    brute = sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))
    for parts in (1, 7, 32):
        assert value(metrics.roc_auc(df.repartition(parts), "y", "s")) == pytest.approx(brute, abs=1e-12)


def test_auc_of_one_class_is_undefined(spark):
    assert value(metrics.roc_auc(spark.createDataFrame([(1, 0.3)], "y int, s double"), "y", "s")) is None


def test_squared_errors(spark):
    df = spark.createDataFrame([(3.0, 3.0, 0.0), (0.0, 0.0, 2.0)], "y double, same double, p double")
    assert value(metrics.rmse(df, "y", "p")) == pytest.approx(math.sqrt(6.5))
    assert value(metrics.rmsle(df, "y", "same")) == 0.0
    assert value(metrics.msle(df, "y", "p")) == pytest.approx((math.log(4) ** 2 + math.log(3) ** 2) / 2)
    with pytest.raises(Exception, match="negative value"):
        metrics.rmsle(spark.createDataFrame([(1.0, -0.5)], "y double, p double"), "y", "p").collect()
    assert metrics.side_by_side([metrics.rmse(df, "y", "same")]) == {"rmse": 0.0}


def keys(df):
    return sorted(r[0] for r in df.select("id").collect())


@pytest.mark.parametrize("cut", [split.hash_split, split.exact_split])
def test_split_does_not_depend_on_partitions(spark, cut):
    df = spark.range(1000)
    sides = [keys(cut(df.repartition(n), "id").test) for n in (1, 7, 32)]
    assert sides[0] == sides[1] == sides[2]
    parts = cut(df, "id")
    assert sorted(keys(parts.train) + keys(parts.test)) == list(range(1000))
    assert keys(cut(df, "id", seed=7).test) != sides[0]


@pytest.mark.parametrize("n, fraction, limit", [(1001, 0.2, 100_000), (1001, 0.2, 1), (1, 0.2, 1), (7, 0.5, 1), (10, 0.999, 1)])
def test_exact_split_has_exact_size(spark, monkeypatch, n, fraction, limit):
    monkeypatch.setattr(split, "CUT_ROWS", limit)
    df = spark.range(n)
    test = keys(split.exact_split(df, "id", fraction).test)
    assert len(test) == math.ceil(n * fraction)
    lowest = df.orderBy(split.key_hash("id", 42), "id").limit(len(test))
    assert test == keys(lowest)


def test_exact_split_of_nothing_and_of_duplicates(spark, monkeypatch):
    assert split.exact_split(spark.range(0), "id").test.count() == 0
    rows = spark.range(100).select(F.floor(F.col("id") / 10).alias("g"), "id").union(spark.range(30).select(F.lit(77).alias("g"), "id"))
    sides = []
    for limit in (100_000, 3):  # the same groups, whatever the size
        monkeypatch.setattr(split, "CUT_ROWS", limit)
        parts = split.exact_split(rows, "g", 0.2)
        sides.append({(r.g, r.n) for r in parts.test.groupBy("g").agg(F.count("*").alias("n")).collect()})
        assert parts.test.count() >= 26 and parts.test.count() + parts.train.count() == 130
    assert sides[0] == sides[1] and all(n == (30 if g == 77 else 10) for g, n in sides[0])
    monkeypatch.setattr(split, "CUT_ROWS", 3)
    assert split.exact_split(spark.range(9).select(F.lit(1).alias("id")), "id").test.count() == 9


def test_exact_split_with_composite_key(spark):
    df = spark.range(200).select((F.col("id") % 10).alias("id"), F.col("id").cast("string").alias("b"))
    parts = split.exact_split(df, ["id", "b"], 0.25)
    assert parts.test.count() == 50 and parts.train.count() == 150


def test_group_split_keeps_groups_together(spark):
    df = spark.range(900).select("id", (F.col("id") % 90).alias("g"))
    parts = split.hash_split(df, "g")
    assert parts.test.select("g").intersect(parts.train.select("g")).count() == 0
    assert 0 < parts.test.count() < 900


def test_share_must_be_a_share(spark):
    for cut in (split.hash_split, split.exact_split):
        with pytest.raises(ValueError):
            cut(spark.range(3), "id", 1.0)


NAN = float("nan")


@pytest.mark.parametrize("gap", [(None, 0.5), (1, None), (1, NAN)])
@pytest.mark.parametrize("metric", ["accuracy", "log_loss", "roc_auc", "rmse", "msle", "rmsle"])
def test_a_missing_value_fails_a_metric_or_is_counted(spark, metric, gap):
    whole = [(0, 0.25), (1, 0.75), (1, 0.5)]
    fn = getattr(metrics, metric)
    df = spark.createDataFrame([*whole, gap], "y int, p double")
    with pytest.raises(Exception, match="missing label or prediction"):
        fn(df, "y", "p").collect()
    kept = fn(df, "y", "p", missing="skip").first()
    assert kept.n == 3 and kept[0] == fn(spark.createDataFrame(whole, df.schema), "y", "p").first()[0]
    with pytest.raises(ValueError, match="unknown handling"):
        fn(df, "y", "p", missing="guess")


def test_missing_values_of_several_targets(spark):
    df = spark.createDataFrame([(0, 1, 0.25, 0.5), (1, None, 0.75, 0.5)], "a int, b int, pa double, pb double")
    pairs = {"a": "pa", "b": "pb"}
    for fn in (metrics.log_loss_targets, metrics.exact_match):
        with pytest.raises(Exception, match="missing label or prediction"):
            fn(df, pairs).collect()
        assert fn(df, pairs, missing="skip").first().n == 1


def test_labels_other_than_zero_and_one_are_refused(spark):
    df = spark.createDataFrame([(2, 0.5)], "y int, p double")
    for fn in (metrics.log_loss, metrics.roc_auc):
        with pytest.raises(Exception, match="not a 0/1 label"):
            fn(df, "y", "p").collect()
