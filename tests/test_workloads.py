"""The complete jobs, from CSV files to a CSV submission."""

import pytest
from pyspark.sql import functions as F

from fitloom.plans import workloads as w
from fitloom.plans.models import boosted_classifier, boosted_regressor, forest_classifier
from fitloom.sources import hashed_integers, hashed_normal, hashed_uniform, numbered_rows, read_csv, write_csv


def through_csv(spark, df, path, **options):
    write_csv(df, str(path))
    return read_csv(spark, str(path), **options)


def finished(spark, outcome, path, columns, rows):
    write_csv(outcome.submission, str(path))
    back = read_csv(spark, str(path))
    assert back.columns == columns and back.count() == rows
    assert back.where(" or ".join(f"`{c}` is null" for c in columns)).count() == 0
    return outcome.score.first()[0]


def number(name, scale=1.0):
    return hashed_normal("id", name, 42, scale).alias(name)


def test_one_target(spark, tmp_path):
    def table(n, start):
        return numbered_rows(spark, n, start).select(
            "id", number("feat1", 10), number("feat2", 5), hashed_integers("id", "feat3", 42, 0, 100).alias("feat3"),
            hashed_uniform("id", "feat4", 42, 50).alias("feat4"), number("feat5"),
        )

    train = through_csv(spark, table(500, 1).withColumn("label", (F.col("feat1") * F.col("feat2") > 0).cast("int")), tmp_path / "a")
    test = through_csv(spark, table(200, 1001), tmp_path / "b")
    outcome = w.one_target(train, test, model=forest_classifier(trees=20))
    assert finished(spark, outcome, tmp_path / "out", ["id", "label"], 200) > 0.85


@pytest.mark.parametrize("output", ["prediction", "probability"])
def test_two_targets(spark, tmp_path, output):
    def table(n, start):
        return numbered_rows(spark, n, start).select("id", number("feat1", 10), number("feat2", 5))

    labels = {"label1": (F.col("feat1") > 0).cast("int"), "label2": (F.col("feat2") > 0).cast("int")}
    train = through_csv(spark, table(500, 1).withColumns(labels), tmp_path / "a")
    test = through_csv(spark, table(200, 1001), tmp_path / "b")
    outcome = w.two_targets(train, test, model=forest_classifier(trees=10), output=output)
    score = finished(spark, outcome, tmp_path / "out", ["id", "label1", "label2"], 200)
    assert score > 0.9 if output == "prediction" else score < 0.3


@pytest.mark.parametrize("scope, by", [("train", None), ("all", "series_id")])
def test_robot_surface(spark, tmp_path, scope, by):
    ids = numbered_rows(spark, 800)
    sensors = ids.select(
        F.concat(F.lit("r"), "id").alias("row_id"), (F.col("id") % 80).alias("series_id"), (F.col("id") % 10).alias("measurement_number"),
        (F.col("id") % 80 % 3 + hashed_uniform("id", "x", 1, 0.5)).alias("x"), number("noise"),
    )
    classes = numbered_rows(spark, 70, 0, "series_id").select(
        "series_id", (F.col("series_id") % 5).alias("group_id"),
        F.element_at(F.array(F.lit("carpet"), F.lit("tiles"), F.lit("wood")), (F.col("series_id") % 3 + 1).cast("int")).alias("surface"),
    )
    train, labels = through_csv(spark, sensors, tmp_path / "a"), through_csv(spark, classes, tmp_path / "b")
    outcome = w.robot_surface(train, labels, train, model=forest_classifier(trees=10), fit_scope=scope, by=by)
    assert outcome.scored.columns == ["row_id", "surface", "series_id", "surface_prediction"]
    assert finished(spark, outcome, tmp_path / "out", ["row_id", "surface"], 800) > 0.9


def test_bike_demand(spark, tmp_path):
    hours = numbered_rows(spark, 1500).select(
        F.date_format(F.timestamp_seconds(F.lit(1_300_000_000) + F.col("id") * 3600), "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        (F.col("id") % 7 < 5).cast("int").alias("workingday"), hashed_uniform("id", "temp", 1, 30).alias("temp"), "id",
    )
    full = hours.withColumn("count", (F.hour("datetime") * 10 + 5).cast("bigint"))
    full = full.withColumns({"casual": F.col("count"), "registered": F.lit(0)}).drop("id")
    train, test = through_csv(spark, full, tmp_path / "a"), through_csv(spark, hours.drop("id"), tmp_path / "b")
    outcome = w.bike_demand(train, test, model=boosted_regressor(rounds=10, rate=0.3))
    assert finished(spark, outcome, tmp_path / "out", ["datetime", "count"], 1500) < 0.4


def test_categorical_target(spark, tmp_path):
    def table(n, start):
        return numbered_rows(spark, n, start).select(
            "id", F.when(F.col("id") % 2 == 0, "T").otherwise("F").alias("bin_3"), (F.col("id") % 5).alias("ord_0"),
            (F.col("id") % 4).cast("string").alias("nom_0"), F.concat(F.lit("v"), F.col("id") % 25).alias("nom_9"),
            (F.col("id") % 7 + 1).alias("day"), (F.col("id") % 12 + 1).alias("month"),
        )

    train = through_csv(spark, table(600, 1).withColumn("target", (F.col("id") % 2).cast("int")), tmp_path / "a")
    unseen = table(100, 1001).withColumn("nom_9", F.lit("never seen"))
    test = through_csv(spark, unseen, tmp_path / "b")
    outcome = w.categorical_target(train, test, model=boosted_classifier(rounds=3))
    assert finished(spark, outcome, tmp_path / "out", ["id", "target"], 100) > 0.95
    assert outcome.scored.count() == 120


def test_house_prices(spark, tmp_path):
    def table(n, start):
        area = hashed_uniform("id", "area", 1, 200)
        return numbered_rows(spark, n, start).select(
            F.col("id").alias("Id"), area.alias("LotArea"), F.when(F.col("id") % 7 > 0, F.col("id") % 30).alias("Age"),
            F.when(F.col("id") % 5 > 0, F.concat(F.lit("Z"), F.col("id") % 3)).alias("Zone"),
        )

    train = through_csv(spark, table(400, 1).withColumn("SalePrice", 50_000 + 1000 * F.col("LotArea")), tmp_path / "a")
    test = through_csv(spark, table(150, 1001), tmp_path / "b")
    outcome = w.house_prices(train, test, model=boosted_regressor(rounds=10, rate=0.3))
    assert finished(spark, outcome, tmp_path / "out", ["Id", "SalePrice"], 150) < 0.15
    assert outcome.submission.agg(F.min("SalePrice")).first()[0] > 40_000
    assert outcome.scored.count() == 80


def test_game_events(spark, tmp_path):
    def table(n, start):
        return numbered_rows(spark, n, start).select("id", number("ball_pos_x", 50), F.when(F.col("id") % 6 > 0, F.col("id") % 100).alias("boost0"))

    near = hashed_uniform("id", "r", 1, 20.0)
    targets = {
        "team_A_scoring_within_10sec": (F.col("ball_pos_x") > 20 + near).cast("int"),
        "team_B_scoring_within_10sec": (F.col("ball_pos_x") < -20 - near).cast("int"),
    }
    extra = {"game_num": F.lit(1), "event_time": F.lit(0.5), "player_scoring_next": F.lit(2), "team_scoring_next": F.lit("A")}
    train = table(600, 1).withColumns(targets).withColumns(extra).withColumnRenamed("id", "event_id")
    parts = []
    for i, share in enumerate([F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1]):
        write_csv(train.where(share), str(tmp_path / f"train_{i}"))
        parts.append(str(tmp_path / f"train_{i}"))
    train = read_csv(spark, parts).withColumnRenamed("event_id", "id")
    test = through_csv(spark, table(150, 1001), tmp_path / "b")
    outcome = w.game_events(train, test, model=boosted_classifier(rounds=5, rate=0.3))
    assert finished(spark, outcome, tmp_path / "out", ["id", *targets], 150) < 0.3
    vectors = [s for s in outcome.learner.model.stages if hasattr(s, "getInputCols")]
    assert set(vectors[-1].getInputCols()) == {"ball_pos_x", "boost0", "boost0_missing"}


def test_game_events_from_lists_of_files(spark, tmp_path):
    rows = numbered_rows(spark, 400).select(
        "id", (F.col("id") % 10).alias("ball"), (F.col("id") % 10 < 4).cast("int").alias("team_A_scoring_within_10sec"),
        (F.col("id") % 10 > 6).cast("int").alias("team_B_scoring_within_10sec"), F.lit("A").alias("team_scoring_next"),
    )
    files = [str(tmp_path / f"train_{i}") for i in range(3)]
    for i, path in enumerate(files):
        write_csv(rows.where(F.col("id") % 3 == i), path)
    write_csv(rows.select("id", "ball"), str(tmp_path / "test"))
    types = {"id": "int64", "ball": "float16", w.GAME_TARGETS[0]: "int8", w.GAME_TARGETS[1]: "int8", "team_scoring_next": "object"}
    for name, own in (("train_types", types), ("test_types", {k: types[k] for k in ("id", "ball")})):
        write_csv(spark.createDataFrame(list(own.items()), "column string, dtype string"), str(tmp_path / name))
    outcome = w.game_events(
        {"file_names": files, "schema": str(tmp_path / "train_types")},
        {"file_names": str(tmp_path / "test"), "schema": str(tmp_path / "test_types")}, model=boosted_classifier(rounds=5, rate=0.3),
    )
    assert finished(spark, outcome, tmp_path / "out", ["id", *w.GAME_TARGETS], 400) < 0.3
