import pytest
from pyspark.sql import functions as F

from fitloom.functions import append_text
from fitloom.operators import metrics
from fitloom.operators.columns import derive
from fitloom.operators.encode import RoutedEncode, StandardScale
from fitloom.plans import workloads
from fitloom.plans.learner import FeaturePlan, FittedLearner, tap
from fitloom.plans.models import PriorClassifier, boosted_classifier, boosted_regressor, forest_classifier


def with_suffix(df):
    return derive(df, {"Names": append_text("Names", " Test")})


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def points(spark):
    """Two informative columns and two targets, one of them text."""
    df = spark.range(600).select(
        "id",
        (F.pmod(F.xxhash64("id"), F.lit(100)) / 10.0).alias("a"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) / 10.0).alias("b"),
    )
    return df.withColumns(
        {"y": (F.col("a") > 5).cast("int"), "c": F.when(F.col("b") > 6, "high").when(F.col("b") > 3, "mid").otherwise("low")}
    ).cache()


def plan(**changes):
    settings = {"key": "id", "target": "y", "model": forest_classifier(trees=10), "drop": ["c"], "stages": [StandardScale(inputCols=["a", "b"])]}
    return FeaturePlan(**(settings | changes))


def test_better_than_the_prior(points):
    parts = plan().split(points)
    forest = plan().make_learner().fit(features=parts.train).predict(features=parts.test)
    prior = plan(model=PriorClassifier()).make_learner().fit(features=parts.train).predict(features=parts.test)
    good, base = (metrics.accuracy(s, "y", "y_prediction").first()[0] for s in (forest, prior))
    assert good > 0.95 > base


def test_result_does_not_depend_on_layout_or_run(points):
    learner = plan().make_learner()
    got = [bag(learner.fit(raw=points.repartition(n)).predict(raw=points, output="both")) for n in (1, 7, 32)]
    assert got[0] == got[1] == got[2]


def test_preview_uses_the_first_rows_only(points):
    shown = plan().preview(points, 40)
    assert sorted(r["id"] for r in shown.collect()) == list(range(40))


def test_class_numbers_keep_their_type_and_are_no_probabilities(points):
    scored = plan().make_learner().fit(raw=points).predict(raw=points)
    assert scored.schema["y_prediction"].dataType == points.schema["y"].dataType
    with pytest.raises(TypeError, match="not a probability column"):
        metrics.log_loss(scored, "y", "y_prediction")


def test_outputs(points):
    fitted = plan(target="c", drop=["y"]).make_learner().fit(raw=points)
    scored = fitted.predict(raw=points, output="both")
    assert scored.columns == ["id", "c", "c_prediction", "c_probability"]
    row = scored.first()
    assert row["c_prediction"] in ("high", "low", "mid") and len(row["c_probability"]) == 3
    assert metrics.accuracy(scored, "c", "c_prediction").first()[0] > 0.95
    assert fitted.predict(raw=points.drop("c", "y")).columns == ["id", "c_prediction"]
    assert fitted.predict(raw=points, output="probability").columns == ["id", "c", "c_probability"]
    with pytest.raises(ValueError):
        fitted.predict(raw=points, output="labels")
    with pytest.raises(ValueError):
        fitted.predict()
    with pytest.raises(ValueError):
        fitted.predict(raw=points, features=points)


def test_two_targets_share_one_matrix(points):
    both = plan(target=["y", "c"], drop=[], model={"y": boosted_classifier(rounds=5), "c": forest_classifier(trees=10)})
    fitted = both.make_learner().fit(raw=points)
    scored = fitted.predict(raw=points, output="both")
    assert scored.columns == ["id", "y", "c", "y_prediction", "y_probability", "c_prediction", "c_probability"]
    assert metrics.exact_match(scored, {"y": "y_prediction", "c": "c_prediction"}).first()[0] > 0.95
    alone = plan(model=boosted_classifier(rounds=5)).make_learner().fit(raw=points)
    assert bag(scored.select("id", "y_probability")) == bag(
        alone.predict(raw=points, output="both").select("id", "y_probability")
    )
    assert fitted.submission(fitted.predict(raw=points)).columns == ["id", "y", "c"]


def test_log_target_is_scored_on_the_raw_scale(points):
    grown = points.withColumn("count", F.exp("a")).drop("y", "c")
    fitted = plan(target="count", drop=[], stages=[], model=boosted_regressor(rounds=10), target_transform="log1p").make_learner().fit(raw=grown)
    scored = fitted.predict(raw=grown)
    assert metrics.rmsle(scored, "count", "count_prediction").first()[0] < 1.2
    assert scored.agg(F.max("count_prediction")).first()[0] > 500
    with pytest.raises(ValueError, match="no probabilities"):
        fitted.predict(raw=grown, output="probability")
    with pytest.raises(Exception, match="outside its domain"):
        plan(target="count", drop=[], stages=[], model=boosted_regressor(rounds=2), target_transform="log").make_learner().fit(
            raw=grown.withColumn("count", F.lit(0.0))
        )


def test_save_and_load(points, tmp_path):
    made = plan(target=["y", "c"], drop=[], stages=[RoutedEncode(inputCols=["a"])])
    fitted = made.make_learner().fit(raw=points)
    fitted.save(str(tmp_path / "learner"))
    loaded = FittedLearner.load(str(tmp_path / "learner"))
    assert bag(loaded.predict(raw=points, output="both")) == bag(fitted.predict(raw=points, output="both"))
    assert (loaded.keys, loaded.targets, loaded.binary) == (("id",), ("y", "c"), ("y",))


def test_training_statistics_ignore_other_rows(points):
    parts = plan().split(points)
    a = plan().make_learner().fit(features=parts.train)
    shifted = parts.test.withColumn("a", F.col("a") + 1000)
    b = plan().make_learner().fit(features=parts.train.unionByName(shifted).where("a < 900"))
    for column, values in a.model.stages[0].fitted().items():
        assert b.model.stages[0].fitted()[column] == pytest.approx(values)
    seen = plan().make_learner().fit(features=parts.train, stage_rows=points)
    assert seen.model.stages[0].fitted()["a"] != a.model.stages[0].fitted()["a"]


def test_raw_input_passes_prepare_and_marked_input_does_not(spark):
    schema = "id int, Names string, label int"
    df = spark.createDataFrame([(1, "Mike", 0), (2, "Nathalie", 1)], schema)
    other = spark.createDataFrame([(1, "1", 0), (2, "22", 1)], schema)
    baseline = workloads.name_baseline("id", with_suffix)
    assert bag(baseline.stages[0].transform(baseline.at_mark(df)).select("id", "Names")) == [(1, 9), (2, 13)]
    assert bag(baseline.stages[0].transform(df).select("id", "Names")) == [(1, 4), (2, 8)]
    fitted = baseline.make_learner().fit(features=other)
    assert bag(fitted.predict(raw=df, output="both")) == [(1, 0, 0.0, 0.5), (2, 1, 0.0, 0.5)]
    assert bag(baseline.evaluate(df)) == [(1, 0, 0.0), (2, 1, 0.0)]
    split = baseline.split(df, 0.5)
    assert split.train.count() + split.test.count() == 2


def test_contract_errors(points):
    with pytest.raises(TypeError, match="not an estimator"):
        plan(stages=[with_suffix])
    with pytest.raises(TypeError):
        plan(model=with_suffix)
    with pytest.raises(ValueError, match="one model per target"):
        plan(target=["y", "c"], model={"y": forest_classifier()})
    with pytest.raises(ValueError, match="key and target"):
        plan(key="y")
    with pytest.raises(ValueError, match="target transform"):
        plan(target_transform="square")
    with pytest.raises(KeyError, match="no such column"):
        plan(target="zzz", drop=[]).make_learner().fit(raw=points)


def test_target_and_key_are_no_features(points):
    fitted = plan(drop=[], keep=["c"]).make_learner().fit(raw=points)
    assembler = next(s for s in fitted.model.stages if hasattr(s, "getInputCols"))
    assert assembler.getInputCols() == ["a", "b"]
    assert fitted.predict(raw=points).columns == ["id", "y", "c", "y_prediction"]


def test_prior_needs_labels(spark):
    empty = spark.createDataFrame([(1, None, 2.0)], "id int, y int, a double")
    with pytest.raises(ValueError, match="no labelled rows"):
        plan(model=PriorClassifier(), stages=[]).make_learner().fit(raw=empty)


def test_tap_sees_rows_without_a_job_of_its_own(points):
    watched, seen = tap(points, "points", F.count(F.lit(1)).alias("n"))
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 600


def test_scoring_is_narrow(points):
    fitted = plan().make_learner().fit(raw=points)
    text = fitted.predict(raw=points)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text.split("InMemoryRelation")[0]


def test_rows_alone_decide_the_training_layout(spark, monkeypatch):
    from fitloom.plans import learner

    sizes = {1: 1, 20_000: 1, 20_001: 2, 160_000: 8, 16_000_000: 8, 20_000_000: 10}
    for rows, parts in sizes.items():
        table = type("Table", (), {"count": lambda self, rows=rows: rows})()
        assert learner._training_partitions(table) == parts


def test_a_submission_may_have_kept_columns_as_key(spark):
    rows = spark.createDataFrame([(i, i // 2, float(i % 2), i % 2) for i in range(40)], "row_id int, series_id int, x double, y int")
    plan = FeaturePlan(key="row_id", target="y", model=forest_classifier(trees=5, featureSubsetStrategy="all"), keep=["series_id"])
    learner = plan.make_learner().fit(raw=rows)
    made = learner.submission(learner.predict(raw=rows.drop("y")), key="series_id")
    assert made.columns == ["series_id", "y"] and made.count() == 40


def test_prior_keeps_any_class(spark):
    rows = spark.createDataFrame([(-1.0,), (0.4,), (0.4,), (1.9,)], "label double")
    scored = PriorClassifier().fit(rows).transform(rows).first()
    assert scored.prediction == 0.4 and scored.probability.toArray().tolist() == [0.25, 0.5, 0.25]
    ones = spark.createDataFrame([(1.0,)], "label double")
    assert PriorClassifier().fit(ones).transform(ones).first().probability.toArray().tolist() == [0.0, 1.0]


def test_a_category_of_validation_rows_only_is_known(spark):
    rows = [(i, f"o{i % 5}" if i else "rare", "n", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, ord_1 string, nom_1 string, target int")
    made = workloads.categorical_target(df, model=forest_classifier(trees=3), fraction=0.5)
    assert made.scored.count() == 30 and made.score.first()[0] is not None


def test_wide_rows_and_many_trees_make_more_pieces(spark, monkeypatch):
    """What a task holds of a row counts, not only the number of rows."""
    from fitloom.plans import learner

    rows = spark.range(400).select("id", (F.col("id") % 2).alias("y"), *[(F.col("id") * i % 7).alias(f"x{i}") for i in range(8)])
    seen, fit_models = {}, learner._fit_models

    def watched(plan, labels, matrix):
        seen[plan.model.getNumTrees()] = (learner._row_bytes(plan, matrix), matrix.rdd.getNumPartitions())
        return fit_models(plan, labels, matrix)

    monkeypatch.setattr(learner, "_fit_models", watched)
    monkeypatch.setattr(learner, "PIECE_BYTES", 400 * 200)
    for trees in (1, 30):
        FeaturePlan(key="id", target="y", model=forest_classifier(trees=trees, maxDepth=2)).make_learner().fit(raw=rows)
    assert seen == {1: (67 + 96 + 4, 1), 30: (67 + 96 + 120, 2)}
