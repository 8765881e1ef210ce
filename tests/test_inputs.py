"""Named inputs, upstream steps, separate targets, checked alignment, and their storing."""

import re

import pytest
from pyspark.sql import functions as F

from fitloom.operators.combine import concat_columns
from fitloom.plans import inputs as inputs_module
from fitloom.plans.catalog import series_plan, with_suffix
from fitloom.plans.inputs import PathsInput, SchemaInput, TableInput, ValueInput, read_files
from fitloom.plans.learner import FeaturePlan, FittedLearner
from fitloom.plans.models import PriorClassifier, forest_classifier
from fitloom.plans.workloads import BikeFeatures, JoinLabels
from fitloom.sources import write_csv


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def sources(spark):
    measurements = spark.range(200).select(F.col("id").alias("o_orderkey"), (F.col("id") % 20).alias("custkey"), F.lit(1.0).alias("x"))
    series = spark.range(20).select(F.col("id").alias("custkey"), F.col("id").cast("int").alias("nation"))
    labels = series.select("custkey", F.when(F.col("nation") < 10, "low").otherwise("high").alias("surface"))
    return {"measurements": measurements, "series": series, "labels": labels}


def scaled_rows(rows, factor):
    return rows.withColumn("x", F.col("x") * factor)


def test_joins_are_replayed_on_another_binding(spark, sources):
    learner = series_plan().make_learner().fit(raw=sources)
    other = sources["series"].withColumn("nation", F.lit(19))
    new = {"measurements": sources["measurements"], "series": other}
    assert {r.surface_prediction for r in learner.predict(raw=new).collect()} == {"high"}
    assert "surface" not in learner.predict(raw=new).columns
    both = learner.predict(raw={**new, "labels": sources["labels"]})
    assert "surface" in both.columns and both.count() == 200


def test_split_evaluate_and_preview_take_bindings(sources):
    plan = series_plan()
    parts = plan.split(sources)
    assert parts.train.count() + parts.test.count() == 200
    assert plan.evaluate(sources).count() == 200
    shown = plan.preview(sources, n=30)
    assert sorted(r.o_orderkey for r in shown.collect()) == list(range(30))


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"series": None}, "series: not bound"),
        ({"labels": None}, "labels: not bound"),
        ({"lables": 1}, "lables: no input of this name"),
        ({"series": "series.csv"}, "series: a DataFrame is needed, not str"),
    ],
)
def test_a_binding_is_checked_as_a_whole(sources, change, message):
    with pytest.raises(ValueError, match=message):
        series_plan().make_learner().fit(raw={**sources, **change})


def test_columns_and_types_are_checked(sources):
    text = sources["series"].withColumn("nation", F.col("nation").cast("string"))
    with pytest.raises(ValueError, match="nation is string, not int"):
        series_plan().at_mark({**sources, "series": text})
    with pytest.raises(ValueError, match=r"no such column: \['nation'\].*no such column: \['surface'\]"):
        series_plan().at_mark({**sources, "series": text.drop("nation"), "labels": text})
    with pytest.raises(ValueError, match="is a binding of"):
        series_plan().make_learner().fit(raw=sources["measurements"])
    with pytest.raises(ValueError, match="no named inputs"):
        FeaturePlan(key="id", target="y", model=PriorClassifier()).at_mark(sources)


def test_plans_are_checked_when_they_are_made():
    def made(**options):
        return FeaturePlan(key="id", target="y", model=PriorClassifier(), **options)

    with pytest.raises(ValueError, match=r"step prepare: no input or earlier step is called \['rows', 'factor'\]"):
        made(inputs=[TableInput("table")], prepare=scaled_rows)
    with pytest.raises(ValueError, match="two inputs of one name"):
        made(inputs=[TableInput("a"), PathsInput("a")])
    with pytest.raises(ValueError, match="need a step"):
        made(inputs=[PathsInput("files")])
    with pytest.raises(ValueError, match="several steps need named inputs"):
        made(prepare={"one": with_suffix})
    with pytest.raises(ValueError, match="name of an input"):
        made(inputs=[TableInput("rows"), ValueInput("factor")], prepare={"rows": scaled_rows})


def test_values_files_and_schemas(spark, tmp_path):
    rows = spark.range(60).select("id", (F.col("id") * 1.5).alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    files = [str(tmp_path / f"part_{i}") for i in range(3)]
    for i, path in enumerate(files):
        write_csv(rows.where(F.col("id") % 3 == i), path)
    write_csv(spark.createDataFrame([("id", "int64"), ("x", "float16"), ("y", "int32")], "column string, dtype string"), str(tmp_path / "types"))
    plan = FeaturePlan(
        key="id", target="y", model=PriorClassifier(), inputs=[PathsInput("file_names"), SchemaInput("schema"), ValueInput("factor")],
        prepare={"rows": read_files, "scaled": scaled_rows},
    )
    binding = {"file_names": files, "schema": str(tmp_path / "types"), "factor": 2.0}
    table = plan.at_mark(binding)
    assert table.schema["x"].dataType.simpleString() in ("float", "double")
    assert table.agg(F.sum("x")).first()[0] == 2 * 1.5 * sum(range(60))
    assert {r.id % 3 for r in plan.preview({**binding, "file_names": files[::-1]}, n=99, files=2).collect()} == {0, 1}
    learner = plan.make_learner().fit(raw=binding)
    one = learner.predict(raw={"file_names": files[1], "schema": table.schema, "factor": 1.0})
    assert one.count() == 20
    for wrong in ({"factor": 2}, {"file_names": []}, {"file_names": [1]}, {"schema": 7}):
        with pytest.raises(ValueError, match=f"{next(iter(wrong))}: "):
            plan.at_mark({**binding, **wrong})


# --- alignment and separate targets --------------------------------------------------


def test_exact_alignment_fails_by_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, l string")
    right = spark.createDataFrame([(3, 30), (2, 20), (1, None)], "k int, r int")
    assert bag(concat_columns(left, right, "k", "exact")) == [(1, "a", None), (2, "b", 20), (3, None, 30)]
    for side, other, message in [
        (left.union(left.limit(1)), right, 'a key repeats on the left: {"k":1}'),
        (left, right.union(right.where("k = 3")), 'a key repeats on the right: {"k":3}'),
        (left.where("k > 1"), right, 'a key is missing on the left: {"k":1}'),
        (left, right.where("k > 1"), 'a key is missing on the right: {"k":1}'),
        (left.withColumn("k", F.nullif("k", F.lit(2))), right, 'a key is NULL: {"k":null}'),
    ]:
        with pytest.raises(Exception, match=re.escape(message)):
            concat_columns(side, other, "k", "exact").collect()
    with pytest.raises(Exception, match="repeats on the left"):
        concat_columns(left.union(left), right, "k").select("r").count()


def test_kinds_of_alignment(spark):
    left = spark.createDataFrame([(1, "x", "a"), (2, "x", "b")], "k int, j string, l string")
    right = spark.createDataFrame([(2, "x", 20), (3, "y", 30)], "k int, j string, r int")
    both, lone, other = (2, "x", "b", 20), (1, "x", "a", None), (3, "y", None, 30)
    assert bag(concat_columns(left, right, ["k", "j"])) == sorted([both, lone, other], key=repr)
    assert bag(concat_columns(left, right, ["k", "j"], "inner")) == [both]
    with pytest.raises(Exception, match="missing on the left"):
        concat_columns(left, right, ["k", "j"], "left").collect()
    assert bag(concat_columns(left, right.where("k = 2"), ["k", "j"], "left")) == sorted([both, lone], key=repr)
    with pytest.raises(ValueError, match="columns of both sides"):
        concat_columns(left, right.withColumnRenamed("r", "l"), ["k", "j"])
    with pytest.raises(ValueError, match="kind of alignment"):
        concat_columns(left, right, ["k", "j"], "cross")


def test_repeats_never_multiply_and_each_side_moves_once(spark):
    one = spark.range(1).select(F.lit(7).alias("k"), F.lit(1).alias("l"))
    many = spark.range(200_000).select(F.lit(7).alias("k"), F.lit(1).alias("r"))
    with pytest.raises(Exception, match="repeats on the right"):
        concat_columns(one, many, "k").collect()
    plan = concat_columns(one, many, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_targets_of_their_own(spark):
    rows = spark.range(100).select("id", (F.col("id") % 10).alias("x"), (F.col("id") % 10 < 3).cast("int").alias("y"))
    plan = FeaturePlan(key="id", target="y", model=forest_classifier(trees=5, featureSubsetStrategy="all"))
    features, target = rows.drop("y"), rows.select("y", "id", F.lit(5).alias("more")).orderBy(F.desc("id"))
    apart = plan.make_learner().fit(features=features, target=target)
    together = plan.make_learner().fit(features=rows)
    assert bag(apart.predict(features=features, output="both")) == bag(together.predict(features=features, output="both"))
    with pytest.raises(Exception, match="missing on the right"):
        plan.make_learner().fit(features=features, target=target.where("id > 0"))
    with pytest.raises(Exception, match="repeats on the right"):
        plan.make_learner().fit(features=features, target=target.union(target))
    with pytest.raises(ValueError, match="in both tables"):
        plan.make_learner().fit(features=rows, target=target)
    with pytest.raises(KeyError, match="in the targets"):
        plan.make_learner().fit(features=features, target=target.drop("y"))
    with pytest.raises(ValueError, match="feature mark"):
        plan.make_learner().fit(raw=rows, target=target)


# --- storing --------------------------------------------------------------------------


def test_steps_and_inputs_are_stored(spark, sources, tmp_path):
    learner = series_plan().make_learner().fit(raw=sources)
    learner.save(str(tmp_path / "learner"))
    loaded = FittedLearner.load(str(tmp_path / "learner"))
    assert loaded.inputs == tuple(series_plan().inputs)
    new = {n: sources[n] for n in ("measurements", "series")}
    assert bag(loaded.predict(raw=new)) == bag(learner.predict(raw=new))
    with pytest.raises(ValueError, match="series: not bound"):
        loaded.predict(raw={"measurements": sources["measurements"]})


def test_objects_are_stored_with_their_fields(spark):
    for step in (BikeFeatures("when"), JoinLabels("series_id", ["a", "b"])):
        kept = inputs_module.described(step, ())
        again, _ = inputs_module.restored(kept, None, "fail")
        assert vars(again) == vars(step) and type(again) is type(step)


def test_changed_and_nameless_steps(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1, "Mike", 4.0, 0), (2, "Nathalie", 8.0, 1)], "id int, Names string, x double, label int")
    plan = FeaturePlan(key="id", target="label", model=PriorClassifier(), prepare=with_suffix)
    plan.make_learner().fit(raw=rows).save(str(tmp_path / "named"))
    loaded = FittedLearner.load(str(tmp_path / "named"))
    assert loaded.prepare is with_suffix
    with pytest.raises(TypeError, match="other types"):
        loaded.predict(raw=rows.withColumn("Names", F.lit(3)))
    monkeypatch.setattr(inputs_module, "_source_hash", lambda step: "another")
    with pytest.raises(ValueError, match="with_suffix.* has changed"):
        FittedLearner.load(str(tmp_path / "named"))
    assert FittedLearner.load(str(tmp_path / "named"), changed="accept").prepare is with_suffix
    monkeypatch.undo()
    nameless = FeaturePlan(key="id", target="label", model=PriorClassifier(), prepare=lambda df: with_suffix(df))
    nameless.make_learner().fit(raw=rows).save(str(tmp_path / "nameless"))
    with pytest.raises(ValueError, match="hand prepare in"):
        FittedLearner.load(str(tmp_path / "nameless"))
    assert FittedLearner.load(str(tmp_path / "nameless"), prepare=with_suffix).predict(raw=rows).count() == 2
