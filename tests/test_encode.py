import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fitloom.operators import encode as en
from fitloom.operators.columns import quoted


def frame(spark, values, schema="id int, c string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], schema)


def out(model, df, column="c"):
    return [r[0] for r in model.transform(df).orderBy("id").select(quoted(column)).collect()]


def save_and_load(model, path):
    PipelineModel([model]).write().overwrite().save(path)
    return PipelineModel.load(path)


def add_one(df):
    return df.withColumn("c", F.col("c") + 1)


def test_standard_scale(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0], "id int, c double")
    got = out(en.StandardScale(inputCols=["c"]).fit(df), df)
    assert [round(x, 4) for x in got] == [-1.3416, -0.4472, 0.4472, 1.3416]
    flat = frame(spark, [5, 5, 5], "id int, c bigint")
    assert out(en.StandardScale(inputCols=["c"]).fit(flat), flat) == [0.0, 0.0, 0.0]


def test_statistics_come_from_the_fitted_rows_only(spark):
    train = frame(spark, [1.0, 3.0], "id int, c double")
    model = en.StandardScale(inputCols=["c"]).fit(train)
    alone = out(model, train)
    larger = model.transform(train.unionByName(spark.createDataFrame([(9, 1e9)], "id int, c double")))
    assert [r["c"] for r in larger.where("id < 9").orderBy("id").collect()] == alone == [-1.0, 1.0]


def test_median_and_mode_impute(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0, None, float("nan")], "id int, c double")
    assert out(en.MedianImpute(inputCols=["c"]).fit(df), df) == [1.0, 2.0, 3.0, 4.0, 2.5, 2.5]
    text = frame(spark, ["b", "a", None])
    assert out(en.ModeImpute(inputCols=["c"]).fit(text), text) == ["b", "a", "a"]


def test_median_into_an_integer_column(spark):
    df = frame(spark, [1, 2, None], "id int, c int")
    assert out(en.MedianImpute(inputCols=["c"]).fit(df), df) == [1.0, 2.0, 1.5]


def test_fill_numbers(spark):
    df = spark.createDataFrame([(0, 1.0, 1), (1, None, 2), (2, 3.0, 3)], "id int, a double, b int")
    model = en.FillNumbers(exclude=["id"]).fit(df)
    assert out(model, df, "a") == [1.0, 2.0, 3.0] and out(model, df, "a_missing") == [0, 1, 0]
    later = spark.createDataFrame([(0, 1.0, None)], "id int, a double, b int")
    assert out(model, later, "b") == [0] and "b_missing" not in model.transform(later).columns


def test_ordinal(spark):
    model = en.OrdinalEncode(inputCols=["c"]).fit(frame(spark, ["b", "a"]))
    assert out(model, frame(spark, ["a", "b", None])) == [0.0, 1.0, None]
    with pytest.raises(Exception, match="unknown category"):
        out(model, frame(spark, ["c"]))
    lenient = en.OrdinalEncode(inputCols=["c"], unknown="null").fit(frame(spark, ["b", "a"]))
    assert out(lenient, frame(spark, ["c"])) == [None]
    numbers = en.OrdinalEncode(inputCols=["c"]).fit(frame(spark, [10, 9], "id int, c int"))
    assert out(numbers, frame(spark, [9, 10], "id int, c int")) == [0.0, 1.0]


def test_one_hot(spark):
    model = en.OneHotEncode(inputCols=["c"]).fit(frame(spark, ["a", "b"]))
    df = frame(spark, ["a", "c", None])
    assert model.transform(df).columns == ["id", "c=a", "c=b"]
    assert out(model, df, "c=a") == [1.0, 0.0, 0.0] and out(model, df, "c=b") == [0.0, 0.0, 0.0]
    named = en.OneHotEncode(inputCols=["c"], missingAsCategory=True).fit(frame(spark, ["a", None]))
    assert out(named, df, "c=NULL") == [0.0, 0.0, 1.0]


def test_one_hot_vectors_dense_and_sparse(spark):
    train, df = frame(spark, ["a", "b.x"]), frame(spark, ["b.x", "c", None])
    dense = en.OneHotEncode(inputCols=["c"], output="vector").fit(train)
    sparse = Pipeline(stages=en.sparse_one_hot(["c"])).fit(train)
    for model in (dense, sparse):
        made = model.transform(df).orderBy("id").select(vector_to_array("c_onehot").alias("v"))
        assert [r["v"] for r in made.collect()] == [[0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


@pytest.mark.parametrize("missing", [False, True])
def test_wide_blocks_have_the_slots_of_narrow_ones(spark, monkeypatch, missing):
    nan = float("nan")
    rows = [(0, "a", 10.0), (1, "b", 9.0), (2, "c", nan), (3, None, None), (4, "b", 100.0)]
    df = spark.createDataFrame(rows, "id int, c string, x double")
    other = spark.createDataFrame([(0, "z", 11.0), (1, None, nan), (2, "a", 9.0)], df.schema)

    def made(model, table):
        return model.transform(table).orderBy("id").select(vector_to_array("c_onehot"), vector_to_array("x_onehot")).collect()

    encoder = en.OneHotEncode(inputCols=["c", "x"], output="vector", missingAsCategory=missing)
    narrow = encoder.fit(df)
    monkeypatch.setattr(en, "INLINE_CATEGORIES", 2)
    wide = encoder.fit(df)
    assert made(wide, df) == made(narrow, df) and made(wide, other) == made(narrow, other)
    assert made(wide, df)[1][1][:3] == [1.0, 0.0, 0.0] and sum(made(wide, df)[2][1]) == missing
    assert set(wide.transform(df).columns) == {"id", "c_onehot", "x_onehot"}


def test_many_categories_are_columns_or_slots_as_asked(spark):
    df = spark.range(1200).select("id", F.concat(F.lit("k"), F.lpad((F.col("id") % 600).cast("string"), 4, "0")).alias("c"))
    assert len(en.OneHotEncode(inputCols=["c"]).fit(df).transform(df).columns) == 601
    routed = en.RoutedEncode(inputCols=["c"], threshold=1000, output="vector").fit(df).transform(df)
    row = routed.where("id = 607").select(vector_to_array("c_onehot").alias("v")).first()
    assert len(row.v) == 600 and row.v.index(1.0) == 7


def test_nan_gets_the_median_and_an_indicator(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 3.0), (4, 5.0)], "id int, x double")
    rows = en.FillNumbers(exclude=["id"]).fit(df).transform(df).orderBy("id").collect()
    assert [(r.x, r.x_missing) for r in rows] == [(1.0, 0), (3.0, 1), (3.0, 0), (5.0, 0)]


def test_a_long_frequent_value_is_listed(spark, monkeypatch):
    monkeypatch.setattr(en, "SMALL_ENTRIES", 3)
    long = "x" * 10_000
    df = spark.range(400).select("id", F.when(F.col("id") % 2 == 0, long).otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("c"))
    model = en.FrequencyEncode(inputCols=["c"], spreadBy=["id"]).fit(df)
    hot = model.fitted()["columns"]["c"]["hot"]
    assert max(map(len, hot["values"])) == 32 and 0.5 in hot["codes"]
    assert model.transform(df).where("c = 0.5").count() == 200


def test_frequency(spark):
    model = en.FrequencyEncode(inputCols=["c"]).fit(frame(spark, ["a", "a", "b", None]))
    assert out(model, frame(spark, ["a", "b", "c", None])) == [2 / 3, 1 / 3, None, None]
    empty = en.FrequencyEncode(inputCols=["c"]).fit(frame(spark, [None, None]))
    assert out(empty, frame(spark, ["a"])) == [None]


@pytest.mark.parametrize("kind", [en.FrequencyEncode, en.OrdinalEncode])
def test_large_dictionaries_give_the_same_codes(spark, monkeypatch, tmp_path, kind):
    values = [f"v{i % 97}" if i % 3 else "hot" for i in range(600)]
    df = frame(spark, values).withColumn("n", F.col("id") % 40)
    small = kind(inputCols=["c", "n"]).fit(df)
    monkeypatch.setattr(en, "SMALL_ENTRIES", 3)
    large = kind(inputCols=["c", "n"]).fit(df)
    assert all("table" in d for d in large.fitted()["columns"].values())
    loaded = save_and_load(large, str(tmp_path / "m"))
    for column in ("c", "n"):
        assert out(large, df, column) == out(small, df, column) == out(loaded, df, column)


def test_routing_at_the_threshold(spark):
    df = spark.range(90).select(F.col("id"), (F.col("id") % 9).cast("string").alias("nine"), (F.col("id") % 10).cast("string").alias("ten"))
    model = en.RoutedEncode(inputCols=["nine", "ten"]).fit(df)
    made = model.transform(df)
    assert "nine=0" in made.columns and "nine" not in made.columns
    assert {r["ten"] for r in made.collect()} == {0.1}
    later = df.withColumn("ten", F.lit("1"))
    assert model.transform(later).columns == made.columns


def test_groups_drop_what_is_not_listed(spark):
    df = spark.createDataFrame([(0, 1.0, "x", "gone")], "id int, a double, b string, z string")
    groups = [("num", [en.StandardScale(inputCols=["a"])], ["a"]), ("cat", [en.OneHotEncode(inputCols=["b"])], ["b"])]
    stages = en.column_groups(groups, keep=["id"])
    assert Pipeline(stages=stages).fit(df).transform(df).columns == ["id", "a", "b=x"]
    with pytest.raises(ValueError, match="shares columns"):
        en.column_groups([groups[0], ("again", [], ["a"])], keep=[])


def test_function_stage(spark, tmp_path):
    df = frame(spark, [1, 2], "id int, c int")
    stage = en.FunctionStage.of(add_one)
    assert out(stage, df) == [2, 3]
    assert out(save_and_load(stage, str(tmp_path / "f")), df) == [2, 3]
    with pytest.raises(TypeError):
        en.FunctionStage.of(lambda d: d)


def test_every_fitted_stage_can_be_saved(spark, tmp_path):
    df = spark.createDataFrame([(0, 1.0, "x"), (1, None, "y"), (2, 3.0, None)], "id int, a double, b string")
    stages = [
        en.FillNumbers(exclude=["id"]),
        en.ModeImpute(inputCols=["b"]),
        en.StandardScale(inputCols=["a"]),
        en.RoutedEncode(inputCols=["b"], threshold=2),
        en.DropColumns(inputCols=["zzz"]),
        en.FeatureVector(exclude=["id"]),
    ]
    model = Pipeline(stages=stages).fit(df)
    loaded = save_and_load(model, str(tmp_path / "all"))
    assert loaded.transform(df).select("id", "features").collect() == model.transform(df).select("id", "features").collect()


def test_no_features_is_an_error(spark):
    with pytest.raises(ValueError, match="no feature"):
        en.FeatureVector(exclude=["id"]).fit(frame(spark, ["a"]))


def test_fitted_stages_apply_to_a_stream(spark, tmp_path):
    df = spark.range(50).select("id", (F.col("id") % 4).cast("string").alias("c"), F.col("id").cast("double").alias("x"))
    stages = [en.FrequencyEncode(inputCols=["c"]), en.StandardScale(inputCols=["x"]), en.FeatureVector(exclude=["id"])]
    model = Pipeline(stages=stages).fit(df)
    df.write.parquet(str(tmp_path / "in"))
    stream = model.transform(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    running = stream.writeStream.format("memory").queryName("scored").option("checkpointLocation", str(tmp_path / "cp")).start()
    running.processAllAvailable()
    running.stop()
    got = spark.table("scored").select("id", "c", "x").orderBy("id").collect()
    assert got == model.transform(df).select("id", "c", "x").orderBy("id").collect()


def test_small_dictionaries_have_a_common_limit(spark, monkeypatch):
    df = spark.range(30).select("id", *[(F.col("id") % n).cast("string").alias(f"c{n}") for n in (3, 5, 7)])
    names = ["c3", "c5", "c7"]
    inline = en.OrdinalEncode(inputCols=names).fit(df)
    monkeypatch.setattr(en, "SMALL_TOTAL_BYTES", 3 * 17 + 5 * 17)
    mixed = en.OrdinalEncode(inputCols=names).fit(df)
    assert ["table" in mixed.fitted()["columns"][c] for c in names] == [False, False, True]
    assert sorted(mixed.transform(df).collect()) == sorted(inline.transform(df).collect())
