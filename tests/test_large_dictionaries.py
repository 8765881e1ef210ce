"""Dictionaries beyond the broadcast limit: one join for all columns, frequent values answered at once."""

import re

import pytest
from pyspark.sql import functions as F

from fitloom.operators import combine, encode


@pytest.fixture
def small_limits(spark, monkeypatch):
    """Everything is large, and no table is broadcast unless the code asks for it."""
    monkeypatch.setattr(encode, "SMALL_ENTRIES", 3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield monkeypatch
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(spark, n=900):
    i = F.col("id")
    return spark.range(n).select(
        "id",
        F.when(i % 9 != 0, F.concat(F.lit("a"), i % 50)).alias("a"),
        F.when(i % 7 == 0, F.lit("NaN").cast("double")).otherwise((i % 40) * 0.5 - 3).alias("b"),
        F.concat(F.lit("c"), i % 33).alias("c"),
        F.lit("beside").alias("value"),
    )


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one_by_one(model, table):
    for c in model.columns():
        single = encode.DictionaryModel.of([c], {**model.fitted(), "columns": {c: model.fitted()["columns"][c]}})
        table = single.transform(table)
    return table


@pytest.mark.parametrize("spread", [[], ["id"], ["value"]])
@pytest.mark.parametrize("hot_rows", [1, 5_000])
def test_all_at_once_equals_one_by_one(spark, small_limits, spread, hot_rows):
    small_limits.setattr(combine, "HOT_ROWS", hot_rows)
    model = encode.FrequencyEncode(inputCols=["a", "b", "c"], spreadBy=spread).fit(rows(spark).where("id % 3 > 0"))
    assert all("table" in d for d in model.fitted()["columns"].values())
    table = rows(spark).withColumn("c", F.when(F.col("id") % 2 == 0, "never").otherwise(F.col("c")))
    table = table.union(table.where("id < 40"))
    got = model.transform(table)
    assert got.columns == table.columns and bag(got) == bag(one_by_one(model, table))
    assert got.where("c is null").count() >= 450


def test_ordinal_codes_and_unknown_values(spark, small_limits):
    model = encode.OrdinalEncode(inputCols=["b", "c"], spreadBy=["id"]).fit(rows(spark))
    got = {r["id"]: (r.b, r.c) for r in model.transform(rows(spark)).collect()}
    texts = sorted(f"c{k}" for k in range(33))
    assert got[1] == (1.0, float(texts.index("c1"))) and got[7][0] is None and len(got) == 900
    with pytest.raises(Exception, match="column c: unknown category: new"):
        model.transform(rows(spark).withColumn("c", F.lit("new"))).collect()


def test_rows_move_once(spark, small_limits):
    model = encode.FrequencyEncode(inputCols=["a", "b", "c"], spreadBy=["id"]).fit(rows(spark))
    done = model.transform(rows(spark))
    done.write.format("noop").mode("overwrite").save()
    text = done._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)", text)
    named = ["column, value" if "column" in m else "_name" if "_name" in m else m for m in (re.sub(r"#\d+", "", m) for m in moved)]
    # narrow rows and dictionaries by value, narrow codes and wide rows by name
    assert sorted(n for n in named if n in ("column, value", "_name")) == ["_name", "_name", "column, value", "column, value"]


def test_a_frequent_unknown_value_meets_no_task(spark, small_limits):
    small_limits.setattr(combine, "HOT_ROWS", 100)
    table = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, "never fitted").otherwise(F.concat(F.lit("v"), F.col("id") % 500)).alias("v"), F.lit("w").alias("w"))
    known = spark.range(2_000).select(F.concat(F.lit("v"), F.col("id")).alias("value"), F.col("id").cast("double").alias("code"))
    none = spark.createDataFrame([], "value string, code double")
    hot = combine.hot_entries(table, {"v": known, "w": known}, {"v": none, "w": none})
    assert {(r.column, r.code) for r in hot.where("code is null").collect()} == {(0, None), (1, None)}
    open_, answered = combine._open_values(table.withColumn("_name", F.col("id").cast("string")), ["v", "w"], hot)
    keyed = open_.repartition(8, "column", "value").withColumn("p", F.spark_partition_id())
    largest = max((r["count"] for r in keyed.groupBy("p").count().collect()), default=0)
    assert largest <= 2 * 20_000 / 8 and open_.where("value = 'never fitted'").isEmpty() and answered.count() + open_.count() == 80_000
    coded = combine.lookup_many(table, {"v": known, "w": known}, {"v": "x", "w": "y"}, hot, "id")
    assert coded.where("x is not null").count() == 20_000 and coded.where("y is not null").isEmpty() and coded.count() == 40_000


def test_frequent_values_are_found_in_one_pass(spark, monkeypatch):
    monkeypatch.setattr(combine, "HOT_ROWS", 50)
    table = spark.range(1_000).select(F.when(F.col("id") < 200, "often").otherwise(F.col("id").cast("string")).alias("v"), F.lit(None).cast("string").alias("n"))
    digest = spark.range(1).select(combine.digest(F.lit("often"))).first()[0]
    assert combine.frequent_values(table, ["v", "n"]) == [(0, digest)]
    assert combine.frequent_values(table.where("false"), ["v"]) == []


def test_streams_are_looked_up_one_by_one(spark, small_limits, tmp_path):
    model = encode.FrequencyEncode(inputCols=["a", "c"], spreadBy=["id"]).fit(rows(spark))
    rows(spark, 60).write.parquet(str(tmp_path / "in"))
    stream = model.transform(spark.readStream.schema(rows(spark).schema).parquet(str(tmp_path / "in")))
    run = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
    run.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("b")
    assert got.count() == 60 and bag(got) == bag(model.transform(rows(spark, 60)).drop("b"))


@pytest.fixture
def singly(small_limits):
    """Tables and dictionaries of over a kilobyte are too large to be broadcast."""
    small_limits.setattr(combine, "BROADCAST_BYTES", 1_000)
    return small_limits


def moved(df):
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return [re.sub(r"#\d+L?", "", m) for m in re.findall(r"Exchange hashpartitioning\(([^)]*)", text)]


def many(spark):
    """Two columns of many values, one of few."""
    i = F.col("id")
    return spark.range(2_000).select("id", F.concat(F.lit("a"), i % 900).alias("a"), (i % 700 / 4).alias("b"), F.concat(F.lit("c"), i % 20).alias("c"))


@pytest.mark.parametrize("spread", [[], ["id"]])
@pytest.mark.parametrize("hot_rows", [1, 5_000])
def test_narrow_rows_meet_large_dictionaries_one_by_one(spark, singly, spread, hot_rows):
    singly.setattr(combine, "HOT_ROWS", hot_rows)
    model = encode.FrequencyEncode(inputCols=["a", "b", "c"], spreadBy=spread).fit(many(spark).where("id % 3 > 0"))
    table = many(spark).withColumn("a", F.when(F.col("id") % 4 == 0, "never").when(F.col("id") % 4 > 1, F.col("a")))
    table = table.union(table.where("id < 40"))
    got = model.transform(table)
    assert got.dtypes == [("id", "bigint"), *[(c, "double") for c in "abc"]]
    assert bag(got) == bag(one_by_one(model, table))
    ways = moved(got)
    # the dictionary of few values is broadcast; each of the others and the whole row meet by value
    assert not any("_name" in w for w in ways) and sum("_key" in w for w in ways) == 2


@pytest.mark.parametrize("hot_rows", [1, 5_000])
def test_places_and_unknown_values_one_by_one(spark, singly, hot_rows):
    singly.setattr(combine, "HOT_ROWS", hot_rows)
    model = encode.OrdinalEncode(inputCols=["a", "b", "c"], spreadBy=["id"]).fit(many(spark))
    texts = {c: sorted({r[0] for r in many(spark).select(c).collect()}) for c in "abc"}
    want = sorted((r.id, *[float(texts[c].index(r[c])) for c in "abc"]) for r in many(spark).collect())
    assert sorted(tuple(r) for r in model.transform(many(spark)).collect()) == want
    for c in "ac":
        with pytest.raises(Exception, match=f"column {c}: unknown category: new"):
            model.transform(many(spark).withColumn(c, F.when(F.col("id") > 2, F.lit("new")).otherwise(F.col(c)))).collect()
        gone = model.transform(many(spark).withColumn(c, F.when(F.col("id") > 2, F.col(c))))
        assert gone.where(f"{c} is null").count() == 3


def test_places_of_a_dictionary_survive_saving(spark, singly, tmp_path):
    model = encode.OrdinalEncode(inputCols=["a", "b"], spreadBy=["id"]).fit(many(spark))
    assert all("before" in d for d in model.fitted()["columns"].values())
    model.write().overwrite().save(str(tmp_path / "model"))
    again = encode.DictionaryModel.load(str(tmp_path / "model"))
    assert bag(again.transform(many(spark))) == bag(model.transform(many(spark)))


def test_each_value_of_a_dictionary_moves_once_into_its_order(spark, tmp_path):
    from fitloom.operators import stats

    rows = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("value")).repartition(9)
    path, before = stats.written_in_order(rows, ["value"], [F.col("value")], "places")
    got = spark.read.parquet(path).select("value", stats.place(F.col("at"), before).alias("n")).collect()
    assert len(got) == 5_000 and all(r.value == r.n for r in got)
    assert stats.written_in_order(rows.where("false"), ["value"], [F.col("value")], "places")[1] == [0]
