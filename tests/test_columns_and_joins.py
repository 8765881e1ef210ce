import random

import pytest
from pyspark.sql import functions as F

from fitloom.operators import columns as cols
from fitloom.operators import combine, stats
from fitloom.plans.learner import column_function


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "a", 2.0), (2, None, 3.0)], "id bigint, name string, x double")


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_strict_and_lenient_drop(people):
    with pytest.raises(KeyError, match="zzz"):
        cols.drop_columns(people, "zzz")
    assert cols.drop_columns(people, "zzz", missing_ok=True).columns == people.columns
    assert cols.drop_columns(people, ["x"]).columns == ["id", "name"]
    with pytest.raises(KeyError):
        cols.select_columns(people, ["id", "zzz"])


def test_choosing_names(people):
    assert cols.columns_of_type(people, include="object") == ["name"]
    assert cols.columns_of_type(people, exclude="object") == ["id", "x"]
    assert cols.columns_containing(people, "am") == ["name"]
    assert cols.columns_except(people, ["id"]) == ["name", "x"]
    assert cols.column_at(people, -1) == "x"
    assert cols.features_and_target(people, "x") == (["id", "name"], ["x"])


def test_cardinality_threshold_is_exact(spark):
    df = spark.range(1000).select(
        (F.col("id") % 9).alias("nine"), (F.col("id") % 10).alias("ten"), (F.col("id") % 21).alias("more"),
        F.col("id").alias("all"), F.lit(None).cast("string").alias("none"),
    )
    few, many = cols.columns_by_cardinality(df, df.columns, 10)
    assert few == ["nine", "none"] and many == ["ten", "more", "all"]
    assert cols.columns_by_cardinality(df, [], 10) == ([], [])


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, "p")], "`a.b` int, c string")
    assert bag(cols.drop_columns(df, "c")) == [(1,)]
    assert bag(cols.overwrite_block(df.drop("c"), ["a.b"], lambda c: c + 1)) == [(2,)]


def test_missing_keys_match_only_when_asked(spark):
    left = spark.createDataFrame([(None, "l0"), (1, "l1")], "k bigint, l string")
    right = spark.createDataFrame([(None, "r0"), (1, "r1")], "k bigint, r string")
    assert bag(combine.inner_join(left, right, "k")) == [(1, "l1", "r1")]
    assert bag(combine.inner_join(left, right, "k", null_safe=True)) == [(1, "l1", "r1"), (None, "l0", "r0")]


@pytest.mark.parametrize("null_safe", [False, True])
def test_hot_keys_change_the_plan_but_not_the_rows(spark, null_safe):
    rnd = random.Random(1)
    rows = [(i, None if i % 3 == 1 else (7 if i % 3 == 0 else rnd.randrange(500))) for i in range(3000)]
    left = spark.createDataFrame(rows, "id bigint, k int")
    right = spark.createDataFrame([(k, f"r{k}") for k in [*range(0, 500, 2), 7, None]], "k bigint, r string")
    hot = stats.frequent_key_hashes(left, ["k"], least=500)
    assert len(hot) == 2
    plain = combine.inner_join(left, right, "k", null_safe, hot=[])
    salted = combine.inner_join(left, right, "k", null_safe, hot=hot, spread_by="id")
    assert "_salt" in salted._jdf.queryExecution().toString()
    assert bag(salted) == bag(plain) and salted.columns == plain.columns
    expected = sum(1 for _, k in rows if (k is None and null_safe) or (k is not None and (k % 2 == 0 or k == 7)))
    assert salted.count() == expected


def test_salted_pieces_share_the_hot_key(spark, monkeypatch):
    monkeypatch.setattr(combine, "PIECE_ROWS", 1000)
    left = spark.range(64_000).select("id", F.lit(7).alias("k"))
    right = spark.createDataFrame([(7, "r")], "k int, r string")
    hot = stats.frequent_key_hashes(left, ["k"], least=1000)
    assert list(hot.values()) == [64_000]
    salt = F.pmod(F.xxhash64("id"), F.lit(64))  # as many pieces as a thousand rows each need
    assert ", 63, None" in combine.inner_join(left, right, "k", hot=hot)._jdf.queryExecution().analyzed().toString()
    assert left.groupBy(salt).count().agg(F.max("count")).first()[0] < 2000
    assert combine.inner_join(left, right, "k", hot=hot, spread_by="id").count() == 64_000


def test_small_right_side_is_broadcast_and_large_one_measured(spark, monkeypatch):
    left = spark.range(1000).select("id", (F.col("id") % 3 + 7).cast("int").alias("k"))
    right = spark.createDataFrame([(7, "r", 1.5), (8, None, None)], "k int, r string, x double")
    assert combine.counted_bytes(right) == 2 * (16 + 16 + 16) + 1
    assert combine.counted_bytes(right.withColumn("a", F.array("k"))) is None

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = combine.inner_join(left, right, "k")
        assert "BroadcastHashJoin" in plan(small)
        monkeypatch.setattr(combine, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(combine, "frequent_key_hashes", lambda df, on: stats.frequent_key_hashes(df, on, least=10))
        large = combine.inner_join(left, right, "k", spread_by="id")
        assert "BroadcastHashJoin" not in plan(large) and "_salt" in plan(large)
        assert bag(small) == bag(large)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_composite_keys_and_small_tables(spark):
    left = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], "x int, y string, v double")
    right = spark.createDataFrame([(1, "a", 9.0)], "x int, y string, w double")
    assert bag(combine.inner_join(left, right, ["x", "y"])) == [(1, "a", 1.0, 9.0)]
    assert stats.frequent_key_hashes(left, ["x"]) == {}
    assert stats.frequent_key_hashes(left.limit(0), ["x"]) == {}


def test_lookup_paths_agree(spark):
    rows = [(i, "hot" if i % 2 else f"v{i % 50}" if i % 5 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "id bigint, v string")
    entries = spark.createDataFrame([("hot", 0.5)] + [(f"v{i}", float(i)) for i in range(0, 50, 4)], "value string, code double")
    hot = entries.where("value = 'hot'").withColumn("value", combine.digest("value"))
    small = combine.lookup(df, "v", entries, "c", small=True)
    large = combine.lookup(df, "v", entries, "c", hot=hot, spread_by="id")
    unknown_hot = combine.lookup(df, "v", entries, "c")
    assert bag(small) == bag(large) == bag(unknown_hot)
    codes = {(r["v"], r["c"]) for r in small.collect()}
    assert ("hot", 0.5) in codes and (None, None) in codes and ("v2", None) in codes and ("v4", 4.0) in codes


def test_large_lookup_without_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_lookup_paths_agree(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_concat_columns_keeps_unmatched_rows(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, l string")
    right = spark.createDataFrame([(2, "x"), (3, "y")], "k int, r string")
    assert bag(combine.concat_columns(left, right, "k")) == [(1, "a", None), (2, "b", "x"), (3, None, "y")]


def test_union_fills_absent_columns(spark):
    one = spark.createDataFrame([(1, "a")], "id int, a string")
    two = spark.createDataFrame([("b", 2)], "b string, id int")
    both = combine.union_by_name([one, two])
    assert both.columns == ["id", "a", "b"]
    assert bag(both) == [(1, "a", None), (2, None, "b")]


def test_stacked_predictions(spark):
    df = spark.createDataFrame([(1, 0, 1), (2, 1, 1)], "id int, p int, q int")
    stacked = combine.stack_predictions(df, "id", {"A": "p", "B": "q"})
    assert bag(stacked) == [(1, "A", 0), (1, "B", 1), (2, "A", 1), (2, "B", 1)]


def test_column_function_runs_on_batches(people):
    shout = column_function(lambda s: s.str.upper(), "string")
    assert [r[0] for r in people.select(shout("name")).collect()] == ["A", None]


def test_missing_is_null_or_nan_everywhere(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,), (1.0,)], "x double")
    assert [r[0] for r in df.select(cols.is_missing(df, "x")).collect()] == [0, 1, 0, 1, 0]
    assert stats.distinct_counts(df, ["x"]).first().x == 2
    assert cols.columns_by_cardinality(df, ["x"], 3) == (["x"], [])
    text = spark.createDataFrame([("NaN",), (None,)], "x string")
    assert [r[0] for r in text.select(cols.is_missing(text, "x")).collect()] == [0, 1]
