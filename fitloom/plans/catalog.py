"""The registered queries: each operator on the given tables.

A query takes (spark, folder of Parquet tables) and returns a table. Values that come
from floating-point sums are rounded so that engines can be compared.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    append_text,
    checked_exp,
    checked_expm1,
    checked_ln,
    checked_log1p,
    checked_sqrt,
    cyclic,
    interaction,
    parse_timestamp,
    strip_line_ends,
    text_length,
    with_calendar,
)
from ..operators import columns as cols
from ..operators import combine, encode, metrics, stats
from ..operators.split import exact_test_rows, hash_split, in_test, with_side
from ..session import scratch_path
from ..sources import (
    hashed_integers,
    hashed_normal,
    hashed_uniform,
    infer_schema,
    literal_table,
    preview,
    preview_files,
    read_csv,
    read_schema_table,
    submission,
    write_csv,
)
from . import workloads
from .inputs import PathsInput, SchemaInput, TableInput, read_files
from .learner import FeaturePlan, FittedLearner, column_function, tap
from .models import PriorClassifier, forest_classifier

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, names: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(cols.quoted(n), digits) for n in names})


def stamp(ts: str | Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


# --- calendar, scalar and text functions -----------------------------------------


def event_features(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    return events.withColumn("workingday", (F.weekday("ts") < 5).cast("int"))


CYCLIC = ["hour_sin", "hour_cos", "day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos"]


@query
def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    features = with_calendar(event_features(spark, folder), "ts")
    return rounded(cols.drop_columns(features, ["ts", "casual", "registered"], missing_ok=True), CYCLIC, 9)


@query
def cyclic_encoding(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    month_sin, month_cos = cyclic(F.month("o_orderdate"), 12, offset=1)
    week_sin, week_cos = cyclic(F.weekday("o_orderdate"), 7)
    made = cols.derive(
        orders.select("o_orderkey", "o_orderdate"),
        {"month_sin": month_sin, "month_cos": month_cos, "week_sin": week_sin, "week_cos": week_cos},
    )
    return rounded(made.drop("o_orderdate"), ["month_sin", "month_cos", "week_sin", "week_cos"], 9)


@query
def parse_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    text = table(spark, folder, "orders").select(
        "o_orderkey",
        stamp("o_orderdate").alias("text"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("xx")).otherwise(stamp("o_orderdate")).alias("dirty"),
    )
    strict, lenient = parse_timestamp("text"), parse_timestamp("dirty", strict=False)
    return text.select(
        "o_orderkey",
        F.year(strict).alias("year"),
        F.dayofmonth(strict).alias("day"),
        F.month(lenient).alias("lenient_month"),
        F.hour(lenient).alias("lenient_hour"),
    )


@query
def log_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(*LINE_KEY, "l_extendedprice")
    logs = cols.derive(lines, {"log": checked_ln("l_extendedprice"), "log1p": checked_log1p("l_extendedprice")})
    back = cols.derive(
        logs,
        {
            "exp": checked_exp("log"),
            "expm1": checked_expm1("log1p"),
            "root": checked_sqrt("l_extendedprice"),
        },
    )
    return rounded(back, ["log", "log1p", "root"]).withColumns({n: F.round(n, 3) for n in ("exp", "expm1")})


@query
def string_suffix_length(spark: SparkSession, folder: str) -> DataFrame:
    named = cols.derive(table(spark, folder, "customer").select("c_custkey", "c_name"), {"name": append_text("c_name", " Test")})
    return named.select("c_custkey", "name", text_length("name").alias("n_chars"))


@query
def row_function(spark: SparkSession, folder: str) -> DataFrame:
    """A function of each row; this one has a built-in expression."""
    return table(spark, folder, "documents").select("doc_id", text_length("text").cast("bigint").alias("n"))


def _without_marks(text: str | None) -> str | None:
    if text is None:
        return None
    bare = (c for c in unicodedata.normalize("NFD", text) if not unicodedata.category(c).startswith("M"))
    return unicodedata.normalize("NFC", "".join(bare))


@query
def row_function_batches(spark: SparkSession, folder: str) -> DataFrame:
    """A function of each whole text that no built-in expresses, in Arrow batches."""
    plain = column_function(lambda texts: texts.map(_without_marks), "string")
    documents = table(spark, folder, "documents").withColumn("text", F.concat("text", F.lit(" d\u00e9j\u00e0 na\u00efve \u00c5ngstr\u00f6m e\u0301")))
    bare = documents.select("doc_id", plain("text").alias("text"))
    return bare.select("doc_id", F.md5("text").alias("digest"), F.char_length("text").cast("bigint").alias("n_chars"))


@query
def strip_text_line_ends(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    padded = F.concat(F.regexp_replace("text", "\n", " \t\n"), F.lit("  \r"))
    clean = strip_line_ends(padded)
    return documents.select("doc_id", F.md5(clean).alias("digest"), text_length(clean).cast("bigint").alias("n_chars"))


# --- column selection --------------------------------------------------------------


@query
def select_by_dtype(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    return cols.select_columns(customer, ["c_custkey", *cols.columns_of_type(customer, include="object")])


@query
def select_by_dtype_exclude(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    return cols.select_columns(customer, cols.columns_of_type(customer, exclude="object"))


@query
def select_by_name(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return cols.select_columns(part, ["p_partkey", *cols.columns_containing(part, "p_name"), *cols.columns_containing(part, "price")])


@query
def select_by_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    few, many = cols.columns_by_cardinality(part, ["p_type", "p_brand", "p_name"], 10)
    return part.select(
        "p_partkey",
        F.concat_ws("|", *[cols.quoted(c) for c in few]).alias("few"),
        F.concat_ws("|", *[cols.quoted(c) for c in many]).alias("many"),
    )


@query
def select_by_exclusion(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return cols.select_columns(part, cols.columns_except(part, ["p_brand", "p_type"]))


@query
def select_by_position(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    return cols.select_columns(labels, [cols.column_at(labels, 0), cols.column_at(labels, 2)])


@query
def drop_strict(spark: SparkSession, folder: str) -> DataFrame:
    return cols.drop_columns(table(spark, folder, "orders"), ["o_orderdate", "o_orderpriority"])


@query
def drop_lenient(spark: SparkSession, folder: str) -> DataFrame:
    return cols.drop_columns(table(spark, folder, "orders"), ["o_orderdate", "casual", "registered"], missing_ok=True)


@query
def derive_columns(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(*LINE_KEY, "l_quantity", "l_extendedprice", "l_discount")
    made = cols.derive(lines, {"new_feat": interaction("l_quantity", "l_discount"), "unit": F.col("l_extendedprice") / 24.0})
    return rounded(made, ["new_feat", "unit"])


@query
def overwrite_block(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(*LINE_KEY, "l_discount", "l_tax")
    return rounded(cols.overwrite_block(lines, ["l_discount", "l_tax"], lambda c: c * 100.0), ["l_discount", "l_tax"])


@query
def rename_columns(spark: SparkSession, folder: str) -> DataFrame:
    renamed = cols.rename(table(spark, folder, "part"), {"p_partkey": "id", "p_retailprice": "target"})
    return cols.select_columns(renamed, ["id", "target"])


@query
def features_and_target(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    features, target = cols.features_and_target(part, "p_retailprice")
    return part.select(
        "p_partkey", F.lit(",".join(features)).alias("features"), cols.quoted(target[0]).alias("target")
    )


def customer_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with missing values; half of the missing balances are NaN."""
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal"))
        .when(F.col("c_custkey") % 2 == 0, F.lit("NaN").cast("double")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")).alias("c_nationkey"),
    )


@query
def null_indicator(spark: SparkSession, folder: str) -> DataFrame:
    gaps = customer_with_gaps(spark, folder)
    return gaps.select("c_custkey", cols.is_missing(gaps, "c_acctbal").alias("no_balance"), cols.is_missing(gaps, "c_mktsegment").alias("no_segment"))


def label_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with two scores and two guesses made from their length."""
    documents = table(spark, folder, "documents").select("doc_id", "n_chars")
    joined = combine.inner_join(table(spark, folder, "labels"), documents, "doc_id", hot=[])
    n = F.col("n_chars")
    return joined.withColumns(
        {
            "p_quality": (n % 97 + 1) / F.lit(98.0),
            "p_toxic": (n % 13 + 1) / F.lit(14.0),
            "quality_guess": (n % 3 > 0).cast("int"),
            "toxic_guess": (n % 11 == 0).cast("int"),
        }
    )


@query
def class_one_probability(spark: SparkSession, folder: str) -> DataFrame:
    scored = label_scores(spark, folder)
    vectors = scored.withColumn("probability", array_to_vector(F.array(1.0 - F.col("p_quality"), F.col("p_quality"))))
    return vectors.select("doc_id", F.round(cols.class_probability(), 9).alias("p"))


@query
def pick_matrix_columns(spark: SparkSession, folder: str) -> DataFrame:
    scored = label_scores(spark, folder)
    p, q = F.col("p_quality"), F.col("p_toxic")
    stacked = scored.withColumn("y_pred", F.array(1.0 - p, p, 1.0 - q, q))
    picked = stacked.select("doc_id", *cols.pick_positions("y_pred", {"quality": 1, "toxic": 3}))
    return rounded(picked, ["quality", "toxic"], 9)


# --- joins and unions ----------------------------------------------------------------


@query
def join_inner_labels(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    joined = combine.inner_join(
        lines, table(spark, folder, "orders"), "o_orderkey", spread_by=["l_partkey", "l_suppkey", "l_linenumber"]
    )
    return cols.drop_columns(joined, ["l_returnflag", "l_linestatus", "l_shipdate", "o_orderdate", "o_custkey"])


@query
def join_null_safe(spark: SparkSession, folder: str) -> DataFrame:
    """Missing keys match each other: a seventh of the orders meets one keyless customer."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("custkey")
    )
    customer = table(spark, folder, "customer").select(
        F.when(F.col("c_custkey") != 0, F.col("c_custkey")).alias("custkey"), "c_name"
    )
    return combine.inner_join(orders, customer, "custkey", null_safe=True, spread_by="o_orderkey")


@query
def lookup_map(spark: SparkSession, folder: str) -> DataFrame:
    """Each order mapped to the share of its lines; orders without lines get NULL."""
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    mapping = encode.FrequencyEncode(inputCols=["o_orderkey"], spreadBy=["id"]).fit(lines)
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderkey").alias("id"))
    return mapping.transform(orders).select("id", F.round("o_orderkey", 12).alias("share"))


@query
def lookup_frequent_unknown(spark: SparkSession, folder: str) -> DataFrame:
    """A value that the dictionary lacks and half of the scored rows have."""
    lines = table(spark, folder, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"))
    mapping = encode.FrequencyEncode(inputCols=["line"], spreadBy=["id"]).fit(lines)
    line = F.when(F.col("l_linenumber") < 4, F.concat_ws("-", "l_orderkey", "l_linenumber")).otherwise("none")
    scored = table(spark, folder, "lineitem").select(line.alias("line"), F.concat_ws("-", *LINE_KEY).alias("id"))
    return mapping.transform(scored).select("id", F.round("line", 12).alias("share"))


def large_values(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.concat_ws("-", *LINE_KEY).alias("id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"),
        F.concat_ws("|", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("goods"),
        F.col("l_extendedprice").alias("price"),
    )


@query
def frequency_encode_large(spark: SparkSession, folder: str) -> DataFrame:
    """Three columns of very many values, learned on the training rows, applied to all by one join."""
    lines = table(spark, folder, "lineitem")
    names = ["line", "goods", "price"]
    fitted = encode.FrequencyEncode(inputCols=names, spreadBy=["id"]).fit(large_values(hash_split(lines, "l_partkey", 0.2).train))
    return rounded(fitted.transform(large_values(lines)), names, 12)


@query
def ordinal_encode_large(spark: SparkSession, folder: str) -> DataFrame:
    """Positions among the sorted values of three columns of very many values."""
    values = large_values(table(spark, folder, "lineitem"))
    names = ["line", "goods", "price"]
    return encode.OrdinalEncode(inputCols=names, spreadBy=["id"]).fit(values).transform(values)


@query
def column_concat_keyed(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_brand")
    sold = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n_lines"))
    return combine.concat_columns(part, sold, "p_partkey")


@query
def stack_columns(spark: SparkSession, folder: str) -> DataFrame:
    scored = label_scores(spark, folder)
    return combine.stack_columns(scored, "doc_id", {"label1": "quality_guess", "label2": "toxic_guess"})


@query
def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    supplier = table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id")
    )
    return combine.union_by_name([customer, supplier])


@query
def stack_predictions(spark: SparkSession, folder: str) -> DataFrame:
    scored = label_scores(spark, folder)
    return combine.stack_predictions(scored, "doc_id", {"quality": "quality_guess", "toxic": "toxic_guess"})


# --- aggregates -------------------------------------------------------------------------


@query
def distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    return stats.distinct_counts(customer_with_gaps(spark, folder), ["c_acctbal", "c_mktsegment", "c_nationkey"])


@query
def relative_frequency(spark: SparkSession, folder: str) -> DataFrame:
    shares = stats.relative_frequencies(customer_with_gaps(spark, folder), "c_mktsegment")
    return rounded(shares, ["frequency"], 12)


@query
def mean_and_deviation(spark: SparkSession, folder: str) -> DataFrame:
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    found = stats.means_and_deviations(table(spark, folder, "lineitem"), names)
    rows = [(n, *found[n]) for n in names]
    return rounded(literal_table(spark, rows, "feature string, mean double, deviation double"), ["mean", "deviation"])


@query
def median_per_column(spark: SparkSession, folder: str) -> DataFrame:
    lines = stats.medians(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    gaps = stats.medians(customer_with_gaps(spark, folder), ["c_acctbal"])
    return rounded(literal_table(spark, list((lines | gaps).items()), "feature string, median double"), ["median"])


@query
def mode_per_column(spark: SparkSession, folder: str) -> DataFrame:
    found = stats.modes(table(spark, folder, "part"), ["p_type", "p_brand", "p_name"])
    found |= stats.modes(customer_with_gaps(spark, folder), ["c_mktsegment"])
    return literal_table(spark, list(found.items()), "feature string, mode string")


@query
def sorted_categories(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    listed = stats.categories(orders, "o_orderpriority")
    model = encode.OrdinalEncode(inputCols=["value"]).fit(orders.select(F.col("o_orderpriority").alias("value")))
    return model.transform(listed.withColumn("category", F.col("value"))).select("category", F.col("value").cast("bigint").alias("position"))


@query
def class_prior(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.class_shares(table(spark, folder, "labels"), "quality"), ["share"], 12)


# --- metrics ------------------------------------------------------------------------------


@query
def metric_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.accuracy(label_scores(spark, folder), "quality", "quality_guess"), ["accuracy"], 9)


@query
def metric_exact_match(spark: SparkSession, folder: str) -> DataFrame:
    pairs = {"quality": "quality_guess", "toxic": "toxic_guess"}
    return rounded(metrics.exact_match(label_scores(spark, folder), pairs), ["accuracy"], 9)


@query
def metric_logloss(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.log_loss(label_scores(spark, folder), "quality", "p_quality"), ["log_loss"], 9)


PROBABILITIES = {"quality": "p_quality", "toxic": "p_toxic"}


@query
def metric_logloss_two(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.log_loss_targets(label_scores(spark, folder), PROBABILITIES), ["log_loss"], 9)


@query
def metric_logloss_indicator(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.log_loss_targets(label_scores(spark, folder), PROBABILITIES, "indicator"), ["log_loss"], 9)


def line_scores(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_extendedprice") * (1.0 - F.col("l_discount"))).alias("score"),
        "l_quantity",
        "l_extendedprice",
        (F.col("l_quantity") * 2000.0).alias("guess"),
    )


@query
def metric_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.roc_auc(line_scores(spark, folder), "y", "score"), ["auc"], 9)


@query
def metric_auc_ties(spark: SparkSession, folder: str) -> DataFrame:
    """Fifty distinct scores over all lines: almost every comparison is a tie."""
    return rounded(metrics.roc_auc(line_scores(spark, folder), "y", "l_quantity"), ["auc"], 9)


@query
def metric_rmse(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.rmse(line_scores(spark, folder), "l_extendedprice", "guess"), ["rmse"])


@query
def metric_msle(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.msle(line_scores(spark, folder), "l_extendedprice", "guess"), ["msle"], 9)


@query
def metric_rmsle(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.rmsle(line_scores(spark, folder), "l_extendedprice", "guess"), ["rmsle"], 9)


# --- splits ---------------------------------------------------------------------------------


@query
def split_hash(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return with_side(orders, in_test("o_orderkey", 0.2, 42))


@query
def split_exact(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return with_side(orders, exact_test_rows(orders, "o_orderkey", 0.2, 42))


@query
def split_by_group(spark: SparkSession, folder: str) -> DataFrame:
    """All lines of an order fall on one side."""
    parts = hash_split(table(spark, folder, "lineitem").select(*LINE_KEY), "l_orderkey", 0.2, 0)
    return combine.union_by_name([parts.test.withColumn("side", F.lit("test")), parts.train.withColumn("side", F.lit("train"))])


# --- fitted preprocessing ---------------------------------------------------------------------


SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(*LINE_KEY, *SCALED)
    return rounded(encode.StandardScale(inputCols=SCALED).fit(lines).transform(lines), SCALED)


@query
def standard_scale_train_only(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    parts = hash_split(orders, "o_orderkey")
    model = encode.StandardScale(inputCols=["o_totalprice"]).fit(parts.train)
    return rounded(model.transform(orders), ["o_totalprice"])


@query
def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    gaps = customer_with_gaps(spark, folder).select("c_custkey", "c_acctbal")
    return rounded(encode.MedianImpute(inputCols=["c_acctbal"]).fit(gaps).transform(gaps), ["c_acctbal"])


@query
def impute_mode(spark: SparkSession, folder: str) -> DataFrame:
    gaps = customer_with_gaps(spark, folder).select("c_custkey", "c_mktsegment")
    return encode.ModeImpute(inputCols=["c_mktsegment"]).fit(gaps).transform(gaps)


@query
def fill_numbers(spark: SparkSession, folder: str) -> DataFrame:
    gaps = customer_with_gaps(spark, folder).select("c_custkey", "c_acctbal", "c_nationkey")
    filled = encode.FillNumbers(exclude=["c_custkey", "c_nationkey"]).fit(gaps).transform(gaps)
    return rounded(filled.drop("c_nationkey"), ["c_acctbal"])


@query
def ordinal_encode(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    names = ["o_orderpriority", "o_orderstatus"]
    return encode.OrdinalEncode(inputCols=names).fit(orders).transform(orders)


@query
def ordinal_encode_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers are coded in numeric order, and a key column has as many codes as rows."""
    part = table(spark, folder, "part").select("p_partkey", "p_size", F.col("p_retailprice").alias("price"))
    return encode.OrdinalEncode(inputCols=["p_size", "price"]).fit(part).transform(part)


@query
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_type")
    return encode.OneHotEncode(inputCols=["p_type"]).fit(part).transform(part)


@query
def one_hot_missing(spark: SparkSession, folder: str) -> DataFrame:
    gaps = customer_with_gaps(spark, folder).select("c_custkey", "c_mktsegment")
    return encode.OneHotEncode(inputCols=["c_mktsegment"], missingAsCategory=True).fit(gaps).transform(gaps)


@query
def one_hot_unknown(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on line states, applied to order states: the one never seen is all zeros."""
    flags = table(spark, folder, "lineitem").select(F.col("l_linestatus").alias("state"))
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderstatus").alias("state"))
    return encode.OneHotEncode(inputCols=["state"]).fit(flags).transform(orders)


@query
def one_hot_sparse(spark: SparkSession, folder: str) -> DataFrame:
    """Sparse vectors, read back as the position of their single one (or none)."""
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    made = Pipeline(stages=encode.sparse_one_hot(["p_name"])).fit(part).transform(part)
    ones = vector_to_array("p_name_onehot")
    return made.select(
        "p_partkey", F.size(ones).alias("width"), (F.array_position(ones, 1.0) - 1).alias("position")
    )


@query
def frequency_encode(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_brand", "p_name")
    coded = encode.FrequencyEncode(inputCols=["p_brand", "p_name"]).fit(part).transform(part)
    return rounded(coded, ["p_brand", "p_name"], 12)


@query
def frequency_encode_train_only(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of customers among the training orders; customers only seen in test are NULL."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    model = encode.FrequencyEncode(inputCols=["o_custkey"], spreadBy=["o_orderkey"]).fit(hash_split(orders, "o_orderkey").train)
    return rounded(model.transform(orders), ["o_custkey"], 12)


@query
def encode_routed(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_type", "p_brand", "p_name")
    routed = encode.RoutedEncode(inputCols=["p_type", "p_brand", "p_name"]).fit(part).transform(part)
    return rounded(routed, ["p_brand", "p_name"], 12)


@query
def encode_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """A whole column-set transformer; the listed groups stay, other columns go."""
    part = table(spark, folder, "part")
    stages = encode.column_groups(
        [
            ("num", [encode.StandardScale(inputCols=["p_retailprice"])], ["p_retailprice"]),
            ("ord", [encode.OrdinalEncode(inputCols=["p_size"])], ["p_size"]),
            ("cat", [encode.OneHotEncode(inputCols=["p_type"])], ["p_type"]),
            ("freq", [encode.FrequencyEncode(inputCols=["p_brand"])], ["p_brand"]),
        ],
        keep=["p_partkey"],
    )
    return rounded(Pipeline(stages=stages).fit(part).transform(part), ["p_retailprice", "p_brand"])


def add_line_value(df: DataFrame) -> DataFrame:
    return cols.derive(df, {"new_feat": interaction("l_quantity", "l_discount")})


@query
def function_stage(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(*LINE_KEY, "l_quantity", "l_discount")
    stages = [encode.FunctionStage.of(add_line_value), encode.StandardScale(inputCols=["new_feat"])]
    return rounded(Pipeline(stages=stages).fit(lines).transform(lines), ["new_feat"])


@query
def feature_vector(spark: SparkSession, folder: str) -> DataFrame:
    """Assembled features, read back in order as text."""
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice", "p_brand")
    made = encode.FeatureVector(exclude=["p_partkey"]).fit(part).transform(part)
    values = vector_to_array("features")
    return made.select("p_partkey", F.size(values).alias("width"), values[0].alias("first"), values[1].alias("second"))


# --- sources and sinks ----------------------------------------------------------------------------


LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"]
LINE_TYPES = {
    "l_orderkey": "int64",
    "l_linenumber": "int32",
    "l_quantity": "float16",
    "l_extendedprice": "float64",
    "l_returnflag": "object",
    "l_shipdate": "datetime64[ns]",
}


def write_schema_table(spark: SparkSession, types: dict[str, str]) -> str:
    path = scratch_path(spark, "schema")
    write_csv(literal_table(spark, list(types.items()), "column string, dtype string"), path)
    return path


def write_line_parts(spark: SparkSession, folder: str, reorder: bool = False) -> list[str]:
    """The lines as two CSV folders; the second may have its columns in another order."""
    lines = table(spark, folder, "lineitem").select(*LINE_COLUMNS)
    parts = hash_split(lines, "l_orderkey", 0.5)
    paths = [scratch_path(spark, "lines"), scratch_path(spark, "lines")]
    write_csv(parts.train, paths[0])
    write_csv(parts.test.select(*reversed(LINE_COLUMNS)) if reorder else parts.test, paths[1])
    return paths


def readable(lines: DataFrame) -> DataFrame:
    return lines.withColumns({"l_quantity": F.col("l_quantity").cast("double"), "l_shipdate": stamp("l_shipdate")})


@query
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    orders = table(spark, folder, "orders")
    write_csv(orders, path)
    back = read_csv(spark, path, orders.schema)
    return back.withColumn("o_orderdate", stamp("o_orderdate"))


@query
def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """Types found in the text: keys and sizes become long, prices double, the rest string."""
    path = scratch_path(spark, "part")
    write_csv(table(spark, folder, "part"), path)
    schema = infer_schema(spark, path)
    types = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in schema)
    return read_csv(spark, path, schema).withColumn("types", F.lit(types))


@query
def csv_missing_markers(spark: SparkSession, folder: str) -> DataFrame:
    """Empty fields, NaN and NA all read as NULL."""
    path = scratch_path(spark, "gaps")
    key = F.col("c_custkey")
    marker = F.when(key % 7 == 0, "NaN").when(key % 7 == 1, "NA").when(key % 7 == 2, "")
    balance = F.coalesce(marker, F.col("c_acctbal").cast("string"))
    write_csv(table(spark, folder, "customer").select("c_custkey", balance.alias("c_acctbal")), path)
    return read_csv(spark, path, {"c_custkey": T.LongType(), "c_acctbal": T.DoubleType()})


@query
def csv_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Types come from a schema table; half precision is widened."""
    path = scratch_path(spark, "lines")
    write_csv(table(spark, folder, "lineitem").select(*LINE_COLUMNS), path)
    schema = read_schema_table(spark, write_schema_table(spark, LINE_TYPES))
    return readable(read_csv(spark, path, schema))


@query
def csv_multifile(spark: SparkSession, folder: str) -> DataFrame:
    schema = read_schema_table(spark, write_schema_table(spark, LINE_TYPES))
    return readable(read_csv(spark, write_line_parts(spark, folder), schema))


@query
def csv_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Files whose columns come in different orders are bound by name."""
    schema = read_schema_table(spark, write_schema_table(spark, LINE_TYPES))
    paths = write_line_parts(spark, folder, reorder=True)
    return readable(read_csv(spark, paths, schema, mixed_headers=True))


def line_totals(spark: SparkSession, paths: list[str], schema_path: str) -> DataFrame:
    lines = read_csv(spark, paths, read_schema_table(spark, schema_path))
    return lines.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.sum(F.col("l_quantity").cast("double")), 2).alias("quantity")
    )


@query
def csv_rebind(spark: SparkSession, folder: str) -> DataFrame:
    """One job over two bindings of its file list and schema."""
    schema = write_schema_table(spark, LINE_TYPES)
    first, second = write_line_parts(spark, folder)
    totals = [line_totals(spark, [p], schema).withColumn("binding", F.lit(i)) for i, p in enumerate([first, second])]
    return combine.union_by_name(totals)


@query
def csv_text_with_line_ends(spark: SparkSession, folder: str) -> DataFrame:
    """Quotes, commas and line ends inside a field survive."""
    path = scratch_path(spark, "documents")
    documents = table(spark, folder, "documents").select("doc_id", "text")
    write_csv(documents, path)
    back = read_csv(spark, path, documents.schema, multi_line=True)
    return back.select("doc_id", F.md5("text").alias("digest"))


@query
def csv_text_split(spark: SparkSession, folder: str) -> DataFrame:
    """The same, with every file cut into records by several tasks; one type is inferred."""
    path = scratch_path(spark, "documents")
    write_csv(table(spark, folder, "documents").select("doc_id", "text", "n_chars"), path)
    back = read_csv(spark, path, {"doc_id": T.LongType(), "text": T.StringType()}, multi_line="split")
    return back.select("doc_id", F.md5("text").alias("digest"), "n_chars")


@query
def submission_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The key and one named output, written and read back."""
    path = scratch_path(spark, "submission")
    out = submission(label_scores(spark, folder), "doc_id", {"quality": "quality_guess"})
    write_csv(out, path)
    return read_csv(spark, path, {"doc_id": T.LongType(), "quality": T.IntegerType()})


@query
def preview_sample(spark: SparkSession, folder: str) -> DataFrame:
    return preview(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 100)


@query
def preview_file_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Of a list of tables the first three by name, and then the first rows by key."""
    names = preview_files([f"{folder}/{n}.parquet" for n in ("supplier", "customer", "part", "nation")], 3)
    sides = []
    for path in names:
        rows = spark.read.parquet(path)
        sides.append(rows.select(F.col(rows.columns[0]).cast("bigint").alias("id"), F.col(rows.columns[1]).alias("name")))
    return preview(combine.union_by_name(sides), ["id", "name"], 100)


@query
def synthetic_table(spark: SparkSession, folder: str) -> DataFrame:
    """One generated row per order, a function of the key alone."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    made = orders.withColumns(
        {
            "feat1": hashed_normal("id", "feat1", 42, 10.0),
            "feat2": hashed_normal("id", "feat2", 42, 5.0),
            "feat3": hashed_integers("id", "feat3", 42, 0, 100),
            "feat4": hashed_uniform("id", "feat4", 42, 50.0),
            "label": hashed_integers("id", "label", 42, 0, 2),
        }
    )
    return rounded(made, ["feat1", "feat2", "feat4"])


# --- models and the learner -------------------------------------------------------------------------


@query
def prior_baseline(spark: SparkSession, folder: str) -> DataFrame:
    """Largest class and its share, learned on the training rows."""
    labels = table(spark, folder, "labels")
    plan = FeaturePlan(key="doc_id", target="quality", model=PriorClassifier(), drop=["toxic"], stages=[])
    with_length = combine.inner_join(labels, table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id", hot=[])
    learner = plan.make_learner().fit(features=plan.split(with_length).train)
    scored = learner.predict(raw=with_length, output="both")
    return scored.select("doc_id", "quality_prediction", F.round("quality_probability", 12).alias("quality_probability"))


def with_suffix(df: DataFrame) -> DataFrame:
    return cols.derive(df, {"Names": append_text("Names", " Test")})


@query
def raw_or_marked_input(spark: SparkSession, folder: str) -> DataFrame:
    """Raw input passes the upstream step, a table given at the mark does not."""
    names = table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("Names"), F.lit(0).alias("label"))
    plan = workloads.name_baseline("c_custkey", with_suffix)
    both = plan.at_mark(names.withColumn("as_given", F.col("Names")))
    return both.select("c_custkey", text_length("Names").alias("raw_length"), text_length("as_given").alias("marked_length"))


@query
def model_sees_the_marked_table(spark: SparkSession, folder: str) -> DataFrame:
    """A class set by the length of a name: right for raw input and for a table at the mark only
    if the upstream step ran once for the one and not at all for the other."""
    names = table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("Names"))
    raw = names.withColumn("label", (F.char_length("Names") + 5 > 15).cast("int"))
    plan = replace(workloads.name_baseline("p_partkey", with_suffix), model=exact_forest(maxBins=64))
    learner = plan.make_learner().fit(raw=raw.where(~unlabelled("p_partkey")))
    test = names.where(unlabelled("p_partkey"))
    sides = [learner.predict(raw=test).withColumn("input", F.lit("raw")), learner.predict(features=with_suffix(test)).withColumn("input", F.lit("marked"))]
    return combine.union_by_name(sides)


@query
def name_baseline(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_name").alias("Names"), (F.col("c_acctbal") > 2000.0).cast("int").alias("label")
    )
    plan = workloads.name_baseline("c_custkey", with_suffix)
    learner = plan.make_learner().fit(raw=names)
    scored = learner.predict(features=names, output="both")
    return scored.select("c_custkey", "label_prediction", F.round("label_probability", 12).alias("label_probability"))


@query
def observe_tap(spark: SparkSession, folder: str) -> DataFrame:
    """Row and text counts seen while another action ran."""
    customer = table(spark, folder, "customer")
    watched, seen = tap(customer, "customers", F.count(F.lit(1)).alias("n"), F.sum(F.length("c_name")).alias("chars"))
    watched.write.format("noop").mode("overwrite").save()
    return literal_table(spark, [(seen.get["n"], seen.get["chars"])], "n bigint, chars bigint")


@query
def eval_rebind(spark: SparkSession, folder: str) -> DataFrame:
    """The same plan evaluated on two different tables."""
    plan = FeaturePlan(key="id", target="label", model=PriorClassifier())
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), (F.col("c_acctbal") > 0).cast("int").alias("label"), F.col("c_acctbal").alias("x")
    )
    supplier = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), (F.col("s_acctbal") > 5000).cast("int").alias("label"), F.col("s_acctbal").alias("x")
    )
    sides = [plan.evaluate(t).withColumn("input", F.lit(n)) for n, t in (("customer", customer), ("supplier", supplier))]
    return combine.union_by_name(sides)


def unlabelled(key: str) -> Column:
    """A fifth of the keys, whose label the models have to predict."""
    return F.pmod(F.col(key), F.lit(5)) == 0


def exact_forest(**options):
    """Every tree may look at every column, so a rule over one column is found by each."""
    return forest_classifier(featureSubsetStrategy="all", **options)


def surface_outcome(spark: SparkSession, folder: str, **options) -> workloads.Outcome:
    """Lines as measurements of orders; the class of an order is set by one of its columns."""
    measurements = table(spark, folder, "lineitem").drop("l_returnflag", "l_linestatus", "l_shipdate")
    measurements = measurements.withColumnRenamed("l_orderkey", "o_orderkey")
    measurements = measurements.withColumn("band", F.pmod("o_orderkey", F.lit(7)))
    named = F.when(F.col("o_orderkey") % 7 < 2, "tiles").when(F.col("o_orderkey") % 7 < 5, "carpet").otherwise("wood")
    labels = table(spark, folder, "orders").select("o_orderkey", named.alias("surface")).where(~unlabelled("o_orderkey"))
    return workloads.robot_surface(
        measurements, labels, measurements.where(unlabelled("o_orderkey")), model=exact_forest(),
        key=["o_orderkey", *LINE_KEY[1:]], on="o_orderkey", drop=[], by="o_orderkey", **options,
    )


@query
def fit_predict_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Three text classes by a forest: the submission for the lines of unlabelled orders."""
    return surface_outcome(spark, folder).submission


@query
def fit_predict_forest_score(spark: SparkSession, folder: str) -> DataFrame:
    return surface_outcome(spark, folder, fit_scope="all").score


@query
def fit_predict_regression(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar features, a log1p target and boosted trees: the submission for unlabelled events."""
    events = event_features(spark, folder).withColumnRenamed("ts", "datetime")
    demand = F.when(F.col("workingday") == 1, 120.0).otherwise(35.0) + F.when(F.hour("datetime") < 12, 0.0).otherwise(400.0)
    train = events.where(~unlabelled("event_id")).withColumn("value", demand)
    made = workloads.bike_demand(train, events.where(unlabelled("event_id")).drop("value"), key="event_id", target="value")
    return rounded(made.submission, ["value"], 3)


def document_features(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with features of their whole text; only those texts are looked at."""
    labels = table(spark, folder, "labels")
    documents = combine.inner_join(table(spark, folder, "documents"), labels, "doc_id")
    return documents.select(
        "doc_id",
        "quality",
        "toxic",
        "lang",
        "source",
        "n_chars",
        F.regexp_count("text", F.lit("\n")).alias("lines"),
        F.regexp_count("text", F.lit(r"\s+")).alias("words"),
        F.regexp_count("text", F.lit("[0-9]")).alias("digits"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("capitals"),
    )


def language_labels(docs: DataFrame) -> DataFrame:
    """Two labels that the language of a document decides."""
    return docs.withColumns({"quality": (F.col("lang") == "en").cast("int"), "toxic": F.col("lang").isin("de", "fr").cast("int")})


@query
def fit_predict_gbt(spark: SparkSession, folder: str) -> DataFrame:
    """Routed categorical encoding and boosted trees: the likelier class of unlabelled documents."""
    docs = language_labels(document_features(spark, folder)).drop("toxic")
    made = workloads.categorical_target(
        docs.where(~unlabelled("doc_id")), docs.where(unlabelled("doc_id")).drop("quality"),
        key="doc_id", target="quality", ordinal=["lang"], nominal=["source"],
    )
    return rounded(made.submission, ["quality"], 0)


@query
def fit_predict_boosted_regression(spark: SparkSession, folder: str) -> DataFrame:
    """Median and mode imputation, one-hot text and boosted trees on a log price."""
    part = table(spark, folder, "part")
    gaps = part.select(
        "p_partkey",
        "p_type",
        F.when(F.col("p_partkey") % 5 != 2, F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_retailprice")).alias("list_price"),
        (F.col("p_size") % 4).alias("grade"),
    )
    price = F.when(F.col("p_type") == "ECONOMY", 100.0).otherwise(250.0) * (1 + F.col("grade"))
    made = workloads.house_prices(
        gaps.where(~unlabelled("p_partkey")).withColumn("price", price), gaps.where(unlabelled("p_partkey")), key="p_partkey", target="price"
    )
    return rounded(made.submission, ["price"], 0)


def two_target_outcome(spark: SparkSession, folder: str, **options) -> workloads.Outcome:
    docs = language_labels(document_features(spark, folder))
    return workloads.game_events(
        docs.where(~unlabelled("doc_id")),
        docs.where(unlabelled("doc_id")).drop("quality", "toxic"),
        key="doc_id",
        targets=["quality", "toxic"],
        drop=[],
        stages=[encode.RoutedEncode(inputCols=["lang", "source"], output="vector")],
        **options,
    )


@query
def two_target_learner(spark: SparkSession, folder: str) -> DataFrame:
    """Two boosted classifiers over one feature matrix: the likelier class of both targets."""
    return rounded(two_target_outcome(spark, folder).submission, ["quality", "toxic"], 0)


def generated_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Generated features; the labels are rules over a column with few values."""
    made = synthetic_table(spark, folder).withColumn("feat3", F.col("feat3") % 10)
    return made.withColumns({"label1": (F.col("feat3") >= 4).cast("int"), "label2": (F.col("feat3") < 7).cast("int")})


@query
def two_target_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Two forests on generated features, one row per order; both labels must be right."""
    made = generated_rows(spark, folder).select("id", "feat2", "feat3", "label1", "label2")
    test = made.where(unlabelled("id")).drop("label1", "label2")
    return workloads.two_targets(made.where(~unlabelled("id")), test, model=exact_forest()).submission


@query
def one_target_forest(spark: SparkSession, folder: str) -> DataFrame:
    """An interaction and scaled columns; the label is a rule over one of them."""
    made = generated_rows(spark, folder).withColumns({"feat5": F.col("feat3").cast("double"), "label": F.col("label1")}).drop("label1", "label2")
    return workloads.one_target(made.where(~unlabelled("id")), made.where(unlabelled("id")).drop("label"), model=exact_forest()).submission


@query
def learner_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of a learner that was saved and loaded."""
    outcome = two_target_outcome(spark, folder, model=exact_forest())
    path = scratch_path(spark, "learner")
    outcome.learner.save(path)
    scored = FittedLearner.load(path).predict(features=language_labels(document_features(spark, folder)), output="both")
    return rounded(scored, ["quality_probability", "toxic_probability"], 0)


@query
def learner_reload_raw(spark: SparkSession, folder: str) -> DataFrame:
    """A learner saved and loaded with its upstream step, applied to raw input."""
    names = table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("Names"))
    raw = names.withColumn("label", (F.char_length("Names") + 5 > 15).cast("int"))
    plan = replace(workloads.name_baseline("p_partkey", with_suffix), model=exact_forest(maxBins=64))
    path = scratch_path(spark, "learner")
    plan.make_learner().fit(raw=raw.where(~unlabelled("p_partkey"))).save(path)
    return FittedLearner.load(path).predict(raw=names.where(unlabelled("p_partkey")))


def with_nation(measurements: DataFrame, series: DataFrame) -> DataFrame:
    return combine.inner_join(measurements, series, "custkey", spread_by="o_orderkey")


def with_surface(with_nation: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Labels of the series, where there are any: none are bound to predict."""
    return with_nation if labels is None else combine.inner_join(with_nation, labels, "custkey", spread_by="o_orderkey")


def series_plan() -> FeaturePlan:
    return FeaturePlan(
        key="o_orderkey",
        target="surface",
        model=exact_forest(),
        inputs=[
            TableInput("measurements", {"o_orderkey": "bigint", "custkey": "bigint"}, preview_key="o_orderkey"),
            TableInput("series", {"custkey": "bigint", "nation": "int"}),
            TableInput("labels", ["custkey", "surface"], fit_only=True),
        ],
        prepare={"with_nation": with_nation, "train_data": with_surface},
        drop=["custkey"],
    )


@query
def named_inputs_join(spark: SparkSession, folder: str) -> DataFrame:
    """Three sources joined inside the plan: fitted on one binding, predicting on another.

    The class of a customer is set by its nation, which only the join brings in.
    """
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"), "o_totalprice")
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_nationkey").cast("int").alias("nation"))
    surface = F.when(F.col("nation") < 8, "tiles").when(F.col("nation") < 16, "carpet").otherwise("wood")
    labels = customer.select("custkey", surface.alias("surface"))
    new = unlabelled("o_orderkey")
    learner = series_plan().make_learner().fit(raw={"measurements": orders.where(~new), "series": customer, "labels": labels})
    return learner.predict(raw={"measurements": orders.where(new), "series": customer})


def order_features(rows: DataFrame) -> DataFrame:
    return cols.derive(rows, {"band": F.pmod("o_orderkey", F.lit(7))})


def order_files(spark: SparkSession, folder: str) -> tuple[list[str], str, list[str], str]:
    """Orders as files of four groups of keys, labelled, and those to predict, with their schemas."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", (F.col("o_orderkey") % 7 < 3).cast("int").alias("early"))
    base = scratch_path(spark, "orders")
    train = [f"{base}/train_{i}" for i in range(4)]
    for i, path in enumerate(train):
        write_csv(orders.where(~unlabelled("o_orderkey") & (F.col("o_orderkey") % 4 == i)), path)
    write_csv(orders.where(unlabelled("o_orderkey")).select("o_totalprice", "o_orderkey"), f"{base}/test")
    types = {"o_orderkey": "int64", "o_totalprice": "float64"}
    return train, write_schema_table(spark, types | {"early": "int8"}), [f"{base}/test"], write_schema_table(spark, types)


def files_plan(model=None) -> FeaturePlan:
    return FeaturePlan(
        key="o_orderkey",
        target="early",
        model=model or exact_forest(),
        inputs=[PathsInput("file_names"), SchemaInput("schema")],
        prepare={"rows": read_files, "features": order_features},
    )


@query
def named_inputs_files(spark: SparkSession, folder: str) -> DataFrame:
    """A list of files and a schema as inputs of the plan: each run binds its own."""
    train, types, test, test_types = order_files(spark, folder)
    learner = files_plan().make_learner().fit(raw={"file_names": train, "schema": types})
    return learner.predict(raw={"file_names": test, "schema": test_types}).withColumn("early_prediction", F.col("early_prediction").cast("int"))


@query
def named_inputs_preview(spark: SparkSession, folder: str) -> DataFrame:
    """The plan on a sample: of four files the first three by name, of their rows the first by key."""
    train, types, _, _ = order_files(spark, folder)
    shown = files_plan(PriorClassifier()).preview({"file_names": train[::-1], "schema": types}, n=50)
    return shown.select("o_orderkey", F.col("early").cast("int").alias("early"), F.col("early_prediction").cast("int").alias("early_prediction"))


@query
def target_of_its_own(spark: SparkSession, folder: str) -> DataFrame:
    """Features and targets in two tables, rows in different orders, met by key."""
    part = table(spark, folder, "part")
    features = part.select("p_partkey", "p_size", "p_retailprice")
    grade = (F.col("p_size") % 10 < 4).cast("int").alias("grade")
    plan = FeaturePlan(key="p_partkey", target="grade", model=exact_forest(maxBins=64))
    old = ~unlabelled("p_partkey")
    target = part.where(old).select(grade, "p_partkey").orderBy(F.desc("p_partkey"))
    learner = plan.make_learner().fit(features=features.where(old), target=target)
    return learner.predict(features=features.where(~old))


@query
def column_concat_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables of the same keys side by side, checked one to one."""
    lines = table(spark, folder, "lineitem").select(*LINE_KEY, "l_quantity", "l_tax").dropDuplicates(LINE_KEY)
    return combine.concat_columns(lines.drop("l_tax"), lines.drop("l_quantity").repartition("l_tax"), LINE_KEY, "exact")


@query
def many_text_classes(spark: SparkSession, folder: str) -> DataFrame:
    """A text target with six hundred classes."""
    kind = F.concat(F.lit("kind-"), F.lpad((F.col("o_orderkey") % 600).cast("string"), 3, "0"))
    named = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", kind.alias("kind"))
    plan = FeaturePlan(key="o_orderkey", target="kind", model=PriorClassifier())
    return plan.make_learner().fit(raw=named).predict(raw=named.drop("kind"))


@query
def prior_of_any_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Negative and fractional classes keep their values and their shares."""
    rows = table(spark, folder, "orders").select("o_orderkey", ((F.col("o_orderkey") % 5) * 0.75 - 1.5).alias("label"))
    learner = FeaturePlan(key="o_orderkey", target="label", model=PriorClassifier(labelCol="label"), stages=[]).make_learner()
    scored = learner.fit(raw=rows.withColumn("x", F.lit(1.0))).predict(raw=rows.withColumn("x", F.lit(1.0)), output="both")
    classes = F.transform("label_probability", lambda p: F.round(p, 9))
    return scored.select("o_orderkey", F.col("label_prediction").cast("double").alias("label_prediction"), F.size(classes).alias("classes"), F.round(F.aggregate(classes, F.lit(0.0), lambda a, p: a + p), 6).alias("total"))


@query
def one_hot_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Hundreds of numbers as one sparse vector: slots in numeric order, missing ones without."""
    rows = table(spark, folder, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, (F.col("o_orderkey") % 700) * 1.5).otherwise(F.lit("NaN").cast("double")).alias("x"))
    made = encode.OneHotEncode(inputCols=["x"], output="vector").fit(rows).transform(rows)
    ones = F.filter(F.transform(vector_to_array("x_onehot"), lambda v, i: F.when(v == 1.0, i)), lambda i: i.isNotNull())
    return made.select("o_orderkey", F.coalesce(F.get(ones, F.lit(0)), F.lit(-1)).cast("int").alias("slot"), F.size(ones).alias("n_ones"))


@query
def split_exact_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Whole orders, of lowest hash, until a fifth of the lines is reached."""
    lines = table(spark, folder, "lineitem").select(*LINE_KEY)
    return with_side(lines, exact_test_rows(lines, "l_orderkey", 0.2, 42))


@query
def metric_skip_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without a label or with NaN as prediction left out, and the number of those used."""
    gaps = table(spark, folder, "orders").select(
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 2).alias("y"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey") % 4 / 2.0 % 2).otherwise(F.lit("NaN").cast("double")).alias("p"),
    )
    return metrics.accuracy(gaps, "y", "p", missing="skip")
