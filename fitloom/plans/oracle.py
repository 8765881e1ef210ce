"""Independent SQL for the registered queries, in DuckDB's dialect."""

from __future__ import annotations


def _test(key: str, seed: int = 42, cut: str = "33333333") -> str:
    """The rows of the test side: leading hash digits below the cut (0.2 of 16^8)."""
    return f"substr(md5({key}::VARCHAR || '_{seed}'), 1, 8) < '{cut}'"


def _side(key: str, seed: int = 42) -> str:
    return f"CASE WHEN {_test(key, seed)} THEN 'test' ELSE 'train' END AS side"


LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
GAPS = """(SELECT c_custkey,
    CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal,
    CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS c_mktsegment,
    CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey END AS c_nationkey FROM customer)"""
SCORES = """(SELECT l.*, d.n_chars, (d.n_chars % 97 + 1)::DOUBLE / 98 AS p_quality,
    (d.n_chars % 13 + 1)::DOUBLE / 14 AS p_toxic, (d.n_chars % 3 > 0)::INTEGER AS quality_guess,
    (d.n_chars % 11 = 0)::INTEGER AS toxic_guess FROM labels l JOIN documents d USING (doc_id))"""
LINES = """(SELECT (l_returnflag = 'R')::INTEGER AS y, l_extendedprice * (1::DOUBLE - l_discount) AS score,
    l_quantity, l_extendedprice, l_quantity * 2000 AS guess FROM lineitem)"""
LARGE = f"""SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, l_orderkey || '-' || l_linenumber AS line,
    concat_ws('|', l_partkey, l_suppkey, l_quantity, l_extendedprice) AS goods, l_extendedprice AS price, {_test('l_partkey')} AS test
    FROM lineitem"""
EPS = "2.220446049250313e-16::DOUBLE"


def _clip(p: str) -> str:
    return f"greatest(least({p}, 1::DOUBLE - {EPS}), {EPS})"


def _loss(y: str, p: str) -> str:
    c = _clip(p)
    return f"-({y}::DOUBLE * ln({c}) + (1 - {y})::DOUBLE * ln(1::DOUBLE - {c}))"


def _auc(score: str) -> str:
    return f"""WITH r AS (SELECT y, rank() OVER (ORDER BY {score}) AS lo,
            count(*) OVER (PARTITION BY {score}) AS same FROM {LINES}),
        a AS (SELECT y, lo + (same - 1) / 2::DOUBLE AS mid FROM r),
        t AS (SELECT sum(y)::DOUBLE AS p, sum(1 - y)::DOUBLE AS n, sum(CASE WHEN y = 1 THEN mid ELSE 0 END) AS s FROM a)
        SELECT round((s - p * (p + 1) / 2) / (p * n), 9) AS auc FROM t"""


def _each(names: list[str], select: str) -> str:
    return " UNION ALL ".join(select.format(c=c) for c in names)


def _uniform(key: str, name: str, scale: str) -> str:
    digits = f"('0x' || substr(md5({key}::VARCHAR || '_{name}_42'), 1, 13))::BIGINT::DOUBLE"
    return f"(({digits} + 0.5::DOUBLE) / 4503599627370496::DOUBLE * {scale})"


def _normal(key: str, name: str, scale: str) -> str:
    radius = f"sqrt(-2::DOUBLE * ln({_uniform(key, name + ':r', '1::DOUBLE')}))"
    return f"round({radius} * cos({_uniform(key, name + ':a', '(2 * pi())')}) * {scale}, 6)"


def _zscore(column: str) -> str:
    return f"round(({column} - avg({column}) OVER ()) / stddev_pop({column}) OVER (), 6) AS {column}"


def _flag(column: str, value: str) -> str:
    return f"""(coalesce({column} = '{value}', false))::INTEGER::DOUBLE AS "{column}={value}\""""


PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
STAMP = "strftime({c}, '%Y-%m-%d %H:%M:%S')"
CSV_LINES = f"""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
    {STAMP.format(c='l_shipdate')} AS l_shipdate FROM lineitem"""

ORACLE: dict[str, str] = {
    # calendar, scalar and text functions
    "calendar_features": """WITH p AS (SELECT event_id, value, (isodow(ts) - 1 < 5)::INTEGER AS workingday,
            hour(ts)::INTEGER AS hour, (isodow(ts) - 1)::INTEGER AS day_of_week, month(ts)::INTEGER AS month,
            year(ts)::INTEGER AS year, day(ts)::INTEGER AS day FROM events)
        SELECT *, (hour * workingday)::INTEGER AS hour_workingday_interaction,
            round(sin(hour * (2 * pi() / 24)), 9) AS hour_sin, round(cos(hour * (2 * pi() / 24)), 9) AS hour_cos,
            round(sin(day_of_week * (2 * pi() / 7)), 9) AS day_of_week_sin,
            round(cos(day_of_week * (2 * pi() / 7)), 9) AS day_of_week_cos,
            round(sin((month - 1) * (2 * pi() / 12)), 9) AS month_sin,
            round(cos((month - 1) * (2 * pi() / 12)), 9) AS month_cos FROM p""",
    "cyclic_encoding": """SELECT o_orderkey, round(sin((month(o_orderdate) - 1) * (2 * pi() / 12)), 9) AS month_sin,
            round(cos((month(o_orderdate) - 1) * (2 * pi() / 12)), 9) AS month_cos,
            round(sin((isodow(o_orderdate) - 1) * (2 * pi() / 7)), 9) AS week_sin,
            round(cos((isodow(o_orderdate) - 1) * (2 * pi() / 7)), 9) AS week_cos FROM orders""",
    "parse_timestamps": """SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, day(o_orderdate)::INTEGER AS day,
            CASE WHEN o_orderkey % 5 <> 0 THEN month(o_orderdate)::INTEGER END AS lenient_month,
            CASE WHEN o_orderkey % 5 <> 0 THEN hour(o_orderdate)::INTEGER END AS lenient_hour FROM orders""",
    "log_roundtrip": f"""SELECT {LINE_KEY}, l_extendedprice, round(ln(l_extendedprice), 6) AS log,
            round(ln(1 + l_extendedprice), 6) AS log1p, round(exp(ln(l_extendedprice)), 3) AS exp,
            round(exp(ln(1 + l_extendedprice)) - 1, 3) AS expm1, round(sqrt(l_extendedprice), 6) AS root
        FROM lineitem""",
    "string_suffix_length": """SELECT c_custkey, c_name || ' Test' AS name,
            length(c_name || ' Test')::INTEGER AS n_chars FROM customer""",
    "row_function": "SELECT doc_id, length(text)::BIGINT AS n FROM documents",
    "row_function_batches": """WITH p AS (SELECT doc_id, strip_accents(text || ' d\u00e9j\u00e0 na\u00efve \u00c5ngstr\u00f6m e\u0301') AS t FROM documents)
        SELECT doc_id, md5(t) AS digest, length(t)::BIGINT AS n_chars FROM p""",
    "strip_text_line_ends": r"""WITH p AS (SELECT doc_id, regexp_replace(
            replace(text, chr(10), ' ' || chr(9) || chr(10)) || '  ' || chr(13), '(?m)[ \t\r\f\v]+$', '', 'g') AS t
        FROM documents) SELECT doc_id, md5(t) AS digest, length(t)::BIGINT AS n_chars FROM p""",
    # column selection
    "select_by_dtype": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "select_by_dtype_exclude": "SELECT c_custkey, c_nationkey, c_acctbal FROM customer",
    "select_by_name": "SELECT p_partkey, p_name, p_retailprice FROM part",
    "select_by_cardinality": "SELECT p_partkey, p_type AS few, p_brand || '|' || p_name AS many FROM part",
    "select_by_exclusion": "SELECT p_partkey, p_name, p_size, p_retailprice FROM part",
    "select_by_position": "SELECT doc_id, toxic FROM labels",
    "drop_strict": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "drop_lenient": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "derive_columns": f"""SELECT {LINE_KEY}, l_quantity, l_extendedprice, l_discount,
            round(l_quantity * l_discount, 6) AS new_feat, round(l_extendedprice / 24, 6) AS unit FROM lineitem""",
    "overwrite_block": f"""SELECT {LINE_KEY}, round(l_discount * 100, 6) AS l_discount, round(l_tax * 100, 6) AS l_tax
        FROM lineitem""",
    "rename_columns": "SELECT p_partkey AS id, p_retailprice AS target FROM part",
    "features_and_target": """SELECT p_partkey, 'p_partkey,p_name,p_brand,p_type,p_size' AS features,
            p_retailprice AS target FROM part""",
    "null_indicator": f"""SELECT c_custkey, (c_acctbal IS NULL)::INTEGER AS no_balance,
            (c_mktsegment IS NULL)::INTEGER AS no_segment FROM {GAPS}""",
    "class_one_probability": f"SELECT doc_id, round(p_quality, 9) AS p FROM {SCORES}",
    "pick_matrix_columns": f"SELECT doc_id, round(p_quality, 9) AS quality, round(p_toxic, 9) AS toxic FROM {SCORES}",
    # joins and unions
    "join_inner_labels": """SELECT l_orderkey AS o_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
            l_extendedprice, l_discount, l_tax, o_orderstatus, o_totalprice, o_orderpriority
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "join_null_safe": """WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS custkey FROM orders),
            c AS (SELECT CASE WHEN c_custkey <> 0 THEN c_custkey END AS custkey, c_name FROM customer)
        SELECT o.o_orderkey, o.custkey, c.c_name FROM o JOIN c ON o.custkey IS NOT DISTINCT FROM c.custkey""",
    "lookup_map": """WITH f AS (SELECT l_orderkey, count(*)::DOUBLE / (SELECT count(*) FROM lineitem) AS f
            FROM lineitem GROUP BY 1)
        SELECT o_orderkey AS id, round(f, 12) AS share FROM orders LEFT JOIN f ON l_orderkey = o_orderkey""",
    "lookup_frequent_unknown": """WITH t AS (SELECT l_orderkey || '-' || l_linenumber AS line, count(*) / (SELECT count(*) FROM lineitem)::DOUBLE AS share
            FROM lineitem GROUP BY 1)
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, round(CASE WHEN l_linenumber < 4 THEN share END, 12) AS share
        FROM lineitem JOIN t ON t.line = l_orderkey || '-' || l_linenumber""",
    "frequency_encode_large": f"""WITH v AS ({LARGE}), t AS (SELECT * FROM v WHERE NOT test),
            a AS (SELECT line, count(*) / sum(count(*)) OVER ()::DOUBLE AS f FROM t GROUP BY 1),
            b AS (SELECT goods, count(*) / sum(count(*)) OVER ()::DOUBLE AS f FROM t GROUP BY 1),
            c AS (SELECT price, count(*) / sum(count(*)) OVER ()::DOUBLE AS f FROM t GROUP BY 1)
        SELECT id, round(a.f, 12) AS line, round(b.f, 12) AS goods, round(c.f, 12) AS price
        FROM v LEFT JOIN a USING (line) LEFT JOIN b USING (goods) LEFT JOIN c USING (price)""",
    "ordinal_encode_large": f"""WITH v AS ({LARGE})
        SELECT id, (dense_rank() OVER (ORDER BY line) - 1)::DOUBLE AS line, (dense_rank() OVER (ORDER BY goods) - 1)::DOUBLE AS goods,
            (dense_rank() OVER (ORDER BY price) - 1)::DOUBLE AS price FROM v""",
    "column_concat_keyed": """WITH s AS (SELECT l_partkey AS p_partkey, count(*) AS n_lines FROM lineitem GROUP BY 1)
        SELECT p_partkey, p_brand, n_lines FROM part FULL JOIN s USING (p_partkey)""",
    "stack_columns": f"SELECT doc_id, quality_guess AS label1, toxic_guess AS label2 FROM {SCORES}",
    "union_by_name": """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
        UNION ALL BY NAME SELECT s_name AS name, s_acctbal AS balance, s_suppkey AS id FROM supplier""",
    "stack_predictions": f"""SELECT doc_id, 'quality' AS target, quality_guess AS prediction FROM {SCORES}
        UNION ALL SELECT doc_id, 'toxic', toxic_guess FROM {SCORES}""",
    # aggregates
    "distinct_counts": f"""SELECT count(DISTINCT c_acctbal) AS c_acctbal, count(DISTINCT c_mktsegment) AS c_mktsegment,
            count(DISTINCT c_nationkey) AS c_nationkey FROM {GAPS}""",
    "relative_frequency": f"""SELECT c_mktsegment AS value, count(*) AS n,
            round(count(*)::DOUBLE / sum(count(*)) OVER (), 12) AS frequency
        FROM {GAPS} WHERE c_mktsegment IS NOT NULL GROUP BY 1""",
    "mean_and_deviation": _each(
        SCALED,
        "SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS deviation FROM lineitem",
    ),
    "median_per_column": _each(SCALED, "SELECT '{c}' AS feature, round(median({c}), 6) AS median FROM lineitem")
    + f" UNION ALL SELECT 'c_acctbal', round(median(c_acctbal), 6) FROM {GAPS}",
    "mode_per_column": _each(
        ["p_type", "p_brand", "p_name"],
        "SELECT * FROM (SELECT '{c}' AS feature, {c} AS mode FROM part GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)",
    )
    + f""" UNION ALL SELECT * FROM (SELECT 'c_mktsegment', c_mktsegment FROM {GAPS} WHERE c_mktsegment IS NOT NULL
        GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1)""",
    "sorted_categories": """SELECT o_orderpriority AS category, row_number() OVER (ORDER BY o_orderpriority) - 1 AS position
        FROM (SELECT DISTINCT o_orderpriority FROM orders)""",
    "class_prior": """SELECT quality, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 12) AS share,
            row_number() OVER (ORDER BY count(*) DESC, quality) = 1 AS majority FROM labels GROUP BY quality""",
    # metrics
    "metric_accuracy": f"SELECT round(avg((quality = quality_guess)::INTEGER::DOUBLE), 9) AS accuracy FROM {SCORES}",
    "metric_exact_match": f"""SELECT round(avg((quality = quality_guess AND toxic = toxic_guess)::INTEGER::DOUBLE), 9)
        AS accuracy FROM {SCORES}""",
    "metric_logloss": f"SELECT round(avg({_loss('quality', 'p_quality')}), 9) AS log_loss FROM {SCORES}",
    "metric_logloss_two": f"""SELECT round(avg({_loss('quality', 'p_quality')} + {_loss('toxic', 'p_toxic')}) / 2, 9)
        AS log_loss FROM {SCORES}""",
    "metric_logloss_indicator": f"""SELECT round(avg(-quality::DOUBLE * ln({_clip('p_quality')})
        - toxic::DOUBLE * ln({_clip('p_toxic')})), 9) AS log_loss FROM {SCORES}""",
    "metric_auc": _auc("score"),
    "metric_auc_ties": _auc("l_quantity"),
    "metric_rmse": f"SELECT round(sqrt(avg((l_extendedprice - guess) ** 2)), 6) AS rmse FROM {LINES}",
    "metric_msle": f"SELECT round(avg((ln(1 + l_extendedprice) - ln(1 + guess)) ** 2), 9) AS msle FROM {LINES}",
    "metric_rmsle": f"SELECT round(sqrt(avg((ln(1 + l_extendedprice) - ln(1 + guess)) ** 2)), 9) AS rmsle FROM {LINES}",
    # splits
    "split_hash": f"SELECT o_orderkey, o_totalprice, {_side('o_orderkey')} FROM orders",
    "split_exact": """WITH h AS (SELECT o_orderkey, o_totalprice,
            row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR || '_42'), o_orderkey) AS r, count(*) OVER () AS n FROM orders)
        SELECT o_orderkey, o_totalprice, CASE WHEN r <= ceil(0.2::DOUBLE * n) THEN 'test' ELSE 'train' END AS side FROM h""",
    "split_by_group": f"SELECT {LINE_KEY}, {_side('l_orderkey', 0)} FROM lineitem",
    # fitted preprocessing
    "standard_scale": f"SELECT {LINE_KEY}, {', '.join(_zscore(c) for c in SCALED)} FROM lineitem",
    "standard_scale_train_only": f"""WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d
            FROM orders WHERE NOT {_test('o_orderkey')})
        SELECT o_orderkey, round((o_totalprice - m) / d, 6) AS o_totalprice FROM orders, s""",
    "impute_median": f"""SELECT c_custkey, round(coalesce(c_acctbal, (SELECT median(c_acctbal) FROM {GAPS})), 6) AS c_acctbal
        FROM {GAPS}""",
    "impute_mode": f"""WITH m AS (SELECT c_mktsegment AS v FROM {GAPS} WHERE c_mktsegment IS NOT NULL
            GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT c_custkey, coalesce(c_mktsegment, v) AS c_mktsegment FROM {GAPS}, m""",
    "fill_numbers": f"""SELECT c_custkey, (c_acctbal IS NULL)::INTEGER AS c_acctbal_missing,
            round(coalesce(c_acctbal, (SELECT median(c_acctbal) FROM {GAPS})), 6) AS c_acctbal FROM {GAPS}""",
    "ordinal_encode": """SELECT o_orderkey, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::DOUBLE AS o_orderpriority,
            (dense_rank() OVER (ORDER BY o_orderstatus) - 1)::DOUBLE AS o_orderstatus FROM orders""",
    "ordinal_encode_numbers": """SELECT p_partkey, (dense_rank() OVER (ORDER BY p_size) - 1)::DOUBLE AS p_size,
            (dense_rank() OVER (ORDER BY p_retailprice) - 1)::DOUBLE AS price FROM part""",
    "one_hot": f"SELECT p_partkey, {', '.join(_flag('p_type', v) for v in PART_TYPES)} FROM part",
    "one_hot_missing": f"""SELECT c_custkey, {', '.join(_flag('c_mktsegment', v) for v in SEGMENTS)},
            (c_mktsegment IS NULL)::INTEGER::DOUBLE AS "c_mktsegment=NULL" FROM {GAPS}""",
    "one_hot_unknown": f"""SELECT o_orderkey, {_flag('state', 'F')}, {_flag('state', 'O')}
        FROM (SELECT o_orderkey, o_orderstatus AS state FROM orders)""",
    "one_hot_sparse": """SELECT p_partkey, (SELECT count(DISTINCT p_name) FROM part)::INTEGER AS width,
            dense_rank() OVER (ORDER BY p_name) - 1 AS position FROM part""",
    "frequency_encode": """SELECT p_partkey, round(count(*) OVER (PARTITION BY p_brand)::DOUBLE / count(*) OVER (), 12) AS p_brand,
            round(count(*) OVER (PARTITION BY p_name)::DOUBLE / count(*) OVER (), 12) AS p_name FROM part""",
    "frequency_encode_train_only": f"""WITH t AS (SELECT * FROM orders WHERE NOT {_test('o_orderkey')}),
            f AS (SELECT o_custkey, count(*)::DOUBLE / (SELECT count(*) FROM t) AS f FROM t GROUP BY 1)
        SELECT o_orderkey, round(f, 12) AS o_custkey FROM orders LEFT JOIN f USING (o_custkey)""",
    "encode_routed": f"""SELECT p_partkey, {', '.join(_flag('p_type', v) for v in PART_TYPES)},
            round(count(*) OVER (PARTITION BY p_brand)::DOUBLE / count(*) OVER (), 12) AS p_brand,
            round(count(*) OVER (PARTITION BY p_name)::DOUBLE / count(*) OVER (), 12) AS p_name FROM part""",
    "encode_mixed": f"""SELECT p_partkey, {', '.join(_flag('p_type', v) for v in PART_TYPES)}, {_zscore('p_retailprice')},
            (dense_rank() OVER (ORDER BY p_size) - 1)::DOUBLE AS p_size,
            round(count(*) OVER (PARTITION BY p_brand)::DOUBLE / count(*) OVER (), 6) AS p_brand FROM part""",
    "function_stage": f"""SELECT {LINE_KEY}, l_quantity, l_discount, {_zscore('new_feat')}
        FROM (SELECT *, l_quantity * l_discount AS new_feat FROM lineitem)""",
    "feature_vector": """SELECT p_partkey, 2::INTEGER AS width, p_size::DOUBLE AS first, p_retailprice AS second FROM part""",
    # sources and sinks
    "csv_roundtrip": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
            strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders""",
    "csv_inferred": """SELECT p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size, p_retailprice,
            'p_partkey:bigint,p_name:string,p_brand:string,p_type:string,p_size:bigint,p_retailprice:double' AS types
        FROM part""",
    "csv_missing_markers": "SELECT c_custkey, CASE WHEN c_custkey % 7 > 2 THEN c_acctbal END AS c_acctbal FROM customer",
    "csv_typed": CSV_LINES,
    "csv_multifile": CSV_LINES,
    "csv_mixed_headers": CSV_LINES,
    "csv_rebind": f"""SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity,
            ({_test('l_orderkey', cut='80000000')})::INTEGER AS binding FROM lineitem GROUP BY l_returnflag, binding""",
    "csv_text_with_line_ends": "SELECT doc_id, md5(text) AS digest FROM documents",
    "csv_text_split": "SELECT doc_id, md5(text) AS digest, n_chars FROM documents",
    "submission_csv": f"SELECT doc_id, quality_guess AS quality FROM {SCORES}",
    "preview_sample": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100",
    "preview_file_sample": """SELECT * FROM (SELECT c_custkey AS id, c_name AS name FROM customer
            UNION ALL SELECT n_nationkey::BIGINT, n_name FROM nation UNION ALL SELECT p_partkey, p_name FROM part)
        ORDER BY id, name LIMIT 100""",
    "synthetic_table": f"""SELECT o_orderkey AS id, {_normal('o_orderkey', 'feat1', '10')} AS feat1,
            {_normal('o_orderkey', 'feat2', '5')} AS feat2,
            floor({_uniform('o_orderkey', 'feat3', '100')})::BIGINT AS feat3,
            round({_uniform('o_orderkey', 'feat4', '50')}, 6) AS feat4,
            floor({_uniform('o_orderkey', 'label', '2')})::BIGINT AS label FROM orders""",
    # learner surface
    "prior_baseline": f"""WITH t AS (SELECT avg(quality::DOUBLE) AS share FROM labels JOIN documents USING (doc_id)
            WHERE NOT {_test('doc_id')})
        SELECT doc_id, (share > 0.5)::INTEGER AS quality_prediction, round(share, 12) AS quality_probability
        FROM labels JOIN documents USING (doc_id), t""",
    "raw_or_marked_input": """SELECT c_custkey, length(c_name || ' Test')::INTEGER AS raw_length,
            length(c_name)::INTEGER AS marked_length FROM customer""",
    "name_baseline": """WITH t AS (SELECT avg((c_acctbal > 2000)::INTEGER::DOUBLE) AS share FROM customer)
        SELECT c_custkey, (share > 0.5)::INTEGER AS label_prediction, round(share, 12) AS label_probability
        FROM customer, t""",
    "observe_tap": "SELECT count(*) AS n, sum(length(c_name))::BIGINT AS chars FROM customer",
    "eval_rebind": """WITH u AS (SELECT c_custkey AS id, (c_acctbal > 0)::INTEGER AS label, 'customer' AS input FROM customer
            UNION ALL SELECT s_suppkey, (s_acctbal > 5000)::INTEGER, 'supplier' FROM supplier)
        SELECT id, label, (avg(label::DOUBLE) OVER (PARTITION BY input) > 0.5)::INTEGER AS label_prediction, input FROM u""",
    # models: the right prediction of every unlabelled row
    "fit_predict_forest": """SELECT l_orderkey AS o_orderkey, l_linenumber, l_partkey, l_suppkey,
            CASE WHEN l_orderkey % 7 < 2 THEN 'tiles' WHEN l_orderkey % 7 < 5 THEN 'carpet' ELSE 'wood' END AS surface
        FROM lineitem WHERE l_orderkey % 5 = 0""",
    "fit_predict_forest_score": "SELECT 1::DOUBLE AS accuracy",
    "fit_predict_regression": """SELECT event_id, (CASE WHEN isodow(ts) < 6 THEN 120 ELSE 35 END
            + CASE WHEN hour(ts) < 12 THEN 0 ELSE 400 END)::DOUBLE AS value FROM events WHERE event_id % 5 = 0""",
    "fit_predict_gbt": """SELECT doc_id, (lang = 'en')::INTEGER::DOUBLE AS quality
        FROM labels JOIN documents USING (doc_id) WHERE doc_id % 5 = 0""",
    "fit_predict_boosted_regression": """SELECT p_partkey,
            (CASE WHEN p_type = 'ECONOMY' THEN 100 ELSE 250 END * (1 + p_size % 4))::DOUBLE AS price
        FROM part WHERE p_partkey % 5 = 0""",
    "two_target_learner": """SELECT doc_id, (lang = 'en')::INTEGER::DOUBLE AS quality, (lang IN ('de', 'fr'))::INTEGER::DOUBLE AS toxic
        FROM labels JOIN documents USING (doc_id) WHERE doc_id % 5 = 0""",
    "two_target_forest": f"""WITH t AS (SELECT o_orderkey AS id, floor({_uniform('o_orderkey', 'feat3', '100')})::BIGINT % 10 AS f FROM orders)
        SELECT id, (f >= 4)::INTEGER AS label1, (f < 7)::INTEGER AS label2 FROM t WHERE id % 5 = 0""",
    "one_target_forest": f"""WITH t AS (SELECT o_orderkey AS id, floor({_uniform('o_orderkey', 'feat3', '100')})::BIGINT % 10 AS f FROM orders)
        SELECT id, (f >= 4)::INTEGER AS label FROM t WHERE id % 5 = 0""",
    "learner_reload": """WITH t AS (SELECT doc_id, (lang = 'en')::INTEGER AS q, (lang IN ('de', 'fr'))::INTEGER AS t
            FROM labels JOIN documents USING (doc_id))
        SELECT doc_id, q AS quality, t AS toxic, q AS quality_prediction, q::DOUBLE AS quality_probability,
            t AS toxic_prediction, t::DOUBLE AS toxic_probability FROM t""",
    "model_sees_the_marked_table": """SELECT p_partkey, (length(p_name) + 5 > 15)::INTEGER AS label_prediction, input
        FROM part, (VALUES ('raw'), ('marked')) AS i(input) WHERE p_partkey % 5 = 0""",
    "learner_reload_raw": """SELECT p_partkey, (length(p_name) + 5 > 15)::INTEGER AS label_prediction
        FROM part WHERE p_partkey % 5 = 0""",
    "named_inputs_join": """SELECT o_orderkey, CASE WHEN c_nationkey < 8 THEN 'tiles' WHEN c_nationkey < 16 THEN 'carpet' ELSE 'wood' END AS surface_prediction
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 5 = 0""",
    "named_inputs_files": "SELECT o_orderkey, (o_orderkey % 7 < 3)::INTEGER AS early_prediction FROM orders WHERE o_orderkey % 5 = 0",
    "named_inputs_preview": """WITH t AS (SELECT o_orderkey, (o_orderkey % 7 < 3)::INTEGER AS early FROM orders
            WHERE o_orderkey % 5 <> 0 AND o_orderkey % 4 < 3 ORDER BY o_orderkey LIMIT 50)
        SELECT o_orderkey, early, (SELECT (avg(early) > 0.5)::INTEGER FROM t) AS early_prediction FROM t""",
    "target_of_its_own": "SELECT p_partkey, (p_size % 10 < 4)::INTEGER AS grade_prediction FROM part WHERE p_partkey % 5 = 0",
    "column_concat_exact": f"SELECT {LINE_KEY}, max(l_quantity) AS l_quantity, max(l_tax) AS l_tax FROM lineitem GROUP BY ALL",
    "many_text_classes": """WITH t AS (SELECT 'kind-' || lpad((o_orderkey % 600)::VARCHAR, 3, '0') AS kind FROM orders),
            best AS (SELECT kind FROM t GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1)
        SELECT o_orderkey, best.kind AS kind_prediction FROM orders, best""",
    "prior_of_any_numbers": """WITH t AS (SELECT (o_orderkey % 5) * 0.75::DOUBLE - 1.5::DOUBLE AS label FROM orders),
            best AS (SELECT label FROM t GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
        SELECT o_orderkey, best.label AS label_prediction, 5 AS classes, 1::DOUBLE AS total FROM orders, best""",
    "one_hot_wide": """WITH t AS (SELECT DISTINCT o_orderkey % 700 AS v FROM orders WHERE o_orderkey % 11 <> 0),
            r AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS slot FROM t)
        SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN slot ELSE -1 END::INTEGER AS slot,
            (o_orderkey % 11 <> 0)::INTEGER AS n_ones FROM orders LEFT JOIN r ON v = o_orderkey % 700""",
    "split_exact_groups": f"""WITH h AS (SELECT {LINE_KEY}, md5(l_orderkey::VARCHAR || '_42') AS h FROM lineitem),
            r AS (SELECT h, row_number() OVER (ORDER BY h) AS r, count(*) OVER () AS n FROM h),
            cut AS (SELECT min(h) AS c FROM r WHERE r >= ceil(0.2::DOUBLE * n))
        SELECT {LINE_KEY}, CASE WHEN h <= c THEN 'test' ELSE 'train' END AS side FROM h, cut""",
    "metric_skip_missing": """SELECT avg((o_orderkey % 2 = (o_orderkey % 4) / 2.0 % 2)::INTEGER::DOUBLE) AS accuracy, count(*) AS n
        FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 7 <> 0""",
}
