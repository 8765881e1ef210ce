"""Scores of predictions, as one-row tables.

All but the AUC are a single aggregate with a constant-size state. The rank-based
AUC groups equal scores first and cumulates counts slice by slice. A missing label or
prediction, NULL or NaN, fails every metric unless it is told to skip and count.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .columns import present, quoted
from .stats import _running

# Fixed value: probabilities are clipped to [EPSILON, 1 - EPSILON] before the logarithm.
EPSILON = 2.220446049250313e-16


def _known(df: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [present(df, n).isNotNull() for n in names])


def _mean(df: DataFrame, names: Sequence[str], value: Column, out: str, missing: str, last: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """The mean of a row value, where all named columns must be there.

    A missing label or prediction fails the metric. With ``missing="skip"`` such rows are
    left out, and ``n`` tells how many were used.
    """
    known = _known(df, names)
    if missing == "skip":
        used = F.when(known, value)
        return df.agg(last(F.avg(used)).alias(out), F.count(F.when(known, 1)).alias("n"))
    if missing != "fail":
        raise ValueError(f"unknown handling of missing values: {missing}")
    failure = F.raise_error(F.lit(f"missing label or prediction in one of {list(names)}"))
    return df.agg(last(F.avg(F.when(known, value).otherwise(failure))).alias(out))


def accuracy(df: DataFrame, label: str, prediction: str, out: str = "accuracy", missing: str = "fail") -> DataFrame:
    hit = (quoted(label) == quoted(prediction)).cast("double")
    return _mean(df, [label, prediction], hit, out, missing)


def exact_match(df: DataFrame, pairs: Mapping[str, str], out: str = "accuracy", missing: str = "fail") -> DataFrame:
    """Share of rows where every label equals its prediction."""
    hit = reduce(lambda a, b: a & b, [quoted(y) == quoted(p) for y, p in pairs.items()])
    return _mean(df, [*pairs, *pairs.values()], hit.cast("double"), out, missing)


def _probability(df: DataFrame, name: str) -> Column:
    if not isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        raise TypeError(f"{name} is not a probability column; score the probability output, not the label")
    p = quoted(name).cast("double")
    failure = F.raise_error(F.concat(F.lit(f"{name}: not a probability: "), p.cast("string")))
    p = F.when(p.isNull() | p.between(0.0, 1.0), p).otherwise(failure)
    return F.greatest(F.least(p, F.lit(1.0 - EPSILON)), F.lit(EPSILON))


def _binary(name: str) -> Column:
    """A 0/1 label as a number; any other label fails."""
    y = quoted(name).cast("double")
    failure = F.raise_error(F.concat(F.lit(f"{name}: not a 0/1 label: "), y.cast("string")))
    return F.when(y.isNull() | y.isin(0.0, 1.0), y).otherwise(failure)


def _row_loss(df: DataFrame, label: str, probability: str) -> Column:
    y, p = _binary(label), _probability(df, probability)
    return -(y * F.ln(p) + (1.0 - y) * F.ln(1.0 - p))


def log_loss(df: DataFrame, label: str, probability: str, out: str = "log_loss", missing: str = "fail") -> DataFrame:
    """Binary log loss of a 0/1 label and its class-1 probability."""
    return _mean(df, [label, probability], _row_loss(df, label, probability), out, missing)


def log_loss_targets(
    df: DataFrame, pairs: Mapping[str, str], mode: str = "per_target", out: str = "log_loss", missing: str = "fail"
) -> DataFrame:
    """Log loss over several 0/1 targets.

    ``per_target`` is the mean of the binary losses. ``indicator`` reads the targets
    as one indicator matrix and sums -y ln(p) over the row.
    """
    if mode == "per_target":
        terms = [_row_loss(df, y, p) for y, p in pairs.items()]
        scale = 1.0 / len(terms)
    elif mode == "indicator":
        terms = [-(_binary(y) * F.ln(_probability(df, p))) for y, p in pairs.items()]
        scale = 1.0
    else:
        raise ValueError(f"unknown mode: {mode}")
    return _mean(df, [*pairs, *pairs.values()], reduce(lambda a, b: a + b, terms), out, missing, lambda c: c * F.lit(scale))


def roc_auc(df: DataFrame, label: str, score: str, out: str = "auc", missing: str = "fail") -> DataFrame:
    """Area under the ROC curve; equal scores count half.

    Rows collapse to one per distinct score, with combining before the shuffle, so a
    score shared by many rows is a single row from there on.
    """
    known = _known(df, [label, score])
    rows = df.select(_binary(label).alias("y"), quoted(score).alias("score"), known.alias("known"))
    if missing == "skip":
        rows = rows.where("known")
    elif missing == "fail":
        failure = F.raise_error(F.lit(f"missing label or prediction in one of {[label, score]}"))
        rows = rows.withColumn("y", F.when(F.col("known"), F.col("y")).otherwise(failure))
    else:
        raise ValueError(f"unknown handling of missing values: {missing}")
    y = F.col("y").cast("bigint")
    by_score = materialise(rows.groupBy("score").agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")), "scores")
    ranked = _running(by_score, ["score"], "neg", "upto", [], by_score.count())
    pos, neg, upto = (F.col(c).cast("double") for c in ("pos", "neg", "upto"))
    won = F.sum(pos * (upto - neg / 2.0))
    result = [F.try_divide(won, F.sum(pos) * F.sum(neg)).alias(out)]
    if missing == "skip":
        result.append(F.coalesce(F.sum(F.col("pos") + F.col("neg")), F.lit(0)).cast("bigint").alias("n"))
    return ranked.agg(*result)


def rmse(df: DataFrame, label: str, prediction: str, out: str = "rmse", missing: str = "fail") -> DataFrame:
    gap = quoted(label).cast("double") - quoted(prediction).cast("double")
    return _mean(df, [label, prediction], gap * gap, out, missing, F.sqrt)


def _log1p_nonnegative(name: str) -> Column:
    x = quoted(name).cast("double")
    failure = F.raise_error(F.concat(F.lit(f"{name}: negative value: "), x.cast("string")))
    return F.when(x.isNull() | (x >= 0), F.log1p(x)).otherwise(failure)


def msle(df: DataFrame, label: str, prediction: str, out: str = "msle", missing: str = "fail") -> DataFrame:
    """Mean squared difference of log1p; negative values are refused."""
    gap = _log1p_nonnegative(label) - _log1p_nonnegative(prediction)
    return _mean(df, [label, prediction], gap * gap, out, missing)


def rmsle(df: DataFrame, label: str, prediction: str, out: str = "rmsle", missing: str = "fail") -> DataFrame:
    gap = _log1p_nonnegative(label) - _log1p_nonnegative(prediction)
    return _mean(df, [label, prediction], gap * gap, out, missing, F.sqrt)


def side_by_side(metrics: Sequence[DataFrame]) -> dict[str, float]:
    """Collect several one-row metric tables into a dict."""
    return {name: value for m in metrics for name, value in m.first().asDict().items()}
