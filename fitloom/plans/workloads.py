"""Complete jobs: join or read, make features, split, fit, score, write.

Each function takes the training table (and a table to predict, if any) and returns the
fitted learner, its validation score and the prediction table. None collects rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import interaction, parse_timestamp, text_length, with_calendar
from ..functions.scalars import checked_ln
from ..operators import metrics
from ..operators.columns import columns_containing, columns_except, columns_of_type, derive, drop_columns
from ..operators.combine import inner_join
from ..operators.encode import (
    FillNumbers,
    FunctionStage,
    MedianImpute,
    ModeImpute,
    OneHotEncode,
    OrdinalEncode,
    RoutedEncode,
    StandardScale,
    column_groups,
)
from .inputs import PathsInput, SchemaInput, TableInput, read_files
from .learner import FeaturePlan, FittedLearner, Raw
from .models import PriorClassifier, boosted_classifier, boosted_regressor, forest_classifier


@dataclass(frozen=True)
class Outcome:
    learner: FittedLearner
    scored: DataFrame
    score: DataFrame
    submission: DataFrame | None = None


def run(
    plan: FeaturePlan,
    train: Raw,
    test: Raw | None,
    metric: Callable[[DataFrame], DataFrame],
    output: str = "prediction",
    seed: int = 42,
    fraction: float = 0.2,
    by: str | Sequence[str] | None = None,
    exact: bool = False,
    fit_scope: str = "train",
    submission_key: str | Sequence[str] | None = None,
) -> Outcome:
    """Split, fit on the training part, score the rest, and predict ``test``.

    ``by`` splits by group instead of by row; ``fit_scope="all"`` fits the stages, but
    never the models, on training and validation rows together.
    """
    if fit_scope not in ("train", "all"):
        raise ValueError(f"unknown fit scope: {fit_scope}")
    parts = plan.split(train, fraction, seed, by, exact)
    everything = plan.at_mark(train) if fit_scope == "all" else None
    learner = plan.make_learner().fit(features=parts.train, stage_rows=everything)
    scored = learner.predict(features=parts.test, output="both" if output == "probability" else output)
    submission = None
    if test is not None:
        submission = learner.submission(learner.predict(raw=test, output=output), output, key=submission_key)
    return Outcome(learner, scored, metric(scored), submission)


def numeric_features(df: DataFrame, but: Sequence[str]) -> list[str]:
    return [c for c in columns_of_type(df, include="number") if c not in set(but)]


@dataclass(frozen=True)
class JoinLabels:
    """Measurements with the label of their series; as they are where no labels are bound."""

    on: str
    spread_by: Sequence[str]

    def __call__(self, measurements: DataFrame, labels: DataFrame | None) -> DataFrame:
        return measurements if labels is None else inner_join(measurements, labels, self.on, spread_by=self.spread_by)


def robot_surface(
    measurements: DataFrame,
    labels: DataFrame,
    test: DataFrame | None = None,
    model: Estimator | None = None,
    key: str | Sequence[str] = "row_id",
    on: str = "series_id",
    target: str = "surface",
    drop: Sequence[str] = ("measurement_number", "group_id"),
    **options,
) -> Outcome:
    """Join sensor rows with the label of their series, scale, and classify with a forest.

    Both tables are inputs of the plan and the join is its first step; only measurements are
    bound to predict. Predictions stay one per measurement, beside the row key and the series.
    """
    keys = [key] if isinstance(key, str) else list(key)
    numbers = [c for t in (measurements, labels) for c in numeric_features(t, [*keys, on, target, *drop])]
    plan = FeaturePlan(
        key=key,
        target=target,
        model=model or forest_classifier(),
        drop=drop,
        keep=[] if on in keys else [on],
        stages=[StandardScale(inputCols=numbers)],
        inputs=[TableInput("measurements", [*keys, on]), TableInput("labels", [on, target], fit_only=True)],
        prepare=JoinLabels(on, tuple(keys)),
    )
    train = {"measurements": measurements, "labels": labels}
    test = None if test is None else {"measurements": test}
    return run(plan, train, test, lambda s: metrics.accuracy(s, target, f"{target}_prediction"), **options)


def bike_features(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """Calendar and cyclic features; the counts that make up the target are dropped if present."""
    if df.schema[ts].dataType.simpleString() == "string":
        df = df.withColumn("_ts", parse_timestamp(ts))
    else:
        df = df.withColumn("_ts", F.col(ts))
    return drop_columns(with_calendar(df, "_ts"), ["_ts", "casual", "registered"], missing_ok=True)


@dataclass(frozen=True)
class BikeFeatures:
    ts: str

    def __call__(self, df: DataFrame) -> DataFrame:
        return bike_features(df, self.ts)


def bike_demand(
    train: DataFrame, test: DataFrame | None = None, model: Estimator | None = None, key: str = "datetime",
    ts: str = "datetime", target: str = "count", **options,
) -> Outcome:
    """Boosted regression on log1p of the count, scored on the raw scale by RMSLE."""
    plan = FeaturePlan(
        key=key,
        target=target,
        model=model or boosted_regressor(rounds=100, rate=0.05),
        prepare=BikeFeatures(ts),
        keep=[] if ts == key else [ts],
        target_transform="log1p",
    )
    return run(plan, train, test, lambda s: metrics.rmsle(s, target, f"{target}_prediction"), **options)


def categorical_target(
    train: DataFrame, test: DataFrame | None = None, model: Estimator | None = None, key: str = "id",
    target: str = "target", ordinal: Sequence[str] | None = None, nominal: Sequence[str] | None = None, **options,
) -> Outcome:
    """Ordinal codes for binary and ordered columns, routed encoding for nominal ones, AUC.

    The encoders are fitted on all labelled rows, so a category that only validation rows
    have is known.
    """
    features = drop_columns(train, [key, target])
    if ordinal is None:
        ordinal = columns_containing(features, "bin") + columns_containing(features, "ord")
    if nominal is None:
        nominal = columns_containing(features, "nom")
    plan = FeaturePlan(
        key=key,
        target=target,
        model=model or boosted_classifier(),
        stages=[
            OrdinalEncode(inputCols=list(ordinal), unknown="error", spreadBy=[key]),
            RoutedEncode(inputCols=list(nominal), output="vector", spreadBy=[key]),
            FillNumbers(exclude=[key, target, f"_label_{target}"]),
        ],
    )
    settings = {"seed": 0, "exact": True, "fit_scope": "all", "output": "probability"} | options
    return run(plan, train, test, lambda s: metrics.roc_auc(s, target, f"{target}_probability"), **settings)


def house_prices(
    train: DataFrame, test: DataFrame | None = None, model: Estimator | None = None, key: str = "Id",
    target: str = "SalePrice", **options,
) -> Outcome:
    """Median for numbers, mode and one-hot for text, boosted regression on the log price, RMSE of logs."""
    numbers = numeric_features(train, [key, target])
    texts = columns_of_type(drop_columns(train, [key, target]), include="object")
    groups = [
        ("num", [MedianImpute(inputCols=numbers)], numbers),
        ("cat", [ModeImpute(inputCols=texts), OneHotEncode(inputCols=texts, output="vector")], texts),
    ]
    plan = FeaturePlan(
        key=key,
        target=target,
        model=model or boosted_regressor(maxDepth=HOUSE_DEPTH),
        stages=column_groups([g for g in groups if g[2]], keep=[key, target, f"_label_{target}"]),
        target_transform="log",
    )

    def rmse_of_logs(scored: DataFrame) -> DataFrame:
        logs = derive(scored, {"y": checked_ln(target), "p": checked_ln(f"{target}_prediction")})
        return metrics.rmse(logs, "y", "p")

    return run(plan, train, test, rmse_of_logs, **({"seed": 0, "exact": True} | options))


# Fixed value: tree depth of the house price model.
HOUSE_DEPTH = 3

# Columns of the game table that are no features.
GAME_COLUMNS = ("game_num", "event_id", "event_time", "player_scoring_next", "team_scoring_next")
GAME_TARGETS = ("team_A_scoring_within_10sec", "team_B_scoring_within_10sec")


def game_events(
    train: Raw, test: Raw | None = None, model: Estimator | None = None,
    key: str | Sequence[str] = "id", targets: Sequence[str] = GAME_TARGETS, drop: Sequence[str] = GAME_COLUMNS,
    stages: Sequence[Estimator | Transformer] = (), mode: str = "per_target", **options,
) -> Outcome:
    """Two boosted classifiers over one shared feature matrix, scored by log loss.

    ``train`` and ``test`` are tables, or bindings of ``file_names`` and ``schema``: the files
    are then read within the plan. ``stages`` come before the completion of missing numbers,
    for columns that are text.
    """
    files = not isinstance(train, DataFrame)
    keys = [key] if isinstance(key, str) else list(key)
    fill = FillNumbers(exclude=[*keys, *targets, *[f"_label_{t}" for t in targets]])
    plan = FeaturePlan(
        key=key,
        target=targets,
        model=model or boosted_classifier(),
        stages=[*stages, fill],
        drop=[d for d in drop if d not in keys],
        inputs=[PathsInput("file_names"), SchemaInput("schema")] if files else [],
        prepare=read_files if files else None,
    )
    pairs = {t: f"{t}_probability" for t in targets}
    return run(
        plan, train, test, lambda s: metrics.log_loss_targets(s, pairs, mode), output="probability", **options
    )


def one_target_features(df: DataFrame) -> DataFrame:
    """An interaction column; its first factor and one other column are no features."""
    return drop_columns(derive(df, {"new_feat": interaction("feat1", "feat2")}), ["feat1", "feat3"])


def one_target(train: DataFrame, test: DataFrame | None = None, model: Estimator | None = None, **options) -> Outcome:
    """Interaction, scaling and a forest, scored by accuracy."""
    plan = FeaturePlan(
        key="id",
        target="label",
        model=model or forest_classifier(),
        stages=[
            FunctionStage.of(one_target_features),
            StandardScale(inputCols=["feat2", "feat4", "feat5", "new_feat"]),
        ],
    )
    return run(plan, train, test, lambda s: metrics.accuracy(s, "label", "label_prediction"), **options)


def two_targets(
    train: DataFrame, test: DataFrame | None = None, model: Estimator | None = None,
    targets: Sequence[str] = ("label1", "label2"), output: str = "prediction", **options,
) -> Outcome:
    """Two forests over one scaled matrix: both labels right, or log loss of the probabilities."""
    numbers = columns_except(train, ["id", *targets])
    plan = FeaturePlan(
        key="id", target=targets, model=model or forest_classifier(), stages=[StandardScale(inputCols=numbers)]
    )
    pairs = {t: f"{t}_{output}" for t in targets}
    metric = metrics.exact_match if output == "prediction" else metrics.log_loss_targets
    return run(plan, train, test, lambda s: metric(s, pairs), output=output, **options)


def name_length_features(df: DataFrame) -> DataFrame:
    return derive(df, {"Names": text_length("Names")})


def name_baseline(key: str, prepare: Callable[[DataFrame], DataFrame], target: str = "label") -> FeaturePlan:
    """Length of a name as the only feature of the prior baseline.

    ``prepare`` belongs to the raw input only; a table handed in at the mark skips it.
    """
    return FeaturePlan(
        key=key, target=target, model=PriorClassifier(), prepare=prepare,
        stages=[FunctionStage.of(name_length_features)],
    )
