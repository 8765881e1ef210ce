"""A whole table-to-prediction job as one learner.

``FeaturePlan`` states, once, how a raw table becomes features and what is predicted.
``prepare`` runs before the feature mark: it is repeated for raw input only. Raw input is one
table, or a binding of the plan's named ``inputs``: the joins and reads that make one table of
several sources are then steps of the plan, replayed by every fit and predict. ``stages``
come after the mark: they are fitted on training rows and replayed on every table.
The plan is a thin layer over ``pyspark.ml.Pipeline``; all tables stay lazy DataFrames.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import checked_ln, checked_log1p
from ..operators.columns import drop_columns, quoted
from ..operators.combine import concat_columns
from ..operators.encode import FeatureVector, sorted_categories
from ..operators.split import Split, exact_split, hash_split
from ..session import materialise, shared_dir
from ..sources.csv_files import submission
from ..sources.preview import preview
from .inputs import Input, Steps, check_inputs, described, previewed_binding, restored, table_at_mark

Raw = DataFrame | Mapping[str, object]

# Target transforms and the SQL name of their inverses.
TARGET_TRANSFORMS: dict[str, tuple[Callable[[Column], Column], str]] = {
    "log1p": (checked_log1p, "expm1"),
    "log": (checked_ln, "exp"),
}
SPLIT_SEED = 42
MODELS_AT_ONCE = 4
# What one piece of a training matrix may take in a task's memory, and what a plain row takes.
PIECE_BYTES = 128 << 20
PLAIN_ROW_BYTES = 67


def _names(value: str | Sequence[str]) -> tuple[str, ...]:
    return (value,) if isinstance(value, str) else tuple(value)


def tap(df: DataFrame, name: str, *expressions: Column) -> tuple[DataFrame, Observation]:
    """Watch a table while a later action runs over it; adds no job and moves no rows."""
    seen = Observation(name)
    return df.observe(seen, *expressions), seen


def column_function(fn: Callable, returns: str) -> Callable[..., Column]:
    """A Python function over pandas Series as a column function, run in Arrow batches.

    Only for work that has no built-in expression.
    """
    return F.pandas_udf(fn, returns)


@dataclass(frozen=True)
class FeaturePlan:
    """What identifies a row, what is predicted, and how features are made.

    ``drop`` lists columns that are no features and may be absent from new tables;
    ``keep`` lists columns that are no features but stay beside the predictions. Every
    other numeric or vector column that the stages leave becomes a feature.

    ``inputs`` names several sources; ``prepare`` is then a function of them by name, or an
    ordered mapping of such functions, each of which may also take earlier ones' results.
    """

    key: str | Sequence[str]
    target: str | Sequence[str]
    model: Estimator | Mapping[str, Estimator]
    prepare: Steps | None = None
    stages: Sequence[Estimator | Transformer] = ()
    drop: Sequence[str] = ()
    keep: Sequence[str] = ()
    target_transform: str | None = None
    partitions: int | None = None
    inputs: Sequence[Input] = ()

    def __post_init__(self):
        check_inputs(self.inputs, self.prepare)
        for stage in [*self.stages, *self.models.values()]:
            if not isinstance(stage, (Estimator, Transformer)):
                raise TypeError(f"not an estimator or transformer: {stage!r}")
        if set(self.models) != set(self.targets):
            raise ValueError("name one model per target")
        if set(self.keys) & set(self.targets):
            raise ValueError("a column cannot be both key and target")
        if self.target_transform is not None and self.target_transform not in TARGET_TRANSFORMS:
            raise ValueError(f"unknown target transform: {self.target_transform}")

    @property
    def keys(self) -> tuple[str, ...]:
        return _names(self.key)

    @property
    def targets(self) -> tuple[str, ...]:
        return _names(self.target)

    @property
    def models(self) -> dict[str, Estimator]:
        if isinstance(self.model, Mapping):
            return dict(self.model)
        return {t: self.model for t in self.targets}

    def at_mark(self, raw: Raw) -> DataFrame:
        """Raw input after ``prepare``: the table the feature mark sees, targets included."""
        return _at_mark(self.prepare, raw, None, self.inputs)

    def split(
        self,
        raw: Raw,
        fraction: float = 0.2,
        seed: int = SPLIT_SEED,
        by: str | Sequence[str] | None = None,
        exact: bool = False,
    ) -> Split:
        """Train and test rows at the mark; ``by`` names a group column to keep together."""
        cut = exact_split if exact else hash_split
        return cut(self.at_mark(raw), by or self.keys, fraction, seed)

    def make_learner(self) -> Learner:
        return Learner(self)

    def evaluate(self, raw: Raw) -> DataFrame:
        """Fit and predict on one raw table: the same plan looked at with other input."""
        return self.make_learner().fit(raw=raw).predict(raw=raw)

    def preview(self, raw: Raw, n: int = 100, files: int = 3) -> DataFrame:
        """The plan evaluated on the first ``n`` rows by key. ``fit`` never samples.

        Of named inputs, path lists are cut to their first ``files`` by name and tables with a
        preview key to ``n`` rows, before the steps; what these make is cut to ``n`` rows again.
        """
        if not self.inputs:
            return self.evaluate(preview(raw, self.keys, n))
        table = preview(self.at_mark(previewed_binding(self.inputs, raw, n, files)), self.keys, n)
        return self.make_learner().fit(features=table).predict(features=table)


def _at_mark(
    prepare: Steps | None, raw: Raw | None, features: DataFrame | None, inputs: Sequence[Input] = (), fitting: bool = True
) -> DataFrame:
    if (raw is None) == (features is None):
        raise ValueError("give either raw input or a table at the feature mark")
    if features is not None:
        return features
    if inputs:
        if isinstance(raw, DataFrame):
            raise ValueError(f"raw input of this plan is a binding of {[i.name for i in inputs]}")
        return table_at_mark(inputs, prepare, raw, fitting)
    if not isinstance(raw, DataFrame):
        raise ValueError("this plan has no named inputs: raw input is one table")
    return prepare(raw) if prepare else raw


@dataclass(frozen=True)
class Learner:
    """An unfitted plan."""

    plan: FeaturePlan

    def fit(
        self,
        raw: Raw | None = None,
        features: DataFrame | None = None,
        stage_rows: DataFrame | None = None,
        target: DataFrame | None = None,
    ) -> FittedLearner:
        """Fit all stages and models on the given rows.

        ``target`` gives the targets of ``features`` as a table of their own, in any order: both
        need the plan's key, once for every row. A key that is NULL, repeats, or stands on one side only fails.

        ``stage_rows`` lets the stages, but not the models, see other rows than the
        training ones; leave it out to keep every statistic inside the training rows.

        The table at the mark is written once: the class list, the statistics, the row count
        and the matrix all read it, so a join before the mark runs once.

        The model matrix is spread over a fixed number of partitions by row hash and
        sorted within them, so the result does not depend on the layout of the input
        and a key held by many rows crowds no partition. It is stored once and shared
        by the models of all targets.
        """
        plan = self.plan
        if target is not None:
            features = _with_target(plan, features, target)
        table = drop_columns(_at_mark(plan.prepare, raw, features, plan.inputs), plan.drop, missing_ok=True)
        absent = [n for n in (*plan.keys, *plan.targets) if n not in table.columns]
        if absent:
            raise KeyError(f"no such column: {absent}")
        table, labels, texts = _with_labels(materialise(table, "training"), plan)
        exclude = [*plan.keys, *plan.targets, *plan.keep, *labels.values()]
        seen = table if stage_rows is None else drop_columns(stage_rows, plan.drop, missing_ok=True)
        preparation = Pipeline(stages=[*plan.stages, FeatureVector(exclude=exclude)]).fit(seen)
        keys = [quoted(k) for k in plan.keys]
        matrix = preparation.transform(table).select(*keys, *[quoted(c) for c in labels.values()], "features")
        partitions = plan.partitions or _training_partitions(table, _row_bytes(plan, matrix))
        row_hash = F.xxhash64(*keys)
        matrix = matrix.repartition(partitions, row_hash).sortWithinPartitions(*keys, row_hash)
        shared_dir(table.sparkSession)
        matrix = matrix.persist(StorageLevel.MEMORY_AND_DISK)
        stages: list[Transformer] = list(preparation.stages)
        binary = []
        try:
            for target, model in _fit_models(plan, labels, matrix).items():
                stages += [model, _on_target_scale(plan, target, table.schema[target].dataType, model, texts.get(target))]
                if getattr(model, "numClasses", 0) == 2:
                    binary.append(target)
        finally:
            matrix.unpersist()
        return FittedLearner(
            PipelineModel(stages), plan.keys, plan.targets, tuple(plan.drop), tuple(plan.keep), tuple(binary), plan.prepare,
            tuple(plan.inputs), _types(raw),
        )


def _types(raw: Raw | None) -> dict[str, str]:
    """Column types of a raw table: what later raw tables have to agree with."""
    return {f.name: f.dataType.simpleString() for f in raw.schema} if isinstance(raw, DataFrame) else {}


def _with_target(plan: FeaturePlan, features: DataFrame | None, target: DataFrame) -> DataFrame:
    if features is None:
        raise ValueError("targets of their own belong to a table at the feature mark")
    absent = [n for n in (*plan.keys, *plan.targets) if n not in target.columns]
    if absent:
        raise KeyError(f"no such column in the targets: {absent}")
    both = [t for t in plan.targets if t in features.columns]
    if both:
        raise ValueError(f"targets stand in both tables: {both}")
    names = [quoted(n) for n in (*plan.keys, *plan.targets)]
    return concat_columns(features, target.select(*names), plan.keys, "exact")


def _row_bytes(plan: FeaturePlan, matrix: DataFrame) -> int:
    """What tree training keeps of a row: its features, their bins, and for forests how often
    each tree draws it."""
    attributes = matrix.schema["features"].metadata.get("ml_attr", {})
    trees = [m.getOrDefault("numTrees") if m.hasParam("numTrees") else 0 for m in plan.models.values()]
    return PLAIN_ROW_BYTES + 12 * attributes.get("num_attrs", 0) + 4 * max(trees)


def _training_partitions(table: DataFrame, row_bytes: int = PLAIN_ROW_BYTES) -> int:
    """Small matrices in few partitions, large ones in pieces that fit a task's memory.

    The rows and their width alone decide, as forests draw their bags by partition: the same
    table gives the same model on any cluster. This counts the rows; a plan with ``partitions``
    set saves that pass.
    """
    rows = table.count()
    return max(1, min(8, math.ceil(rows / 20_000)), math.ceil(rows * row_bytes / PIECE_BYTES))


def _fit_models(plan: FeaturePlan, labels: dict[str, str], matrix: DataFrame) -> dict[str, Model]:
    """Fit the model of every target on the same stored matrix, all at once.

    Tree training is a chain of short jobs; the chains of several targets fill the
    cluster better side by side. A copy of a model is kept, because the model itself
    holds on to its training summary and with it to the session.
    """
    inherit = inheritable_thread_target(matrix.sparkSession)
    matrix.count()  # stored once, before several models ask for it
    with ThreadPoolExecutor(min(len(plan.models), MODELS_AT_ONCE)) as pool:
        running = {t: pool.submit(inherit(_wired(m, t, labels[t]).fit), matrix) for t, m in plan.models.items()}
        return {t: future.result().copy() for t, future in running.items()}


def _with_labels(table: DataFrame, plan: FeaturePlan) -> tuple[DataFrame, dict[str, str], dict[str, list[str]]]:
    """Add one numeric label column per target; text classes are numbered in sorted order."""
    labels = {t: f"_label_{t}" for t in plan.targets}
    texts = {}
    for target, label in labels.items():
        if isinstance(table.schema[target].dataType, T.StringType):
            texts[target] = sorted_categories(table, [target])[target]
            table = StringIndexerModel.from_labels(texts[target], target, label).transform(table)
        elif plan.target_transform:
            forward = TARGET_TRANSFORMS[plan.target_transform][0]
            table = table.withColumn(label, forward(quoted(target).cast("double")))
        else:
            table = table.withColumn(label, quoted(target).cast("double"))
    return table, labels, texts


def _wired(estimator: Estimator, target: str, label: str) -> Estimator:
    """A copy of the estimator that reads one label and writes columns named after its target."""
    names = {
        "labelCol": label,
        "predictionCol": f"_output_{target}",
        "probabilityCol": f"_probability_{target}",
        "rawPredictionCol": f"_margin_{target}",
    }
    return estimator.copy({estimator.getParam(n): v for n, v in names.items() if estimator.hasParam(n)})


def _on_target_scale(
    plan: FeaturePlan, target: str, dtype: T.DataType, model: Model, texts: list[str] | None
) -> Transformer:
    """The model output in the target's own terms.

    That is the class text, the class number in the type of the target, or the number
    with the target transform undone.
    """
    if texts:
        return IndexToString(inputCol=f"_output_{target}", outputCol=f"{target}_prediction", labels=texts)
    if plan.target_transform:
        back = TARGET_TRANSFORMS[plan.target_transform][1]
    else:
        back = dtype.simpleString() if hasattr(model, "numClasses") else "double"
    return SQLTransformer(statement=f"SELECT *, {back}(`_output_{target}`) AS `{target}_prediction` FROM __THIS__")


@dataclass(frozen=True)
class FittedLearner:
    """A fitted plan. Predicting is one lazy, mostly narrow projection of the input."""

    model: PipelineModel = field(repr=False)
    keys: tuple[str, ...]
    targets: tuple[str, ...]
    drop: tuple[str, ...] = ()
    keep: tuple[str, ...] = ()
    binary: tuple[str, ...] = ()
    prepare: Steps | None = None
    inputs: tuple[Input, ...] = ()
    raw_types: Mapping[str, str] = field(default_factory=dict)

    def predict(
        self, raw: Raw | None = None, features: DataFrame | None = None, output: str = "prediction"
    ) -> DataFrame:
        """Key, targets if present, kept columns, and ``<target>_prediction``.

        ``output="probability"`` gives ``<target>_probability`` instead: of class 1 for
        two classes, else an array over the classes. ``"both"`` gives the two.
        """
        if output not in ("prediction", "probability", "both"):
            raise ValueError(f"unknown output: {output}")
        changed = {n: t for n, t in _types(raw).items() if self.raw_types.get(n, t) != t}
        if changed:
            raise TypeError(f"columns with other types than at the fit: {changed}")
        table = drop_columns(_at_mark(self.prepare, raw, features, self.inputs, fitting=False), self.drop, missing_ok=True)
        beside = [n for n in (*self.keys, *self.targets, *self.keep) if n in table.columns]
        scored = self.model.transform(table)
        columns = [quoted(n) for n in beside]
        for t in self.targets:
            if output != "probability":
                columns.append(quoted(f"{t}_prediction"))
            if output != "prediction":
                if f"_probability_{t}" not in scored.columns:
                    raise ValueError(f"the model of {t} gives no probabilities")
                classes = vector_to_array(quoted(f"_probability_{t}"))
                chosen = F.get(classes, F.lit(1)) if t in self.binary else classes
                columns.append(chosen.alias(f"{t}_probability"))
        return scored.select(*columns)

    def submission(
        self,
        scored: DataFrame,
        output: str = "prediction",
        names: Mapping[str, str] | None = None,
        key: str | Sequence[str] | None = None,
    ) -> DataFrame:
        """Key columns and one output column per target, named after the target.

        ``key`` may name kept columns instead of the row key.
        """
        named = names or {t: t for t in self.targets}
        return submission(
            scored, _names(key) if key else self.keys, {named[t]: quoted(f"{t}_{output}") for t in self.targets}
        )

    def save(self, path: str) -> None:
        """Store the fitted stages and the input contract.

        Upstream steps are code: stored are their import path and a hash of their source, the
        named inputs, and the column types of a raw table. A step without an import path, such
        as a lambda, has to be handed in at load.
        """
        spark = SparkSession.active()
        self.model.write().overwrite().save(f"{path}/stages")
        contract = {n: list(getattr(self, n)) for n in ("keys", "targets", "drop", "keep", "binary")}
        contract |= {"upstream": described(self.prepare, self.inputs), "raw_types": dict(self.raw_types)}
        spark.createDataFrame([(json.dumps(contract),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/contract")

    @classmethod
    def load(cls, path: str, prepare: Steps | None = None, changed: str = "fail") -> FittedLearner:
        """A stored learner, upstream steps included.

        A step whose source has changed since fails; ``changed="accept"`` takes it as it is now.
        """
        if changed not in ("fail", "accept"):
            raise ValueError(f"unknown treatment of changed steps: {changed}")
        contract = json.loads(SparkSession.active().read.text(f"{path}/contract").first()[0])
        upstream = contract.pop("upstream", {"steps": [], "several": False, "inputs": []})
        raw_types = contract.pop("raw_types", {})
        steps, inputs = restored(upstream, prepare, changed)
        check_inputs(inputs, steps)
        model = PipelineModel.load(f"{path}/stages")
        return cls(model, **{n: tuple(v) for n, v in contract.items()}, prepare=steps, inputs=inputs, raw_types=raw_types)
