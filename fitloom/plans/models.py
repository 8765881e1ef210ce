"""The models, as configured Spark ML estimators, and a prior baseline."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stats import value_counts

# Model settings.
FOREST_TREES = 100
# Megabytes for the statistics of one pass over the rows: more of a tree level fits a pass.
LEVEL_MEMORY = 1024
BOOSTING_ROUNDS = 100
BOOSTING_RATE = 0.1
SEED = 42


def forest_classifier(trees: int = FOREST_TREES, seed: int = SEED, **options) -> RandomForestClassifier:
    """Random forest for two or more classes."""
    settings = {"maxDepth": 10, "featuresCol": "features", "maxMemoryInMB": LEVEL_MEMORY} | options
    return RandomForestClassifier(numTrees=trees, seed=seed, **settings)


def boosted_classifier(rounds: int = BOOSTING_ROUNDS, rate: float = BOOSTING_RATE, seed: int = SEED, **options) -> GBTClassifier:
    """Gradient-boosted trees for a 0/1 target; five levels hold about 31 leaves."""
    settings = {"maxDepth": 5, "featuresCol": "features", "maxMemoryInMB": LEVEL_MEMORY} | options
    return GBTClassifier(maxIter=rounds, stepSize=rate, seed=seed, **settings)


def boosted_regressor(rounds: int = BOOSTING_ROUNDS, rate: float = BOOSTING_RATE, seed: int = SEED, **options) -> GBTRegressor:
    """Gradient-boosted regression trees with squared error."""
    settings = {"maxDepth": 5, "featuresCol": "features", "maxMemoryInMB": LEVEL_MEMORY} | options
    return GBTRegressor(maxIter=rounds, stepSize=rate, seed=seed, **settings)


class _PriorParams(Params):
    labelCol = Param(Params._dummy(), "labelCol", "target", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "output", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "output", TypeConverters.toString)


class PriorClassifier(Estimator, _PriorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Baseline: predicts the largest class and the class shares; lowest class on a tie.

    Classes are the distinct label numbers in order, whatever they are; a label of zeros
    and ones always has both.
    """

    @keyword_only
    def __init__(
        self, *, labelCol: str = "label", predictionCol: str = "prediction", probabilityCol: str = "probability"
    ):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction", probabilityCol="probability")
        self._set(**self._input_kwargs)

    def setLabelCol(self, value: str) -> PriorClassifier:
        return self._set(labelCol=value)

    def setPredictionCol(self, value: str) -> PriorClassifier:
        return self._set(predictionCol=value)

    def setProbabilityCol(self, value: str) -> PriorClassifier:
        return self._set(probabilityCol=value)

    def _fit(self, dataset: DataFrame) -> PriorModel:
        label = self.getOrDefault(self.labelCol)
        counts = value_counts(dataset.select(F.col(label).cast("double").alias(label)), [label])
        found = {r["value"]: r["n"] for r in counts.collect()}
        if not found:
            raise ValueError("no labelled rows")
        if set(found) <= {0.0, 1.0}:
            found = {0.0: 0, 1.0: 0} | found
        classes, total = sorted(found), sum(found.values())
        shares = [found[k] / total for k in classes]
        model = PriorModel()
        model._set(
            classes=classes,
            shares=shares,
            predictionCol=self.getOrDefault(self.predictionCol),
            probabilityCol=self.getOrDefault(self.probabilityCol),
        )
        return model


class PriorModel(Model, _PriorParams, DefaultParamsReadable, DefaultParamsWritable):
    classes = Param(Params._dummy(), "classes", "the classes in order", TypeConverters.toListFloat)
    shares = Param(Params._dummy(), "shares", "share of each class", TypeConverters.toListFloat)

    @property
    def numClasses(self) -> int:
        return len(self.getOrDefault(self.shares))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shares, classes = self.getOrDefault(self.shares), self.getOrDefault(self.classes)
        return dataset.withColumns(
            {
                self.getOrDefault(self.predictionCol): F.lit(classes[shares.index(max(shares))]),
                self.getOrDefault(self.probabilityCol): array_to_vector(F.array(*[F.lit(s) for s in shares])),
            }
        )
