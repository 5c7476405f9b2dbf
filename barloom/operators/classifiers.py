"""Classifiers by name, per symbol or pooled over all symbols."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as mlc
from pyspark.ml.feature import Binarizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import bayes, trees
from barloom.operators.features import binary_class, proportion_class
from barloom.schema import CODE, COMPAT_RANGE, DATE, FEATURE_LENGTH
from barloom.sources.keyed import KeyedStore


@dataclass(frozen=True)
class Classifier:
    fit: Callable[[DataFrame], DataFrame]
    classify: Callable[[DataFrame, DataFrame], DataFrame]


# The names a classifier is chosen by.
CLASSIFIERS: dict[str, Classifier] = {
    "Decision Tree": Classifier(trees.fit_tree, trees.classify_trees),
    "Random Forest": Classifier(trees.fit_forest, trees.classify_trees),
    "AdaBoost": Classifier(trees.fit_boosted, trees.classify_boosted),
    "Gaussian Naive Bayes": Classifier(bayes.fit_gaussian, bayes.classify_gaussian),
    "Multinomial Naive Bayes": Classifier(bayes.fit_multinomial, bayes.classify_multinomial),
    "Bernoulli Naive Bayes": Classifier(bayes.fit_bernoulli, bayes.classify_bernoulli),
    "LDA": Classifier(bayes.fit_discriminant, bayes.classify_discriminant),
}


def training_span(mode: str) -> int | None:
    """``full`` trains on up to 135 recent rows; ``compat_last`` on the shortest range, one sample.

    The second is the literal behaviour of refitting a stored model and only useful to
    reproduce it.
    """
    if mode not in ("full", "compat_last"):
        raise ValueError("mode must be 'full' or 'compat_last'")
    return None if mode == "full" else COMPAT_RANGE


def class_samples(series: DataFrame, mode: str = "full") -> DataFrame:
    return binary_class(series, training_span(mode))


def value_samples(series: DataFrame, mode: str = "full") -> DataFrame:
    return proportion_class(series, training_span(mode))


def _pooled_stages(name: str, seed: int):
    args = {"featuresCol": "vector", "labelCol": "label"}
    if name == "Decision Tree":
        return [mlc.DecisionTreeClassifier(maxDepth=5, maxBins=256, seed=seed, **args)]
    if name == "Random Forest":
        return [
            mlc.RandomForestClassifier(
                numTrees=10, maxDepth=5, maxBins=256, featureSubsetStrategy="1", seed=seed, **args
            )
        ]
    if name == "Gaussian Naive Bayes":
        return [mlc.NaiveBayes(modelType="gaussian", **args)]
    if name == "Multinomial Naive Bayes":
        return [mlc.NaiveBayes(modelType="multinomial", smoothing=1.0, **args)]
    if name == "Bernoulli Naive Bayes":
        above = Binarizer(threshold=0.0, inputCol="vector", outputCol="above")
        return [above, mlc.NaiveBayes(modelType="bernoulli", featuresCol="above", labelCol="label")]
    raise ValueError(f"no pooled form of {name!r}")


def _vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("vector", array_to_vector("features"))


def fit_pooled(samples: DataFrame, name: str = "Decision Tree", seed: int = 7) -> PipelineModel:
    """One model for all symbols. Return index windows are relative to each symbol's start, so
    they can be pooled, but the result is not that of per-symbol models."""
    return Pipeline(stages=_pooled_stages(name, seed)).fit(_vectors(samples))


def classify_pooled(model: PipelineModel, windows: DataFrame) -> DataFrame:
    scored = model.transform(_vectors(windows.where(F.size("features") == FEATURE_LENGTH)))
    return scored.select(CODE, DATE, F.col("prediction").cast("int").alias("prediction"))


class ModelStore:
    """Models of both kinds by name, one row or more for each symbol.

    Saving replaces the models of the symbols in the table and leaves all others as they are;
    the models after any earlier run stay readable. See :mod:`barloom.sources.keyed`.
    """

    def __init__(self, spark: SparkSession, path: str, live: int = 8):
        self.spark, self.path, self.live = spark, path.rstrip("/"), live

    def _store(self, name: str) -> KeyedStore:
        return KeyedStore(self.spark, f"{self.path}/{name.replace(' ', '_')}", self.live)

    def save(self, name: str, model: DataFrame, run: int) -> None:
        store = self._store(name)
        staged = store.stage(run, "models", model)
        store.commit(run, staged.select(CODE).distinct(), ["models"], [])

    def load(self, name: str, run: int | None = None) -> DataFrame | None:
        """Every symbol's model, as of a run; ``None`` if none was saved."""
        return self._store(name).current("models", run)


def save_model(model: DataFrame | PipelineModel, path: str) -> None:
    """Model tables are stored as Parquet, pooled models in their own format."""
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
    else:
        model.write.mode("overwrite").parquet(path)


def load_model(spark, path: str, pooled: bool = False) -> DataFrame | PipelineModel:
    return PipelineModel.load(path) if pooled else spark.read.parquet(path)
