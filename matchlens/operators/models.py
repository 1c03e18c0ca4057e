"""The six classifiers, cross-validation and the comparison of feature sets."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens import config
from matchlens.functions.numeric import half_even
from matchlens.operators.boosting import (
    BoostingSettings,
    HistogramBoosting,
    HistogramBoostingModel,
)
from matchlens.operators.cart import ExactTree, ExactTreeModel
from matchlens.operators.crossfold import naive_bayes_folds
from matchlens.operators.forest import ForestSettings, UnlimitedForest, UnlimitedForestModel
from matchlens.operators.logistic import LogisticModel, NewtonLogistic
from matchlens.operators.metrics import overall_scores
from matchlens.operators.neighbours import (
    column_vector,
    feature_weights,
    nearest_neighbour_vote,
)


@dataclass(frozen=True)
class ModelSettings:
    """Hyperparameters. Forests have no depth limit."""

    tree_depth: int = 12
    forest_trees: int = 300
    iterations: int = 1000
    penalty: float = 1.0
    neighbours: int = 25
    boosting: BoostingSettings = BoostingSettings()
    seed: int = config.SEED


class NearestNeighbours(Estimator):
    """k nearest neighbours on standardised features, voted by :mod:`neighbours`."""

    def __init__(self, features: Sequence[str], label: str, key: str, k: int = 25):
        super().__init__()
        self.features, self.label, self.key, self.k = list(features), label, key, k

    def _fit(self, dataset: DataFrame) -> NearestNeighboursModel:
        return NearestNeighboursModel(
            dataset.select(self.key, self.label, *self.features),
            feature_weights(dataset, self.features), self.features, self.label, self.key, self.k)


class NearestNeighboursModel(Model):
    def __init__(self, train, weights, features, label, key, k):
        super().__init__()
        self.train, self.weights, self.features = train, weights, list(features)
        self.label, self.key, self.k = label, key, k

    def _transform(self, dataset: DataFrame) -> DataFrame:
        vector = column_vector(self.features).alias("vector")
        votes = nearest_neighbour_vote(
            self.train.select(F.col(self.key).alias("train_key"),
                              F.col(self.label).cast("int").alias("class_code"), vector),
            dataset.select(F.col(self.key).alias("query_key"), vector),
            self.k, self.weights)
        return (dataset.join(votes, F.col(self.key) == F.col("query_key"))
                .drop("query_key").withColumn("prediction", F.col("prediction").cast("double")))

    def save(self, path: str) -> None:
        self.train.write.mode("overwrite").parquet(f"{path}/rows")
        about = {"weights": self.weights, "features": self.features, "label": self.label,
                 "key": self.key, "k": self.k}
        (self.train.sparkSession.createDataFrame([(json.dumps(about),)], "about string")
         .coalesce(1).write.mode("overwrite").text(f"{path}/about"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> NearestNeighboursModel:
        about = json.loads(spark.read.text(f"{path}/about").first()["value"])
        return cls(spark.read.parquet(f"{path}/rows"), **about)


# Models of this library by display name; the others are Spark's pipelines.
OWN_MODELS = {config.DECISION_TREE: ExactTreeModel, config.RANDOM_FOREST: UnlimitedForestModel,
              config.LOGISTIC_REGRESSION: LogisticModel,
              config.NEAREST_NEIGHBOURS: NearestNeighboursModel,
              config.GRADIENT_BOOSTING: HistogramBoostingModel}


def save_model(model: Model, path: str) -> None:
    if isinstance(model, tuple(OWN_MODELS.values())):
        model.save(path)
    else:
        model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str, name: str) -> Model:
    if name in OWN_MODELS:
        return OWN_MODELS[name].load(spark, path)
    return PipelineModel.load(path)


def build_models(features: Sequence[str], label: str = config.LABEL, key: str = config.ROW_KEY,
                 settings: ModelSettings = ModelSettings()) -> dict[str, Estimator]:
    """Name to unfitted model, in comparison order. Only three of the six use scaled input."""
    features = list(features)
    assemble = VectorAssembler(inputCols=features, outputCol="vector")
    scale = StandardScaler(inputCol="vector", outputCol="scaled", withMean=True, withStd=True)

    def scaled(classifier):
        return Pipeline(stages=[assemble, scale, classifier])

    return {
        config.DECISION_TREE: ExactTree(features, label, settings.tree_depth),
        config.RANDOM_FOREST: UnlimitedForest(features, label, key, ForestSettings(
            trees=settings.forest_trees, seed=settings.seed)),
        config.NAIVE_BAYES: scaled(NaiveBayes(
            featuresCol="scaled", labelCol=label, modelType="gaussian")),
        config.LOGISTIC_REGRESSION: NewtonLogistic(features, label, 1 / settings.penalty,
                                                   settings.iterations),
        config.NEAREST_NEIGHBOURS: NearestNeighbours(features, label, key, settings.neighbours),
        config.GRADIENT_BOOSTING: HistogramBoosting(features, label, settings.boosting),
    }


PARALLEL_FITS = 8  # beside the timed ones; most fits are chains of jobs that leave cores idle


def _side_by_side(work: Sequence[Callable], parallelism: int) -> list:
    """What each function returns, some running at a time."""
    if not work:
        return []
    with ThreadPool(min(parallelism, len(work))) as pool:
        return pool.map(lambda job: job(), work, chunksize=1)


def _fold_accuracy(model: Estimator, folded: DataFrame, fold: int, label: str) -> float:
    fitted = model.fit(folded.filter(F.col("fold") != fold))
    predicted = fitted.transform(folded.filter(F.col("fold") == fold))
    return overall_scores(predicted, label).first()["accuracy"]


def cross_validate_all(estimators: Mapping[str, Estimator], folded: DataFrame,
                       label: str = config.LABEL, folds: int = config.CV_FOLDS,
                       parallelism: int = PARALLEL_FITS) -> dict[str, list[float]]:
    """Accuracy per fold of each model on a frame that carries a ``fold`` column. Fits of different
    models run side by side, fold by fold, so that one fills the cores that another leaves idle."""
    jobs = [(name, fold) for fold in range(folds) for name in estimators]
    found = _side_by_side([partial(_fold_accuracy, estimators[name], folded, fold, label)
                           for name, fold in jobs], parallelism)
    by_job = dict(zip(jobs, found))
    return {name: [by_job[name, fold] for fold in range(folds)] for name in estimators}


def cross_validate(model: Estimator, folded: DataFrame, label: str = config.LABEL,
                   folds: int = config.CV_FOLDS, parallelism: int = 2) -> list[float]:
    """Accuracy per fold of a frame that carries a ``fold`` column; fits run side by side."""
    return cross_validate_all({"model": model}, folded, label, folds, parallelism)["model"]


RESULT_SCHEMA = ("feature_set string, algorithm string, accuracy double, macro_f1 double, "
                 "cv_mean double, cv_std double, fit_seconds double")


def evaluate_models(train: DataFrame, test: DataFrame, features: Sequence[str], feature_set: str,
                    **options) -> DataFrame:
    """Fit, predict and score every model on one feature set; one row each."""
    return compare_feature_sets(train, test, {feature_set: features}, **options)


def best_result(results: DataFrame, names: Sequence[str] = config.MODEL_NAMES,
                feature_set: str = config.ALL_FEATURES) -> DataFrame:
    """Highest rounded accuracy among the rows of one feature set; the earlier model wins ties."""
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("algorithm"))
    return (results.filter(F.col("feature_set") == feature_set)
            .orderBy(F.desc("accuracy"), order).limit(1))


def accuracy_pivot(results: DataFrame,
                   feature_sets: Sequence[str] = (config.SELECTED_FEATURES, config.ALL_FEATURES),
                   ) -> DataFrame:
    """Algorithm by feature set with the difference, best first. A repeated pair is an error."""
    selected, everything = feature_sets
    once = F.when(F.count(F.lit(1)) > 1, F.raise_error(
        F.concat(F.lit("more than one result for "), F.first("algorithm")))).otherwise(
        F.first("accuracy"))
    wide = (results.groupBy("algorithm", "feature_set").agg(once.alias("accuracy"))
            .groupBy("algorithm").pivot("feature_set", list(feature_sets)).agg(F.first("accuracy")))
    return (wide.withColumn("diff", half_even(F.col(everything) - F.col(selected), 4))
            .orderBy(F.desc_nulls_last(everything), "algorithm"))


def compare_feature_sets(train: DataFrame, test: DataFrame,
                         feature_sets: Mapping[str, Sequence[str]], label: str = config.LABEL,
                         key: str = config.ROW_KEY, settings: ModelSettings = ModelSettings(),
                         cv: bool = True, folds: int = config.CV_FOLDS,
                         on_row: Callable[[tuple], None] | None = None,
                         on_model: Callable[[str, str, Model], None] | None = None) -> DataFrame:
    """Fit, predict and score every model on the same split for every feature set; one row each,
    set by set.

    ``train`` carries a ``fold`` column when ``cv`` is set; without it the CV columns are NULL.
    Only scores reach the driver. The fits that are timed run one after the other; then their
    predictions and the folds of all models and sets run side by side. ``on_model`` is given the
    feature set, the name and each fitted model.
    """
    estimators, fits, rows = {}, {}, []
    for feature_set, features in feature_sets.items():
        for name, model in build_models(features, label, key, settings).items():
            started = time.perf_counter()
            fitted = model.fit(train)
            estimators[feature_set, name] = model
            fits[feature_set, name] = fitted, time.perf_counter() - started
            if on_model:
                on_model(feature_set, name, fitted)

    def score(fitted: Model):
        return overall_scores(fitted.transform(test), label).first()

    jobs = [(one, fold) for fold in range(folds if cv else 0) for one in estimators
            if one[1] != config.NAIVE_BAYES] + [(one, None) for one in fits]
    found = dict(zip(jobs, _side_by_side(
        [partial(score, fits[one][0]) if fold is None else
         partial(_fold_accuracy, estimators[one], train, fold, label) for one, fold in jobs],
        PARALLEL_FITS)))
    accuracies = {one: [found[one, fold] for fold in range(folds)] for one in estimators
                  if cv and one[1] != config.NAIVE_BAYES}
    for feature_set, features in feature_sets.items() if cv else ():
        # from moments of the folds, without further fits
        by_fold = naive_bayes_folds(train, {feature_set: features}, label)
        accuracies[feature_set, config.NAIVE_BAYES] = [
            r["accuracy"] for r in by_fold.orderBy("fold").collect()]
    for one, (_, seconds) in fits.items():
        scores = found[one, None]
        rows.append((*one, round(scores["accuracy"], 4), round(scores["macro_f1"], 4),
                     round(fmean(accuracies[one]), 4) if cv else None,
                     round(pstdev(accuracies[one]), 4) if cv else None, round(seconds, 3)))
        if on_row:
            on_row(rows[-1])
    return train.sparkSession.createDataFrame(rows, RESULT_SCHEMA)
