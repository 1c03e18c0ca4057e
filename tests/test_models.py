"""Fits on the smallest tables with small settings."""

from inspect import signature
from threading import Barrier

import pytest
from pyspark.ml import Estimator, Model
from pyspark.sql import functions as F

from matchlens import config
from matchlens.operators import models, scoring
from matchlens.operators.boosting import BoostingSettings
from matchlens.operators.distribution import majority_share
from matchlens.operators.metrics import overall_scores
from matchlens.plans import queries, study
from matchlens.session import new_shared_path
from matchlens.sources.staging import staged_matches, staged_modelling_frame
from matchlens.sources.tables import load_tables

TINY = models.ModelSettings(tree_depth=4, forest_trees=10, neighbours=15,
                            boosting=BoostingSettings(rounds=4))
FOREST = {"trees": 10}


@pytest.fixture(scope="module")
def parts(spark):
    frame = staged_modelling_frame(spark, "/root/testdata/sf0.01")
    train, test = study.split_frame(frame, folds=2)
    return train.persist(), test.persist()


@pytest.mark.parametrize("name", config.MODEL_NAMES)
def test_model_beats_the_majority(parts, name):
    train, test = parts
    predicted = models.build_models(config.FEATURE_COLUMNS, settings=TINY)[name].fit(
        train).transform(test)
    assert predicted.count() == test.count()
    assert {r[0] for r in predicted.select("prediction").distinct().collect()} <= {0.0, 1.0, 2.0}
    accuracy = overall_scores(predicted).first()["accuracy"]
    assert accuracy > majority_share(test).first()[0] + 0.02


def test_split_is_whole(spark, parts):
    train, test = parts
    frame = staged_modelling_frame(spark, "/root/testdata/sf0.01")
    keys = train.select(config.ROW_KEY).unionAll(test.select(config.ROW_KEY))
    assert keys.count() == keys.distinct().count() == frame.count()


def test_importance_is_repeatable_and_sums_to_one(parts):
    runs = [{r["feature"]: r["rf_importance"] for r in scoring.forest_importance(
        parts[0], config.FEATURE_COLUMNS, **FOREST).collect()} for _ in range(2)]
    assert runs[0] == runs[1]
    assert sum(runs[0].values()) == pytest.approx(1.0)


@pytest.mark.parametrize("name", [config.RANDOM_FOREST, config.LOGISTIC_REGRESSION, config.NEAREST_NEIGHBOURS,
                                  config.GRADIENT_BOOSTING])
def test_saved_model_predicts_the_same(spark, parts, name):
    train, test = parts
    fitted = models.build_models(config.FEATURE_COLUMNS, settings=TINY)[name].fit(train)
    path = new_shared_path(spark, "test-model")
    models.save_model(fitted, path)
    columns = [config.ROW_KEY, "prediction"]
    before = fitted.transform(test).select(columns)
    after = models.load_model(spark, path, name).transform(test).select(columns)
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))


def test_without_cross_validation_the_columns_are_null(parts):
    train, test = parts
    row = models.evaluate_models(train, test, ["odds_home", "shots_diff"], "two", settings=TINY,
                                 cv=False).filter(F.col("algorithm") == config.NAIVE_BAYES).first()
    assert row["cv_mean"] is None and row["cv_std"] is None and row["feature_set"] == "two"


def test_whole_study(spark, sf_dir):
    folder = new_shared_path(spark, "test-study")
    tables = study.run_study(staged_matches(spark, sf_dir), folder, settings=TINY, folds=2,
                             **FOREST)
    results = tables["model_results"].collect()
    assert len(results) == 12
    assert all(0 <= r["cv_mean"] <= 1 and r["cv_std"] >= 0 for r in results)
    loaded = load_tables(spark, folder)
    assert loaded["accuracy_pivot"].count() == 6
    assert loaded["class_report"].count() == 6
    assert loaded["column_profile"].count() == 29
    assert loaded["feature_importance"].count() == 21


def test_winner_is_not_fitted_again(spark, monkeypatch):
    fits = []

    def two(features, label, key, settings):
        every = build(features, label, key, settings)
        return {n: every[n] for n in (config.DECISION_TREE, config.NAIVE_BAYES)}

    def counted(self, *args):
        fits.append(type(self).__name__)
        return fit(self, *args)

    build, fit = models.build_models, Estimator.fit
    monkeypatch.setattr(models, "build_models", two)
    monkeypatch.setattr(study, "build_models", two, raising=False)
    monkeypatch.setattr(Estimator, "fit", counted)
    frame = staged_modelling_frame(spark, "/root/testdata/sf0.001")
    outcome = study.compare_models(frame, ["odds_home", "shots_diff"], settings=TINY, folds=2)
    assert outcome.best_name in (config.DECISION_TREE, config.NAIVE_BAYES)
    assert outcome.best_predictions.count() == outcome.test.count()
    assert (fits.count("ExactTree"), fits.count("Pipeline")) == (2 * (1 + 2), 2)
    outcome.release()


def test_folds_of_different_models_run_side_by_side(spark):
    met = Barrier(2, timeout=60)

    class Always(Estimator):
        def _fit(self, dataset):
            met.wait()
            return Same()

    class Same(Model):
        def _transform(self, dataset):
            return dataset.withColumn("prediction", F.lit(1.0))

    folded = spark.createDataFrame([(1, 0), (1, 0), (0, 1), (1, 1)], f"{config.LABEL} int, fold int")
    found = models.cross_validate_all({"a": Always(), "b": Always()}, folded, folds=2, parallelism=2)
    assert found == {"a": [1.0, 0.5], "b": [1.0, 0.5]}


def test_queries_compare_models_of_the_full_settings(spark, sf_dir, monkeypatch):
    """The comparison and the winner's report run the settings of the single predictions."""
    asked, sign = [], signature(study.compare_models)

    class Outcome:
        results = spark.createDataFrame([(config.ALL_FEATURES, config.DECISION_TREE, 0.5, 0.5, 0.5,
                                          0.1, 1.0)], models.RESULT_SCHEMA)

        def release(self):
            pass

    def compared(*args, **options):
        given = sign.bind(*args, **options)
        given.apply_defaults()
        asked.append((given.arguments["settings"], given.arguments["folds"]))
        return Outcome()

    def built(features, label=config.LABEL, key=config.ROW_KEY, settings=models.ModelSettings()):
        asked.append((settings, config.CV_FOLDS))
        return build(features, label, key, settings)

    build = models.build_models
    monkeypatch.setattr(study, "compare_models", compared)
    monkeypatch.setattr(study, "select_features", lambda frame: (["odds_home"], None))
    monkeypatch.setattr(queries, "staged", lambda spark, name, origin, build: build())
    monkeypatch.setattr(queries.models, "build_models", built)
    assert queries.model_comparison(spark, sf_dir).count() == 1
    assert queries.accuracy_pivot(spark, sf_dir).count() == 1
    assert queries.best_model(spark, sf_dir).count() == 6
    assert set(asked) == {(models.ModelSettings(), 5)}
    assert models.ModelSettings().boosting.rounds == 100


def test_predictions_of_both_sets_run_side_by_side(spark, monkeypatch):
    met, fits = Barrier(2, timeout=60), []

    class Always(Estimator):
        def _fit(self, dataset):
            fits.append(met.n_waiting)
            return Meets()

    class Meets(Model):
        def _transform(self, dataset):
            met.wait()
            return dataset.withColumn("prediction", F.lit(1.0))

    monkeypatch.setattr(models, "build_models", lambda *args: {config.DECISION_TREE: Always()})
    table = spark.createDataFrame([(1, 0.5), (0, 1.5)], f"{config.LABEL} int, a double")
    results = models.compare_feature_sets(table, table, {"one": ["a"], "two": ["a"]}, cv=False)
    assert [(r["feature_set"], r["accuracy"]) for r in results.collect()] == [("one", 0.5), ("two", 0.5)]
    assert fits == [0, 0]
