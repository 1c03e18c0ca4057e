"""The registered queries: operators applied to the given tables, each over all their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens import config
from matchlens.functions.numeric import half_even
from matchlens.functions.outcome import class_name
from matchlens.operators import (
    correlation,
    crossfold,
    distribution,
    metrics,
    models,
    outliers,
    preparation,
    profile,
    scoring,
    split,
)
from matchlens.plans import study
from matchlens.session import new_shared_path
from matchlens.sources.csv import read_inferred, read_matches
from matchlens.sources.matches import table
from matchlens.sources.staging import staged, staged_matches, staged_modelling_frame
from matchlens.sources.tables import load_tables, save_table

Query = Callable[[SparkSession, str], DataFrame]

KEY = config.ROW_KEY
OUTLIER_COLUMNS = config.STATISTIC_COLUMNS + config.ODDS_COLUMNS
LINE_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
CORRELATED = (*config.FEATURE_COLUMNS, config.LABEL)


def _round(df: DataFrame, columns, digits: int) -> DataFrame:
    return df.withColumns({c: half_even(c, digits) for c in columns})


# Source, label, profile

def matches_class_distribution(spark, sf_dir):
    return distribution.class_distribution(preparation.add_label(staged_matches(spark, sf_dir)))


def majority_baseline(spark, sf_dir):
    labelled = preparation.add_label(staged_matches(spark, sf_dir))
    return _round(distribution.majority_share(labelled), ["baseline_accuracy"], 6)


def event_type_distribution(spark, sf_dir):
    return distribution.top_categories(table(spark, sf_dir, "events"), "event_type")


def match_rows(spark, sf_dir):
    return staged_matches(spark, sf_dir)


def match_table_shape(spark, sf_dir):
    return profile.table_shape(staged_matches(spark, sf_dir))


def labelled_matches(spark, sf_dir):
    label = F.col(config.LABEL)
    return preparation.add_label(staged_matches(spark, sf_dir)).select(
        KEY, label, class_name(label, config.CLASS_NAMES).alias("class_label"),
        class_name(label, config.CLASS_SHORT_NAMES).alias("class_short"))


def column_profile(spark, sf_dir):
    return profile.column_profile(staged_matches(spark, sf_dir))


def _documents_with_labels(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def column_profile_documents(spark, sf_dir):
    return profile.column_profile(_documents_with_labels(spark, sf_dir))


def missing_report(spark, sf_dir):
    return profile.missing_report(staged_matches(spark, sf_dir))


def missing_severity(spark, sf_dir):
    return profile.missing_severity(profile.missing_report(staged_matches(spark, sf_dir)))


def missing_severity_documents(spark, sf_dir):
    return profile.missing_severity(profile.missing_report(_documents_with_labels(spark, sf_dir)))


def worst_missing(spark, sf_dir):
    return profile.worst_missing(profile.missing_report(staged_matches(spark, sf_dir)))


def iqr_outliers(spark, sf_dir):
    return outliers.iqr_outliers(staged_matches(spark, sf_dir), OUTLIER_COLUMNS)


def iqr_outliers_lineitem(spark, sf_dir):
    return outliers.iqr_outliers(table(spark, sf_dir, "lineitem"), LINE_MEASURES)


def selected_outliers(spark, sf_dir):
    return outliers.selected_outliers(iqr_outliers(spark, sf_dir), config.REPORT_OUTLIER_COLUMNS)


def boxplot_stats(spark, sf_dir):
    return _round(outliers.boxplot_statistics(staged_matches(spark, sf_dir),
                                              config.BOXPLOT_COLUMNS),
                  ["q1", "median", "q3", "whisker_low", "whisker_high"], 4)


def boxplot_stats_lineitem(spark, sf_dir):
    return _round(outliers.boxplot_statistics(table(spark, sf_dir, "lineitem"), LINE_MEASURES),
                  ["q1", "median", "q3", "whisker_low", "whisker_high"], 4)


def describe_features(spark, sf_dir):
    return outliers.describe(staged_modelling_frame(spark, sf_dir), config.FEATURE_COLUMNS)


def describe_lineitem(spark, sf_dir):
    return outliers.describe(table(spark, sf_dir, "lineitem"), LINE_MEASURES)


def describe_events(spark, sf_dir):
    return outliers.describe(table(spark, sf_dir, "events"), ["value"])


def top_leagues(spark, sf_dir):
    return distribution.top_categories(staged_matches(spark, sf_dir), "league")


def correlation_lower(spark, sf_dir):
    pairs = correlation.lower_triangle(
        correlation.correlation_matrix(staged_modelling_frame(spark, sf_dir), CORRELATED))
    return _round(pairs, ["r"], 6).select("row_name", "column_name", "r")


def correlation_pairwise_odds(spark, sf_dir):
    """Pairs over the raw table, where each pair has its own complete rows."""
    pairs = correlation.pairwise_correlation(
        staged_matches(spark, sf_dir), config.ODDS_COLUMNS + config.GOAL_COLUMNS)
    return _round(pairs, ["r"], 6).select("row_name", "column_name", "r")


def correlation_lineitem(spark, sf_dir):
    pairs = correlation.lower_triangle(
        correlation.correlation_matrix(table(spark, sf_dir, "lineitem"), LINE_MEASURES))
    return _round(pairs, ["r"], 6).select("row_name", "column_name", "r")


def implied_prob_density(spark, sf_dir):
    return _round(distribution.class_density(staged_modelling_frame(spark, sf_dir),
                                             "implied_prob_home"), ["x", "density"], 6)


# Preparation

def engineered_features(spark, sf_dir):
    derived = preparation.add_derived_features(staged_matches(spark, sf_dir))
    return _round(derived.select(KEY, *config.DERIVED_COLUMNS), config.DERIVED_COLUMNS, 6)


def complete_cases(spark, sf_dir):
    return preparation.complete_cases(staged_matches(spark, sf_dir),
                                      config.REQUIRED_COLUMNS).select(KEY, "league", "season")


def modelling_frame(spark, sf_dir):
    return _round(staged_modelling_frame(spark, sf_dir), config.DERIVED_COLUMNS, 6)


def retention_funnel(spark, sf_dir):
    return preparation.match_retention(staged_matches(spark, sf_dir))


# Scores and selection

def scaled_features(spark, sf_dir):
    scaled = scoring.standard_scale(staged_modelling_frame(spark, sf_dir), config.FEATURE_COLUMNS)
    return _round(scaled, config.FEATURE_COLUMNS, 6)


def _match_anova(spark, sf_dir):
    return scoring.anova_f(scoring.class_moments(
        staged_modelling_frame(spark, sf_dir), config.FEATURE_COLUMNS, config.LABEL))


def anova_f_scores(spark, sf_dir):
    return _round(_match_anova(spark, sf_dir), ["anova_f"], 6)


def anova_f_embeddings(spark, sf_dir):
    moments = scoring.vector_class_moments(table(spark, sf_dir, "embeddings"),
                                           "embedding", "label")
    return _round(scoring.anova_f(moments), ["anova_f"], 6)


def _deterministic_ranking(spark, sf_dir):
    """ANOVA F combined with the absolute correlation to the label."""
    strength = (correlation.correlation_matrix(staged_modelling_frame(spark, sf_dir), CORRELATED)
                .filter((F.col("column_name") == config.LABEL)
                        & (F.col("row_name") != config.LABEL))
                .select(F.col("row_name").alias("feature"), F.abs("r").alias("label_corr")))
    return scoring.combined_ranking(_match_anova(spark, sf_dir), strength,
                                    "anova_f", "label_corr", "anova_norm", "corr_norm")


def minmax_ranking(spark, sf_dir):
    return _round(_deterministic_ranking(spark, sf_dir),
                  ["anova_f", "label_corr", "anova_norm", "corr_norm", "combined_score"], 6)


def top_k_features(spark, sf_dir):
    return scoring.top_features(_deterministic_ranking(spark, sf_dir)).select("feature")


def selected_flags(spark, sf_dir):
    return scoring.flag_selected(_deterministic_ranking(spark, sf_dir)).select(
        "feature", "place", "is_selected")


def combined_importance(spark, sf_dir):
    return study.feature_importance(staged_modelling_frame(spark, sf_dir))


# Split

def stratified_split(spark, sf_dir):
    return split.mark_test_rows(staged_modelling_frame(spark, sf_dir)).select(
        KEY, config.LABEL, "is_test")


def stratified_split_counts(spark, sf_dir):
    return (stratified_split(spark, sf_dir).groupBy(config.LABEL, "is_test")
            .agg(F.count(F.lit(1)).alias("row_count")))


def stratified_split_embeddings(spark, sf_dir):
    return split.mark_test_rows(table(spark, sf_dir, "embeddings"), "label", ("vec_id",)).select(
        "vec_id", "label", "is_test")


def stratified_folds(spark, sf_dir):
    return split.mark_folds(staged_modelling_frame(spark, sf_dir)).select(
        KEY, config.LABEL, "fold")


def hashed_split(spark, sf_dir):
    return split.mark_test_rows_by_hash(staged_modelling_frame(spark, sf_dir)).select(
        KEY, "is_test")


# Models

def _split_matches(spark, sf_dir):
    """Training and test rows, each written once per application."""
    def part(is_test):
        return staged(spark, f"split-{is_test}", sf_dir, lambda: split.mark_test_rows(
            staged_modelling_frame(spark, sf_dir)).filter(F.col("is_test") == is_test)
            .repartition(spark.sparkContext.defaultParallelism, KEY))
    return part(False), part(True)


def _match_predictions(name: str) -> Query:
    def query(spark, sf_dir):
        train, test = _split_matches(spark, sf_dir)
        model = models.build_models(config.FEATURE_COLUMNS)[name]
        predicted = model.fit(train).transform(test)
        return predicted.select(KEY, config.LABEL, F.col("prediction").cast("int"))
    return query


def _embedding_split(spark, sf_dir):
    marked = split.mark_test_rows(table(spark, sf_dir, "embeddings"), "label", ("vec_id",))
    wide = marked.select("vec_id", "label", "is_test", *[
        F.expr(f"CAST(embedding[{i}] AS DOUBLE)").alias(f"e{i}") for i in range(64)])
    return wide.filter("NOT is_test"), wide.filter("is_test")


def _embedding_predictions(name: str) -> Query:
    def query(spark, sf_dir):
        train, test = _embedding_split(spark, sf_dir)
        model = models.build_models([f"e{i}" for i in range(64)], "label", "vec_id")[name]
        return model.fit(train).transform(test).select(
            "vec_id", "label", F.col("prediction").cast("int"))
    return query


def _naive_bayes_folds(spark, sf_dir):
    """Accuracy of each of five folds with all features and with the differences alone."""
    folded = staged(spark, "folds", sf_dir,
                    lambda: split.mark_folds(staged_modelling_frame(spark, sf_dir)))
    return crossfold.naive_bayes_folds(folded, {
        config.ALL_FEATURES: config.FEATURE_COLUMNS,
        "differences": [c for c in config.FEATURE_COLUMNS if c.endswith("_diff")]})


def naive_bayes_folds(spark, sf_dir):
    return _round(_naive_bayes_folds(spark, sf_dir), ["accuracy"], 9)


def naive_bayes_cv(spark, sf_dir):
    """Mean and population deviation over the folds."""
    return _round(crossfold.fold_summary(_naive_bayes_folds(spark, sf_dir)),
                  ["cv_mean", "cv_std"], 9)


def logistic_certificate(spark, sf_dir):
    """The derivative of the penalised loss at the fitted model: 0 marks the only optimum."""
    train, _ = _split_matches(spark, sf_dir)
    model = models.build_models(config.FEATURE_COLUMNS)[config.LOGISTIC_REGRESSION].fit(train)
    return _round(model.gradient(train, config.LABEL), ["gradient"], 9)


def model_round_trip(spark, sf_dir):
    """Predictions of a saved and reloaded model."""
    train, test = _split_matches(spark, sf_dir)
    model = models.build_models(config.FEATURE_COLUMNS)[config.NAIVE_BAYES].fit(train)
    path = new_shared_path(spark, "model")
    models.save_model(model, path)
    loaded = models.load_model(spark, path, config.NAIVE_BAYES)
    return loaded.transform(test).select(KEY, config.LABEL, F.col("prediction").cast("int"))


# Metrics, on the rule "the side with more shots wins"

def _rule_predictions(spark, sf_dir):
    shots = F.col("shots_diff")
    rule = F.when(shots > 0, 1).when(shots == 0, 0).otherwise(2)
    return staged_modelling_frame(spark, sf_dir).withColumn("prediction", rule)


def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_rule_predictions(spark, sf_dir))


def classification_report(spark, sf_dir):
    return metrics.classification_report(_rule_predictions(spark, sf_dir))


def overall_scores(spark, sf_dir):
    return _round(metrics.overall_scores(_rule_predictions(spark, sf_dir)),
                  ["accuracy", "macro_f1"], 6)


# Comparison

def _rule_results(spark, sf_dir):
    """Accuracy of the rule "the side with more of it wins" on three statistics. The first set
    calls equal sides a draw, the second never predicts one."""
    frame = staged_modelling_frame(spark, sf_dir)
    drawn = {config.ALL_FEATURES: 0, config.SELECTED_FEATURES: 2}
    rules = [(feature_set, statistic, F.when(F.col(statistic) > 0, 1)
              .when(F.col(statistic) == 0, code).otherwise(2))
             for feature_set, code in drawn.items()
             for statistic in ("shots_diff", "shots_target_diff", "corners_diff")]
    wide = frame.agg(*[half_even(F.avg((F.col(config.LABEL) == rule).cast("double")), 4)
                       .alias(f"a{i}") for i, (_, _, rule) in enumerate(rules)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(feature_set).alias("feature_set"), F.lit(statistic).alias("algorithm"),
                 F.col(f"a{i}").alias("accuracy"))
        for i, (feature_set, statistic, _) in enumerate(rules)])))


def rule_accuracy_pivot(spark, sf_dir):
    return models.accuracy_pivot(_rule_results(spark, sf_dir))


def best_rule(spark, sf_dir):
    return models.best_result(_rule_results(spark, sf_dir),
                              ("shots_diff", "shots_target_diff", "corners_diff"))


def _comparison(spark, sf_dir):
    """The results, written once per application: three queries look at them."""
    def build():
        frame = staged_modelling_frame(spark, sf_dir)
        selected, _ = study.select_features(frame)
        outcome = study.compare_models(frame, selected)
        outcome.release()
        return outcome.results
    return staged(spark, "comparison", sf_dir, build)


def model_comparison(spark, sf_dir):
    return _comparison(spark, sf_dir).drop("fit_seconds")


def accuracy_pivot(spark, sf_dir):
    return models.accuracy_pivot(_comparison(spark, sf_dir))


def best_model(spark, sf_dir):
    """The class report of the winner, fitted again."""
    train, test = _split_matches(spark, sf_dir)
    candidates = models.build_models(config.FEATURE_COLUMNS)
    name = models.best_result(_comparison(spark, sf_dir)).first()["algorithm"]
    return metrics.classification_report(candidates[name].fit(train).transform(test))


# Sinks

def csv_round_trip(spark, sf_dir):
    """The raw table, written as CSV and scanned again."""
    path = save_table(staged_matches(spark, sf_dir), new_shared_path(spark, "csv"), "matches")
    return read_matches(spark, path, keys=(KEY,))


def csv_inferred(spark, sf_dir):
    """The raw table, written as CSV and scanned without a declared schema."""
    path = save_table(staged_matches(spark, sf_dir), new_shared_path(spark, "csv"), "matches")
    return read_inferred(spark, path, escape="\\")


def csv_inferred_types(spark, sf_dir):
    """The types found in the CSV form of the orders."""
    path = save_table(table(spark, sf_dir, "orders"), new_shared_path(spark, "csv"), "orders")
    return spark.createDataFrame(read_inferred(spark, path, escape="\\").dtypes,
                                 "column_name string, data_type string")


def result_table_round_trip(spark, sf_dir):
    folder = new_shared_path(spark, "tables")
    save_table(missing_report(spark, sf_dir), folder, "missing_report")
    return load_tables(spark, folder, ["missing_report"])["missing_report"]


def registered() -> dict[str, Query]:
    plain = (
        matches_class_distribution, majority_baseline, event_type_distribution, match_rows,
        match_table_shape, labelled_matches, column_profile, column_profile_documents,
        missing_report, missing_severity, missing_severity_documents, worst_missing,
        iqr_outliers, iqr_outliers_lineitem, selected_outliers, boxplot_stats,
        boxplot_stats_lineitem, describe_features, describe_lineitem, describe_events,
        top_leagues, correlation_lower, correlation_pairwise_odds, correlation_lineitem,
        implied_prob_density, engineered_features, complete_cases, modelling_frame,
        retention_funnel, scaled_features, anova_f_scores, anova_f_embeddings, minmax_ranking,
        top_k_features, selected_flags, combined_importance, stratified_split,
        stratified_split_counts, stratified_split_embeddings, stratified_folds, hashed_split,
        naive_bayes_folds, naive_bayes_cv, logistic_certificate, model_round_trip, confusion_matrix, classification_report, overall_scores,
        rule_accuracy_pivot, best_rule, model_comparison, accuracy_pivot, best_model, csv_round_trip,
        csv_inferred, csv_inferred_types, result_table_round_trip,
    )
    return {query.__name__: query for query in plain} | {
        "tree_predictions": _match_predictions(config.DECISION_TREE),
        "forest_predictions": _match_predictions(config.RANDOM_FOREST),
        "gaussian_nb_predictions": _match_predictions(config.NAIVE_BAYES),
        "logistic_predictions": _match_predictions(config.LOGISTIC_REGRESSION),
        "knn_predictions": _match_predictions(config.NEAREST_NEIGHBOURS),
        "boosting_predictions": _match_predictions(config.GRADIENT_BOOSTING),
        "gaussian_nb_embeddings": _embedding_predictions(config.NAIVE_BAYES),
        "knn_embeddings": _embedding_predictions(config.NEAREST_NEIGHBOURS),
    }
