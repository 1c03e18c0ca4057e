"""Identities that hold between the published result tables."""

import pytest
from pyspark.sql import functions as F

from matchlens import config
from matchlens.operators import metrics, models, scoring

# Published scores (feature, ANOVA F, forest importance, combined score), ranked
IMPORTANCE = """
shots_target_diff 8883.3516 0.0909 1.0
implied_prob_home 6076.3496 0.075 0.7446
implied_prob_away 6008.0279 0.0744 0.7373
odds_home 4043.5178 0.0557 0.5116
away_shots_target 4623.7323 0.0465 0.4888
home_shots_target 4326.0841 0.048 0.481
odds_away 3658.7267 0.0511 0.4623
shots_diff 2044.8486 0.0526 0.3798
implied_prob_draw 1023.1957 0.0613 0.3756
away_shots 1443.1109 0.0458 0.3043
home_shots 1125.2597 0.0475 0.297
away_fouls 62.4892 0.051 0.2583
corners_diff 50.029 0.0501 0.2519
home_fouls 32.0801 0.0501 0.2513
odds_draw 1000.6317 0.0356 0.2177
home_corners 40.3319 0.0419 0.2016
away_corners 34.4075 0.0385 0.1803
home_yellow 319.2531 0.0321 0.1573
away_yellow 79.8514 0.0337 0.1537
home_red 548.8823 0.0089 0.0292
away_red 379.4803 0.0093 0.0219
"""

# Published accuracies (all features, selected features)
ACCURACY = {
    config.DECISION_TREE: (0.5694, 0.5718),
    config.RANDOM_FOREST: (0.6096, 0.5732),
    config.NAIVE_BAYES: (0.5286, 0.5342),
    config.LOGISTIC_REGRESSION: (0.6141, 0.6025),
    config.NEAREST_NEIGHBOURS: (0.592, 0.5839),
    config.GRADIENT_BOOSTING: (0.6211, 0.5987),
}


def results(spark, rows):
    return spark.createDataFrame([(s, a, v, 0.0, None, None, 0.0) for s, a, v in rows],
                                 models.RESULT_SCHEMA)


@pytest.fixture(scope="module")
def published(spark):
    return results(spark, [(s, a, v[i]) for i, s in enumerate(
        (config.ALL_FEATURES, config.SELECTED_FEATURES)) for a, v in ACCURACY.items()])


def test_combined_ranking(spark):
    rows = [line.split() for line in IMPORTANCE.strip().splitlines()]
    first = spark.createDataFrame([(r[0], float(r[1])) for r in rows],
                                  "feature string, anova_f double")
    second = spark.createDataFrame([(r[0], float(r[2])) for r in rows],
                                   "feature string, rf_importance double")
    ranking = scoring.combined_ranking(first, second, "anova_f", "rf_importance",
                                       "anova_norm", "rf_norm")
    found = ranking.collect()
    assert [r["feature"] for r in found] == [r[0] for r in rows]
    for got, row in zip(found, rows):
        assert got["combined_score"] == pytest.approx(float(row[3]), abs=1e-3)
    assert [r["feature"] for r in scoring.top_features(ranking).collect()] == [
        r[0] for r in rows[:10]]


def test_pivot(published):
    rows = models.accuracy_pivot(published).collect()
    assert [(r["algorithm"], r["diff"]) for r in rows] == [
        (config.GRADIENT_BOOSTING, 0.0224), (config.LOGISTIC_REGRESSION, 0.0116),
        (config.RANDOM_FOREST, 0.0364), (config.NEAREST_NEIGHBOURS, 0.0081),
        (config.DECISION_TREE, -0.0024), (config.NAIVE_BAYES, -0.0056)]


def test_pivot_refuses_a_repeated_pair(spark, published):
    doubled = published.unionByName(published.filter(
        (F.col("algorithm") == config.NAIVE_BAYES)
        & (F.col("feature_set") == config.ALL_FEATURES)))
    with pytest.raises(Exception, match="more than one result"):
        models.accuracy_pivot(doubled).collect()


def test_best(spark, published):
    best = models.best_result(published).first()
    assert (best["algorithm"], best["accuracy"]) == (config.GRADIENT_BOOSTING, 0.6211)
    tied = results(spark, [(config.ALL_FEATURES, a, 0.5) for a in reversed(list(ACCURACY))])
    assert models.best_result(tied).first()["algorithm"] == config.DECISION_TREE


def test_report_averages(spark):
    scores = spark.createDataFrame(
        [(1, 4959, 4056, 0.6669, 0.8179, 0.7347), (0, 2791, 555, 0.4329, 0.1989, 0.2725),
         (2, 3323, 2266, 0.6109, 0.6819, 0.6445)],
        "class_code int, support bigint, hits bigint, precision double, recall double, "
        "f1_score double")
    rows = [tuple(r) for r in metrics.report_from_scores(
        scores, config.CLASS_ORDER, config.CLASS_NAMES).collect()]
    assert rows[3][0] == "accuracy" and rows[3][1:] == pytest.approx([0.6211] * 4, abs=1e-4)
    assert rows[4][1:] == pytest.approx([0.5702, 0.5662, 0.5506, 11073], abs=1e-4)
    assert rows[5][1:] == pytest.approx([0.5911, 0.6211, 0.5911, 11073], abs=1e-4)
