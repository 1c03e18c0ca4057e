"""Hand-made rows for the corner cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlens import config
from matchlens.operators import correlation, distribution, metrics, outliers, preparation
from matchlens.operators import profile, quantiles, scoring


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def full_match(**changes):
    row = {c: 1.0 for c in config.REQUIRED_COLUMNS + config.GOAL_COLUMNS} | {
        "odds_home": 2.0, "odds_draw": 4.0, "odds_away": 4.0}
    return row | changes


def matches(spark, *rows):
    columns = config.REQUIRED_COLUMNS + config.GOAL_COLUMNS
    return frame(spark, [tuple(r[c] for c in columns) for r in rows],
                 ", ".join(f"{c} double" for c in columns))


def test_label(spark):
    goals = [(2.0, 1.0), (1.0, 1.0), (0.0, 3.0), (None, 1.0), (1.0, None)]
    df = preparation.add_label(frame(spark, goals, "home_goals double, away_goals double"))
    assert [r["result"] for r in df.collect()] == [1, 0, 2, 2, 2]


def test_implied_probabilities(spark):
    row = preparation.add_derived_features(matches(spark, full_match())).first()
    assert [row[c] for c in config.DERIVED_COLUMNS[:3]] == [0.5, 0.25, 0.25]


def test_zero_odds_and_infinite_statistics_leave_the_frame(spark):
    raw = matches(spark, full_match(), full_match(odds_home=0.0),
                  full_match(home_shots=math.inf), full_match(away_red=math.nan),
                  full_match(home_fouls=None))
    derived = preparation.add_derived_features(raw).collect()
    assert derived[1]["implied_prob_home"] is None
    assert preparation.modelling_frame(raw).count() == 1
    funnel = preparation.match_retention(raw).first()
    assert (funnel["start_rows"], funnel["complete_rows"], funnel["final_rows"]) == (5, 4, 1)


def test_leakage_guard():
    preparation.check_no_leakage(config.FEATURE_COLUMNS)
    with pytest.raises(ValueError, match="home_goals"):
        preparation.check_no_leakage(("home_shots", "home_goals"))


def test_outliers(spark):
    df = frame(spark, [(1.0, 0.0, None), (2.0, 0.0, None), (3.0, 0.0, None), (10.0, 0.0, None),
                       (None, 1.0, None)], "a double, b double, c double")
    rows = {r["column_name"]: r for r in
            outliers.iqr_outliers(df, ["a", "b", "c", "absent"]).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert tuple(rows["a"])[1:] == (-2.75, 9.25, 1, 25.0)
    assert tuple(rows["b"])[1:] == (0.0, 0.0, 1, 20.0)
    assert tuple(rows["c"])[1:] == (None, None, 0, None)


@pytest.mark.parametrize("bits", [8, 13, 16])
def test_quantiles_match_numpy(spark, bits):
    generator = np.random.default_rng(7)
    skewed = np.exp(generator.normal(size=3000) * 3)
    crowded = np.where(generator.random(3000) < 0.4, 5.0, generator.integers(0, 50, 3000) * 1.0)
    df = frame(spark, [(float(a), float(b)) for a, b in zip(skewed, crowded)],
               "a double, b double")
    shares = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)
    found = quantiles.exact_quantiles(df, ["a", "b"], shares, bits)
    for column, values in (("a", skewed), ("b", crowded)):
        assert found[column] == pytest.approx(np.quantile(values, shares).tolist(), rel=1e-12)


def test_quantiles_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    df = frame(spark, [(-0.0, None, 1.0, inf), (0.0, None, nan, -inf), (-5e-324, None, -1.0, 1e308),
                       (5e-324, None, -nan, -1e308)], "a double, b double, c double, d double")
    found = quantiles.exact_quantiles(df.repartition(3), "abcd", (0.0, 1 / 3, 2 / 3, 1.0))
    assert found["a"] == [-5e-324, 0.0, 0.0, 5e-324] and found["b"] == [None] * 4
    assert found["c"][:2] == [-1.0, 1.0] and np.isnan(found["c"][2:]).all()
    assert found["d"] == [-inf, -1e308, 1e308, inf]
    assert quantiles.exact_quantiles(df.where("false"), "a", (0.5,)) == {"a": [None]}
    bits = quantiles.ordered_bits(np.array([-inf, -1.5, -0.0, 0.0, 2.5, inf, nan]))
    assert (np.diff(bits.astype(object)) >= 0).all() and bits[2] == bits[3]
    assert [quantiles.double_of(b) for b in bits[[0, 1, 4]]] == [-inf, -1.5, 2.5]


def test_profile_counts_nulls_and_distinct(spark):
    df = frame(spark, [("a", 0.0), ("a", -0.0), (None, 1.5)], "s string, d double")
    for exact in (True, False):
        rows = {r["column_name"]: r for r in profile.column_profile(df, exact).collect()}
        assert tuple(rows["s"])[1:] == ("string", 2, 1, 33.33, 1)
        assert tuple(rows["d"])[1:] == ("double", 3, 0, 0.0, 2)


def test_absent_class(spark):
    df = frame(spark, [(1,), (1,), (2,)], "result int")
    rows = distribution.class_distribution(df).collect()
    assert [(r["class_code"], r["class_count"]) for r in rows] == [(1, 2), (0, None), (2, 1)]


def test_min_max_of_equal_scores(spark):
    df = frame(spark, [("a", 5.0), ("b", 5.0), ("c", 5.0)], "feature string, s double")
    assert {r["n"] for r in scoring.min_max(df, "s", "n").collect()} == {0.0}


def test_zero_k_means_the_default(spark):
    df = frame(spark, [(f"f{i:02}", float(i)) for i in range(21)],
               "feature string, combined_score double")
    assert scoring.top_features(df, 0).count() == scoring.top_features(df).count() == 10
    assert scoring.flag_selected(df, 3).filter("is_selected").count() == 3


def test_constant_feature_has_no_f(spark):
    df = frame(spark, [(1.0, 2.0, 0), (1.0, 3.0, 0), (1.0, 5.0, 1), (1.0, 7.0, 1)],
               "c double, v double, y int")
    rows = {r["feature"]: r["anova_f"] for r in
            scoring.anova_f(scoring.class_moments(df, ["c", "v"], "y")).collect()}
    assert rows["c"] is None
    assert rows["v"] == pytest.approx(12.25 / 1.25)


def test_correlation(spark):
    df = frame(spark, [(1.0, 2.0, 1.0), (2.0, 4.0, 1.0), (3.0, 7.0, 1.0)],
               "a double, b double, c double")
    rows = {(r["row_name"], r["column_name"]): r["r"] for r in
            correlation.lower_triangle(correlation.correlation_matrix(df, ["a", "b", "c"]))
            .collect()}
    assert rows["b", "a"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1])
    assert rows["c", "a"] is None and len(rows) == 3


def test_correlation_of_pairs_with_gaps(spark):
    df = frame(spark, [(1.0, 2.0), (2.0, 4.0), (3.0, 7.0), (None, 100.0), (50.0, None)],
               "a double, b double")
    row = correlation.pairwise_correlation(df, ["a", "b"]).first()
    assert row["r"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1])


def test_class_never_predicted(spark):
    df = frame(spark, [(1, 1.0), (0, 1.0), (2, 2.0)], "result int, prediction double")
    rows = {r["class_label"]: r for r in metrics.classification_report(df).collect()}
    draw = rows[config.CLASS_NAMES[0]]
    assert (draw["precision"], draw["f1_score"], draw["support"]) == (0.0, 0.0, 1.0)
    confusion = metrics.confusion_matrix(df).collect()
    assert len(confusion) == 9 and sum(r["row_count"] for r in confusion) == 3
    assert metrics.accuracy(df).first()[0] == pytest.approx(2 / 3)
    assert metrics.macro_f1(df).first()[0] == pytest.approx((2 / 3 + 0 + 1) / 3)


def test_density_far_from_the_values(spark):
    """Values that reach few grid points; the whole sum is the reference."""
    values = np.concatenate([np.linspace(0, 1, 40_000), [50.0]])
    df = spark.createDataFrame([(1, float(v)) for v in values], "result int, v double")
    rows = distribution.class_density(df, "v").collect()
    width = values.std(ddof=1) * len(values) ** -0.2
    assert len(rows) == 200 and 18 * width < 0.2 * 50
    for r in rows[::7]:
        scaled = (r["x"] - values) / width
        density = np.exp(-0.5 * scaled ** 2).sum() / len(values) / width / np.sqrt(2 * np.pi)
        assert r["density"] == pytest.approx(density, rel=1e-9, abs=1e-15)


def test_density_integrates_to_one(spark):
    df = spark.range(500).select((F.col("id") % 3).cast("int").alias("result"),
                                 (F.sin("id") + 0.001 * F.col("id")).alias("v"))
    rows = distribution.class_density(df, "v").collect()
    assert len(rows) == 600
    for code in (0, 1, 2):
        points = sorted((r["x"], r["density"]) for r in rows if r["class_code"] == code)
        area = np.trapezoid([d for _, d in points], [x for x, _ in points])
        assert area == pytest.approx(1.0, abs=0.01)
