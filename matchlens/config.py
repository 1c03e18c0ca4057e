"""Column groups, labels and constants of the match schema.

Operators take column names as parameters; the lists here are only their defaults.
"""

from __future__ import annotations

# Modelling constants
SEED = 42
TEST_SHARE = 0.20
CV_FOLDS = 5
TOP_K = 10

# Label column, class codes in report order, class names
LABEL = "result"
CLASS_ORDER = (1, 0, 2)
MODEL_CLASSES = (0, 1, 2)
CLASS_NAMES = {1: "Ev Sahibi Galibiyeti", 0: "Beraberlik", 2: "Deplasman Galibiyeti"}
CLASS_SHORT_NAMES = {1: "Ev (1)", 0: "Beraberlik (0)", 2: "Deplasman (2)"}

# Raw table, in file order
STRING_COLUMNS = ("date", "league", "home_team", "away_team", "referee", "season", "source")
RAW_COLUMNS = (
    "date", "league", "home_team", "away_team",
    "home_goals", "away_goals", "ht_home_goals", "ht_away_goals", "referee",
    "odds_home", "odds_draw", "odds_away", "odds_over_25", "odds_under_25",
    "home_shots", "away_shots", "home_shots_target", "away_shots_target",
    "home_corners", "away_corners", "home_fouls", "away_fouls",
    "home_yellow", "away_yellow", "home_red", "away_red",
    "season", "source",
)

# Column groups
GOAL_COLUMNS = ("home_goals", "away_goals")
NON_FEATURE_COLUMNS = (
    "date", "home_team", "away_team", "referee", "odds_over_25", "odds_under_25",
    "ht_home_goals", "ht_away_goals", "season", "source",
)
ODDS_COLUMNS = ("odds_home", "odds_draw", "odds_away")
STATISTIC_COLUMNS = (
    "home_shots", "away_shots", "home_shots_target", "away_shots_target",
    "home_corners", "away_corners", "home_fouls", "away_fouls",
    "home_yellow", "away_yellow", "home_red", "away_red",
)
DERIVED_COLUMNS = (
    "implied_prob_home", "implied_prob_draw", "implied_prob_away",
    "shots_diff", "shots_target_diff", "corners_diff",
)
REQUIRED_COLUMNS = ODDS_COLUMNS + STATISTIC_COLUMNS
FEATURE_COLUMNS = REQUIRED_COLUMNS + DERIVED_COLUMNS
BOXPLOT_COLUMNS = STATISTIC_COLUMNS[:8]

# The six outlier rows shown in the report
REPORT_OUTLIER_COLUMNS = (
    "home_shots", "away_shots", "home_corners", "away_fouls", "away_red", "odds_home",
)

# Display names of the six models, in comparison order
DECISION_TREE = "Karar Ağacı"
RANDOM_FOREST = "Random Forest"
NAIVE_BAYES = "Naive Bayes"
LOGISTIC_REGRESSION = "Lojistik Regresyon"
NEAREST_NEIGHBOURS = "K-En Yakın Komşu"
GRADIENT_BOOSTING = "Gradient Boosting"
MODEL_NAMES = (DECISION_TREE, RANDOM_FOREST, NAIVE_BAYES, LOGISTIC_REGRESSION,
               NEAREST_NEIGHBOURS, GRADIENT_BOOSTING)

ALL_FEATURES = "all_features"
SELECTED_FEATURES = "selected_features"

ROW_KEY = "match_id"
