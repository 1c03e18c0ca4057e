"""SQL for the registered queries, to be run by another engine over the same tables.

Written independently of the operators wherever that is possible: windows instead of cut points,
``quantile_cont`` instead of interval search, plain pair joins instead of cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from matchlens import config
from matchlens.sources.matches import COLUMN_SQL, LINE_ORDER

_KEY, _LABEL = config.ROW_KEY, config.LABEL
_SIDE_COLUMNS = ("s_name", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_linenumber", "l_partkey", "p_size")


def _sides() -> str:
    parts = []
    for rank, side in ((1, "h"), (2, "a")):
        columns = ", ".join(f"{c} AS {side}_{c}" for c in _SIDE_COLUMNS)
        parts.append(f"{side} AS (SELECT l_orderkey AS {side}_orderkey, {columns} "
                     f"FROM ranked_lines WHERE rn = {rank})")
    return ",\n".join(parts)


_MATCHES = f"""
ranked_lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS rn
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey),
{_sides()},
matches AS (
  SELECT {', '.join(f'{sql} AS "{name}"' for name, sql in COLUMN_SQL.items())}
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN h ON h_orderkey = o_orderkey LEFT JOIN a ON a_orderkey = o_orderkey)"""

_LABELLED = """
labelled AS (
  SELECT *, CASE WHEN home_goals > away_goals THEN 1 WHEN home_goals = away_goals THEN 0
                 ELSE 2 END AS result FROM matches)"""

_DERIVED = """
inverse_odds AS (
  SELECT *, 1e0 / nullif(odds_home, 0) AS ih, 1e0 / nullif(odds_draw, 0) AS idr,
         1e0 / nullif(odds_away, 0) AS ia FROM labelled),
derived AS (
  SELECT *, ih / (ih + idr + ia) AS implied_prob_home, idr / (ih + idr + ia) AS implied_prob_draw,
         ia / (ih + idr + ia) AS implied_prob_away, home_shots - away_shots AS shots_diff,
         home_shots_target - away_shots_target AS shots_target_diff,
         home_corners - away_corners AS corners_diff FROM inverse_odds)"""

_MODELLING = f"""
modelling AS (
  SELECT {_KEY}, {', '.join(config.FEATURE_COLUMNS)}, {_LABEL} FROM derived
  WHERE {' AND '.join(f'{c} IS NOT NULL AND isfinite({c})' for c in config.FEATURE_COLUMNS)})"""

_SPLIT = f"""
class_sizes AS (SELECT {_LABEL}, count(*) AS n FROM modelling GROUP BY {_LABEL}),
wanted AS (SELECT *, CAST(ceil(sum(n) OVER () * 0.2) AS BIGINT) AS w,
                  CAST(sum(n) OVER () AS BIGINT) AS total FROM class_sizes),
remainders AS (SELECT *, (w * n) // total AS base,
                      row_number() OVER (ORDER BY (w * n) % total DESC, {_LABEL}) AS rk FROM wanted),
quotas AS (SELECT {_LABEL}, base + CASE WHEN rk <= w - CAST(sum(base) OVER () AS BIGINT)
                                        THEN 1 ELSE 0 END AS quota FROM remainders),
hash_order AS (SELECT *, row_number() OVER (PARTITION BY {_LABEL}
                 ORDER BY md5(CAST({_KEY} AS VARCHAR)), {_KEY}) AS hash_rank FROM modelling),
split AS (SELECT hash_order.*, hash_rank <= quota AS is_test
          FROM hash_order JOIN quotas USING ({_LABEL})),
train AS (SELECT * FROM split WHERE NOT is_test), test AS (SELECT * FROM split WHERE is_test)"""

_EMBEDDING_SPLIT = (
    _SPLIT.replace(_LABEL, "label").replace(_KEY, "vec_id").replace("modelling", "embeddings"))


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_M = _with(_MATCHES)
_L = _with(_MATCHES, _LABELLED)
_D = _with(_MATCHES, _LABELLED, _DERIVED)
_F = _with(_MATCHES, _LABELLED, _DERIVED, _MODELLING)
_S = _with(_MATCHES, _LABELLED, _DERIVED, _MODELLING, _SPLIT)


def _round(expression: str, digits: int) -> str:
    return f"round_even(({expression}) * 1e{digits}, 0) / 1e{digits} + 0e0"


def _union(selects) -> str:
    return "\nUNION ALL\n".join(selects)


def _names(table: dict[int, str], column: str = "result") -> str:
    return "CASE " + column + " " + " ".join(
        f"WHEN {code} THEN '{name}'" for code, name in table.items()) + " END"


def _null_pct(column: str) -> str:
    return _round(f"100e0 * count(*) FILTER ({column} IS NULL) / count(*)", 2)


def _missing(prefix: str, source: str, columns) -> str:
    rows = _union(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, "
                  f"{_null_pct(c)} AS null_pct FROM {source}" for c in columns)
    return f"{prefix}, report AS ({rows})"


def _severity(report: str) -> str:
    return (f"{report} SELECT *, CASE WHEN null_pct > 50 THEN 'high' WHEN null_pct > 20 "
            "THEN 'medium' ELSE 'low' END AS severity FROM report WHERE null_pct > 0")


def _profile(prefix: str, source: str, types: dict[str, str]) -> str:
    return prefix + _union(
        f"SELECT '{c}' AS column_name, '{kind}' AS data_type, count({c}) AS non_null_count, "
        f"count(*) - count({c}) AS null_count, {_null_pct(c)} AS null_pct, "
        f"count(DISTINCT {c}) AS distinct_count FROM {source}" for c, kind in types.items())


def _fences(column: str, source: str) -> str:
    return (f"(SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi, q1, q2, q3 FROM "
            f"(SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS q2, "
            f"quantile_cont({column}, 0.75) AS q3 FROM {source}))")


def _outliers(prefix: str, source: str, columns) -> str:
    return prefix + _union(
        f"SELECT '{c}' AS column_name, {_round('any_value(lo)', 2)} AS lower_fence, "
        f"{_round('any_value(hi)', 2)} AS upper_fence, "
        f"count(*) FILTER ({c} < lo OR {c} > hi) AS outlier_count, "
        f"{_round(f'100e0 * count(*) FILTER ({c} < lo OR {c} > hi) / count({c})', 2)} "
        f"AS outlier_pct FROM {source}, {_fences(c, source)}" for c in columns)


def _boxplot(prefix: str, source: str, columns) -> str:
    return prefix + _union(
        f"SELECT '{c}' AS column_name, {_round('any_value(q1)', 4)} AS q1, "
        f"{_round('any_value(q2)', 4)} AS median, {_round('any_value(q3)', 4)} AS q3, "
        f"{_round(f'min({c}) FILTER ({c} BETWEEN lo AND hi)', 4)} AS whisker_low, "
        f"{_round(f'max({c}) FILTER ({c} BETWEEN lo AND hi)', 4)} AS whisker_high, "
        f"count(*) FILTER ({c} < lo OR {c} > hi) AS flier_count "
        f"FROM {source}, {_fences(c, source)}" for c in columns)


def _describe(prefix: str, source: str, columns) -> str:
    def row(c):
        measures = {"count": f"count({c})", "mean": f"avg({c})", "std": f"stddev_samp({c})",
                    "min": f"min({c})", "p25": f"quantile_cont({c}, 0.25)",
                    "p50": f"quantile_cont({c}, 0.5)", "p75": f"quantile_cont({c}, 0.75)",
                    "max": f"max({c})"}
        return (f"SELECT '{c}' AS column_name, " + ", ".join(
            f'{_round(sql, 3)} AS "{name}"' for name, sql in measures.items()) + f" FROM {source}")
    return prefix + _union(row(c) for c in columns)


def _correlation(prefix: str, source: str, columns) -> str:
    return prefix + _union(
        f"SELECT '{a}' AS row_name, '{b}' AS column_name, {_round(f'corr({a}, {b})', 6)} AS r "
        f"FROM {source}" for i, a in enumerate(columns) for b in columns[:i])


def _anova(values: str, source: str) -> str:
    """``source`` has feature, class_code and v."""
    return f"""{values},
    grand AS (SELECT feature, avg(v) AS m, count(v) AS n, count(DISTINCT class_code) AS k
              FROM {source} GROUP BY feature),
    per_class AS (SELECT feature, class_code, avg(v) AS cm, count(v) AS cn
                  FROM {source} GROUP BY feature, class_code),
    between_ AS (SELECT feature, sum(cn * (cm - m) * (cm - m)) AS ssb
                 FROM per_class JOIN grand USING (feature) GROUP BY feature),
    within_ AS (SELECT feature, sum((v - cm) * (v - cm)) AS ssw
                FROM {source} JOIN per_class USING (feature, class_code) GROUP BY feature),
    scores AS (SELECT feature, (ssb / (k - 1)) / nullif(ssw / (n - k), 0) AS anova_f
               FROM between_ JOIN within_ USING (feature) JOIN grand USING (feature))"""


_LONG = (f", long AS (SELECT feature, {_LABEL} AS class_code, v FROM (UNPIVOT modelling ON "
         f"{', '.join(config.FEATURE_COLUMNS)} INTO NAME feature VALUE v))")
_ANOVA = _anova(_F + _LONG, "long")
_EMBEDDING_LONG = ("WITH long AS (SELECT CAST(i - 1 AS VARCHAR) AS feature, label AS class_code, "
                   "CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) AS r(i))")

_RANKING = f"""{_ANOVA},
    strength AS (SELECT feature, abs(corr(v, class_code)) AS label_corr FROM long GROUP BY feature),
    both_ AS (SELECT feature, anova_f, label_corr,
        (anova_f - min(anova_f) OVER ()) / (max(anova_f) OVER () - min(anova_f) OVER ()) AS anova_norm,
        (label_corr - min(label_corr) OVER ()) / (max(label_corr) OVER () - min(label_corr) OVER ())
          AS corr_norm FROM scores JOIN strength USING (feature)),
    ranking AS (SELECT *, (anova_norm + corr_norm) / 2 AS combined_score FROM both_),
    placed AS (SELECT *, CAST(row_number() OVER (ORDER BY combined_score DESC, feature) AS INTEGER)
                 AS place FROM ranking)"""


def _naive_bayes(prefix: str, key: str, label: str, train: str, test: str) -> str:
    """``train`` and ``test`` are long: key, class_code, feature, v."""
    return f"""{prefix},
    scaling AS (SELECT feature, avg(v) AS m, stddev_samp(v) AS s FROM {train} GROUP BY feature),
    z_train AS (SELECT class_code, feature, CASE WHEN s > 0 THEN (v - m) / s ELSE 0 END AS z
                FROM {train} JOIN scaling USING (feature)),
    z_test AS (SELECT row_key, class_code AS actual, feature,
                      CASE WHEN s > 0 THEN (v - m) / s ELSE 0 END AS z
               FROM {test} JOIN scaling USING (feature)),
    smoothing AS (SELECT 1e-9 * max(vp) AS eps FROM
                  (SELECT var_pop(z) AS vp FROM z_train GROUP BY feature)),
    shape AS (SELECT class_code, feature, avg(z) AS cm, var_pop(z) + any_value(eps) AS cv,
                     count(*) AS n FROM z_train, smoothing GROUP BY class_code, feature),
    prior AS (SELECT class_code, ln(n / sum(n) OVER ()) AS lp
              FROM (SELECT class_code, any_value(n) AS n FROM shape GROUP BY class_code)),
    likelihood AS (SELECT row_key, actual, shape.class_code,
                          sum(-0.5 * (ln(2 * pi() * cv) + (z - cm) * (z - cm) / cv)) + any_value(lp) AS ll
                   FROM z_test JOIN shape USING (feature)
                   JOIN prior ON prior.class_code = shape.class_code
                   GROUP BY row_key, actual, shape.class_code)
    SELECT row_key AS {key}, any_value(actual) AS {label},
           CAST(arg_max(class_code, ll) AS INTEGER) AS prediction
    FROM likelihood GROUP BY row_key"""


def _match_long(source: str) -> str:
    return (f"{source}_long AS (SELECT {_KEY} AS row_key, {_LABEL} AS class_code, feature, v FROM "
            f"(UNPIVOT {source} ON {', '.join(config.FEATURE_COLUMNS)} INTO NAME feature VALUE v))")


def _embedding_long(source: str) -> str:
    return (f"{source}_long AS (SELECT vec_id AS row_key, label AS class_code, i AS feature, "
            f"CAST(embedding[i] AS DOUBLE) AS v FROM {source}, range(1, 65) AS r(i))")


def _neighbours(prefix: str, key: str, label: str, features: dict[str, str]) -> str:
    """Every pair of test and training row, then the 25 nearest of each test row."""
    wide = ", ".join(f"{sql} AS {name}" for name, sql in features.items())
    weights = ", ".join(f"1 / var_pop({name}) AS w_{name}" for name in features)
    distance = " + ".join(f"(q.{n} - t.{n}) * (q.{n} - t.{n}) * w_{n}" for n in features)
    return f"""{prefix},
    known AS (SELECT {key} AS row_key, {label} AS class_code, {wide} FROM train),
    asked AS (SELECT {key} AS row_key, {label} AS actual, {wide} FROM test),
    weights AS (SELECT {weights} FROM known),
    pairs AS (SELECT q.row_key, q.actual, t.class_code, row_number() OVER (
                PARTITION BY q.row_key ORDER BY {distance}, t.row_key) AS place
              FROM asked q, known t, weights QUALIFY place <= 25),
    votes AS (SELECT row_key, any_value(actual) AS actual, class_code, count(*) AS n
              FROM pairs GROUP BY row_key, class_code)
    SELECT row_key AS {key}, any_value(actual) AS {label},
           CAST(arg_min(class_code, class_code - n * 1000) AS INTEGER) AS prediction
    FROM votes GROUP BY row_key"""


def _tree(prefix: str, key: str, label: str, features: Sequence[str], depth: int) -> str:
    """A tree level by level: counts of every value, all cuts, the best one per node."""
    width, classes = len(features), config.MODEL_CLASSES
    columns = ", ".join(f"CAST({f} AS DOUBLE)" for f in features)
    left = [f"l{c}" for c in classes]
    right = [f"(t{c} - l{c})" for c in classes]

    def purity(counts):
        squares = " + ".join(f"{c} * {c}" for c in counts)
        return f"CAST({squares} AS DOUBLE) / CAST({' + '.join(counts)} AS DOUBLE)"

    parts = [f"""{prefix},
    rows0 AS (SELECT {label} AS label, [{columns}] AS x, CAST(1 AS BIGINT) AS node FROM train)"""]
    for d in range(depth):
        running = ", ".join(f"sum(n{c}) OVER (PARTITION BY node, feature ORDER BY value) AS l{c}, "
                            f"sum(n{c}) OVER (PARTITION BY node, feature) AS t{c}" for c in classes)
        tallies = ", ".join(f"count(*) FILTER (label = {c}) AS n{c}" for c in classes)
        impure = " + ".join(f"CAST(t{c} > 0 AS INTEGER)" for c in classes)
        parts.append(f"""
    counts{d} AS (SELECT node, feature, x[feature] AS value, {tallies}
                  FROM rows{d}, range(1, {width + 1}) AS r(feature) GROUP BY ALL),
    sums{d} AS (SELECT *, {running}, lead(value) OVER (PARTITION BY node, feature
                ORDER BY value) AS beyond FROM counts{d}),
    cuts{d} AS MATERIALIZED (SELECT node, feature, CASE WHEN value / 2 + beyond / 2 < beyond
                  THEN value / 2 + beyond / 2 ELSE value END AS threshold FROM sums{d}
                  WHERE beyond IS NOT NULL AND {impure} > 1
                  QUALIFY row_number() OVER (PARTITION BY node ORDER BY
                    {purity(left)} + {purity(right)} DESC, feature, value) = 1),
    rows{d + 1} AS MATERIALIZED (SELECT label, x,
                  2 * node + CAST(x[feature] > threshold AS BIGINT) AS node
                  FROM rows{d} JOIN cuts{d} USING (node))""")
    counted = _union(f"SELECT node, label, count(*) AS n FROM rows{d} GROUP BY ALL"
                     for d in range(depth + 1))
    parts.append(f"""
    leaves AS (SELECT node, CAST(arg_max(label, n * 1000 - label) AS INTEGER) AS prediction
               FROM ({counted}) GROUP BY node),
    asked0 AS (SELECT {key} AS row_key, {label} AS actual, [{columns}] AS x,
                      CAST(1 AS BIGINT) AS node FROM test)""")
    for d in range(depth):
        parts.append(f"""
    asked{d + 1} AS (SELECT row_key, actual, x, CASE WHEN feature IS NULL THEN a.node
                     ELSE 2 * a.node + CAST(x[feature] > threshold AS BIGINT) END AS node
                     FROM asked{d} a LEFT JOIN cuts{d} c ON c.node = a.node)""")
    return ",".join(parts) + f"""
    SELECT row_key AS {key}, actual AS {label}, prediction FROM asked{depth} JOIN leaves
    USING (node)"""


_DENSITY = f"""{_F},
    shape AS (SELECT {_LABEL} AS class_code, count(*) AS n, min(implied_prob_home) AS lo,
                     max(implied_prob_home) AS hi,
                     stddev_samp(implied_prob_home) * pow(count(*), -0.2) AS h
              FROM modelling GROUP BY {_LABEL}),
    grid AS (SELECT class_code, n, h, CAST(i AS INTEGER) AS grid_index,
                    lo - 3 * h + i * ((hi + 3 * h) - (lo - 3 * h)) / 199 AS x
             FROM shape, range(0, 200) AS r(i))
    SELECT class_code, grid_index, {_round('any_value(x)', 6)} AS x,
           {_round('sum(exp(-0.5 * ((x - implied_prob_home) / h) * ((x - implied_prob_home) / h)))'
                   ' / (any_value(n) * any_value(h) * sqrt(2 * pi()))', 6)} AS density
    FROM grid JOIN modelling ON {_LABEL} = class_code GROUP BY class_code, grid_index"""

_CONFUSION = f"""{_F},
    predicted AS (SELECT {_LABEL} AS actual, CASE WHEN shots_diff > 0 THEN 1
                         WHEN shots_diff = 0 THEN 0 ELSE 2 END AS predicted FROM modelling),
    codes AS (SELECT * FROM (VALUES (1), (0), (2)) AS c(code)),
    confusion AS (SELECT a.code AS actual, p.code AS predicted, count(m.actual) AS row_count
                  FROM codes a CROSS JOIN codes p
                  LEFT JOIN predicted m ON m.actual = a.code AND m.predicted = p.code
                  GROUP BY a.code, p.code),
    class_scores AS (
      SELECT code, CAST((SELECT sum(row_count) FROM confusion WHERE actual = code) AS DOUBLE) AS support,
             (SELECT sum(row_count) FROM confusion WHERE predicted = code) AS claimed,
             (SELECT sum(row_count) FROM confusion WHERE actual = code AND predicted = code) AS hits
      FROM codes),
    rates AS (SELECT *, coalesce(hits / nullif(claimed, 0), 0) AS pr,
                     coalesce(hits / nullif(support, 0), 0) AS rc,
                     coalesce(2 * hits / nullif(claimed + support, 0), 0) AS f1 FROM class_scores)"""

_REPORT = _CONFUSION + " " + _union([
    f"SELECT {_names(config.CLASS_NAMES, 'code')} AS class_label, {_round('pr', 4)} AS precision, "
    f"{_round('rc', 4)} AS recall, {_round('f1', 4)} AS f1_score, support FROM rates",
    "SELECT 'accuracy', v, v, v, v FROM (SELECT "
    f"{_round('sum(hits) / sum(support)', 4)} AS v FROM rates)",
    f"SELECT 'macro avg', {_round('avg(pr)', 4)}, {_round('avg(rc)', 4)}, {_round('avg(f1)', 4)}, "
    "sum(support) FROM rates",
    "SELECT 'weighted avg', " + ", ".join(
        _round(f"sum({m} * support) / sum(support)", 4) for m in ("pr", "rc", "f1"))
    + ", sum(support) FROM rates"])

_RULES = f"""{_F},
    rule_accuracy AS ({_union(
        f"SELECT '{feature_set}' AS feature_set, '{s}' AS algorithm, " + _round(
            f"avg(CASE WHEN {_LABEL} = CASE WHEN {s} > 0 THEN 1 WHEN {s} = 0 THEN {code} "
            "ELSE 2 END THEN 1e0 ELSE 0e0 END)", 4) + " AS accuracy FROM modelling"
        for feature_set, code in ((config.ALL_FEATURES, 0), (config.SELECTED_FEATURES, 2))
        for s in ("shots_diff", "shots_target_diff", "corners_diff"))})"""

_FOLDS = f"""{_F},
    sizes AS (SELECT {_LABEL}, count(*) AS n FROM modelling GROUP BY {_LABEL}),
    starts AS (SELECT *, CAST(sum(n) OVER (ORDER BY {_LABEL}) - n AS BIGINT) AS start FROM sizes),
    dealt AS (SELECT {_LABEL}, f AS fold, count(*) AS taken
              FROM (SELECT {_LABEL}, unnest(range(start, start + n)) % 5 AS f FROM starts)
              GROUP BY {_LABEL}, f),
    ends AS (SELECT *, sum(taken) OVER (PARTITION BY {_LABEL} ORDER BY fold) AS upto FROM dealt),
    hash_order AS (SELECT {_KEY}, {_LABEL}, row_number() OVER (PARTITION BY {_LABEL}
                     ORDER BY md5(CAST({_KEY} AS VARCHAR)), {_KEY}) AS hash_rank FROM modelling)
    SELECT {_KEY}, {_LABEL}, CAST(fold AS INTEGER) AS fold FROM hash_order JOIN ends USING ({_LABEL})
    WHERE hash_rank <= upto AND hash_rank > upto - taken"""

_DIFFERENCES = ", ".join(f"'{c}'" for c in config.FEATURE_COLUMNS if c.endswith("_diff"))
_FOLD_ACCURACY = f"""{_FOLDS.replace(f"SELECT {_KEY}, {_LABEL}, CAST(fold AS INTEGER)",
                                     f", folded AS (SELECT {_KEY}, CAST(fold AS INTEGER)")}),
    sets AS (SELECT '{config.ALL_FEATURES}' AS feature_set UNION ALL SELECT 'differences'),
    long AS MATERIALIZED (SELECT feature_set, fold, {_KEY} AS row_key, {_LABEL} AS class_code,
      feature, v FROM (SELECT * FROM (UNPIVOT modelling ON {', '.join(config.FEATURE_COLUMNS)}
                                      INTO NAME feature VALUE v)) JOIN folded USING ({_KEY}), sets
      WHERE feature_set = '{config.ALL_FEATURES}' OR feature IN ({_DIFFERENCES})),
    held AS (SELECT unnest(range(5)) AS out),
    scaling AS (SELECT feature_set, out, feature, avg(v) AS m, stddev_samp(v) AS s, var_pop(v) AS vp
                FROM long, held WHERE fold <> out GROUP BY ALL),
    smoothing AS (SELECT feature_set, out, 1e-9 * max(vp / (s * s)) AS eps FROM scaling WHERE s > 0
                  GROUP BY ALL),
    shape AS (SELECT feature_set, out, feature, class_code, avg((v - m) / s) AS cm,
                     var_pop((v - m) / s) + any_value(eps) AS cv, count(*) AS n
              FROM (SELECT * FROM long, held WHERE fold <> out)
              JOIN scaling USING (feature_set, out, feature)
              JOIN smoothing USING (feature_set, out) WHERE s > 0
              GROUP BY feature_set, out, feature, class_code),
    prior AS (SELECT feature_set, out, class_code, ln(any_value(n)) AS lp FROM shape GROUP BY ALL),
    scored AS (SELECT t.feature_set, t.fold, t.row_key, any_value(t.class_code) AS actual,
                      p.class_code, any_value(lp) - 0.5 * sum(ln(2 * pi() * cv)
                        + ((v - m) / s - cm) * ((v - m) / s - cm) / cv) AS ll
               FROM long t JOIN scaling c ON c.feature_set = t.feature_set AND c.out = t.fold
                                         AND c.feature = t.feature
               JOIN shape p ON p.feature_set = t.feature_set AND p.out = t.fold
                           AND p.feature = t.feature
               JOIN prior q ON q.feature_set = t.feature_set AND q.out = t.fold
                           AND q.class_code = p.class_code
               GROUP BY t.feature_set, t.fold, t.row_key, p.class_code),
    voted AS (SELECT feature_set, fold, row_key, any_value(actual) AS actual,
                     arg_max(class_code, ll) AS guess FROM scored GROUP BY ALL),
    fold_accuracy AS (SELECT feature_set, fold, count(*) AS row_count,
                             avg(CASE WHEN guess = actual THEN 1e0 ELSE 0e0 END) AS accuracy
                      FROM voted GROUP BY ALL)"""

_MATCH_TYPES = {_KEY: "bigint"} | {
    c: "string" if c in config.STRING_COLUMNS else "double" for c in config.RAW_COLUMNS}
_DOCUMENT_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string",
                   "n_chars": "bigint", "quality": "int", "toxic": "int"}
_DOCUMENTS = "WITH dl AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))"
_LINE_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_OUTLIER_COLUMNS = config.STATISTIC_COLUMNS + config.ODDS_COLUMNS
_ALL = tuple(_MATCH_TYPES)


def sql() -> dict[str, str]:
    missing = _missing(_M, "matches", _ALL)
    outliers = _outliers(_M + " ", "matches", _OUTLIER_COLUMNS)
    rounded_features = ", ".join(
        f"{_round(c, 6)} AS {c}" if c in config.DERIVED_COLUMNS else c
        for c in config.FEATURE_COLUMNS)
    naive_bayes = _naive_bayes(f"{_S}, {_match_long('train')}, {_match_long('test')}",
                               _KEY, _LABEL, "train_long", "test_long")
    embedding_features = {f"e{i}": f"CAST(embedding[{i + 1}] AS DOUBLE)" for i in range(64)}
    return {
        "matches_class_distribution": f"""{_L}
            SELECT {_LABEL} AS class_code, {_names(config.CLASS_NAMES)} AS class_label,
                   count(*) AS class_count,
                   {_round('100e0 * count(*) / sum(count(*)) OVER ()', 2)} AS class_pct
            FROM labelled GROUP BY {_LABEL}""",
        "majority_baseline": f"""{_L} SELECT {_round('max(n) / sum(n)', 6)} AS baseline_accuracy
            FROM (SELECT count(*) AS n FROM labelled GROUP BY {_LABEL})""",
        "event_type_distribution": """SELECT event_type, count(*) AS row_count FROM events
            GROUP BY event_type ORDER BY row_count DESC, event_type LIMIT 15""",
        "match_rows": f"{_M} SELECT * FROM matches",
        "match_table_shape": f"""{_M} SELECT count(*) AS row_count,
            CAST({len(_ALL)} AS BIGINT) AS column_count FROM matches""",
        "labelled_matches": f"""{_L} SELECT {_KEY}, {_LABEL},
            {_names(config.CLASS_NAMES)} AS class_label,
            {_names(config.CLASS_SHORT_NAMES)} AS class_short FROM labelled""",
        "column_profile": _profile(_M + " ", "matches", _MATCH_TYPES),
        "column_profile_documents": _profile(_DOCUMENTS + " ", "dl", _DOCUMENT_TYPES),
        "missing_report": f"{missing} SELECT * FROM report",
        "result_table_round_trip": f"{missing} SELECT * FROM report",
        "missing_severity": _severity(missing),
        "missing_severity_documents": _severity(_missing(_DOCUMENTS, "dl", _DOCUMENT_TYPES)),
        "worst_missing": f"""{missing} SELECT * FROM report WHERE null_pct > 0
            ORDER BY null_pct DESC, column_name LIMIT 8""",
        "iqr_outliers": outliers,
        "iqr_outliers_lineitem": _outliers("", "lineitem", _LINE_MEASURES),
        "selected_outliers": f"""SELECT * FROM ({outliers}) WHERE column_name IN
            ({', '.join(f"'{c}'" for c in config.REPORT_OUTLIER_COLUMNS)})""",
        "boxplot_stats": _boxplot(_M + " ", "matches", config.BOXPLOT_COLUMNS),
        "boxplot_stats_lineitem": _boxplot("", "lineitem", _LINE_MEASURES),
        "describe_features": _describe(_F + " ", "modelling", config.FEATURE_COLUMNS),
        "describe_lineitem": _describe("", "lineitem", _LINE_MEASURES),
        "describe_events": _describe("", "events", ("value",)),
        "top_leagues": f"""{_M} SELECT league, count(*) AS row_count FROM matches
            WHERE league IS NOT NULL GROUP BY league ORDER BY row_count DESC, league LIMIT 15""",
        "correlation_lower": _correlation(_F + " ", "modelling",
                                          (*config.FEATURE_COLUMNS, _LABEL)),
        "correlation_pairwise_odds": _correlation(_M + " ", "matches",
                                                  config.ODDS_COLUMNS + config.GOAL_COLUMNS),
        "correlation_lineitem": _correlation("", "lineitem", _LINE_MEASURES),
        "implied_prob_density": _DENSITY,
        "engineered_features": f"""{_D} SELECT {_KEY},
            {', '.join(f'{_round(c, 6)} AS {c}' for c in config.DERIVED_COLUMNS)} FROM derived""",
        "complete_cases": f"""{_M} SELECT {_KEY}, league, season FROM matches
            WHERE {' AND '.join(f'{c} IS NOT NULL' for c in config.REQUIRED_COLUMNS)}""",
        "modelling_frame": f"{_F} SELECT {_KEY}, {rounded_features}, {_LABEL} FROM modelling",
        "retention_funnel": f"""{_F}, complete AS (SELECT count(*) AS n FROM matches
              WHERE {' AND '.join(f'{c} IS NOT NULL' for c in config.REQUIRED_COLUMNS)})
            SELECT s.n AS start_rows, complete.n AS complete_rows,
                   {_round('100e0 * complete.n / s.n', 1)} AS complete_pct,
                   s.n - complete.n AS dropped_rows, k.n AS final_rows,
                   CAST({len(config.FEATURE_COLUMNS)} AS BIGINT) AS feature_count
            FROM complete, (SELECT count(*) AS n FROM matches) s,
                 (SELECT count(*) AS n FROM modelling) k""",
        "scaled_features": f"{_F} SELECT {_KEY}, " + ", ".join(
            _round(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()", 6) + f" AS {c}"
            for c in config.FEATURE_COLUMNS) + f", {_LABEL} FROM modelling",
        "anova_f_scores": f"{_ANOVA} SELECT feature, {_round('anova_f', 6)} AS anova_f FROM scores",
        "anova_f_embeddings": _anova(_EMBEDDING_LONG, "long")
        + f" SELECT feature, {_round('anova_f', 6)} AS anova_f FROM scores",
        "minmax_ranking": f"{_RANKING} SELECT feature, " + ", ".join(
            f"{_round(c, 6)} AS {c}" for c in ("anova_f", "label_corr", "anova_norm", "corr_norm",
                                              "combined_score")) + " FROM ranking",
        "top_k_features": f"{_RANKING} SELECT feature FROM placed WHERE place <= {config.TOP_K}",
        "selected_flags": f"""{_RANKING} SELECT feature, place,
            place <= {config.TOP_K} AS is_selected FROM placed""",
        "stratified_split": f"{_S} SELECT {_KEY}, {_LABEL}, is_test FROM split",
        "stratified_split_counts": f"""{_S} SELECT {_LABEL}, is_test, count(*) AS row_count
            FROM split GROUP BY {_LABEL}, is_test""",
        "stratified_split_embeddings": f"""{_with(_EMBEDDING_SPLIT)}
            SELECT vec_id, label, is_test FROM split""",
        "stratified_folds": _FOLDS,
        "naive_bayes_folds": f"""{_FOLD_ACCURACY} SELECT feature_set, fold, row_count,
            {_round('accuracy', 9)} AS accuracy FROM fold_accuracy""",
        "naive_bayes_cv": f"""{_FOLD_ACCURACY} SELECT feature_set,
            {_round('avg(accuracy)', 9)} AS cv_mean, {_round('stddev_pop(accuracy)', 9)} AS cv_std
            FROM fold_accuracy GROUP BY feature_set""",
        "hashed_split": f"""{_F} SELECT {_KEY},
            CAST('0x' || substr(md5(CAST({_KEY} AS VARCHAR)), 1, 8) AS BIGINT)
              < {int(config.TEST_SHARE * 16 ** 8)} AS is_test FROM modelling""",
        "gaussian_nb_predictions": naive_bayes,
        "tree_predictions": _tree(_S, _KEY, _LABEL, config.FEATURE_COLUMNS, 12),
        # The loss has one optimum, where every derivative is 0.
        "logistic_certificate": f"""SELECT unnest({list(config.MODEL_CLASSES)}) AS class_code,
            feature, 0e0 AS gradient
            FROM (SELECT unnest({[*config.FEATURE_COLUMNS, '(intercept)']}) AS feature)""",
        "model_round_trip": naive_bayes,
        "knn_predictions": _neighbours(_S, _KEY, _LABEL, {c: c for c in config.FEATURE_COLUMNS}),
        "gaussian_nb_embeddings": _naive_bayes(
            f"{_with(_EMBEDDING_SPLIT)}, {_embedding_long('train')}, {_embedding_long('test')}",
            "vec_id", "label", "train_long", "test_long"),
        "knn_embeddings": _neighbours(_with(_EMBEDDING_SPLIT), "vec_id", "label",
                                      embedding_features),
        "confusion_matrix": f"""{_CONFUSION} SELECT actual, predicted, row_count,
            {_round('row_count / sum(row_count) OVER (PARTITION BY actual)', 4)} AS row_share
            FROM confusion""",
        "classification_report": _REPORT,
        "overall_scores": f"""{_CONFUSION} SELECT {_round('sum(hits) / sum(support)', 6)} AS accuracy,
            {_round('avg(f1)', 6)} AS macro_f1 FROM rates""",
        "rule_accuracy_pivot": f"""{_RULES}
            SELECT algorithm, s.accuracy AS selected_features, a.accuracy AS all_features,
                   {_round('a.accuracy - s.accuracy', 4)} AS diff
            FROM rule_accuracy a JOIN rule_accuracy s USING (algorithm)
            WHERE a.feature_set = '{config.ALL_FEATURES}'
              AND s.feature_set = '{config.SELECTED_FEATURES}'""",
        "best_rule": f"""{_RULES} SELECT feature_set, algorithm, accuracy FROM rule_accuracy
            WHERE feature_set = '{config.ALL_FEATURES}'
            ORDER BY accuracy DESC, CASE algorithm WHEN 'shots_diff' THEN 1
              WHEN 'shots_target_diff' THEN 2 ELSE 3 END LIMIT 1""",
        "csv_round_trip": f"{_M} SELECT * FROM matches",
        # the season is a year, written with digits alone
        "csv_inferred": f"{_M} SELECT * REPLACE (CAST(season AS BIGINT) AS season) FROM matches",
        "csv_inferred_types": """SELECT column_name, CASE
            WHEN column_type IN ('BIGINT', 'INTEGER') THEN 'bigint'
            WHEN column_type = 'DOUBLE' THEN 'double' ELSE 'string' END AS data_type
            FROM (DESCRIBE orders)""",
    }
