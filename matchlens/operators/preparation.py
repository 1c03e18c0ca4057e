"""From the raw match table to the modelling frame. Every step is narrow: no exchange."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens import config
from matchlens.functions import text
from matchlens.functions.outcome import home_minus_away, implied_probabilities, outcome_code
from matchlens.operators.profile import retention_funnel


def add_label(df: DataFrame, label: str = config.LABEL) -> DataFrame:
    return df.withColumn(label, outcome_code())


def add_derived_features(df: DataFrame) -> DataFrame:
    """Implied probabilities and home-minus-away differences."""
    return df.withColumns({**implied_probabilities(),
                           **home_minus_away("shots", "shots_target", "corners")})


def complete_cases(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(required))


def drop_non_finite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Treat NaN and infinity as missing and drop every row that misses one of the columns."""
    kinds = dict(df.dtypes)
    return df.filter(_usable(columns, kinds))


def _usable(columns: Sequence[str], kinds: Mapping[str, str]) -> Column:
    """NULL and NaN fail the comparison as infinity does: NaN sorts above every number."""
    return F.expr(" AND ".join(
        f"abs({text.name(c)}) < double('infinity')" if kinds[c] in ("double", "float")
        else f"{text.name(c)} IS NOT NULL" for c in columns))


def check_no_leakage(features: Sequence[str],
                     forbidden: Sequence[str] = config.GOAL_COLUMNS + config.NON_FEATURE_COLUMNS,
                     ) -> None:
    """Refuse features that give the label away or only identify the row."""
    leaked = sorted(set(features) & set(forbidden))
    if leaked:
        raise ValueError(f"columns must not be used as features: {', '.join(leaked)}")


def modelling_frame(raw: DataFrame, required: Sequence[str] = config.REQUIRED_COLUMNS,
                    features: Sequence[str] = config.FEATURE_COLUMNS,
                    label: str = config.LABEL, keys: Sequence[str] = ()) -> DataFrame:
    """Label, complete cases, derived features, projection, non-finite scrub.

    ``keys`` are carried along for splits; they are not features.
    """
    check_no_leakage(features)
    kept = (*features, label)
    return (raw.transform(lambda df: add_label(df, label))
            .transform(lambda df: complete_cases(df, required))
            .transform(add_derived_features)
            .select(*keys, *kept)
            .transform(lambda df: drop_non_finite(df, kept)))


def match_retention(raw: DataFrame, required: Sequence[str] = config.REQUIRED_COLUMNS,
                    features: Sequence[str] = config.FEATURE_COLUMNS) -> DataFrame:
    """The retention funnel of the modelling frame, counted in one pass over the raw table."""
    prepared = raw.transform(add_label).transform(add_derived_features)
    complete = F.expr(" AND ".join(f"{text.name(c)} IS NOT NULL" for c in required))
    return retention_funnel(prepared, complete, _usable(features, dict(prepared.dtypes)),
                            len(features))
