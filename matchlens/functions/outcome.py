"""Derived label and features of one match."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchlens.functions.numeric import ratio


def outcome_code(home: str = "home_goals", away: str = "away_goals") -> Column:
    """1 home win, 0 draw, 2 otherwise. A missing goal count falls into the last branch."""
    home_goals, away_goals = F.col(home), F.col(away)
    return F.when(home_goals > away_goals, 1).when(home_goals == away_goals, 0).otherwise(2)


def class_name(code: Column | str, names: Mapping[int, str]) -> Column:
    """Look the class code up in a literal map; unknown codes become NULL."""
    code = F.col(code) if isinstance(code, str) else code
    entries = [F.lit(item) for item in chain.from_iterable(names.items())]
    return F.try_element_at(F.create_map(*entries), code.cast("int"))


def implied_probabilities(home: str = "odds_home", draw: str = "odds_draw",
                          away: str = "odds_away") -> dict[str, Column]:
    """Inverse odds over their sum, which removes the bookmaker's margin.

    A zero odd has no inverse: all three probabilities of that row are NULL, and the
    modelling frame later drops the row.
    """
    inverse = {name: F.try_divide(F.lit(1.0), F.col(odd))
               for name, odd in (("home", home), ("draw", draw), ("away", away))}
    overround = inverse["home"] + inverse["draw"] + inverse["away"]
    return {f"implied_prob_{name}": ratio(part, overround) for name, part in inverse.items()}


def home_minus_away(*statistics: str) -> dict[str, Column]:
    """One ``<statistic>_diff`` column per ``home_<statistic>`` / ``away_<statistic>`` pair."""
    return {f"{s}_diff": F.col(f"home_{s}") - F.col(f"away_{s}") for s in statistics}
