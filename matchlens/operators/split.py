"""Stratified hold-out split and cross-validation folds.

Rows are ordered within their class by the md5 of their key. A part of the split is a range of
that order, so it is enough to know the hashes at the cut points. These are found by counting
hash prefixes: no class is ever sorted as a whole, and the split itself is a row-wise comparison
with literals that moves no data.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlens import config
from matchlens.functions import text
from matchlens.functions.ordering import key_hash, key_text

SORT_ROWS = 1_000_000
PREFIX_STEP = 3
MAX_CLASSES = 1_000


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    rows = (df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
            .limit(MAX_CLASSES + 1).collect())
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return {row[label]: row["rows"] for row in sorted(rows, key=lambda r: r[label])}


def test_quotas(counts: Mapping[int, int], share: float = config.TEST_SHARE) -> dict[int, int]:
    """Test rows per class: the total is rounded up, leftovers go to the largest remainders."""
    total = sum(counts.values())
    wanted = math.ceil(Fraction(str(share)) * total)
    exact = {c: Fraction(wanted * n, total) for c, n in counts.items()}
    quotas = {c: math.floor(x) for c, x in exact.items()}
    by_remainder = sorted(exact, key=lambda c: (quotas[c] - exact[c], c))
    for c in by_remainder[:wanted - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


def fold_sizes(counts: Mapping[int, int], folds: int) -> dict[int, list[int]]:
    """Validation rows per class and fold.

    The rows sorted by class are dealt to the folds in turn, so fold sizes differ by at most one
    both overall and within a class.
    """
    sizes, start = {}, 0
    for c, n in sorted(counts.items()):
        sizes[c] = [len(range(start + (fold - start) % folds, start + n, folds))
                    for fold in range(folds)]
        start += n
    return sizes


def cut_points(df: DataFrame, label: str, ranks: Mapping[int, Sequence[int]],
               keys: Sequence[str], sort_rows: int = SORT_ROWS,
               ) -> dict[tuple[int, int], tuple[str, str]]:
    """Hash and key text of the row with each wanted 1-based rank of each class."""
    hashed = df.select(F.col(label).alias("class_code"), key_hash(keys).alias("hash"),
                       key_text(keys).alias("key"))
    # target -> (hash prefix that holds it, rank inside that prefix, rows of that prefix)
    place = {(c, r): ("", r, None) for c, wanted in ranks.items() for r in wanted}
    width = 0
    while any(rows is None or rows > sort_rows for _, _, rows in place.values()) and width < 30:
        held = {(c, place[c, r][0]) for c, r in place}
        width += PREFIX_STEP
        prefix = F.substring("hash", 1, width)
        counted = (hashed.filter(_within(held))
                   .groupBy("class_code", prefix.alias("prefix"))
                   .agg(F.count(F.lit(1)).alias("rows")).collect())
        tally: dict[tuple[int, str], list] = {}
        for row in counted:
            outer = (row["class_code"], row["prefix"][:width - PREFIX_STEP])
            tally.setdefault(outer, []).append((row["prefix"], row["rows"]))
        for target, (outer, rank, _) in place.items():
            for inner, rows in sorted(tally[target[0], outer]):
                if rank <= rows:
                    place[target] = (inner, rank, rows)
                    break
                rank -= rows
    if not place:
        return {}
    held = {(c, place[c, r][0]) for c, r in place}
    order = Window.partitionBy("class_code", "prefix").orderBy("hash", "key")
    wanted = " OR ".join(f"(class_code = {c} AND prefix = '{inner}' AND rank = {rank})"
                         for (c, _), (inner, rank, _) in place.items())
    found = (hashed.filter(_within(held)).withColumn("prefix", F.substring("hash", 1, width))
             .withColumn("rank", F.row_number().over(order)).filter(wanted).collect())
    at = {(row["class_code"], row["prefix"], row["rank"]): (row["hash"], row["key"])
          for row in found}
    return {(c, r): at[c, place[c, r][0], place[c, r][1]] for c, r in place}


def _within(held: set[tuple[int, str]]) -> str:
    """Rows of the given (class, hash prefix) pairs."""
    return " OR ".join(f"(class_code = {c} AND startswith(hash, '{prefix}'))"
                       for c, prefix in sorted(held))


def _up_to(cut: tuple[str, str]) -> str:
    key = text.string(cut[1])
    return f"(row_hash < '{cut[0]}' OR (row_hash = '{cut[0]}' AND row_key <= {key}))"


def _placed(df: DataFrame, keys: Sequence[str], output: str, expression: str) -> DataFrame:
    """Add a column computed from ``row_hash`` and ``row_key``."""
    return (df.withColumns({"row_hash": key_hash(keys), "row_key": key_text(keys)})
            .withColumn(output, F.expr(expression)).drop("row_hash", "row_key"))


def mark_test_rows(df: DataFrame, label: str = config.LABEL,
                   keys: Sequence[str] = (config.ROW_KEY,), share: float = config.TEST_SHARE,
                   sort_rows: int = SORT_ROWS) -> DataFrame:
    """Add ``is_test``, true for an exact stratified share of the rows. ``keys`` must be unique."""
    quotas = test_quotas(class_counts(df, label), share)
    cuts = cut_points(df, label, {c: [q] for c, q in quotas.items() if q}, keys, sort_rows)
    in_test = [f"({text.name(label)} = {c} AND {_up_to(cut)})" for (c, _), cut in cuts.items()]
    return _placed(df, keys, "is_test", " OR ".join(in_test) or "false")


def mark_test_rows_by_hash(df: DataFrame, keys: Sequence[str] = (config.ROW_KEY,),
                           share: float = config.TEST_SHARE) -> DataFrame:
    """Approximate shares without any counting pass: the hash is uniform in every class."""
    bucket = F.conv(F.substring(key_hash(keys), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("is_test", bucket < F.lit(int(share * 16 ** 8)))


def mark_folds(df: DataFrame, label: str = config.LABEL, keys: Sequence[str] = (config.ROW_KEY,),
               folds: int = config.CV_FOLDS, sort_rows: int = SORT_ROWS) -> DataFrame:
    """Add ``fold``: consecutive ranges of each class in hash order. ``keys`` must be unique."""
    sizes = fold_sizes(class_counts(df, label), folds)
    ends = {c: [sum(parts[:i + 1]) for i in range(folds - 1)] for c, parts in sizes.items()}
    cuts = cut_points(df, label, {c: sorted({e for e in wanted if e}) for c, wanted in ends.items()},
                      keys, sort_rows)
    branches = [f"WHEN {text.name(label)} = {c} AND {_up_to(cuts[c, end])} THEN {fold}"
                for c in ends for fold, end in enumerate(ends[c]) if end]
    last = str(folds - 1)
    return _placed(df, keys, "fold", f"CASE {' '.join(branches)} ELSE {last} END"
                   if branches else last)
