"""CSV scan of the raw match table, with a declared schema or with inferred types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens import config
from matchlens.functions import text

# Texts that mean "missing" in a CSV file
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_INTEGER = "^[+-]?[0-9]+$"
_NUMBER = "(?i)^[+-]?([0-9]+[.]?[0-9]*(e[+-]?[0-9]+)?|[.][0-9]+(e[+-]?[0-9]+)?|inf|infinity)$"


def read_matches(spark: SparkSession, path: str,
                 columns: Sequence[str] = config.RAW_COLUMNS,
                 strings: Sequence[str] = config.STRING_COLUMNS,
                 keys: Sequence[str] = ()) -> DataFrame:
    """Read CSV files with a header under a declared schema, without an inference pass.

    Missing-value tokens become NULL in every column. Columns outside ``strings`` and the integer
    ``keys`` are doubles; a token that is no number becomes NULL. The files stay splittable, and
    unused columns are not parsed. Convert a large CSV to parquet once before profiling it.
    """
    fields = ", ".join(f"{text.name(c)} STRING" for c in (*keys, *columns))
    raw = spark.read.schema(fields).csv(path, header=True, enforceSchema=False, encoding="UTF-8")
    return raw.select(*[_typed(c, "bigint" if c in keys else
                               "string" if c in strings else "double").alias(c)
                        for c in (*keys, *columns)])


def infer_types(raw: DataFrame) -> dict[str, str]:
    """``bigint``, ``double`` or ``string`` for each text column, in one aggregation.

    A value's kind is empty, integer, number or text, and a column's kind is the greatest of its
    values', so tasks merge a few numbers per column. A column of integers with gaps is double, and
    so is one without any value; integers beyond 64 bits make a column double. A number is written
    with digits, at most one point and an exponent, or is an infinity; blanks around it do not
    matter.
    """
    if not raw.columns:
        return {}
    measures = []
    for i, c in enumerate(raw.columns):
        kept, value = _kept(c), f"trim({text.name(c)})"
        kind = (f"CASE WHEN {kept} IS NULL THEN 0 "
                f"WHEN {value} RLIKE '{_INTEGER}' AND try_cast({value} AS BIGINT) IS NOT NULL THEN 1 "
                f"WHEN {value} RLIKE '{_NUMBER}' THEN 2 ELSE 3 END")
        measures += [f"max({kind}) AS k{i}", f"min({kind}) AS g{i}"]
    found = raw.selectExpr(*measures).first()
    types = {}
    for i, c in enumerate(raw.columns):
        greatest, least = found[f"k{i}"] or 0, found[f"g{i}"] or 0
        types[c] = "string" if greatest == 3 else "bigint" if greatest == least == 1 else "double"
    return types


def read_inferred(spark: SparkSession, path: str, escape: str = '"') -> DataFrame:
    """Read CSV files with a header; names come from the header, types from all values.

    The missing-value tokens become NULL. The files are read once more for the types and stay
    splittable, so a quoted field must not hold a line break. Without any row, columns are doubles.
    Inside quotes a quote is doubled; ``escape="\\\\"`` reads files that Spark wrote.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False, encoding="UTF-8",
                         escape=escape)
    types = infer_types(raw)
    return raw.select(*[_typed(c, types[c]).alias(c) for c in raw.columns])


def _kept(column: str) -> str:
    tokens = ", ".join(text.string(t) for t in MISSING_TOKENS)
    value = text.name(column)
    return f"CASE WHEN {value} NOT IN ({tokens}) THEN {value} END"


def _typed(column: str, kind: str) -> Column:
    kept = _kept(column)
    return F.expr(kept if kind == "string" else f"try_cast({kept} AS {kind})")
