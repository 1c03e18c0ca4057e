"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on a bounded sample of labelled documents. Every path from a root to a
node is a rule, a conjunction of comparisons of statistics. A logistic regression with a lasso
penalty weights the rules and leaves most at zero. The remaining ones become one Spark column
expression, which scores any number of documents in a single pass without an exchange.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens.llm.columns import bounded_batches, id_and_text, pieces_by_bytes, stored

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "upper_share", "digit_share",
    "symbol_share", "pipe_share", "exclaim_share", "stop_share", "comma_share", "other_share",
    "symbol_words", "lone_symbols", "lines_per_word", "repeated_lines", "distinct_words")
TRAIN_ROWS = 20_000
THRESHOLD = 0.7
BATCH_BYTES = 1 << 19
STRETCH = 200  # words among which distinct ones are counted, so that length does not matter
_BLANKS = np.zeros(256, bool)
_BLANKS[list(b" \t\n\x0b\x0c\r")] = True
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#$%&*+/<=>@[\\]^_`{|}~!")] = True


def _class(codes: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(codes)] = True
    return table


_CLASSES = {"upper_share": _class(bytes(range(65, 91))), "digit_share": _class(b"0123456789"),
            "symbol_share": _SYMBOLS, "pipe_share": _class(b"|"), "exclaim_share": _class(b"!"),
            "stop_share": _class(b".?"), "comma_share": _class(b",;:"),
            "other_share": _class(bytes(range(128, 256)))}


def batch_statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The statistics of each text; those of an empty text are 0. Shares are per byte or word."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)  # a blank ends each text
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]

    def total(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return sums[starts + sizes] - sums[starts]

    blank = _BLANKS[data]
    first = ~blank & np.append(True, blank[:-1])
    last = ~blank & np.append(blank[1:], True)
    begin, end = np.flatnonzero(first), np.flatnonzero(last)
    length = (end - begin + 1).astype(np.float64)
    words = total(first)
    owner = np.repeat(np.arange(len(texts)), words)
    symbol = _SYMBOLS[data]
    per_byte, per_word = np.maximum(sizes, 1), np.maximum(words, 1)
    long = np.bincount(owner, length, minlength=len(texts))
    mean = long / per_word
    spread = np.bincount(owner, (length - mean[owner]) ** 2, minlength=len(texts)) / per_word
    lone = symbol[begin] & (length == 1)
    out = {"log_bytes": np.log1p(sizes), "log_words": np.log1p(words), "word_length": mean,
           "word_length_spread": np.sqrt(spread),
           "symbol_words": np.bincount(owner, symbol[end] & ~lone, len(texts)) / per_word,
           "lone_symbols": np.bincount(owner, lone, len(texts)) / per_word,
           "lines_per_word": total(data == 10) / per_word}
    for name, table in _CLASSES.items():
        out[name] = total(table[data]) / per_byte
    repeated, distinct = [], []
    for text in texts:
        lines = [line for line in text.split(b"\n") if line]
        repeated.append(1 - len(set(lines)) / len(lines) if lines else 0.0)
        parts = text.split()
        stretches = [parts[a:a + STRETCH] for a in range(0, len(parts), STRETCH)]
        distinct.append(sum(len(set(s)) for s in stretches) / len(parts) if parts else 0.0)
    out["repeated_lines"], out["distinct_words"] = np.array(repeated), np.array(distinct)
    return {name: np.asarray(out[name], np.float64) for name in STATISTICS}


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the statistics of every whole text, null texts as empty ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_by_bytes(batches, BATCH_BYTES):
            found = batch_statistics(batch.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(found[name]) for name in STATISTICS)],
                names=["doc_id", *STATISTICS])

    schema = "doc_id long, " + ", ".join(f"{name} double" for name in STATISTICS)
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """Statistics between bounds: ``low < statistic <= high`` for each of ``bounds``."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self, prefix: str = "") -> Column:
        tests = []
        for name, low, high in ((prefix + n, *b) for n, *b in self.bounds):
            if low > -math.inf:
                tests.append(F.col(name) > F.lit(low))
            if high < math.inf:
                tests.append(F.col(name) <= F.lit(high))
        return F.when(F.expr("true") if not tests else _all(tests), 1.0).otherwise(0.0)


def _all(tests: list[Column]) -> Column:
    result = tests[0]
    for test in tests[1:]:
        result = result & test
    return result


@dataclass
class RuleEnsemble:
    """Weighted rules; :meth:`score` compiles them into one column."""

    intercept: float = 0.0
    weights: list[tuple[Rule, float]] = field(default_factory=list)

    def score(self, prefix: str = "") -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + rule.column(prefix) * F.lit(weight)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(trees, names: tuple[str, ...]) -> list[Rule]:
    """The paths to every node but the roots of Spark's ``trees``, each rule once."""
    rules: dict[Rule, None] = {}

    def walk(node, bounds: dict[str, tuple[float, float]]) -> None:
        if bounds:
            rules[Rule(tuple((n, *b) for n, b in sorted(bounds.items())))] = None
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, threshold = names[split.featureIndex()], float(split.threshold())
        low, high = bounds.get(name, (-math.inf, math.inf))
        walk(node.leftChild(), bounds | {name: (low, min(high, threshold))})
        walk(node.rightChild(), bounds | {name: (max(low, threshold), high)})

    for tree in trees:
        walk(tree.rootNode(), {})
    return list(rules)


def fit(train: DataFrame, trees: int = 16, depth: int = 3, lasso: float = 0.002,
        seed: int = 7) -> RuleEnsemble:
    """An ensemble from rows of statistics and ``label`` (0 or 1), bounded in number.

    With one class only, or no rows at all, the score is constant: the share of label 1 with one
    more document of either class.
    """
    tally = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    ones, rows = tally.get(1.0, 0), sum(tally.values())
    if len(tally) < 2:
        return RuleEnsemble(math.log((ones + 1) / (rows - ones + 1)))
    assembled = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(train)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, maxBins=64,
        featureSubsetStrategy="onethird", seed=seed).fit(assembled)
    rules = tree_rules(forest._java_obj.trees(), STATISTICS)
    if not rules:
        return RuleEnsemble(math.log((ones + 1) / (rows - ones + 1)))
    matrix = stored(train.select("label", F.array(*(r.column() for r in rules)).alias("hits"))
                    .coalesce(2), "quality-rules")
    from pyspark.ml.functions import array_to_vector

    model = LogisticRegression(featuresCol="hits", labelCol="label", elasticNetParam=1.0,
                               regParam=lasso, standardization=False, maxIter=30).fit(
        matrix.withColumn("hits", array_to_vector("hits")))
    weights = [(rule, float(w)) for rule, w in zip(rules, model.coefficients.toArray()) if w]
    return RuleEnsemble(float(model.intercept), weights)


def held_out(id_column: Column) -> Column:
    """Documents whose labels are never learnt: crc32 of the id's text leaves 2 modulo 4. A null
    id counts as the empty text, which leaves 0."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics and ``label`` of at most about ``rows`` labelled documents, by hash of the id.

    Rows with a null id or label are left out; repeated ids with the same label count once.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("labelled_id"),
                           F.col("quality").cast("double").alias("label"))
             .where("labelled_id is not null and label in (0, 1)")
             .where(~held_out(F.col("labelled_id"))).distinct())
    share = min(1.0, rows / max(1, known.count()))
    limit = int(share * 2 ** 31)
    some = known.where(F.pmod(F.xxhash64("labelled_id"), F.lit(2 ** 31)) < limit)
    some = stored(some.coalesce(1), "quality-labels")  # at most about ``rows`` pairs of numbers
    chosen = docs.join(F.broadcast(some), docs[id_col].cast("long") == some["labelled_id"],
                       "left_semi")
    found = statistics(chosen, id_col, text_col)
    joined = found.join(F.broadcast(some), found["doc_id"] == some["labelled_id"])
    ordered = joined.repartition(4, "doc_id").sortWithinPartitions("doc_id", "label")
    return stored(ordered.select(*STATISTICS, "label"), "quality-train")


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    The ensemble learns from at most about ``train_rows`` labelled documents of ``docs`` that are
    not held out; labels, language, source and ids are no inputs of the score. Null and empty
    texts get the score of their statistics, all 0. Repeated or null ids are scored row by row,
    an empty table gives an empty result, other columns are not read.
    """
    model = fit(training_rows(docs, labels, train_rows, id_col, text_col))
    return statistics(docs, id_col, text_col).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts to be good, with all their columns.

    Only the text goes to Python, and only its statistics come back: rows stay where they are and
    nothing is joined or exchanged. Null and empty texts are judged by statistics of 0, rows with
    equal or null ids and equal texts each by themselves, very long texts as a whole; an empty
    table stays empty.
    """
    model = fit(training_rows(docs, labels, TRAIN_ROWS, id_col, text_col))
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("struct<" + ", ".join(f"{name}: double" for name in STATISTICS) + ">")
    def measured(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [batch_statistics(part.column("text").cast(pa.binary()).to_pylist())
                 for part in pieces_by_bytes(iter([batch]), BATCH_BYTES)]
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate([p[name] for p in parts] or [np.zeros(0)]))
             for name in STATISTICS], names=list(STATISTICS))

    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.withColumn("__statistics", measured(text)).where(
        model.score("__statistics.") >= threshold).drop("__statistics")
