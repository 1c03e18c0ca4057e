"""Language identification by cross-parsing.

A reference text per language becomes a suffix automaton. A text is parsed from left to right into
the longest phrases that occur in the reference; the fewer phrases a language needs, the closer it
is. c phrases, each one place in a reference of n symbols, cost c * log2(n) bits, which per symbol
estimates the cross entropy; the language with the lowest one wins.

The references are bounded, so a task builds the automata itself. Texts are cut into stretches of
``STRETCH`` symbols that are all parsed side by side, one symbol of each per step.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens.llm.columns import id_and_text, pieces_by_bytes, stored

TRAIN_ROWS = 256  # sampled documents per language, about
SAMPLE = 128  # symbols taken of each: little of a passage that documents of all languages share
STRETCH = 1024
BATCH_BYTES = 4 << 20
NONE = "und"
_OTHER = re.compile(r"[\W\d_]+")
_LETTER = re.compile(r"[^\W\d_]")
_SPACE = 0x20


def normal_form(text: str) -> bytes:
    """The lower-cased letters of ``text`` in UTF-8, with one space for whatever lies between."""
    return _OTHER.sub(" ", text.lower()).strip().encode()


class Automaton:
    """The suffix automaton of ``reference`` as a table of ``state * width + symbol``.

    Where a state has no transition the table holds that of the first state with the sign bit set:
    a phrase ends there and the next one begins with that symbol. Symbol 0 stands for the end of a
    stretch and changes nothing, symbol 1 for bytes that no reference has.
    """

    def __init__(self, reference: np.ndarray, width: int):
        follow: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for symbol in reference.tolist():
            now = len(follow)
            follow.append({})
            link.append(0)
            length.append(length[last] + 1)
            at = last
            while at >= 0 and symbol not in follow[at]:
                follow[at][symbol] = now
                at = link[at]
            if at >= 0:
                to = follow[at][symbol]
                if length[at] + 1 == length[to]:
                    link[now] = to
                else:
                    copy = len(follow)
                    follow.append(dict(follow[to]))
                    link.append(link[to])
                    length.append(length[at] + 1)
                    while at >= 0 and follow[at].get(symbol) == to:
                        follow[at][symbol] = copy
                        at = link[at]
                    link[to] = link[now] = copy
            last = now
        first = np.full(width, len(follow) * width, np.int32)
        for symbol, to in follow[0].items():
            first[symbol] = to * width
        follow.append({})  # after a symbol that the reference lacks, a phrase by itself
        table = np.tile(first | np.int32(-2 ** 31), (len(follow), 1))
        table[0] = first
        for state, steps in enumerate(follow):
            table[state, list(steps)] = np.array(list(steps.values()), np.int32) * width
        table[:, 0] = np.arange(len(follow), dtype=np.int32) * width
        self.table = table.reshape(-1)
        self.bits = math.log2(len(reference) + 1)

    def phrases(self, lines: np.ndarray) -> np.ndarray:
        """Phrases of each column of ``lines`` (symbols, stretches padded with 0)."""
        state = np.zeros(lines.shape[1], np.int32)
        count = np.zeros(lines.shape[1], np.int32)
        for symbols in lines:
            state = self.table.take(state + symbols)
            count += state < 0
            state &= np.int32(2 ** 31 - 1)
        return count + (state > 0)


class Languages:
    """Automata of all learnt languages over one alphabet."""

    def __init__(self, references: tuple[tuple[str, bytes], ...]):
        present = np.unique(np.frombuffer(b"".join(t for _, t in references) + b" ", np.uint8))
        self.symbol = np.ones(256, np.int32)
        self.symbol[present] = np.arange(2, 2 + len(present))
        self.names = [name for name, _ in references]
        self.automata = [Automaton(self.symbol[np.frombuffer(text, np.uint8)], 2 + len(present))
                         for _, text in references]

    def costs(self, texts: list[bytes]) -> np.ndarray:
        """Bits per symbol of each normal form (rows) in each language (columns)."""
        parts, owner = [], []
        for k, text in enumerate(texts):
            pieces = [text[a:a + STRETCH] for a in range(0, len(text), STRETCH)]
            parts += pieces
            owner += [k] * len(pieces)
        total = np.zeros((len(texts), len(self.names)))
        order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
        for a in range(0, len(order), 8192):  # of like length, so that little is padded
            some = order[a:a + 8192]
            size = np.array([len(parts[i]) for i in some])
            lines = np.zeros((len(some), size.max()), np.int32)
            lines[np.arange(size.max()) < size[:, None]] = self.symbol[
                np.frombuffer(b"".join(parts[i] for i in some), np.uint8)]
            lines = np.ascontiguousarray(lines.T)
            mine = np.array(owner)[some]
            for column, automaton in enumerate(self.automata):
                np.add.at(total[:, column], mine, automaton.phrases(lines) * automaton.bits)
        return total / np.maximum(1, [len(t) for t in texts])[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language of least cost, the first among equals; the score is how much less it costs
        than the next one, as a share."""
        forms = [normal_form(t) if t and _LETTER.search(t) else b"" for t in texts]
        costs = self.costs(forms)
        names, scores = [], []
        for form, row in zip(forms, costs):
            if not form or not self.names:
                names.append(NONE)
                scores.append(0.0)
                continue
            best = int(row.argmin())
            rest = np.delete(row, best)
            names.append(self.names[best])
            scores.append(float(1 - row[best] / rest.min()) if len(rest) else 1.0)
        return names, scores


@functools.lru_cache(maxsize=2)
def languages(references: tuple[tuple[str, bytes], ...]) -> Languages:
    return Languages(references)


def held_out(id_column: Column) -> Column:
    """Documents that are never learnt from: crc32 of the id's text leaves 2 modulo 4. A null id
    counts as the empty text, which leaves 0."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def references(docs: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id",
               text_col: str = "text", lang_col: str = "lang") -> tuple[tuple[str, bytes], ...]:
    """A reference text per language, in the order of the names.

    About ``rows`` distinct texts per language are sampled by a hash of the text among the documents
    not held out; each gives at most ``SAMPLE`` symbols in a row, from a place that its hash tells. The size of a reference is thereby bounded, and the driver holds one per language.
    """
    known = docs.where(docs[lang_col].isNotNull() & docs[text_col].isNotNull()
                       & ~held_out(docs[id_col])).select(
        docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("string").alias("text"))
    known = known.where(F.col("text").rlike(r"\p{L}")).withColumn("key", F.xxhash64("text"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(
        F.approx_count_distinct("key").alias("n")).collect()}
    limit = {lang: int(min(1.0, 2 * rows / max(1, n)) * 2 ** 31) for lang, n in counts.items()}
    if not limit:
        return ()
    wanted = F.create_map(*[F.lit(x) for pair in limit.items() for x in pair])[F.col("lang")]
    some = known.where(F.pmod(F.xxhash64("key"), F.lit(2 ** 31)) < wanted)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, key in zip(batch.column("text").to_pylist(), batch.column("key").to_pylist()):
                form = normal_form(text)
                start = key % max(1, len(form) - SAMPLE)
                found.append(b" " + form[start:start + SAMPLE] + b" ")
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("key"), pa.array(found, pa.binary())],
                names=["lang", "key", "stretch"])

    parts = stored(some.mapInArrow(stretches, "lang string, key long, stretch binary"),
                   "language-sample").dropDuplicates(["lang", "key"])
    chosen = {}
    for row in sorted(parts.collect()):  # a few rows per language
        chosen.setdefault(row["lang"], []).append(bytes(row["stretch"]))
    return tuple((lang, b"".join(chosen[lang][:rows])) for lang in sorted(chosen))


def identified(docs: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id",
               text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    Learnt from about ``rows`` texts per language (see :func:`references`) that are not held out;
    language, source and id are no inputs of a prediction. Whole texts are parsed, however long.
    ``lang_pred`` is ``und`` with score 0 where the text is null or has no letter, or where no
    language could be learnt. Costs that tie go to the name that comes first, with score 0. Rows
    are scored one by one, so repeated or null ids and equal texts make no difference; an empty
    table gives an empty result, and other columns are not read.
    """
    learnt = references(docs, rows, id_col, text_col, lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = languages(learnt)
        for batch in pieces_by_bytes(batches, BATCH_BYTES):
            names, scores = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, lang_pred string, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
