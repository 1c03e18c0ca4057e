"""Personal data: fixed patterns first, then contextual patterns bootstrapped from what they find.

The fixed patterns give seed entities. The words around an entity are lexical patterns. Tokens
that look like identifiers but match no fixed pattern are instances as well. Spark scores the
graph of patterns and instances in turns: a pattern is as good as the mean score of the distinct
instances it is seen with, an instance as good as its best patterns make it. Patterns that end
up reliable add the unseen identifiers next to them to the spans of their document.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.llm.columns import id_and_text, pieces_by_bytes, small_enough, stored

# The kinds in the order in which spans are listed, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A run of digits is taken as a whole, which finds the same matches as [0-9]+(\.[0-9]+)(\.[0-9]+)
# (\.[0-9]+) does, but in linear time where a text is one long number.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_HINT = re.compile(r"[0-9@]")
_EDGE = frozenset(" \t\n\x0b\x0c\r\"'`<>()[]{},;|")
_TRIM = ".:!?*&%$#=-"
MIN_TOKEN, MAX_TOKEN = 5, 128
_GROUPS = re.compile(r"\+?[0-9]++(?:[.-][0-9]++)*+")  # a token that may be a part of a number
# What joins the parts of a number; a full stop before a blank ends a sentence.
_JOIN = re.compile(r"(?!\.\x20)[\x20().-]{1,4}")
MAX_DIGITS = 19  # of a number in parts: the most that any kind has
LOOK = 80  # characters looked at on either side for context words
BATCH_BYTES = 1 << 19
ROUNDS = 3
MIN_CONFIDENCE = 0.8  # of a pattern that may add spans
MIN_SEEDS = 3  # distinct entities that must vouch for it
SMOOTHING = 1.0
UNKNOWN = 0.25  # of an instance: what one of the kind's form counts that has no score yet
# What a value of a kind looks like, whether or not it is valid.
FORMS = {"email": r"^[^@\s]+@[^@\s]+$", "ip": r"^[0-9]+([.][0-9]+){3}$",
         "card": r"^[0-9]([\x20.-]*[0-9]){12,18}$",
         "phone": r"^[+(]?[0-9]([\x20().-]*[0-9]){6,14}[)]?$"}
BROADCAST_ROWS = 500_000

SPAN = "struct<kind:string,start:long,end:long>"
SEEN = "struct<start:long,end:long,kind:string,value:string,patterns:array<string>>"


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: around each @, as far left as the last one allows."""
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            floor = domain.end()
        at = text.find("@", max(at + 1, floor))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, end`` in code points by kind, then start. Failing matches are dropped."""
    spans = [("email", *span) for span in emails(text)] if "@" in text else []
    if not _HINT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


def _context(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a span: the word before, two words before, and the pair of
    the words on both sides. A span without a word before it has none."""
    left = text[max(0, start - LOOK):start].lower().split()
    right = text[end:end + LOOK].lower().split()
    if not left:
        return []
    made = ["L1 " + left[-1]]
    if len(left) > 1:
        made.append(f"L2 {left[-2]} {left[-1]}")
    if right:
        made.append(f"LR {left[-1]} | {right[0]}")
    return made


def instances(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Entities and tokens like identifiers, with the lexical patterns they stand in. A number
    written in groups of digits is one identifier."""
    out = [{"start": s, "end": e, "kind": kind, "value": text[s:e].lower(),
            "patterns": _context(text, s, e)} for kind, s, e in base]
    starts, ends = [], []  # of the stretches that base spans cover
    for start, end in sorted((s, e) for _, s, e in base):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    tokens, place = [], 0
    for hint in iter(lambda: _HINT.search(text, place), None):
        start = end = hint.start()
        while start > 0 and hint.start() - start <= MAX_TOKEN and text[start - 1] not in _EDGE:
            start -= 1
        while end < len(text) and end - start <= MAX_TOKEN and text[end] not in _EDGE:
            end += 1
        place = max(end, hint.end())
        while start < end and text[start] in _TRIM:
            start += 1
        while start < end and text[end - 1] in _TRIM:
            end -= 1
        if not 0 < end - start <= MAX_TOKEN:
            continue
        before = bisect_left(starts, end) - 1
        if before >= 0 and ends[before] > start:
            continue
        tokens.append((start, end))
    for start, end in _numbers(text, tokens):
        if end - start >= MIN_TOKEN:
            out.append({"start": start, "end": end, "kind": None,
                        "value": text[start:end].lower(), "patterns": _context(text, start, end)})
    return out


def _numbers(text: str, tokens: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """``tokens`` in order, with the groups of digits that make up one number as one span.

    A bracket around the first or last group belongs to the number. Groups with more digits
    together than any kind has are several numbers and stay as they are.
    """
    run: list[tuple[int, int]] = []

    def joined() -> list[tuple[int, int]]:
        if len(run) < 2:
            return run
        start, end = run[0][0], run[-1][1]
        whole = text[start:end]
        if sum(c in "0123456789" for c in whole) > MAX_DIGITS:
            return run
        if whole.count(")") > whole.count("(") and text[start - 1:start] == "(":
            start -= 1
        elif whole.count("(") > whole.count(")") and text[end:end + 1] == ")":
            end += 1
        return [(start, end)]

    for start, end in tokens:
        part = _GROUPS.fullmatch(text, start, end)
        if run and not (part and text[start] != "+" and start - run[-1][1] <= 4
                        and _JOIN.fullmatch(text, run[-1][1], start)):
            yield from joined()
            run = []
        if part:
            run.append((start, end))
        else:
            yield start, end
    yield from joined()


def extracted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: its base spans and its instances. Written once, read by all rounds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_by_bytes(batches, BATCH_BYTES):
            base, seen = [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
                seen.append(instances(text, spans))
            arrow = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            look = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()),
                              ("value", pa.string()),
                              ("patterns", pa.list_(pa.string()))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"),
                 pa.array(base, pa.list_(arrow)), pa.array(seen, pa.list_(look))],
                names=["doc_id", "text_key", "base", "seen"])

    texts = id_and_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    found = texts.mapInArrow(run, f"doc_id long, text_key long, base array<{SPAN}>, "
                                  f"seen array<{SEEN}>")
    return stored(found.withColumn("row_id", F.monotonically_increasing_id()), "pii-seen")


def reliable_patterns(seen: DataFrame, rounds: int = ROUNDS,
                      min_confidence: float = MIN_CONFIDENCE,
                      min_seeds: int = MIN_SEEDS) -> DataFrame:
    """``pattern, kind, confidence`` of patterns that vouch for unseen identifiers.

    ``seen``: one row per occurrence. A pattern's confidence for a kind is the sum of its distinct
    instances' scores over their number plus a smoothing count. Instances of another kind or form
    count in full. One that has the kind's form but no score yet is neither right nor wrong: it
    counts ``UNKNOWN``, so that some of them do not bury the seeds but many still do.
    """
    form = F.array_compact(F.array(*[F.when(F.col("value").rlike(form), F.lit(kind))
                                     for kind, form in FORMS.items()]))
    edges = stored(seen.select(F.explode("patterns").alias("pattern"), "value", "kind")
                   .groupBy("pattern", "value").agg(F.max("kind").alias("kind"))
                   .withColumn("forms", F.when(F.col("kind").isNull(), form)), "pii-edges")
    seeds = edges.where("kind is not null").select("value", "kind").distinct()
    scores = seeds.withColumn("score", F.lit(1.0))
    kept = None
    for _ in range(rounds):
        sizes = edges.groupBy("pattern").agg(
            F.count("*").alias("n"),
            *[F.count_if(F.array_contains("forms", kind)).alias(f"like_{kind}") for kind in FORMS])
        good = (edges.withColumnRenamed("kind", "seed").join(scores, "value")
                .groupBy("pattern", "kind")
                .agg(F.sum("score").alias("good"),
                     F.sum((F.col("score") == 1.0).cast("int")).alias("sure"),
                     F.count_if(F.array_contains("forms", F.col("kind"))).alias("scored")))
        like = F.coalesce(*[F.when(F.col("kind") == kind, F.col(f"like_{kind}")) for kind in FORMS])
        number = F.col("n") - F.lit(1 - UNKNOWN) * (like - F.col("scored"))
        kept = stored(good.join(sizes, "pattern")
                      .withColumn("confidence", F.col("good") / (number + F.lit(SMOOTHING)))
                      .where((F.col("confidence") >= min_confidence)
                             & (F.col("sure") >= min_seeds))
                      .select("pattern", "kind", "confidence"), "pii-patterns")
        if kept.isEmpty():
            break
        # An instance is as likely as it is that not all of its patterns are wrong.
        guessed = (edges.where("kind is null").join(kept.withColumnRenamed("kind", "found"),
                                                    "pattern")
                   .groupBy("value", F.col("found").alias("kind"))
                   .agg((F.lit(1.0) - F.product(F.lit(1.0) - F.col("confidence"))).alias("p")))
        scores = stored(seeds.withColumn("score", F.lit(1.0)).unionByName(
            guessed.select("value", "kind", F.least(F.col("p"), F.lit(0.99)).alias("score"))),
            "pii-scores")
    return kept.select("pattern", "kind", "confidence")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         min_confidence: float = MIN_CONFIDENCE, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """Per row: ``doc_id, text_key, base`` and ``spans``, arrays of ``kind, start, end``.

    ``base`` holds what the fixed patterns match, ``spans`` also what reliable contexts add, both
    by kind and start, in code points. Null and empty texts have no spans; repeated or null ids
    are searched row by row; an empty table gives an empty result; other columns are not read.
    """
    rows = extracted(docs, id_col, text_col)
    seen = rows.select("row_id", F.explode("seen").alias("s")).select("row_id", "s.*")
    patterns = reliable_patterns(seen, ROUNDS, min_confidence, min_seeds)
    unseen = (seen.where("kind is null").drop("kind")
              .withColumn("pattern", F.explode("patterns")).drop("patterns"))
    added = (unseen.join(patterns, "pattern").groupBy("row_id", "start", "end")
             .agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
             .groupBy("row_id").agg(F.collect_list(F.struct("kind", "start", "end"))
                                    .alias("added")))
    both = rows.drop("seen").join(added, "row_id", "left")
    order = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k)])
    every = F.concat(F.col("base"), F.coalesce("added", F.array().cast(f"array<{SPAN}>")))
    ranked = F.array_sort(F.transform(every, lambda s: F.struct(
        order[s["kind"]].alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
        s["kind"].alias("kind"))))
    spans = F.transform(ranked, lambda s: F.struct(s["kind"].alias("kind"),
                                                   s["start"].alias("start"),
                                                   s["end"].alias("end")))
    return both.select("doc_id", "text_key", "base", spans.alias("spans"))


def _listed(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind))


def digests(docs: DataFrame, **options) -> DataFrame:
    """Counts of base spans per kind, the digest of the base spans, and all spans as text."""
    found = find(docs, **options)
    counts = [_count(kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256)
                        .alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def masked(text: str, spans: list) -> str:
    """``text`` with each of ``spans`` (kind, start, end) replaced by its kind; overlapping spans
    become one."""
    out, place = [], 0
    for start, end, kind in sorted((int(s), int(e), kind) for kind, s, e in spans):
        if end <= place:
            continue
        if start >= place:
            out += [text[place:start], f"<{kind.upper()}>"]
        place = end
    return "".join(out) + text[place:]


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           length_col: str | None = None) -> DataFrame:
    """``docs`` with the found spans masked in their texts; rows and columns stay.

    A column of text lengths named ``length_col`` is brought up to date where a text changed.
    """
    spans = stored(find(docs, id_col, text_col).where(F.size("spans") > 0)
                   .select(F.col("doc_id").alias("span_id"), F.col("text_key").alias("span_key"),
                           F.col("spans").alias("span_list"))
                   .dropDuplicates(["span_id", "span_key"]), "pii-spans")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    joined = docs.join(small_enough(spans, BROADCAST_ROWS),
                       docs[id_col].cast("long").eqNullSafe(spans["span_id"])
                       & (F.xxhash64(text) == spans["span_key"]), "left")
    listed = spans["span_list"]
    changed = listed.isNotNull()
    clean = F.when(changed, F.pandas_udf(_mask_series, "string")(text, _listed(listed)))
    columns = []
    for name in docs.columns:
        column = docs[name]
        if name == text_col:
            column = F.when(changed, clean).otherwise(column)
        elif name == length_col:
            column = F.when(changed, F.length(clean).cast(docs.schema[name].dataType)
                            ).otherwise(column)
        columns.append(column.alias(name))
    return joined.select(*columns)


def _mask_series(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([masked(text, [p.split(":") for p in found.split(",")]) if found else text
                      for text, found in zip(texts, spans)], dtype=object)

