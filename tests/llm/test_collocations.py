"""Collocations against a count of every phrase in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlens.llm import collocations


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def by_force(rows, min_count, max_words, top):
    out = []
    for lang in {r[1] or "und" for r in rows if r[1] != ""} | {r[1] for r in rows if r[1] == ""}:
        n, f = 0, Counter()
        for text, own in rows:
            if (own if own is not None else "und") != lang or text is None:
                continue
            for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
                words = re.findall("[^ \t]+", piece)
                n += len(words)
                f.update(tuple(words[i:i + k]) for k in range(1, max_words + 1)
                         for i in range(len(words) - k + 1))
        f = {p: c for p, c in f.items() if c >= min_count}
        whole = set()
        for q, c in f.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    if f[q[i:i + k]] <= c:
                        whole.add(q[i:i + k])
        ranked = []
        for p, a in f.items():
            if len(p) > 1 and p not in whole:
                score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                     for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def found(spark, rows, parts=4, **options):
    docs = spark.createDataFrame(rows, "text string, lang string").withColumns(
        {c: F.lit("x") for c in ("block", "word", "words", "id", "a", "b", "f", "n", "rank")})
    return sorted(map(tuple, collocations.collocations(docs.repartition(parts), **options)
                      .collect()))


def some_rows(seed, count=60):
    rng = random.Random(seed)
    words = ["a", "B", "cc", "É", "日本", "d-d", "x\x00y", "tHe"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!?", " ; "]
    return [("".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(0, 60))),
             rng.choice(["en", "en", "fr", None, "", "und"])) for _ in range(count)]


@pytest.mark.parametrize("seed,min_count,block", [(1, 3, 1 << 22), (2, 2, 64), (3, 8, 700)])
def test_small_texts(spark, seed, min_count, block):
    rows = some_rows(seed) + [(None, "en"), ("", None), (" \t\n", "fr"), ("w " * 50, "fr")]
    assert found(spark, rows, min_count=min_count, top=25, block_bytes=block) == by_force(
        rows, min_count, 5, 25)


def test_copies_and_a_long_text(spark):
    rows = [("one two three four five six. one two", "en")] * 40 + [("A b! " * 20_000, "en")]
    assert found(spark, rows, min_count=30, block_bytes=4096) == by_force(rows, 30, 5, 2000)


def test_nothing(spark):
    assert found(spark, []) == [] and found(spark, [(None, None), ("  ", "en")]) == []


def test_counts_beyond_64_bits(spark):
    level = spark.createDataFrame(
        [("en", ["p", "q"], 3_000_000_000_001, [7_000_000_000_003], [9_000_000_000_007])],
        "lang string, words array<string>, f long, heads array<long>, tails array<long>")
    empty = level.where("false").selectExpr("0L id", "0L a", "0L b", "*")
    totals = spark.createDataFrame([("en", 98_765_432_109_876)], "lang string, n long")
    full = level.selectExpr("1L id", "0L a", "0L b", "*")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(collocations, "frequent_phrases", lambda *a: ([empty, full], totals))
        row = collocations.collocations(spark.range(0)).first()
    assert row["score"] == 1000 * 3_000_000_000_001 * 98_765_432_109_876 // (
        7_000_000_000_003 * 9_000_000_000_007)


def test_stretches_join_to_the_texts():
    texts = [b"a.b c,d" * 9, b"", b"x" * 40, b"e f"]
    for size in (1, 5, 16, 1000):
        parts = [p for s in collocations.stretches(texts, size) for p in re.split(b"[.,\n]", s)]
        assert [p for p in parts if p] == [p for t in texts for p in re.split(b"[.,\n]", t) if p]


def test_words_are_numbered_in_order():
    words, line = collocations.split_words(b"Ab c.c ab\n\nz\n")
    assert [words[i].as_py() if i >= 0 else None for i in line] == [
        b"ab", b"c", None, b"c", b"ab", None, b"z"]
    assert len(collocations.split_words(b"\n . \n")[1]) == 0
    for values in (line, np.arange(-3, 9), np.zeros(0, np.int64)):
        assert (collocations.expanded(collocations.squeezed(values), values.dtype) == values).all()


@pytest.mark.parametrize("values", [[], [0], [-1, 2 ** 40, 7, 7, -2 ** 62], list(range(70_000))])
@pytest.mark.parametrize("kind", [np.int32, np.int64])
def test_squeezed_numbers_come_back(values, kind):
    numbers = np.array(values, np.int64).astype(kind)
    back = collocations.expanded(collocations.squeezed(numbers), kind)
    assert back.dtype == kind and back.tolist() == numbers.tolist()
