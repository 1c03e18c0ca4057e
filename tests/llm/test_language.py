"""Cross-parsing against a plain search, and predictions on languages that were held out."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_prose import prose
from matchlens.llm import language


def parsed(text, reference):
    """Phrases of ``text``: the longest pieces that occur in ``reference``, one symbol at least."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at:end + 1] in reference:
            end += 1
        count, at = count + 1, end
    return count


@pytest.mark.parametrize("seed", range(4))
def test_phrases_are_the_longest(seed, monkeypatch):
    monkeypatch.setattr(language, "STRETCH", 37)
    rng = np.random.default_rng(seed)
    some = [bytes(rng.choice(list(b"abc d"[:3 + seed % 3]), rng.integers(1, 300)).tolist())
            for _ in range(3)]
    model = language.Languages((("x", some[0]), ("y", some[1] + b"\xc3")))
    texts = [some[2], some[0], b"", b"z", b"abzzab" * 20, some[1] + some[2]]
    costs = model.costs(texts)
    for text, row in zip(texts, costs):
        pieces = [text[a:a + 37] for a in range(0, len(text), 37)]
        for reference, found in zip((some[0], some[1] + b"\xc3"), row):
            bits = sum(parsed(p, reference) for p in pieces) * math.log2(len(reference) + 1)
            assert found == pytest.approx(bits / max(1, len(text)))


def test_held_out_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = language.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    unseen = [r for r in out if r["held_out"]]
    assert len(out) == docs.count() and unseen
    assert sum(r["lang"] == r["lang_pred"] for r in unseen) >= 0.97 * len(unseen)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_labels_of_held_out_documents_are_not_read(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "zz").otherwise(
        F.col("lang")))
    assert sorted(language.identified(wrong).collect()) == sorted(
        language.identified(docs).collect())


def test_odd_rows(spark, odd_rows, no_docs):
    names = [None if k % 5 == 4 else "en" if k % 2 else "xx" for k in range(len(odd_rows))]
    docs = spark.createDataFrame([(*r, n) for r, n in zip(odd_rows, names)],
                                 "doc_id long, text string, lang string")
    docs = docs.withColumns({c: F.lit(1) for c in ("key", "held_out", "lang_pred", "score")})
    out = language.identified(docs).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in out) == sorted(
        (i is not None, i or 0) for i, _ in odd_rows)
    blank = {2: None, 1: "", 3: "  \t\n "}
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in out if r["doc_id"] in blank)
    assert all(r["lang_pred"] in ("en", "xx") for r in out if r["doc_id"] in (4, 6, 12, 14))
    assert language.identified(no_docs).count() == 0
    nothing = language.identified(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}


def test_letters_decide():
    model = language.Languages((("a", prose(1, 50).lower().encode()), ("b", b"zq xk vv")))
    names, scores = model.predict([None, "12 !?", "zq XK", prose(1, 20).upper(), "_1", "ß"])
    assert names[:4] == ["und", "und", "b", "a"] and names[4] == "und"
    assert scores[0] == scores[1] == 0 and 0 <= min(scores) and max(scores) <= 1
