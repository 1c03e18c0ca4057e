"""Words and runs that break weak hashes and recursive matchers."""

import numpy as np
import public_tokenizers
import pytest

from matchlens.llm import bytebpe, hashing, packing, setsketch, substring


def thue_morse(bits: int) -> tuple[str, str]:
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_word_hashes_differ_where_words_do():
    words = [w for bits in range(1, 13) for w in thue_morse(bits)]
    words += ["x" * n for n in range(1, 80)] + ["\x00" * n for n in range(1, 20)]
    hashes = hashing.words([" ".join(words).encode()])[0]
    assert len(hashes) == len(words) and len(np.unique(hashes)) == len(set(words))
    one, two = (hashing.words([t.encode()], lower=True)[0] for t in ("Ab CDEFGHIJk", "aB cdefghijK"))
    assert (one == two).all()


def test_complements_of_a_long_word_are_no_copies(spark):
    one, two = thue_morse(10)
    frame = spark.createDataFrame(
        [(1, " ".join([one] * 13)), (2, " ".join([two] * 13)), (3, " ".join([one] * 14))],
        "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substring.digests(frame).collect()} == {
        1: 0, 2: 0, 3: 14}
    found = setsketch.near_groups(frame, shingle=3, percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {1: 1, 2: 2, 3: 1}


@pytest.mark.parametrize("run", ["\n", " ", "x", "é", "7"])
def test_a_million_equal_characters_are_packed(spark, run):
    text = "a" + run * 1_000_000
    path = public_tokenizers.path("byte_bpe_50k.json")
    expected = bytebpe.encoder(path).library.encode(text, add_special_tokens=False).ids
    assert bytebpe.encoder(path).encode(text).tolist() == expected
    pieces = packing.pack(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    ids = [i for r in sorted(pieces, key=lambda r: r["start"]) for i in r["ids"]]
    assert ids == [*expected, packing.END_ID]
