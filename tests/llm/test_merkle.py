"""The manifest against a plain tree built row by row."""

import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlens.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    """Root, and per leaf the list of (left, right) siblings upwards."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(at):
            other = i ^ 1
            paths[k].append(None if other >= len(level) else (i & 1, level[other]))
            at[k] = i // 2
        level = [h(*level[i:i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def by_force(rows, tampered=True):
    """``rows``: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        other = list(row)
        if tampered and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 \
                and row[3] is not None:
            other[3] += 1
        leaf, claimed = h(*map(framed, row)), h(*map(framed, other))
        groups.setdefault(row[2], []).append(
            (row[0] is not None, row[0] or 0, leaf, claimed, row[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: r[:4])
        trees[g] = tree([r[2] for r in groups[g]])
    root, tops = tree([trees[g][0] for g in names]) if names else (None, [])
    out = []
    for g, top in zip(names, tops):
        for (_, _, leaf, claimed, doc_id), path in zip(groups[g], trees[g][1]):
            path, now = path + top, claimed
            for step in path:
                now = h(now) if step is None else h(step[1], now) if step[0] else h(now, step[1])
            proof = h(*(s[1] for s in path if s))
            out.append((doc_id, leaf, trees[g][0], root, proof, now, now == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def found(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("group", "id", "leaf", "claimed", "place", "n", "chunk", "block")})
    out = merkle.manifest(docs.repartition(5), claims=merkle.tampered(docs))
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("rows", [
    [(7, "s", "en", 1, "a")],
    [(7, None, None, None, None), (8, "", "", 0, "")],
    [(i, "s", "en" if i % 3 else None, i, "x" * i) for i in range(20)],
    [(i, "é", lang, 2 ** 62, "日本" * 3) for i in (-5, -1, 0, 2 ** 62, -2 ** 63, 2 ** 63 - 1)
     for lang in ("en", "é", "z", "")],
    # repeated rows, equal ids with other texts, null ids
    [(1, "s", "en", 1, "a")] * 3 + [(1, "s", "en", 1, f"b{k}") for k in range(5)]
    + [(None, "s", "en", 1, f"c{k}") for k in range(4)] + [(None, None, None, None, None)] * 2
    + [(2, "s", "en", None, "d"), (0, "s", "en", 5, "e" * 100_000)],
])
def test_small_tables(spark, rows):
    assert found(spark, rows) == by_force(rows)


def test_several_stages_and_chunks(spark):
    rng = np.random.default_rng(1)
    ids = rng.permutation(np.unique(rng.integers(0, 1 << 19, 9_200)))[:9_001].tolist()
    rows = [(i, "s", "en" if k < 8_500 else "fr", k, str(k)) for k, i in enumerate(ids)]
    rows += [(rows[0][0], "s", "en", k % 40, "hot") for k in range(300)]
    assert found(spark, rows) == by_force(rows)


def test_nothing(spark):
    assert found(spark, []) == []


def test_bitmaps_hold_what_was_put_in():
    rng = np.random.default_rng(2)
    for n in (0, 1, 100, 4095, 4096, 65536):
        low = np.sort(rng.permutation(65536)[:n])
        assert (merkle.unpack_bits(merkle.pack_bits(low)) == low).all()
        assert len(merkle.pack_bits(low)) <= min(2 * n, 8192)


def test_directory_of_many_chunks(spark):
    rng = np.random.default_rng(3)
    chunks = {g: np.unique(rng.integers(-1000, 3000, 300)).tolist() for g in "ab"}
    rows = [(g, c, int(rng.integers(1, 9))) for g in chunks for c in chunks[g]]
    frame = spark.createDataFrame(rows, "group string, chunk long, n long")
    expected = [(g, c, sum(n for g2, c2, n in rows if g2 == g and c2 < c)) for g, c, _ in rows]
    assert sorted(map(tuple, merkle.before(frame, 2).collect())) == sorted(expected)
