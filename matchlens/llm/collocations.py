"""Collocations by relational mining of phrase occurrences, one word longer each turn.

The relation of a turn holds where the frequent phrases of k words occur, per block of text in the
order of their positions; pieces are set apart by a gap in the positions. A merge join of the
relation with itself at adjacent positions pairs a phrase with the one that starts a word later,
which together are a phrase of k + 1 words. The pairs are counted by group, and a semi-join with
the frequent groups leaves the occurrences that the next turn extends. Both halves of a frequent
phrase are frequent, so nothing is lost.

Blocks count what they hold before anything is exchanged: a phrase that a third of all texts share
is one row per block. Phrases are numbers; no hash stands for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlens.llm.columns import bounded_batches, stored

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
BLOCK_BYTES = 8 << 20
HELD_ROWS = 1 << 17

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _BREAK.copy()
_APART[[0x20, 0x09]] = True


def stretches(texts: list[bytes], size: int) -> Iterator[bytes]:
    """The texts joined to about ``size`` bytes, with a break after each; longer texts are cut at
    their own breaks, as far as they have any."""
    held, total = [], 0
    for text in texts:
        if len(text) > size:
            breaks = np.flatnonzero(_BREAK[np.frombuffer(text, np.uint8)]) + 1
            cuts = np.unique(breaks[np.searchsorted(breaks, np.arange(size, len(text), size)) - 1]
                             if len(breaks) else breaks)
            for a, b in zip([0, *cuts], [*cuts, len(text)]):
                yield text[a:b] + b"\n"
            continue
        if held and total + len(text) > size:
            yield b"\n".join([*held, b""])
            held, total = [], 0
        held.append(text)
        total += len(text)
    if held:
        yield b"\n".join([*held, b""])


def split_words(data: bytes) -> tuple[pa.Array, np.ndarray]:
    """The distinct lower-cased words of ``data``, and their numbers in the order of the text with
    -1 between pieces."""
    codes = _LOWER[np.frombuffer(data, np.uint8)]
    apart = _APART[codes]
    edge = np.flatnonzero(np.diff(apart, prepend=True, append=True))
    begin, end = edge[::2], edge[1::2]
    offsets = np.append(0, np.cumsum(end - begin)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(begin), [
        None, pa.py_buffer(offsets), pa.py_buffer(codes[~apart])]).dictionary_encode()
    piece = np.searchsorted(np.flatnonzero(_BREAK[codes]), begin)
    place = np.arange(len(begin)) + np.cumsum(np.append(False, piece[1:] != piece[:-1])) \
        if len(begin) else begin
    line = np.full(place[-1] + 1 if len(place) else 0, -1, np.int32)
    line[place] = words.indices.to_numpy()
    return words.dictionary, line


def squeezed(values: np.ndarray) -> bytes:
    """The numbers as compressed bytes; relations move and rest in this form. All lowest bytes come
    first, then all next ones: small numbers leave the rest empty."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    data = planes.T.tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def expanded(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _by_language(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, bytes]]:
    """The texts of a task joined to blocks of one language."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(),
                              batch.column("text").cast(pa.binary()).to_pylist()):
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text)
            if sizes[lang] >= size:
                yield from ((lang, data) for data in stretches(held.pop(lang), size))
                del sizes[lang]
        while sum(sizes.values()) > 2 * size:
            lang = max(sizes, key=sizes.get)
            yield from ((lang, data) for data in stretches(held.pop(lang), size))
            del sizes[lang]
    for lang in list(held):
        yield from ((lang, data) for data in stretches(held.pop(lang), size))


def _blocks(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for lang, data in _by_language(batches, block_bytes):
            words, line = split_words(data)
            if not len(words):
                continue
            number += 1
            counts = np.bincount(line[line >= 0], minlength=len(words))
            order = np.argsort(-counts, kind="stable")  # frequent words get small numbers
            ranked = np.zeros(len(words) + 1, np.int32)  # with 0 at -1, between pieces
            ranked[order] = np.arange(1, len(words) + 1)
            line, words, counts = ranked[line], words.take(pa.array(order)), counts[order]
            both = [pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), x)
                    for x in (words, pa.array(counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([lang], pa.string()), *both,
                 pa.array([squeezed(line)], pa.binary())],
                names=["block", "lang", "words", "counts", "line"])
    return run


def _related(block: int, place: np.ndarray, phrase: np.ndarray) -> pa.RecordBatch:
    """Occurrences in the order of their positions, as steps, which are mostly small."""
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()),
         pa.array([squeezed(np.diff(place, prepend=0).astype(np.int32))], pa.binary()),
         pa.array([squeezed(phrase.astype(np.int64))], pa.binary())],
        names=["block", "step", "phrase"])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the numbers of their frequent words in place of their own."""
    for batch in batches:
        for row in range(batch.num_rows):
            line = expanded(batch.column("line")[row].as_py(), np.int32) - 1
            number = np.full(int(line.max(initial=0)) + 1, -1, np.int64)
            number[batch.column("codes")[row].values.to_numpy()] = \
                batch.column("ids")[row].values.to_numpy()
            phrase = np.where(line >= 0, number[line], -1)
            place = np.flatnonzero(phrase >= 0)
            yield _related(batch.column("block")[row].as_py(), place, phrase[place])


def _adjacent(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The merge join: where two phrases start a word apart; all positions and phrases."""
    place = np.cumsum(expanded(batch.column("step")[row].as_py(), np.int32), dtype=np.int64)
    phrase = expanded(batch.column("phrase")[row].as_py(), np.int64)
    return np.flatnonzero(place[1:] == place[:-1] + 1), place, phrase


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            at, _, phrase = _adjacent(batch, row)
            own, code = np.unique(phrase, return_inverse=True)
            pair, n = np.unique(code[at] * len(own) + code[at + 1], return_counts=True)
            for a in range(0, len(pair), HELD_ROWS):
                some = pair[a:a + HELD_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[some // len(own)]), pa.array(own[some % len(own)]),
                     pa.array(n[a:a + HELD_ROWS])], names=["a", "b", "n"])


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            at, place, phrase = _adjacent(batch, row)
            for a in range(0, len(at), HELD_ROWS):
                some = at[a:a + HELD_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), batch.column("block")[row].as_py())),
                     pa.array(place[some]), pa.array(phrase[some]), pa.array(phrase[some + 1])],
                    names=["block", "place", "a", "b"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of the same block that a task holds, as one row; a block may have several."""
    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, place, phrase = (np.concatenate([b.column(c).to_numpy() for b in held])
                                for c in ("block", "place", "id"))
        order = np.lexsort((place, block))
        block, place, phrase = block[order], place[order], phrase[order]
        edges = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        for a, b in zip(edges, np.append(edges[1:], len(block))):
            yield _related(int(block[a]), place[a:b], phrase[a:b])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= 4 * HELD_ROWS:
            yield from flush(held)
            held, size = [], 0
    if held:
        yield from flush(held)


def _regrouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            place = np.concatenate([np.cumsum(expanded(x, np.int32), dtype=np.int64)
                                    for x in batch.column("steps")[row].as_py()])
            phrase = np.concatenate([expanded(x, np.int64)
                                     for x in batch.column("phrases")[row].as_py()])
            order = np.argsort(place)
            yield _related(batch.column("block")[row].as_py(), place[order], phrase[order])


_RELATION = "block long, step binary, phrase binary"


def _longer(relation: DataFrame, shorter: DataFrame, min_count: int) -> DataFrame:
    """The frequent phrases one word longer: ``id, a, b, lang, f, words, heads, tails``.

    ``heads`` and ``tails`` are the counts of the phrase's first and last 1, 2, ... words."""
    pairs = (relation.mapInArrow(_counted, "a long, b long, n long").groupBy("a", "b")
             .agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
             .withColumn("id", F.monotonically_increasing_id()))
    pairs = stored(pairs, "phrase-pairs")
    first = shorter.select(F.col("id").alias("a"), "lang", F.col("f").alias("fa"),
                           F.col("words").alias("wa"), "heads")
    last = shorter.select(F.col("id").alias("b"), F.col("f").alias("fb"),
                          F.element_at("words", -1).alias("wb"), "tails")
    return stored(pairs.join(first, "a").join(last, "b").select(
        "id", "a", "b", "lang", "f", F.array_append("wa", F.col("wb")).alias("words"),
        F.array_append("heads", F.col("fa")).alias("heads"),
        F.array_append("tails", F.col("fb")).alias("tails")), "phrase-level")


def _extended(relation: DataFrame, phrases: DataFrame) -> DataFrame:
    """The relation of the longer phrases: a semi-join leaves the frequent ones."""
    wide = relation.mapInArrow(_occurrences, "block long, place long, a long, b long")
    some = wide.join(phrases.select("a", "b", "id"), ["a", "b"]).select("block", "place", "id")
    parts = some.mapInArrow(_gathered, _RELATION).groupBy("block").agg(
        F.collect_list(F.struct("step", "phrase")).alias("parts"))
    return stored(parts.select("block", F.col("parts.step").alias("steps"),
                               F.col("parts.phrase").alias("phrases"))
                  .mapInArrow(_regrouped, _RELATION), "phrase-relation")


def _frequent_words(blocks: DataFrame, min_count: int) -> DataFrame:
    """Where the frequent words stand in the blocks' lists: ``block, code, id, lang, f, word``, the
    word in one row of each id only. One exchange counts and numbers them; a word has one row per
    block at most."""
    own = blocks.select("block", "lang",
                        F.posexplode(F.arrays_zip("words", "counts")).alias("code", "own"))
    same = Window.partitionBy("lang", "word")
    numbered = (own.select("block", "lang", "code", F.col("own.words").alias("word"),
                           F.col("own.counts").alias("n"))
                .repartition("lang", "word").withColumn("row", F.monotonically_increasing_id())
                .select("*", F.sum("n").over(same).alias("f"),
                        F.min("row").over(same).alias("id")))
    return stored(numbered.where(F.col("f") >= min_count).select(
        "block", "code", "id", "lang", "f",
        F.when(F.col("row") == F.col("id"), F.col("word")).alias("word")), "phrase-words")


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                     block_bytes: int = BLOCK_BYTES) -> tuple[list[DataFrame], DataFrame]:
    """The frequent phrases of 1, 2, ... ``max_words`` words as stored tables, and ``lang, n``, the
    number of words of each language."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"),
                        docs[text_col].cast("string").alias("text")).where("text is not null")
    blocks = stored(texts.mapInArrow(
        _blocks(block_bytes), "block long, lang string, words array<binary>, "
                              "counts array<long>, line binary"), "phrase-blocks")
    totals = stored(blocks.select("lang", F.aggregate(
        "counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
        .groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    no_counts = F.array().cast("array<long>")
    own = _frequent_words(blocks, min_count)
    level = stored(own.where("word is not null").select(
        "id", "lang", "f", F.array("word").alias("words"), no_counts.alias("heads"),
        no_counts.alias("tails")), "phrase-level")
    found = own.groupBy("block").agg(F.collect_list(F.struct("code", "id")).alias("found")).select(
        "block", F.col("found.code").alias("codes"), F.col("found.id").alias("ids"))
    # Both sides grow with the texts; the size of a compressed file would mislead the planner.
    relation = stored(blocks.select("block", "line").join(found.hint("merge"), "block").mapInArrow(
        _numbered, _RELATION), "phrase-relation")
    levels = [level]
    for length in range(2, max_words + 1):
        level = _longer(relation, level, min_count)
        levels.append(level)
        if length < max_words:
            relation = _extended(relation, level)
    return levels, totals


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` phrases per language: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z are lower-cased; texts fall into pieces at ``. , ; : ! ?`` and line ends, and pieces into
    words at blanks and tabs. ``a`` counts a phrase's occurrences within pieces, overlaps included,
    ``n`` all words of the language. Cutting a phrase in two counted ``l`` and ``r`` times gives
    ``1000 * a * n / (l * r)``, rounded down; the lowest such score counts, the earliest cut among
    equals. Phrases of 2 to ``max_words`` words with ``a >= min_count`` compete, without those that
    a longer one of them contains as often as they occur. Equal scores are ordered by ``a``, the
    greater first, then by the phrase's bytes.

    A null language counts as ``und``; null, empty and blank texts have no words; equal texts count
    each time. Texts are read whole; very long ones are cut at their own breaks, and only a piece
    without any is held at once. An empty table gives no rows; other columns are not read.
    """
    levels, totals = frequent_phrases(docs, text_col, lang_col, min_count, max_words, block_bytes)
    kept = []
    for k in range(1, len(levels)):
        level = levels[k].drop("a", "b")
        if k + 1 < len(levels):
            whole = levels[k + 1].select(F.explode(F.array("a", "b")).alias("id"), "f").distinct()
            level = level.join(whole, ["id", "f"], "left_anti")
        kept.append(level.select("lang", "words", "f", "heads", "tails"))
    if not kept:
        raise ValueError("max_words must be 2 or more")
    every = kept[0]
    for level in kept[1:]:
        every = every.unionByName(level)
    cuts = F.expr("""transform(sequence(1, size(heads)), k -> named_struct(
        'score', 1000 * cast(f as decimal(19, 0)) * cast(n as decimal(19, 0)) div (
            cast(heads[k - 1] as decimal(19, 0)) * cast(tails[size(heads) - k] as decimal(19, 0))),
        'k', k, 'l', heads[k - 1], 'r', tails[size(heads) - k]))""")
    scored = every.join(totals, "lang").withColumn("cut", F.array_min(cuts)).select(
        "lang", F.array_join(F.col("words").cast("array<string>"), " ").alias("phrase"),
        F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
