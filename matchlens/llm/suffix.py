"""Repeated byte strings by merging Burrows-Wheeler transforms of shards.

Strings of ``window`` bytes that occur again are found in two steps. First, stretches of windows
meet by anchor (see :mod:`matchlens.llm.anchors`): whole stretches that occur earlier are done,
and only the first copies of stretches with branching anchors stay, so what follows never sees
text that is unique. Their bytes then meet by anchor. Each task sorts the rotations of bounded
shards and merges the shards' transforms: an interleave, at first shard after shard, is refined
by stable counting sorts of the preceding symbols until it is sorted by ``window`` symbols. No
suffix is sorted twice. Neighbours in the merged order whose common prefix reaches the window
form the repeated intervals; all but the earliest member of each goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.llm import hashing
from matchlens.llm.anchors import (ROWS, beside_text, combine, merged_spans, owned, places, scan,
                                   spans_of, stretches, tagged, unpack)
from matchlens.llm.columns import pieces_by_bytes, small_enough, stored

WINDOW = 100
INNER = 32
BATCH_BYTES = 2 << 20
SHARD_BYTES = 1 << 20
GROUP_BYTES = 2 << 20
HOT_HEADS = 5_000  # of one anchor; their windows are joined one by one instead
REMOVED = "doc_id long, place long"


def _joined_hashes(texts: list[bytes]):
    data, starts, sizes = hashing.joined(texts)
    values = hashing.byte_codes()[data]
    return data, starts, sizes, values


def _run_hash(values: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` bytes."""
    sums, down = hashing.prefix_sums(values)
    count = len(values) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    return hashing.mix((sums[length:] - sums[:count]) * down[:count])


def _stretches(window: int):
    def find(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        data, starts, sizes, values = _joined_hashes(texts)
        valid = np.zeros(len(data) + 1, np.int8)
        has = sizes >= window
        np.add.at(valid, starts[has], 1)
        np.add.at(valid, (starts + sizes - window + 1)[has], -1)
        valid = np.cumsum(valid[:-1], dtype=np.int8).astype(bool)
        start, count, anchor, content = stretches(_run_hash(values, INNER), values, valid, window)
        doc = np.searchsorted(starts, start, "right") - 1
        ids = batch.column("doc_id").to_numpy()[doc]
        tags = batch.column("tag").to_numpy()[doc]
        return anchor, content, ids, places(start - starts[doc], tags, count)
    return find


def _mine(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, bytes, np.ndarray, np.ndarray]]:
    """Row, document, tag, text, and the anchors and places of the text's stretches."""
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    for row, (doc_id, tag, found) in enumerate(zip(
            batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(),
            batch.column("found"))):
        items = found.values.flatten().to_numpy().reshape(-1, 2)
        items = items[unpack(items[:, 1])[1] == tag]
        yield row, doc_id, tag, texts[row], items[:, 0], items[:, 1]


def _pieces(window: int):
    """The bytes of first copies of stretches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_by_bytes(batches, BATCH_BYTES):
            out = [(int(anchor), doc_id, int(place), text[start:start + count + window - 1])
                   for _, doc_id, _, text, anchors, at in _mine(batch)
                   for anchor, place, start, count in zip(
                       anchors, at, (at >> 32).tolist(), (at & 0xFF).tolist())]
            columns = list(zip(*out)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["anchor", "doc_id", "place", "piece"])
    return run


def _single_windows(window: int):
    """Hashes of the single windows of stretches, for anchors too frequent for one task."""
    def find(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        _, starts, _, values = _joined_hashes(batch.column("text").cast(pa.binary()).to_pylist())
        hashes = _run_hash(values, window)
        out = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64),
                np.zeros(0, np.int64))]
        for row, doc_id, tag, _, anchors, at in _mine(batch):
            start, _, count = unpack(at)
            inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            where = np.repeat(start, count) + inside
            out.append((np.repeat(anchors, count).view(np.uint64), hashes[starts[row] + where],
                        np.full(len(where), doc_id, np.int64),
                        places(where, np.full(len(where), tag), np.ones(len(where)))))
        return tuple(np.concatenate(x) for x in zip(*out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from combine((find(b) for b in pieces_by_bytes(batches, BATCH_BYTES)), True)
    return run


def shard_transform(symbols: np.ndarray, starts: np.ndarray,
                    depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotations of a shard sorted by ``depth`` symbols, and the two symbols before each.

    ``symbols``: texts one after the other, each ended by a 0, which nothing else is; each text
    is a ring. Ranks of 7 symbols are doubled until the last step covers ``depth`` by overlap.
    """
    size = len(symbols)
    ends = np.append(starts[1:], size) - 1
    following, before = np.arange(1, size + 1), np.arange(-1, size - 1)
    following[ends], before[starts] = starts, ends
    jump, key, span = np.arange(size), symbols.astype(np.uint64), 1
    hops = {0: jump, 1: following}
    while span < min(7, depth):
        jump = following[jump]
        key = (key << np.uint64(8)) | symbols[jump]
        span += 1
    jump = following[jump]
    while True:
        order = np.argsort(key, kind="stable")
        rank = np.empty(size, np.uint64)
        sorted_key = key[order]
        rank[order] = np.cumsum(np.append(False, sorted_key[1:] != sorted_key[:-1]))
        if span >= depth:
            break
        hops[span] = jump
        step = min(span, depth - span)
        far = np.arange(size)
        left = step
        for hop in sorted(hops, reverse=True):
            while hop and left >= hop:
                far, left = hops[hop][far], left - hop
        key = (rank << np.uint64(32)) | rank[far]
        jump = far if step < span else jump[jump]
        span += step
    two = (symbols[before[before[order]]].astype(np.uint16) << 8) | symbols[before[order]]
    return order, two


def merge(transforms: list[np.ndarray], depth: int) -> np.ndarray:
    """The shard of each row of the merged order, given the two symbols before each shard row.

    Round k sorts the interleave by 2 * k symbols: rows are visited in the order of the last
    round and put, stably, behind the two symbols that precede them.
    """
    shard = np.repeat(np.arange(len(transforms), dtype=np.uint8), [len(t) for t in transforms])
    if len(transforms) == 1:
        return shard
    flat, seen = np.concatenate(transforms), np.empty(len(shard), np.uint16)
    for _ in range((depth + 1) // 2):
        seen[np.argsort(shard, kind="stable")] = flat
        finer = shard[np.argsort(seen, kind="stable")]
        if np.array_equal(finer, shard):
            break
        shard = finer
    return shard


def repeated_windows(pieces: list[bytes], docs: np.ndarray, place: np.ndarray, window: int,
                     shard_bytes: int = SHARD_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """``doc_id, place`` of the runs of windows in ``pieces`` that also start earlier.

    Earlier: in a smaller document, or before in the same one. A piece holds the bytes of a
    stretch of windows at ``place``.
    """
    start, tags, count = unpack(place)
    sizes = np.array([len(p) for p in pieces], np.int64) + 1
    begins = np.concatenate([[0], np.cumsum(sizes)])
    # UTF-8 holds no byte 255, so every byte plus 1 fits and 0 is free to end a piece.
    symbols = np.frombuffer(b"\xff".join([*pieces, b""]), np.uint8) + np.uint8(1)
    cuts = [0]
    for k in range(1, len(pieces)):
        if begins[k + 1] - begins[cuts[-1]] > shard_bytes and len(cuts) < 255:
            cuts.append(k)
    cuts.append(len(pieces))
    orders, transforms = [], []
    for a, b in zip(cuts[:-1], cuts[1:]):
        low, high = begins[a], begins[b]
        order, two = shard_transform(symbols[low:high], begins[a:b] - low, window)
        orders.append(order + low)
        transforms.append(two)
    shard = merge(transforms, window)
    merged = np.empty(len(symbols), np.int64)
    merged[np.argsort(shard, kind="stable")] = np.concatenate(orders)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    inside = np.arange(len(symbols)) - begins[owner]
    at = merged[(inside < count[owner])[merged]]  # rotations that begin with a whole window
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    packed = np.zeros(len(symbols), np.uint64)
    for k in range(8):
        packed[:len(symbols) - k] |= symbols[k:].astype(np.uint64) << np.uint64(8 * k)
    same = np.ones(len(at) - 1, bool)
    for offset in [*range(0, window - 7, 8), window - 8]:
        here = packed[at + offset]
        same &= here[1:] == here[:-1]
    edge = np.flatnonzero(np.append(True, ~same))
    rows, off = owner[at], start[owner[at]] + inside[at]
    by_place = np.lexsort((tags[rows], off, docs[rows]))
    fresh = np.append(False, (np.diff(docs[rows][by_place]) != 0) | (np.diff(off[by_place]) != 0)
                      | (np.diff(tags[rows][by_place]) != 0))
    rank = np.empty(len(at), np.int64)
    rank[by_place] = np.cumsum(fresh)
    first = np.repeat(np.minimum.reduceat(rank, edge), np.diff(np.append(edge, len(at))))
    gone = np.sort(at[rank != first])
    run = np.flatnonzero(np.append(True, np.diff(gone) != 1)) if len(gone) else gone
    length = np.diff(np.append(run, len(gone)))
    head = gone[run]
    row = owner[head]
    return docs[row], places(start[row] + inside[head], tags[row], length)


def _merge_groups(window: int):
    """Anchor by anchor, as many together as fit, the repeated windows of their pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def solve(rows: list[tuple]) -> pa.RecordBatch:
            docs, place = repeated_windows(
                [r[3] for r in rows], np.array([r[1] for r in rows], np.int64),
                np.array([r[2] for r in rows], np.int64), window)
            return pa.RecordBatch.from_arrays([pa.array(docs), pa.array(place)],
                                              names=["doc_id", "place"])

        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in
                             ("anchor", "doc_id", "place", "piece"))):
                if size > GROUP_BYTES and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)
    return run


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, window: int,
                   hot_heads: int | None = None) -> DataFrame:
    """``doc_id, item``: spans of bytes to remove, as ``[tag, start, end]``.

    ``hot_heads``: ``HOT_HEADS`` at the time of the call, if none.
    """
    hot_heads = HOT_HEADS if hot_heads is None else hot_heads
    texts = tagged(docs, id_col, text_col)
    found = stored(owned(scan(texts, _stretches(window), True, BATCH_BYTES), "anchor", True, True),
                   "suffix-stretches")
    heads = found.where("head").select("anchor", "doc_id", "place")
    hot = stored(heads.groupBy("anchor").count().where(F.col("count") > hot_heads)
                 .select("anchor"), "suffix-hot")
    item = F.array("anchor", "place").alias("item")
    often = heads.join(small_enough(hot, 1_000_000), "anchor", "left_semi")
    rare = heads.join(small_enough(hot, 1_000_000), "anchor", "left_anti")
    pieces = beside_text(texts, rare.select("doc_id", item), "inner").mapInArrow(
        _pieces(window), "anchor long, doc_id long, place long, piece binary")
    merged = (pieces.repartition("anchor").sortWithinPartitions("anchor")
              .mapInArrow(_merge_groups(window), REMOVED))
    removed = found.where("not head").select("doc_id", "place").unionByName(merged)
    if not hot.isEmpty():
        single = beside_text(texts, often.select("doc_id", item), "inner").mapInArrow(
            _single_windows(window), ROWS)
        removed = removed.unionByName(owned(single, "content", True, False)
                                      .select("doc_id", "place"))
    return stored(merged_spans(removed, window - 1), "suffix-spans")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary) for every row of ``docs``.

    A byte goes if a string of ``window`` bytes over it also starts earlier: in a document with a
    smaller id, or before in the same one. Matches may overlap, never leave their document, and
    are judged on the input. ``n_spans`` counts maximal runs of removed bytes. Null and empty
    texts have no bytes. Rows with a null id lose nothing and make no other lose anything; rows
    of the same id and text are one document; of rows of one id with different texts, the earlier
    start counts as earlier. An empty table gives an empty result; other columns are not read.
    """
    spans = repeated_spans(docs, id_col, text_col, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_by_bytes(batches, BATCH_BYTES):
            rows = []
            for text, tag, found in zip(batch.column("text").cast(pa.binary()).to_pylist(),
                                        batch.column("tag").to_pylist(),
                                        batch.column("found").to_pylist()):
                own, out, at = spans_of(found, tag), [], 0
                for start, end in own:
                    out.append(text[at:start])
                    at = end
                kept = b"".join([*out, text[at:]])
                rows.append((len(text), len(text) - len(kept), len(own), kept))
            columns = list(zip(*rows)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return beside_text(tagged(docs, id_col, text_col), spans, "left").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digests(docs: DataFrame, **options) -> DataFrame:
    """:func:`remove_repeats` with the kept bytes as their SHA-256."""
    return remove_repeats(docs, **options).withColumn(
        "kept_sha256", F.sha2("kept", 256)).drop("kept")
