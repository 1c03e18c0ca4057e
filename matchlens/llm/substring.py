"""Repeated word passages by compaction of the de Bruijn graph of the corpus.

Windows of ``window`` words are the edges of the graph. A document's consecutive windows with one
anchor (the least hash of ``INNER`` words inside) are a path, compacted before anything moves.
The exchange by anchor joins equal paths. An anchor with a single path has no branch: later
copies of the path go as a whole. Where paths branch, the windows of the first copies are opened
and joined edge by edge. The coordinates that return name the words to remove.
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
from matchlens.llm.columns import pieces_by_bytes, stored

WINDOW = 13
INNER = 5
BATCH_BYTES = 1 << 20


def _windows(batch: pa.RecordBatch, window: int):
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    words, _, _, first = hashing.words(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    valid = np.zeros(len(words), bool)
    if len(words) >= window:
        valid[:len(words) - window + 1] = owner[:len(words) - window + 1] == owner[window - 1:]
    return words, first, owner, valid


def _paths(window: int):
    def find(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        words, first, owner, valid = _windows(batch, window)
        inner = hashing.sequence_hash(words, INNER, 1)
        start, count, anchor, content = stretches(inner, words, valid, window)
        doc = owner[start]
        ids = batch.column("doc_id").to_numpy()[doc]
        tags = batch.column("tag").to_numpy()[doc]
        return anchor, content, ids, places(start - first[doc], tags, count)
    return find


def _edges(window: int):
    """Windows of the first copies of branching paths."""
    def find(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        words, first, _, _ = _windows(batch, window)
        hashes = hashing.sequence_hash(words, window, 2)
        out = []
        for row, (doc_id, tag, found) in enumerate(zip(
                batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(),
                batch.column("found"))):
            items = found.values.flatten().to_numpy().reshape(-1, 2)
            start, tags, count = unpack(items[:, 1])
            mine = tags == tag
            start, count, anchor = start[mine], count[mine], items[mine, 0]
            inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = np.repeat(start, count) + inside
            out.append((np.repeat(anchor, count).view(np.uint64), hashes[first[row] + at],
                        np.full(len(at), doc_id, np.int64),
                        places(at, np.full(len(at), tag), np.ones(len(at)))))
        return tuple(np.concatenate(x) for x in zip(*out))
    return find


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``doc_id, item``: spans of words to remove, as ``[tag, start, end]``."""
    texts = tagged(docs, id_col, text_col)
    found = stored(owned(scan(texts, _paths(window), False, BATCH_BYTES), "anchor", False, True),
                   "substring-paths")
    heads = found.where("head").select("doc_id", F.array("anchor", "place").alias("item"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from combine((_edges(window)(b) for b in pieces_by_bytes(batches, BATCH_BYTES)),
                           False)

    edges = beside_text(texts, heads, "inner").mapInArrow(run, ROWS)
    more = owned(edges, "content", False, False)
    removed = found.where("not head").select("doc_id", "place").unionByName(
        more.select("doc_id", "place"))
    return stored(merged_spans(removed, window - 1), "substring-spans")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row of ``docs``.

    Words are runs of bytes that are not ASCII white space. A word goes if a window over it, of
    ``window`` words of its document, also starts in a document with a smaller id, judged on the
    input. The kept words are joined by one space. Null and empty texts have no words. Rows with
    a null id lose nothing and make no other lose anything; rows with equal ids are not smaller
    than each other. An empty table gives an empty result; other columns are not read.
    """
    spans = repeated_spans(docs, id_col, text_col, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_by_bytes(batches, BATCH_BYTES):
            words, removed, kept = [], [], []
            for text, tag, found in zip(batch.column("text").cast(pa.binary()).to_pylist(),
                                        batch.column("tag").to_pylist(),
                                        batch.column("found").to_pylist()):
                own, out, at = text.split(), [], 0  # splits at exactly the six blanks
                for start, end in spans_of(found, tag):
                    out += own[at:start]
                    at = end
                out += own[at:]
                words.append(len(own))
                removed.append(len(own) - len(out))
                kept.append(b" ".join(out).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])

    return beside_text(tagged(docs, id_col, text_col), spans, "left").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_text string")


def digests(docs: DataFrame, **options) -> DataFrame:
    """:func:`remove_repeats` with the kept words as their SHA-256."""
    return remove_repeats(docs, **options).withColumn(
        "kept_sha256", F.sha2("kept_text", 256)).drop("kept_text")
