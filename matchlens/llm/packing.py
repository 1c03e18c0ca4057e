"""Order-preserving packing of documents into token sequences by dynamic programming.

Documents are laid end to end in the order in which their partition holds them, and windows of
at most ``length`` tokens are cut from that line. Cuts may fall after a document, after a
sentence, or, dearer, elsewhere. For cut candidates ``p_0 < p_1 < ...`` with penalties ``t``

    cost(j) = t_j + min over p_j - p_i <= length of  cost(i) + padding(p_j - p_i)

where the padding of n tokens is ``length - n``, or 0 when n is a power of two. As
``cost(i) + length - (p_j - p_i)`` orders the candidates i alike for every j, a monotone queue of
``cost(i) + p_i`` gives the minimum of the sliding window in constant time; the few powers of two
are looked up. Every task solves blocks of bounded size and carries the unfinished window into
the next block, so nothing is shuffled and memory does not grow with the partition.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame

from matchlens.llm.bytebpe import encoder
from matchlens.llm.columns import id_and_text

LENGTH = 2048
END_ID = 1
BLOCK_TOKENS = 1 << 18
SENTENCE_PENALTY = 12.0
WORD_PENALTY = 48.0
WORD_GRID = 128  # where no sentence ends, a cut is possible after so many tokens


def padding(tokens: int, length: int = LENGTH) -> int:
    return 0 if tokens & (tokens - 1) == 0 else length - tokens


def candidates(ends: np.ndarray, sentences: np.ndarray, total: int,
               grid: int = WORD_GRID) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions in ``(0, total]`` and their penalties.

    ``ends``: positions after documents, the last being ``total``. ``sentences``: after
    sentences. Gaps over ``2 * grid`` get cuts inside, so that every window has one.
    """
    fees = np.full(total + 1, np.inf)
    fees[sentences] = SENTENCE_PENALTY
    fees[ends] = 0.0
    marks = np.flatnonzero(np.isfinite(fees))
    gaps = np.diff(marks, prepend=0)
    for k in np.flatnonzero(gaps > 2 * grid):
        fees[marks[k] - gaps[k] + grid:marks[k]:grid] = WORD_PENALTY
    positions = np.flatnonzero(np.isfinite(fees))
    penalties = fees[positions]
    return positions, penalties


def best_cuts(positions: np.ndarray, penalties: np.ndarray, length: int = LENGTH) -> list[int]:
    """Positions of the cheapest cuts, the last candidate included."""
    place = np.append(0, positions)
    at = place.tolist()
    fees = [0.0, *penalties.tolist()]
    index = np.full(2 * length + at[-1] + 1, -1, np.int32)  # position + length -> candidate
    index[place + length] = np.arange(len(at))
    powers: dict[int, list[int]] = {}
    power = 1
    while power < length:
        found = index[place + length - power]
        hits = np.flatnonzero(found >= 0)
        for j, i in zip(hits.tolist(), found[hits].tolist()):
            powers.setdefault(j, []).append(i)
        power *= 2
    cost, came = [0.0] * len(at), [0] * len(at)
    queue, keys = deque([0]), [0.0] * len(at)
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0]] < here - length:
            queue.popleft()
        best = queue[0]
        low = keys[best] + length - here
        for i in powers.get(j, ()):
            if cost[i] < low:
                low, best = cost[i], i
        cost[j] = low + fees[j]
        came[j] = best
        keys[j] = key = cost[j] + here
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(at[j])
        j = came[j]
    return cuts[::-1]


def unpadded_tail(start: int, end: int, length: int = LENGTH) -> list[int]:
    """Cuts of the last window of a task: powers of two as long as padding costs more."""
    cuts = []
    while start < end:
        left = end - start
        step = 1 << (left.bit_length() - 1)
        if padding(left, length) <= WORD_PENALTY:
            step = left
        start += step
        cuts.append(start)
    return cuts


class _Line:
    """Documents of one task laid end to end, and the pieces cut from them."""

    def __init__(self, length: int, keep_ids: bool):
        self.length, self.keep_ids = length, keep_ids
        self.sequence = TaskContext.get().partitionId() << 32 if TaskContext.get() else 0
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, int]] = []  # id, tokens before here, all tokens
        self.sentences: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id, ids: np.ndarray, sentences: np.ndarray) -> None:
        self.docs.append((doc_id, 0, len(ids)))
        self.ids.append(ids)
        self.sentences.append(sentences + self.size)
        self.size += len(ids)

    def cut(self, last: bool) -> pa.RecordBatch | None:
        """Pieces of the finished windows. Unless this is the last call, the tokens after the
        last finished window stay on the line."""
        if not self.size:
            return None
        ids = np.concatenate(self.ids)
        ends = np.cumsum([len(x) for x in self.ids])
        starts = ends - [len(x) for x in self.ids]
        positions, penalties = candidates(ends, np.concatenate(self.sentences), self.size)
        cuts = best_cuts(positions, penalties, self.length)
        tail = cuts[-2] if len(cuts) > 1 else 0
        if last:
            cuts = cuts[:-1] + unpadded_tail(tail, self.size, self.length)
        else:
            cuts = cuts[:-1]
        batch = self._pieces(ids, starts, np.array([0, *cuts], np.int64)) if cuts else None
        first = 0 if last else int(np.searchsorted(ends, tail, "right"))
        if last:
            self.__init__(self.length, self.keep_ids)
        else:
            offset = max(0, tail - int(starts[first])) if first < len(starts) else 0
            marks = np.concatenate(self.sentences)
            self.docs = self.docs[first:]
            self.ids = self.ids[first:]
            if offset:
                doc_id, before, total = self.docs[0]
                self.docs[0] = (doc_id, before + offset, total)
                self.ids[0] = self.ids[0][offset:]
            self.sentences = [marks[marks > tail] - tail]
            self.size -= tail
        return batch

    def _pieces(self, ids: np.ndarray, starts: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
        edges = np.union1d(starts[starts < cuts[-1]], cuts)
        begin, end = edges[:-1], edges[1:]
        doc = np.searchsorted(starts, begin, "right") - 1
        window = np.searchsorted(cuts, begin, "right") - 1
        doc_ids = [self.docs[d][0] for d in doc]
        before = np.array([self.docs[d][1] for d in doc], np.int64)
        total = np.array([self.docs[d][2] for d in doc], np.int64)
        raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
        checks = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), end.tolist())]
        columns = [pa.array(doc_ids, pa.int64()), pa.array(begin - starts[doc] + before),
                   pa.array(end - begin), pa.array(checks, pa.int64()), pa.array(total),
                   pa.array(self.sequence + window), pa.array(begin - cuts[window])]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if self.keep_ids:
            offsets = pa.array(np.append(begin, end[-1]).astype(np.int32))
            columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())))
            names.append("ids")
        self.sequence += len(cuts) - 1
        return pa.RecordBatch.from_arrays(columns, names=names)


def pack(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
         text_col: str = "text", length: int = LENGTH, end_id: int = END_ID,
         keep_ids: bool = True) -> DataFrame:
    """One row per piece of a document: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and, on request, the piece's ``ids``.

    A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone. Every id lies
    in exactly one piece, pieces fill a sequence without gaps, and documents keep the order of
    their partition. Rows with equal or null ids are documents of their own. ``sequence_id``
    holds the number of the partition above its 32nd bit: it is unique, not dense. ``length``
    is a power of two. An empty table gives no rows; other columns are not read.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    if length & (length - 1):
        raise ValueError("length must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, line = encoder(path), _Line(length, keep_ids)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = model.encode(text.as_py())
                marks = np.flatnonzero(model.ends[ids[:-1]] & model.starts[ids[1:]]) + 1 \
                    if len(ids) else np.zeros(0, np.int64)
                line.add(doc_id, np.append(ids, np.int32(end_id)), marks)
                if line.size >= BLOCK_TOKENS:
                    done = line.cut(last=False)
                    if done is not None:
                        yield done
        done = line.cut(last=True)
        if done is not None:
            yield done

    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long") + ", ids array<int>" * keep_ids
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
