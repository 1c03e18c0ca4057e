"""Finding repeated windows of a corpus with one small row per stretch of windows.

Windows of a document that follow one another and share the place of their least inner hash (their
*anchor*) form a stretch. Equal windows have equal anchors, wherever they lie, so only stretches of
one anchor have to meet. One exchange by anchor brings them together, sorted by content:

* a stretch whose content lies in an earlier document is repeated as a whole;
* an anchor with one content has no branches and is done;
* the first stretches of the other, branching anchors are returned to be compared window by
  window.

Tasks merge what they have met themselves before the exchange: of a passage that a third of all
documents share, one row per task batch is sent. The owner of an anchor streams over its rows and
keeps one of them, so no group is held in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.llm.columns import id_and_text, pieces_by_bytes, small_enough, stored
from matchlens.llm.hashing import mix, prefix_sums, sliding_min, span_hash

ROWS = "anchor long, content long, doc_id long, place long, known boolean"
FOUND = "anchor long, doc_id long, place long, head boolean"
COMBINE_ROWS = 1 << 19
BROADCAST_PLACES = 4_000_000

# A place is start << 32 | tag << 8 | windows: where a stretch starts, a 24-bit tag of the text it
# lies in (two rows may share an id), and how many windows it has, fewer than 256.


def tag(text_key):
    """The tag of a text within a place, from its 64-bit key."""
    return F.shiftright(text_key, 20).bitwiseAND(0xFFFFFF)


def places(start: np.ndarray, tags: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << 32) | (tags.astype(np.int64) << 8) | count.astype(np.int64)


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 32, (place >> 8) & 0xFFFFFF, place & 0xFF


def stretches(inner: np.ndarray, values: np.ndarray, valid: np.ndarray,
              window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, anchor and content hash of each stretch.

    ``inner``: hash at each place of the batch of a run shorter than the window; ``values``: the
    symbols; ``valid``: whether a window starts there without leaving its document.
    """
    count = len(values) - window + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    low = sliding_min(inner, len(inner) - count + 1)
    valid = valid[:count]
    # A stretch ends where the least hash changes or its leftmost copy leaves the window, so two
    # windows of one stretch are never equal.
    left = inner[:count - 1] == low[:-1]
    new = valid & np.append(True, (low[1:] != low[:-1]) | left | ~valid[:-1])
    first = np.flatnonzero(new)
    last = np.flatnonzero(valid & ~np.append(valid[1:] & ~new[1:], False))
    sums, down = prefix_sums(values)
    return first, last - first + 1, low[first], span_hash(sums, down, first, last + window)


def combine(parts: Iterable[tuple[np.ndarray, ...]], later_in_doc: bool) -> Iterator[pa.RecordBatch]:
    """Rows ``(anchor, content, doc_id, place)`` with those known to be repeated marked.

    A row is known if the same batch has its content in a smaller document or, with
    ``later_in_doc``, earlier in its own. Known rows need no owner; their anchor becomes a hash
    of their place, which spreads them.
    """
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        anchor, content, doc, place = (np.concatenate(x) for x in zip(*held))
        key = mix(anchor ^ mix(content))
        order = np.lexsort((place, doc, key))
        anchor, content, doc, place, key = (x[order] for x in (anchor, content, doc, place, key))
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(key))))
        known = doc > doc[starts][group]
        if later_in_doc:  # the same place again comes from a row that repeats id and text
            known |= (doc == doc[starts][group]) & (place != place[starts][group])
        anchor = np.where(known, mix(place.view(np.uint64) ^ key), anchor)
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(doc),
             pa.array(place), pa.array(known)],
            names=["anchor", "content", "doc_id", "place", "known"])

    for part in parts:
        if not len(part[0]):
            continue
        held.append(part)
        size += len(part[0])
        if size >= COMBINE_ROWS:
            yield flush()
            held.clear()
            size = 0
    if held:
        yield flush()


def _own(later_in_doc: bool, heads: bool):
    """Streams over rows sorted by anchor, content, document and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        carry = (none, none, none, none, none.astype(bool), none.astype(bool))
        for batch in batches:
            anchor, content, doc, place, known = (
                column.to_numpy(zero_copy_only=False) for column in batch.columns)
            out = [(anchor[known], doc[known], place[known], np.zeros(known.sum(), bool))]
            fresh = ~known
            blank = np.zeros(fresh.sum(), bool)
            rows = (anchor[fresh], content[fresh], doc[fresh], place[fresh], blank, blank)
            anchor, content, doc, place, done, many = (
                np.concatenate(x) for x in zip(carry, rows))
            if len(anchor):
                new = np.append(True, anchor[1:] != anchor[:-1])
                new_content = new | np.append(True, content[1:] != content[:-1])
                path = np.cumsum(new_content) - 1
                owner = np.cumsum(new) - 1
                first = np.flatnonzero(new_content)
                head = np.zeros(len(anchor), bool)
                head[first] = True
                same = doc == doc[first][path]
                if not later_in_doc:
                    head = same
                gone = ~head & ~done
                if later_in_doc:
                    gone &= ~(same & (place == place[first][path]))
                out.append((anchor[gone], doc[gone], place[gone], np.zeros(gone.sum(), bool)))
                branching = np.bincount(owner, new_content) > 1
                branching |= np.bincount(owner, many) > 0
                if heads:
                    send = head & branching[owner] & ~done
                    out.append((anchor[send], doc[send], place[send], np.ones(send.sum(), bool)))
                if branching[-1] or not heads:
                    keep = first[-1:]
                    carry = (anchor[keep], content[keep], doc[keep], place[keep],
                             np.ones(1, bool), branching[-1:])
                else:
                    keep = np.flatnonzero((owner == owner[-1]) & head)
                    carry = (anchor[keep], content[keep], doc[keep], place[keep], done[keep],
                             many[keep])
            columns = [np.concatenate(x) for x in zip(*out)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                             names=["anchor", "doc_id", "place", "head"])
    return run


def owned(rows: DataFrame, by: str, later_in_doc: bool, heads: bool) -> DataFrame:
    """Places that are repeated (``head`` false) and, with ``heads``, the first stretches of
    branching anchors (``head`` true). Rows meet by column ``by``."""
    return (rows.repartition(by).sortWithinPartitions("anchor", "content", "doc_id", "place")
            .select("anchor", "content", "doc_id", "place", "known")
            .mapInArrow(_own(later_in_doc, heads), FOUND))


def tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, tag, text``."""
    return id_and_text(docs, id_col, text_col).select(
        "doc_id", tag(F.xxhash64("text")).alias("tag"), "text")


def scan(texts: DataFrame, find: Callable[[pa.RecordBatch], tuple[np.ndarray, ...]],
         later_in_doc: bool, batch_bytes: int) -> DataFrame:
    """Rows for :func:`owned` of all texts; those with a null id take no part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (find(batch) for batch in pieces_by_bytes(batches, batch_bytes))
        yield from combine(parts, later_in_doc)

    return texts.where("doc_id is not null").mapInArrow(run, ROWS)


def beside_text(texts: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``doc_id, tag, text, found``: each text with the list of its document's rows in ``found``,
    a stored table with columns ``doc_id`` and ``item``.

    Few rows are sent to the texts; many are met by an exchange.
    """
    lists = found.groupBy("doc_id").agg(F.collect_list("item").alias("found"))
    if found.count() <= BROADCAST_PLACES:
        lists = small_enough(stored(lists, "place-lists"), BROADCAST_PLACES)
    lists = lists.withColumnRenamed("doc_id", "found_id")
    return texts.join(lists, texts["doc_id"] == lists["found_id"], how).select(
        "doc_id", "tag", "text", "found")


def merged_spans(removed: DataFrame, extra: int) -> DataFrame:
    """Repeated places as disjoint spans per document: ``doc_id, item`` with the item an array
    ``[tag, start, end]``. A place of c windows covers c + ``extra`` symbols."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, items = [], []
            for doc_id, some in zip(batch.column("doc_id").to_pylist(), batch.column("found")):
                start, tags, count = unpack(some.values.to_numpy())
                for one in np.unique(tags):
                    mine = tags == one
                    order = np.argsort(start[mine], kind="stable")
                    begin = start[mine][order]
                    end = np.maximum.accumulate((begin + count[mine][order] + extra))
                    edge = np.flatnonzero(np.append(True, begin[1:] > end[:-1]))
                    last = np.append(edge[1:], len(begin)) - 1
                    ids += [doc_id] * len(edge)
                    items += np.stack([np.full(len(edge), one), begin[edge], end[last]],
                                      axis=1).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(items, pa.list_(pa.int64()))],
                names=["doc_id", "item"])

    lists = removed.groupBy("doc_id").agg(F.collect_list("place").alias("found"))
    return lists.mapInArrow(run, "doc_id long, item array<long>")


def spans_of(found, tag_value: int) -> list[tuple[int, int]]:
    """The spans of one text out of its document's list."""
    return sorted((start, end) for t, start, end in found or [] if t == tag_value)
