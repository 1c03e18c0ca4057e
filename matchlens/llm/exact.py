"""Exact duplicates through an extendible-hash index on shared files.

Every text gets a 64-bit key. Only keys that occur more than once can hold equal texts, so only
their texts move. A directory maps the leading bits of a key to a bucket: it starts as one bucket
and doubles until no bucket holds more keys or bytes than fit, at most 2**16 slots. Before the
exchange every task merges the copies it has met, so a text that a third of the rows share arrives
once per task. The owner of a bucket reads its keys in order, chains texts that share a key and
compares their bytes. Its entries, without texts, are the index files in the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.llm.columns import id_and_text, one_row_each, small_enough, stored
from matchlens.session import new_shared_path

MAX_DEPTH = 16
BUCKET_KEYS = 20_000
BUCKET_BYTES = 8 << 20  # of distinct texts
COMBINE_BYTES = 32 << 20
BROADCAST_KEYS = 1_000_000
ENTRY = "bucket int, key long, text binary, n long, max_id long"


def grow_directory(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Bucket of each slot of the finest directory, given the load per slot (2**MAX_DEPTH of them).

    The directory doubles whenever the bucket to split is as deep as the directory itself; a
    bucket at the greatest depth stays overfull. Buckets are numbered in key order.
    """
    totals = np.concatenate([[0], np.cumsum(counts)])
    finest = len(counts)
    depth, directory = 0, [(0, 0)]  # slot -> (local depth, prefix)

    def held(local: int, prefix: int) -> int:
        width = finest >> local
        return int(totals[(prefix + 1) * width] - totals[prefix * width])

    while True:
        overfull = {b for b in directory if held(*b) > capacity and 2 ** b[0] < finest}
        if not overfull:
            break
        if any(local == depth for local, _ in overfull):
            directory = [bucket for bucket in directory for _ in range(2)]
            depth += 1
        directory = [(b[0] + 1, slot >> (depth - b[0] - 1)) if b in overfull else b
                     for slot, b in enumerate(directory)]
    numbers = {b: k for k, b in enumerate(dict.fromkeys(directory))}
    return np.repeat([numbers[b] for b in directory], finest // len(directory)).astype(np.int32)


def _slot(key):
    return F.shiftrightunsigned(key, 64 - MAX_DEPTH)


def _combine(directory: np.ndarray):
    """Map side: one entry per distinct text met, flushed whenever the texts held grow large."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            keys = np.array([e[0] for e in held.values()], np.int64)
            slots = keys.view(np.uint64) >> np.uint64(64 - MAX_DEPTH)
            return pa.RecordBatch.from_arrays(
                [pa.array(directory[slots.astype(np.int64)], pa.int32()), pa.array(keys),
                 pa.array(list(held), pa.binary()),
                 pa.array([e[1] for e in held.values()], pa.int64()),
                 pa.array([e[2] for e in held.values()], pa.int64())],
                names=["bucket", "key", "text", "n", "max_id"])

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for doc_id, text, key in zip(batch.column("doc_id").to_pylist(), texts,
                                         batch.column("key").to_pylist()):
                text = text.as_py()
                entry = held.get(text)
                if entry is None:
                    held[text] = [key, 1, doc_id]
                    size += len(text)
                else:
                    entry[1] += 1
                    if doc_id is not None and (entry[2] is None or doc_id > entry[2]):
                        entry[2] = doc_id
                if size > COMBINE_BYTES:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()
    return run


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owner: walks its entries in key order; each chain link is a distinct text."""
    names = ["bucket", "key", "chain", "text_sha256", "n", "keep_id"]
    out: list[tuple] = []
    current, chain = None, []

    def close():
        for link, (text, n, max_id) in enumerate(chain):
            out.append((current[0], current[1], link, hashlib.sha256(text).hexdigest(), n, max_id))

    for batch in batches:
        texts = batch.column("text")
        rest = [batch.column(name).to_pylist() for name in ("bucket", "key", "n", "max_id")]
        for bucket, key, n, max_id, text in zip(*rest, texts):
            if (bucket, key) != current:
                close()
                current, chain = (bucket, key), []
            text = text.as_py()
            for link in chain:
                if link[0] == text:
                    link[1] += n
                    if max_id is not None and (link[2] is None or max_id > link[2]):
                        link[2] = max_id
                    break
            else:
                chain.append([text, n, max_id])
        if len(out) > 50_000:
            yield _rows(out, names)
            out = []
    close()
    yield _rows(out, names)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                      names=names)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 bucket_keys: int = BUCKET_KEYS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256, text_key``.

    Texts are equal when their bytes are; a null text counts as empty, so null and empty texts
    are one group. Of equal texts the greatest id stays, with every row that carries it. Null ids
    lose against any other; a group of null ids only keeps all its rows. An empty table gives an
    empty result; other columns are not read.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
    sized = stored(texts.select("doc_id", "key", F.sha2("text", 256).alias("text_sha256"),
                                F.octet_length("text").cast("long").alias("n_bytes")),
                   "exact-entries")
    entries = sized.drop("n_bytes")
    repeated = stored(sized.groupBy("key").agg(F.count("*").alias("n"),
                                               F.max("n_bytes").alias("n_bytes"))
                      .where("n > 1").select("key", "n_bytes"), "exact-keys")
    # A key loads its bucket by its bytes, but by no less than its share of ``bucket_keys``.
    load = F.greatest(F.col("n_bytes"), F.lit(bucket_bytes // bucket_keys).cast("long"))
    loads = np.zeros(1 << MAX_DEPTH, np.int64)
    for row in (repeated.groupBy(_slot(F.col("key")).alias("slot")).agg(F.sum(load).alias("load"))
                .toLocalIterator()):
        loads[row["slot"]] = row["load"]
    directory = grow_directory(loads, bucket_bytes)
    found = texts.join(small_enough(repeated.select("key"), BROADCAST_KEYS), "key", "left_semi")
    owned = (found.select("doc_id", "text", "key").mapInArrow(_combine(directory), ENTRY)
             .repartition(int(directory[-1]) + 1, "bucket")
             .sortWithinPartitions("bucket", "key")
             .mapInArrow(_own, "bucket int, key long, chain int, text_sha256 string, n long, "
                               "keep_id long"))
    path = new_shared_path(spark, "exact-index")
    owned.write.partitionBy("bucket").parquet(path)
    index = spark.read.schema(owned.schema).parquet(path).select(
        F.col("key").alias("index_key"), F.col("text_sha256").alias("index_sha"), "n", "keep_id")
    joined = entries.join(index, (entries["key"] == index["index_key"])
                          & (entries["text_sha256"] == index["index_sha"]), "left")
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select("doc_id", keep.alias("keep_id"),
                         F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
                         F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256",
                         F.col("key").alias("text_key"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, with all their columns; of kept rows
    with equal ids, or without ids, and equal texts any one."""
    return one_row_each(docs, exact_groups(docs, id_col, text_col), id_col, text_col,
                        BROADCAST_KEYS, "exact-gone")
