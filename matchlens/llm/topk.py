"""Exact top-k inner products, pruned by segment statistics from coarse to fine.

A vector is cut into segments; each keeps its mean and the norm of its deviation. For a query q
and a candidate x the squared distance is at least

    sum over segments of  L * (mean_q - mean_x)**2 + (dev_q - dev_x)**2

(L: components of the segment), which by |q|**2 + |x|**2 - 2 q.x bounds the inner product from
above. A few segments discard most candidates, more segments most of the rest, and only survivors
get the exact integer product. Every task keeps k candidates per query and raises its threshold
as it reads. Queries are sent to the tasks in passes of bounded size; candidates never move.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlens.llm.columns import stored

LEVELS = (4, 16)
BLOCK = 2048
QUERY_BLOCK = 512
QUERIES_PER_PASS = 16_384
NUMBERS_PER_PASS = 4_000_000  # components of all queries of a pass
DENSE_SHARE = 0.05
RESULT = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """``vec_id, v``: floor(scale * component) as long, rows that take no part left out."""
    v = F.col(vector_col)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & whole)
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
                    .alias("v")))


def segment_statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """Columns whose inner product between two vectors bounds the vectors' own from above."""
    if not rows.shape[1]:
        return np.zeros((len(rows), 1))
    columns = []
    for part in np.array_split(rows, min(segments, rows.shape[1]), axis=1):
        mean = part.mean(axis=1)
        deviation = np.sqrt(np.maximum(((part - mean[:, None]) ** 2).sum(axis=1), 0))
        columns += [mean * math.sqrt(part.shape[1]), deviation]
    return np.stack(columns, axis=1)


class _Best:
    """The k best candidates so far of each query of one block of queries."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int):
        self.ids, self.rows, self.k = ids, rows, k
        self.real = rows.astype(np.float64)
        self.levels = [segment_statistics(self.real, s) for s in LEVELS]
        self.norm = np.sqrt((self.real ** 2).sum(axis=1))
        self.found = [np.zeros((0, 2), np.int64) for _ in ids]  # score, vec_id
        self.bar = np.full(len(ids), -np.inf)

    def offer(self, ids: np.ndarray, rows: np.ndarray, real: np.ndarray,
              levels: list[np.ndarray], norm: np.ndarray) -> None:
        slack = 1e-9 * self.norm.max(initial=0) * norm.max(initial=0) + 1e-6
        bound = self.levels[0] @ levels[0].T + slack
        if not np.isfinite(self.bar).all():  # the most promising ones first
            first = np.argsort(-bound.max(axis=0), kind="stable")[:max(4 * self.k, 64)]
            self._exact(np.arange(len(self.ids)), first, ids, rows, real)
            bound[:, first] = -np.inf
        for level in range(len(LEVELS)):
            alive = bound >= self.bar[:, None]
            alive &= np.isfinite(bound)
            q, x = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if not len(q):
                return
            if level + 1 == len(LEVELS):
                break
            finer = self.levels[level + 1][q] @ levels[level + 1][x].T + slack
            tight = np.full(bound.shape, -np.inf)
            tight[np.ix_(q, x)] = np.where(alive[np.ix_(q, x)], finer, -np.inf)
            bound = tight
        if alive.sum() > DENSE_SHARE * len(q) * len(x):
            self._exact(q, x, ids, rows, real)
        else:
            for one in q:
                self._exact(np.array([one]), np.flatnonzero(alive[one]), ids, rows, real)

    def _exact(self, q, x, ids, rows, real) -> None:
        if self.norm.max(initial=0) * np.sqrt((real[x] ** 2).sum(axis=1)).max(initial=0) < 2 ** 52:
            scores = (self.real[q] @ real[x].T).astype(np.int64)  # whole numbers, exact so far
        else:
            scores = self.rows[q] @ rows[x].T
        for row, one in enumerate(q):
            hit = np.flatnonzero((scores[row] >= self.bar[one]) & (ids[x] != self.ids[one]))
            if not len(hit):
                continue
            both = np.concatenate([self.found[one],
                                   np.stack([scores[row, hit], ids[x[hit]]], axis=1)])
            self.found[one] = both[np.lexsort((both[:, 1], -both[:, 0]))[:self.k]]
            if len(self.found[one]) == self.k:
                self.bar[one] = self.found[one][-1, 0]


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers of all lists, and where each list starts and how long it is."""
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1].astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), starts, lengths


def _search(queries: list[tuple[np.ndarray, np.ndarray]], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [_Best(ids[a:a + QUERY_BLOCK], rows[a:a + QUERY_BLOCK], k)
                  for ids, rows in queries for a in range(0, len(ids), QUERY_BLOCK)]
        for batch in batches:
            flat, starts, lengths = _flat(batch.column("v"))
            all_ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            for size in np.unique(lengths):
                mine = [b for b in blocks if b.rows.shape[1] == size]
                place = np.flatnonzero(lengths == size) if mine else np.zeros(0, np.int64)
                for a in range(0, len(place), BLOCK):
                    some = place[a:a + BLOCK]
                    rows = flat[starts[some][:, None] + np.arange(size)].astype(np.int64)
                    real = rows.astype(np.float64)
                    levels = [segment_statistics(real, s) for s in LEVELS]
                    norm = np.sqrt((real ** 2).sum(axis=1))
                    for block in mine:
                        block.offer(all_ids[some], rows, real, levels, norm)
        ids, best = [], []
        for block in blocks:
            ids += [np.full(len(f), i) for i, f in zip(block.ids, block.found)]
            best += block.found
        if ids:
            best = np.concatenate(best)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ids).astype(np.int64)), pa.array(best[:, 1]),
                 pa.array(best[:, 0])], names=["query_id", "vec_id", "score"])
    return run


def _sent(queries: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """The queries of one pass, by length of vector."""
    table = queries.toArrow()
    ids = table.column("vec_id").to_numpy()
    flat, starts, lengths = _flat(table.column("v").combine_chunks())
    return [(ids[lengths == size], flat[starts[lengths == size][:, None] + np.arange(size)])
            for size in np.unique(lengths)]


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding", per_pass: int = QUERIES_PER_PASS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` greatest inner products.

    ``is_query`` is a condition on ``vec_id``. Every row is a candidate, but never one with the
    query's own id. Rows with a null id or vector, or with a null or non-finite component, take
    no part; vectors only meet vectors of their own length, and empty ones score 0. Of rows with
    equal ids that are queries, the smallest vector asks. Ties go to the smaller id, repeated
    candidates count one by one, and a query with fewer than ``k`` candidates returns them all.
    """
    spark = vectors.sparkSession
    candidates = quantised(vectors, id_col, vector_col)
    queries = stored(candidates.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")),
                     "topk-queries")
    tally = queries.agg(F.count("*"), F.coalesce(F.sum(F.size("v")), F.lit(0))).first()
    passes = max(1, math.ceil(tally[0] / per_pass), math.ceil(tally[1] / NUMBERS_PER_PASS))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    results = []
    for number in range(passes):
        some = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == number)
        sent = spark.sparkContext.broadcast(_sent(some))
        found = (candidates.mapInArrow(_run_sent(sent, k), RESULT)
                 .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
        results.append(found if passes == 1 else stored(found, "topk"))
    result = results[0]
    for more in results[1:]:
        result = result.unionByName(more)
    return result.select("query_id", "rank", "vec_id", "score")


def _run_sent(sent, k: int):
    return lambda batches: _search(sent.value, k)(batches)
