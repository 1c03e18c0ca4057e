"""Sums of number arrays over a distributed table, merged before and after one exchange."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_SCHEMA = "slot string, numbers binary"


def _row(slot: str, numbers: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([slot]), pa.array([np.ascontiguousarray(numbers).tobytes()], pa.binary())],
        names=["slot", "numbers"])


def summed(frame: DataFrame, partial: Callable[[pa.RecordBatch], dict[str, np.ndarray]],
           dtype: type = np.int64, reducers: int | None = None) -> dict[str, np.ndarray]:
    """Per slot, the sum of the arrays that ``partial`` returns for the batches of ``frame``.

    A task adds up its own batches, an exchange by slot brings the tasks' sums together, and one
    array per slot reaches the driver. Integers add up exactly, so the order does not matter.
    """
    def add(arrays: Iterator[tuple[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for slot, numbers in arrays:
            if slot in total:
                total[slot] += numbers
            else:
                total[slot] = np.array(numbers, dtype)
        yield from (_row(slot, numbers) for slot, numbers in total.items())

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from add(item for batch in batches if batch.num_rows
                       for item in partial(batch).items())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from add((slot, np.frombuffer(numbers, dtype)) for batch in batches
                       for slot, numbers in zip(batch.column("slot").to_pylist(),
                                                batch.column("numbers").to_pylist()))

    spread = reducers or frame.sparkSession.sparkContext.defaultParallelism
    merged = frame.mapInArrow(local, _SCHEMA).repartition(spread, "slot").mapInArrow(merge, _SCHEMA)
    return {row["slot"]: np.frombuffer(row["numbers"], dtype) for row in merged.collect()}
