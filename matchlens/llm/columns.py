"""Small helpers the operators share: reading, staging and building Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens.session import new_shared_path

WORD_BREAKS = b"\x20\t\n\x0b\x0c\r"  # the contract's word class is everything but these bytes
ARROW_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, size: int = ARROW_BYTES) -> None:
    """Lets the JVM hand Arrow batches of at most about ``size`` bytes to Python from now on in this
    session; a smaller setting stays. Ten thousand long rows would otherwise be one batch."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = "".join(c for c in str(spark.conf.get(name)) if c.isdigit())
    if not now or int(now) > size:
        spark.conf.set(name, str(size))


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text counts as empty."""
    bounded_batches(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written once to the shared folder: it cuts the lineage and survives executors."""
    path = new_shared_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def pieces_by_bytes(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``size`` bytes of ``text``; one row at least."""
    for batch in batches:
        text = batch.column("text")
        lengths = pc.binary_length(text).to_numpy(zero_copy_only=False)
        start = held = 0
        for row, length in enumerate(lengths):
            if held and held + length > size:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(length)
        if start < batch.num_rows:
            yield batch.slice(start)


def small_enough(frame: DataFrame, rows: int) -> DataFrame:
    """``frame``, a stored table of narrow rows, marked for broadcast if it holds at most ``rows``
    rows. A larger one is left to a shuffled join."""
    return F.broadcast(frame) if frame.count() <= rows else frame


def one_row_each(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str, rows: int,
                 name: str) -> DataFrame:
    """``docs`` less what ``groups`` drops, with a single row for each kept id and text.

    ``groups``: ``doc_id, text_key, kept`` per row of ``docs``. Only rows whose id and text key
    repeat are exchanged; whether their texts are equal is told by their bytes.
    """
    marks = stored(groups.groupBy(F.col("doc_id").alias("mark_id"),
                                  F.col("text_key").alias("mark_key"))
                   .agg(F.min("kept").alias("stays"), F.count("*").alias("copies"))
                   .where("not stays or copies > 1"), name)
    key = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))

    def matched(frame: DataFrame, some: DataFrame, how: str) -> DataFrame:
        some = small_enough(some, rows)
        return frame.join(some, docs[id_col].cast("long").eqNullSafe(some["mark_id"])
                          & (key == some["mark_key"]), how)

    once = matched(docs, marks, "left_anti")
    repeated = marks.where("stays")
    if repeated.isEmpty():
        return once
    again = matched(docs, repeated, "left_semi").withColumns({
        "__one_id": F.col(id_col).cast("long"),
        "__one_text": F.coalesce(F.col(text_col).cast("string"), F.lit(""))})
    return once.unionByName(again.dropDuplicates(["__one_id", "__one_text"])
                            .drop("__one_id", "__one_text"))
