"""Merkle manifest of a table, with a proof for every row.

A row's leaf is the SHA-256 of its framed columns. The leaves of a group (a language) ascend by
id, and their places are found without sorting them: tasks put the ids of each group into
compressed bitmaps of ``CHUNK`` ids, the bitmaps of all tasks are merged, and a directory of their
popcounts, itself a tree of bounded fan-out, tells how many ids lie before each bitmap. The place
of a leaf is that number plus its rank inside its bitmap.

With the places known, ``BLOCK`` consecutive leaves fill an array of slots, which one call reduces
by as many levels as it has; the blocks' digests are the leaves of the next stage. On the way down
every block hands its own siblings to its slots, so each row ends with its whole path.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlens.llm.columns import bounded_batches, stored

CHUNK_BITS = 16
FAN_BITS = 12  # entries of the popcount directory below one entry of the next level
BLOCK_BITS = 12
HELD_ROWS = 1 << 20
_DENSE = 1 << (CHUNK_BITS - 3)  # bytes of a plain bitmap; fewer bytes are a list of positions


def digest(*parts: bytes) -> bytes:
    return sha256(b"".join(parts)).hexdigest().encode()


def framed(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(framed, values)), 256)


# Bitmaps

def pack_bits(low: np.ndarray) -> bytes:
    """Sorted distinct positions below ``1 << CHUNK_BITS`` as two bytes each or as a bitmap,
    whichever is shorter."""
    if 2 * len(low) < _DENSE:
        return low.astype("<u2").tobytes()
    bits = np.zeros(1 << CHUNK_BITS, bool)
    bits[low] = True
    return np.packbits(bits).tobytes()


def unpack_bits(data: bytes) -> np.ndarray:
    if len(data) < _DENSE:
        return np.frombuffer(data, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8)))


def merge_counts(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Positions and how often each occurs, over all ``parts`` of the same form."""
    low, copies = (np.concatenate(x) for x in zip(*parts))
    found, inverse = np.unique(low, return_inverse=True)
    return found, np.bincount(inverse, copies, len(found)).astype(np.int64)


def _packed(low: np.ndarray, copies: np.ndarray) -> tuple[bytes, bytes, int]:
    """Bitmap, the positions that occur more than once with their counts, and the total."""
    more = copies > 1
    return (pack_bits(low), np.stack([low[more], copies[more]]).astype("<i8").tobytes(),
            int(copies.sum()))


def _unpacked(bits: bytes, repeats: bytes) -> tuple[np.ndarray, np.ndarray]:
    low = unpack_bits(bits)
    copies = np.ones(len(low), np.int64)
    where, count = np.frombuffer(repeats, "<i8").reshape(2, -1)
    copies[np.searchsorted(low, where)] = count
    return low, copies


def _local_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        names = table.column("group").combine_chunks().dictionary_encode()
        group = names.indices.to_numpy()
        ids = table.column("id").to_numpy()
        high, low = ids >> CHUNK_BITS, ids & ((1 << CHUNK_BITS) - 1)
        order = np.lexsort((low, high, group))
        group, high, low = group[order], high[order], low[order]
        edge = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (high[1:] != high[:-1])))
        rows = [_packed(*merge_counts([(part, np.ones(len(part)))]))
                for part in np.split(low, edge[1:])]
        bits, repeats, n = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [names.dictionary.take(pa.array(group[edge])), pa.array(high[edge]),
             pa.array(bits, pa.binary()), pa.array(repeats, pa.binary()), pa.array(n, pa.int64())],
            names=["group", "chunk", "bits", "repeats", "n"])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= HELD_ROWS:
            yield flush(held)
            held, size = [], 0
    if held:
        yield flush(held)


def _merged_bitmaps(table: pa.Table) -> pa.Table:
    low, copies = merge_counts([_unpacked(b, r) for b, r in zip(
        table.column("bits").to_pylist(), table.column("repeats").to_pylist())])
    bits, repeats, n = _packed(low, copies)
    return pa.table({"group": table.column("group")[:1], "chunk": table.column("chunk")[:1],
                     "bits": pa.array([bits], pa.binary()),
                     "repeats": pa.array([repeats], pa.binary()),
                     "n": pa.array([n], pa.int64())})


def bitmaps(rows: DataFrame) -> DataFrame:
    """``group, chunk, bits, repeats, n``: the ids of ``rows`` (``group, id``), one bitmap for each
    group and run of ``1 << CHUNK_BITS`` ids, with the ids that repeat beside it."""
    schema = "group string, chunk long, bits binary, repeats binary, n long"
    return (rows.select("group", "id").mapInArrow(_local_bitmaps, schema)
            .groupBy("group", "chunk").applyInArrow(_merged_bitmaps, schema))


def before(counts: DataFrame, fan_bits: int = FAN_BITS) -> DataFrame:
    """``group, chunk, before``: how much ``n`` the smaller chunks of the group hold.

    Levels of at most ``1 << fan_bits`` siblings are summed one by one, however many chunks a group
    has."""
    levels = [counts.select("group", F.col("chunk").alias("node"), "n")]
    while True:
        widest = levels[-1].groupBy("group").count().agg(F.max("count")).first()[0] or 0
        if widest <= 1 << fan_bits:
            break
        levels.append(stored(levels[-1].groupBy(
            "group", F.shiftright("node", fan_bits).alias("node")).agg(F.sum("n").alias("n")),
            "merkle-directory"))
    above = None
    for depth, level in reversed(list(enumerate(levels))):
        top = above is None
        level = level.withColumn("parent", F.lit(0).cast("long") if top
                                 else F.shiftright("node", fan_bits))
        siblings = (Window.partitionBy("group", "parent").orderBy("node")
                    .rowsBetween(Window.unboundedPreceding, -1))
        level = level.withColumn("before", F.coalesce(F.sum("n").over(siblings), F.lit(0)))
        if not top:
            level = level.join(above, ["group", "parent"]).withColumn(
                "before", F.col("before") + F.col("before_parent"))
        above = level.select("group", F.col("node").alias("parent"),
                             F.col("before").alias("before_parent"))
        if depth == 0:
            return level.select("group", F.col("node").alias("chunk"), "before")


def _ranks(rows: pa.Table, chunk: pa.Table) -> pa.Table:
    """Places of rows by their rank in the chunk's bitmap."""
    low, copies = _unpacked(chunk.column("bits")[0].as_py(), chunk.column("repeats")[0].as_py())
    ahead = np.cumsum(copies) - copies + chunk.column("before")[0].as_py()
    own = rows.column("id").to_numpy() & ((1 << CHUNK_BITS) - 1)
    place = ahead[np.searchsorted(low, own)]
    return rows.select(["group", "id", "leaf", "claimed"]).append_column(
        "place", pa.array(place, pa.int64()))


_ROWS = "group string, id long, leaf binary, claimed binary"


def _among_equals(rows: DataFrame) -> DataFrame:
    """Places among rows that share ``group`` and ``id``, in the order of their leaves.

    Equal leaves are counted before they meet. The first twelve bits of a leaf, which are uniform,
    bound what one window sorts, even if one id holds most rows."""
    once = stored(rows.groupBy("group", "id", "leaf", "claimed").agg(F.count("*").alias("copies"))
                  .withColumn("bin", F.conv(F.substring(F.col("leaf").cast("string"), 1, 3), 16, 10).cast("int")),
                  "merkle-equals")
    preceding = (Window.unboundedPreceding, -1)
    bins = once.groupBy("group", "id", "bin").agg(F.sum("copies").alias("n")).withColumn(
        "ahead", F.coalesce(F.sum("n").over(Window.partitionBy("group", "id").orderBy("bin")
                                            .rowsBetween(*preceding)), F.lit(0)))
    inside = (Window.partitionBy("group", "id", "bin").orderBy("leaf", "claimed")
              .rowsBetween(*preceding))
    bins = bins.select(F.col("group").alias("bin_group"), F.col("id").alias("bin_id"),
                       F.col("bin").alias("bin_no"), "ahead")
    placed = once.withColumn("inner", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(
        bins, (F.col("group") == F.col("bin_group")) & F.col("id").eqNullSafe(F.col("bin_id"))
        & (F.col("bin") == F.col("bin_no")))
    first = F.col("ahead") + F.col("inner")
    return placed.select("group", "id", "leaf", "claimed", F.explode(
        F.sequence(first, first + F.col("copies") - 1)).alias("among"))


def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (``group, id, leaf, claimed``, a stored table) with their ``place`` in the group,
    and ``group, n``. Null ids come first; equal ids are ordered by leaf."""
    chunks = stored(bitmaps(rows.where("id is not null")), "merkle-bitmaps")
    nulls = rows.where("id is null").groupBy("group").agg(F.count("*").alias("nulls"))
    sizes = stored(chunks.groupBy("group").agg(F.sum("n").alias("n"))
                   .join(nulls, "group", "full")
                   .select("group", (F.coalesce("n", F.lit(0)) + F.coalesce("nulls", F.lit(0)))
                           .alias("n"), F.coalesce("nulls", F.lit(0)).alias("nulls")),
                   "merkle-sizes")
    directory = stored(chunks.join(before(chunks), ["group", "chunk"])
                       .join(sizes.select("group", "nulls"), "group")
                       .select("group", "chunk", "bits", "repeats",
                               (F.col("before") + F.col("nulls")).alias("before")),
                       "merkle-ranks")

    def ranked(some: DataFrame) -> DataFrame:
        some = some.withColumn("chunk", F.shiftright("id", CHUNK_BITS))
        return some.groupBy("group", "chunk").cogroup(directory.groupBy("group", "chunk")) \
            .applyInArrow(_ranks, _ROWS + ", place long")

    shared = rows.where("id is null").limit(1).count() + chunks.where(
        F.length("repeats") > 0).limit(1).count()
    if not shared:
        return ranked(rows), sizes.select("group", "n")
    again = stored(rows.groupBy("group", "id").count().where("count > 1 or id is null").select(
        F.col("group").alias("again_group"), F.col("id").alias("again_id")), "merkle-repeated")
    same = (F.col("group") == F.col("again_group")) & F.col("id").eqNullSafe(F.col("again_id"))
    first = ranked(again.where("again_id is not null").select(
        F.col("again_group").alias("group"), F.col("again_id").alias("id"),
        F.lit(b"").alias("leaf"), F.lit(b"").alias("claimed")))
    first = first.select(F.col("group").alias("again_group"), F.col("id").alias("again_id"),
                         F.col("place").alias("start"))
    several = _among_equals(rows.join(again, same, "left_semi")).join(first, same, "left").select(
        "group", "id", "leaf", "claimed",
        (F.coalesce("start", F.lit(0)) + F.col("among")).alias("place"))
    return ranked(rows.join(again, same, "left_anti")).unionByName(several), \
        sizes.select("group", "n")


# Trees

def levels_of(slots: list[bytes], up: int) -> list[list[bytes]]:
    """The slots and ``up`` levels above them; the last of an odd number is hashed alone."""
    levels = [slots]
    for _ in range(up):
        low = levels[-1]
        levels.append([digest(*low[i:i + 2]) for i in range(0, len(low), 2)])
    return levels


def path_of(levels: list[list[bytes]], slot: int) -> list[bytes]:
    """Per level ``L`` or ``R``, the side of the sibling, and its digest; empty without one."""
    path = []
    for low in levels[:-1]:
        other = slot ^ 1
        path.append((b"L" if slot & 1 else b"R") + low[other] if other < len(low) else b"")
        slot >>= 1
    return path


def fold(leaf: bytes, path: Sequence[bytes]) -> bytes:
    for step in path:
        sides = (step[1:], leaf) if step[:1] == b"L" else (leaf, step[1:])
        leaf = digest(*sides)
    return leaf


def _slots(table: pa.Table, stage: int) -> tuple[np.ndarray, list[list[bytes]]]:
    """The slot of each row of a block, and the block's levels."""
    slot = table.column("place").to_numpy() & ((1 << BLOCK_BITS) - 1)
    slots = [b""] * len(slot)
    for at, leaf in zip(slot.tolist(), table.column("leaf").to_pylist()):
        slots[at] = leaf
    height = table.column("height")[0].as_py()
    return slot, levels_of(slots, min(BLOCK_BITS, max(0, height - BLOCK_BITS * stage)))


def _reduced(stage: int):
    def run(table: pa.Table) -> pa.Table:
        _, levels = _slots(table, stage)
        return pa.table({"group": table.column("group")[:1], "place": table.column("block")[:1],
                         "leaf": pa.array([levels[-1][0]], pa.binary()),
                         "height": table.column("height")[:1]})
    return run


def _paths(stage: int):
    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        slot, levels = _slots(table, stage)
        rest = above.column("path")[0].as_py()
        paths = [path_of(levels, at) + rest for at in slot.tolist()]
        top = [pa.array(above.column(c).to_pylist() * len(slot), pa.binary())
               for c in ("subroot", "root")]
        return pa.table([table.column("group"), table.column("place"),
                         pa.array(paths, pa.list_(pa.binary())), *top],
                        names=["group", "place", "path", "subroot", "root"])
    return run


def _blocked(nodes: DataFrame):
    return nodes.withColumn("block", F.shiftright("place", BLOCK_BITS)).groupBy("group", "block")


def _stages(nodes: DataFrame, tallest: int) -> list[DataFrame]:
    """``nodes`` and the nodes of every stage above, the last of which has one per group."""
    out = [nodes]
    for stage in range(max(1, -(-tallest // BLOCK_BITS))):
        out.append(stored(_blocked(out[-1]).applyInArrow(
            _reduced(stage), "group string, place long, leaf binary, height int"),
            "merkle-stage"))
    return out


_PATHS = "group string, place long, path array<binary>, subroot binary, root binary"


def _descend(stages: list[DataFrame], top: DataFrame, down_to: int) -> DataFrame:
    """Paths of the nodes of stage ``down_to``, from those of the groups' last nodes."""
    for stage in range(len(stages) - 2, down_to - 1, -1):
        above = top.withColumnRenamed("place", "block").groupBy("group", "block")
        top = _blocked(stages[stage]).cogroup(above).applyInArrow(_paths(stage), _PATHS)
    return top


def _with_height(nodes: DataFrame, sizes: DataFrame) -> tuple[DataFrame, int]:
    heights = sizes.select("group", F.length(F.regexp_replace(
        F.bin(F.col("n") - 1), "^0$", "")).cast("int").alias("height"))
    tallest = heights.agg(F.max("height")).first()[0] or 0
    return nodes.join(heights, "group"), tallest


def ordered_places(frame: DataFrame, column: str) -> DataFrame:
    """``frame`` (a small or large table of distinct values of ``column``) with the ``place`` of
    each value in ascending order. Ranges are sorted apart; their sizes alone are collected."""
    spread = stored(frame.repartitionByRange(column).sortWithinPartitions(column).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("no")),
        "merkle-ordered")
    sizes = {r["part"]: r["count"] for r in spread.groupBy("part").count().collect()}
    starts, total = {}, 0
    for part in sorted(sizes):
        starts[part], total = total, total + sizes[part]
    start = F.lit(0).cast("long") if not starts else F.create_map(
        *[F.lit(x) for pair in starts.items() for x in pair])[F.col("part")].cast("long")
    return spread.withColumn("place", start + F.col("no").bitwiseAND((1 << 33) - 1)).drop(
        "part", "no")


def _proven(stage: int):
    """The rows of a block with proof, folded root and verdict."""
    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        slot, levels = _slots(table, stage)
        rest = above.column("path")[0].as_py()
        subroot, root = (above.column(c)[0].as_py() for c in ("subroot", "root"))
        proofs, folded = [], []
        for at, claimed in zip(slot.tolist(), table.column("claimed").to_pylist()):
            path = path_of(levels, at) + rest
            proofs.append(digest(*(step[1:] for step in path)))
            folded.append(fold(claimed, path))
        n = len(proofs)
        strings = [pa.array([x.decode() for x in column], pa.string()) for column in
                   ([*table.column("leaf").to_pylist()], [subroot] * n, [root] * n, proofs, folded)]
        return pa.table([table.column("id"), *strings, pa.array([f == root for f in folded])],
                        names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                               "verified"])
    return run


def manifest(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars",
                                                        "text"),
             id_col: str = "doc_id", group_col: str = "lang",
             claims: Mapping[str, Column] | None = None) -> DataFrame:
    """Per row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf is the hash of the framed ``columns``. Per value of ``group_col`` leaves ascend by id,
    and every two consecutive nodes, or a lone last one, are hashed into one until one remains, the
    subroot. Subroots, ordered by group in UTF-8 bytes with null first, give the root likewise.
    ``proof_sha256`` is the hash of a row's siblings from the leaf upwards. ``folded_root`` is what
    a verifier gets who holds ``claims``, column expressions in place of the named columns, and
    the row's siblings; ``verified`` tells whether that is the root.

    Null ids come first and equal ids follow their leaves' hex digits; repeated rows are leaves of
    their own. A group of one row has its leaf as subroot. Texts are hashed whole, however long,
    and do not move. An empty table gives no rows; columns not named are not read.
    """
    claims = dict(claims or {})
    spark = docs.sparkSession
    bounded_batches(spark)
    leaf = leaf_of([docs[c] for c in columns])
    same = reduce(lambda a, b: a & b, [framed(docs[c]) == framed(v) for c, v in claims.items()],
                  F.lit(True))
    claimed = F.when(~same, leaf_of([claims.get(c, docs[c]) for c in columns]))
    group = docs[group_col].cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("group"),
        docs[id_col].cast("long").alias("id"), leaf.alias("leaf"), claimed.alias("other"))
    rows = stored(rows.select("group", "id", F.col("leaf").cast("binary").alias("leaf"),
                              F.coalesce("other", "leaf").cast("binary").alias("claimed")),
                  "merkle-leaves")
    leaves, sizes = placed(rows)
    nodes, tallest = _with_height(leaves, sizes)
    nodes = stored(nodes, "merkle-places")
    stages = _stages(nodes, tallest)

    subroots = stages[-1].select("group", F.col("leaf").alias("subroot"))
    places = stored(ordered_places(subroots, "group"), "merkle-groups")
    one = places.select(F.lit("").alias("group"), "place", F.col("subroot").alias("leaf"))
    top, top_height = _with_height(one, one.groupBy("group").agg(F.count("*").alias("n")))
    top_stages = _stages(stored(top, "merkle-top"), top_height)
    none = F.array().cast("array<binary>")
    root = top_stages[-1].select("group", "place", none.alias("path"), F.col("leaf").alias("subroot"),
                                 F.col("leaf").alias("root"))
    down = _descend(top_stages, root, 0).select("place", "path", "root")
    down = places.join(down, "place").select("group", F.lit(0).cast("long").alias("place"), "path",
                                             "subroot", "root")
    above = _descend(stages, stored(down, "merkle-paths"), 1).withColumnRenamed("place", "block")
    return _blocked(stages[0]).cogroup(above.groupBy("group", "block")).applyInArrow(
        _proven(0), "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                    "folded_root string, verified boolean")


def tampered(docs: DataFrame) -> dict[str, Column]:
    """Claims that add 1 to ``n_chars`` where 7 divides the crc32 of the id's decimal text."""
    wrong = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0
    number = docs["n_chars"]
    return {"n_chars": F.when(wrong, (number.cast("decimal(20,0)") + 1).cast("string")).otherwise(
        number.cast("string"))}
