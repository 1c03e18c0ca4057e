"""Near duplicates through SetSketch registers.

A document is the set of its distinct word shingles. Each shingle is a Poisson process of points
(value, register) derived from its hash; a register keeps the least value, truncated to a power
of a base close to 1. Registers of two sets agree about as often as the sets overlap, and those of
a union are the lesser ones, so sketches merge. Bands of registers bring candidates together.
The registers of a pair give a likelihood for each similarity; pairs whose most likely similarity
is far too low go, and the others are confirmed on the full sets.

Equal sets are one class from the start. Within a band's bucket, documents are compared with a
leader first, which joins most groups in linear time. Buckets that still hold several components
are dealt into chunks; every two chunks meet in one task, which returns nothing but links, so none
is lost and no list of all pairs is made.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.llm import hashing
from matchlens.llm.columns import (id_and_text, one_row_each, pieces_by_bytes, small_enough,
                                    stored)
from matchlens.llm.hashing import U, mix

REGISTERS = 128
BASE = 1.001
RATE = 20.0
MISS = 1e-6  # greatest chance that the bands miss a pair at the threshold
MARGIN = 0.2  # over six deviations of the estimate
BATCH_BYTES = 1 << 19  # sketching holds many times the text
BROADCAST_ROWS = 1_000_000
CHUNK_SHINGLES = 200_000
CHUNK_NODES = 1_500  # two chunks make a rectangle of pairs in memory


def band_rows(threshold: float, registers: int = REGISTERS) -> int:
    """Most registers to a band such that a pair at the threshold is missed rarely enough."""
    return max((r for r in range(1, registers + 1)
                if (1 - threshold ** r) ** (registers // r) <= MISS), default=1)


def batch_shingles(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text. Fewer words than a shingle has count as
    one shingle; no words, as none."""
    words, _, _, first = hashing.words(texts, lower=True)
    grams = hashing.sequence_hash(words, size, 3)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            some = np.sort(grams[a:b - size + 1])
            out.append(some[np.append(True, some[1:] != some[:-1])])
        elif b > a:
            out.append(hashing.sequence_hash(words[a:b], b - a, 3 + 100 * (b - a)))
        else:
            out.append(np.zeros(0, U))
    return out


def sketch(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """Registers (uint16) of each set. Points of an element come in ascending order, so an
    element stops once its next point lies above all registers of its set."""
    low = np.full((len(sets), registers), np.inf)
    flat = low.reshape(-1)
    seed = np.concatenate(sets) if sets else np.zeros(0, U)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value, worst = np.zeros(len(seed)), np.full(len(sets), np.inf)
    step = 0
    while len(seed):
        step += 1
        random = mix(seed ^ mix(np.full(1, step, U)))
        uniform = ((random >> U(12)).astype(np.float64) + 0.5) * 2.0 ** -52
        value = value - np.log(uniform) / (registers * RATE)
        register = (mix(random) % U(registers)).astype(np.int64)
        np.minimum.at(flat, owner * registers + register, value)
        present = owner[np.append(True, owner[1:] != owner[:-1])]
        worst[present] = low[present].max(axis=1)
        alive = value < worst[owner]
        seed, owner, value = seed[alive], owner[alive], value[alive]
    with np.errstate(divide="ignore"):
        steps = np.floor(1 - np.log(low) / math.log(BASE))
    return np.clip(np.where(np.isfinite(low), steps, 0), 0, 65535).astype(np.uint16)


def estimate(left: np.ndarray, right: np.ndarray, sizes_left: np.ndarray,
             sizes_right: np.ndarray, points: int = 101) -> np.ndarray:
    """The similarity of each pair of sketches that makes its registers most likely."""
    above = (left > right).sum(axis=1)[:, None]
    below = (left < right).sum(axis=1)[:, None]
    equal = left.shape[1] - above - below
    total = sizes_left + sizes_right
    u, v = (sizes_left / total)[:, None], (sizes_right / total)[:, None]
    grid = np.linspace(0, 1, points)[None, :] * np.minimum(u / v, v / u)

    def chance(x):
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / math.log(BASE)

    more, less = chance(u - v * grid), chance(v - u * grid)
    tiny = 1e-12
    score = (above * np.log(np.maximum(more, tiny)) + below * np.log(np.maximum(less, tiny))
             + equal * np.log(np.maximum(1 - more - less, tiny)))
    return grid[np.arange(len(grid)), score.argmax(axis=1)]


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_key, registers`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_by_bytes(batches, BATCH_BYTES):
            sets = batch_shingles(batch.column("text").cast(pa.binary()).to_pylist(), size)
            registers = sketch(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                          pa.binary()),
                 pa.array([r.tobytes() for r in registers], pa.binary())],
                names=["doc_id", "text_key", "n_shingles", "set_key", "registers"])

    texts = id_and_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    return texts.mapInArrow(run, "doc_id long, text_key long, n_shingles long, set_key binary, "
                                 "registers binary")


def _bands(nodes: DataFrame, rows: int) -> DataFrame:
    """``bucket, node``: one row per band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            registers = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16)
            registers = registers.reshape(batch.num_rows, -1)
            bands = registers.shape[1] // rows
            factors = hashing.salts(rows, 31)
            kept = registers[:, :bands * rows].reshape(-1, bands, rows).astype(U)
            value = mix((kept * factors).sum(axis=2, dtype=U) + hashing.salts(bands, 77))
            node = np.repeat(batch.column("node").to_numpy(), bands)
            yield pa.RecordBatch.from_arrays([pa.array(value.reshape(-1).view(np.int64)),
                                              pa.array(node)], names=["bucket", "node"])

    return nodes.select("node", "registers").mapInArrow(run, "bucket long, node long")


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose set sizes and registers leave a link possible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16)
                     .reshape(batch.num_rows, -1) for c in ("ra", "rb")]
            sizes = [batch.column(c).to_numpy().astype(float) for c in ("na", "nb")]
            keep = np.zeros(batch.num_rows, bool)
            for a in range(0, batch.num_rows, 2000):
                part = slice(a, a + 2000)
                keep[part] = estimate(sides[0][part], sides[1][part], sizes[0][part],
                                      sizes[1][part]) >= percent / 100 - MARGIN
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    side = [nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n{x}"),
                         F.col("registers").alias(f"r{x}")) for x in "ab"]
    both = pairs.join(side[0], "a").join(side[1], "b")
    fits = both.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return fits.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, nodes: DataFrame, id_col: str, text_col: str,
          size: int) -> DataFrame:
    """``node, shingles`` of the nodes in ``wanted``, read again from one document of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_by_bytes(batches, BATCH_BYTES):
            sets = batch_shingles(batch.column("text").cast(pa.binary()).to_pylist(), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["node", "shingles"])

    texts = id_and_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    wanted = small_enough(stored(wanted.join(nodes.select("node", "class_id", "class_key"),
                                             "node"), "near-wanted"), BROADCAST_ROWS)
    found = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["class_id"])
                       & (texts["text_key"] == wanted["class_key"]))
    return found.select("node", "text").mapInArrow(
        run, "node long, shingles array<long>").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets overlap enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("sa"), batch.column("sb")):
                one, two = one.values.to_numpy(), two.values.to_numpy()
                both = np.concatenate([one, two])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(one) + len(two) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = [sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab"]
    return pairs.join(side[0], "a").join(side[1], "b").select("a", "b", "sa", "sb").mapInArrow(
        run, "a long, b long")


def _block_links(docs: DataFrame, some: DataFrame, nodes: DataFrame, id_col: str, text_col: str,
                 size: int, percent: int) -> DataFrame:
    """Links between different components of the same bucket, ``some`` being its members.

    A bucket is dealt into chunks of bounded size; every two chunks meet in one task, which
    counts the common shingles of all their pairs at once and returns the links alone, as many as
    it takes to connect what they connect.
    """
    sets = stored(_sets(docs, some.select("node").distinct(), nodes, id_col, text_col, size),
                  "near-sets")
    sized = some.join(nodes.select("node", "n_shingles"), "node")
    chunks = sized.groupBy("bucket").agg(F.greatest(
        F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES),
        F.ceil(F.count("*") / CHUNK_NODES)).cast("int").alias("chunks"))
    dealt = (some.join(chunks, "bucket")
             .withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("bucket", F.least("chunk", "other").alias("i"),
                     F.greatest("chunk", "other").alias("j"), "chunk", "node", "component"))

    def run(table: pa.Table) -> pa.Table:
        chunk, node, component = (table.column(c).to_numpy() for c in
                                  ("chunk", "node", "component"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        lists = table.column("shingles").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        values = lists.values.to_numpy()[lists.offsets[0].as_py():lists.offsets[-1].as_py()]
        one, two = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        possible = component[one][:, None] != component[two][None, :]
        if i == j:
            possible &= node[one][:, None] < node[two][None, :]
        possible &= 100 * sizes[one][:, None] >= percent * sizes[two][None, :]
        possible &= percent * sizes[one][:, None] <= 100 * sizes[two][None, :]
        a, b = np.nonzero(possible)
        if len(a):
            common = common_counts(values, sizes, one, two)[a, b].astype(np.int64)
            a, b = one[a], two[b]
            linked = 100 * common >= percent * (sizes[a] + sizes[b] - common)
            joins = merging(a[linked], b[linked], component)
            a, b = a[linked][joins], b[linked][joins]
        return pa.table({"a": pa.array(np.minimum(node[a], node[b]), pa.int64()),
                         "b": pa.array(np.maximum(node[a], node[b]), pa.int64())})

    met = dealt.join(sets, "node").select("bucket", "i", "j", "chunk", "node", "component",
                                          "shingles")
    return met.groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long").distinct()


def merging(a: np.ndarray, b: np.ndarray, component: np.ndarray) -> list[int]:
    """Those of the links between rows ``a`` and ``b`` that join components not joined before."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while x in parent:
            x = parent[x]
        return x

    out = []
    for k, (one, two) in enumerate(zip(component[a].tolist(), component[b].tolist())):
        one, two = root(one), root(two)
        if one != two:
            parent[max(one, two)] = min(one, two)
            out.append(k)
    return out


def common_counts(values: np.ndarray, sizes: np.ndarray, one: np.ndarray, two: np.ndarray,
                  width: int = 1024) -> np.ndarray:
    """Common elements of every set of ``one`` and every set of ``two``, which are places of sets
    that lie one after the other in ``values``. The counts are the only large square held."""
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    number = np.cumsum(np.append(True, values[1:] != values[:-1])) - 1
    shared = np.bincount(number) > 1  # elements of one set only add nothing
    keep = shared[number]
    number, owner = (np.cumsum(shared) - 1)[number[keep]], owner[keep]
    counts = np.zeros((len(one), len(two)), np.int32)
    cuts = np.searchsorted(number, np.arange(0, int(shared.sum()) + width, width))
    row = np.full((2, len(sizes)), -1)
    for side, places in enumerate((one, two)):
        row[side, places] = np.arange(len(places))
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            blocks = []
            for side, places in enumerate((one, two)):
                at = row[side, owner[a:b]]
                block = np.zeros((len(places), width), np.float32)
                block[at[at >= 0], number[a:b][at >= 0] % width] = 1
                blocks.append(block)
            counts += (blocks[0] @ blocks[1].T).astype(np.int32)  # at most ``width`` each
    return counts


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``links`` (``a, b``): the least node it is connected
    with. Each turn hooks every node to its least neighbour, follows the hooks to their roots and
    contracts the links to those between different roots, which soon leaves none."""
    edges = stored(links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links-both")
    labels = None
    while not edges.isEmpty():
        roots = _roots(stored(edges.groupBy("a").agg(
            F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"),
            "hooks"))
        labels = roots.withColumnRenamed("root", "component") if labels is None else stored(
            labels.join(roots, labels["component"] == roots["node"], "left").select(
                labels["node"], F.coalesce("root", "component").alias("component")), "labels")
        ends = [roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab"]
        edges = stored(edges.join(ends[0], "a").join(ends[1], "b").where("ra <> rb")
                       .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(),
                       "links-left")
    return labels


def _roots(hooks: DataFrame) -> DataFrame:
    """``node, root``: where the hooks of each node end, halving the way in each turn."""
    while True:
        after = hooks.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        new = stored(hooks.join(after, "root").select("node", F.col("beyond").alias("root"),
                                                      F.col("root").alias("old")), "hooks")
        hooks = new.select("node", "root")
        if new.where("root <> old").isEmpty():
            return hooks


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Bucket members with their component, a node of its own if nothing links it."""
    if labels is None:
        return members.withColumn("component", F.col("node"))
    return members.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def _open(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``bucket, node, component`` of buckets that still hold several components, but for those
    of two nodes, which have been compared."""
    some = _labelled(members.where("n > 2").select("bucket", "node"), labels)
    apart = (some.groupBy("bucket").agg(F.min("component").alias("low"),
                                        F.max("component").alias("high"))
             .where("low <> high").select("bucket"))
    return stored(some.join(apart, "bucket").select("bucket", "node", "component"), "near-open")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept, text_key``.

    A-Z are lower-cased and words are runs of bytes that are not ASCII white space. Documents are
    linked when 100 * intersection >= ``percent`` * union of their sets of ``shingle``-word
    shingles; a document with fewer words is one shingle, one without words (null, empty or
    blank) is linked with nothing. ``component_id`` is the least id that links lead to, the row's
    own included; the row that carries it is kept. Null ids are greater than any other; a
    component of null ids only has a null id and keeps all its rows. Rows with equal ids are rows
    of their own. An empty table gives an empty result; other columns are not read.
    """
    signed = stored(signatures(docs, id_col, text_col, shingle), "near-signatures")
    last = F.coalesce("doc_id", F.lit(2 ** 63 - 1))
    nodes = stored(
        signed.where("n_shingles > 0").groupBy("set_key").agg(
            F.min("doc_id").alias("class_id"),
            F.min_by(F.struct("text_key", "n_shingles", "registers"),
                     F.struct(last, "text_key")).alias("first"))
        .select("set_key", "class_id", F.col("first.text_key").alias("class_key"),
                "first.n_shingles", "first.registers",
                F.monotonically_increasing_id().alias("node")), "near-classes")
    bands = _bands(nodes, band_rows(percent / 100))
    buckets = bands.groupBy("bucket").agg(F.count("*").alias("n"),
                                          F.min("node").alias("leader")).where("n > 1")
    members = stored(bands.join(buckets, "bucket"), "near-buckets")
    pairs = stored(_likely(
        members.where(F.col("node") != F.col("leader"))
        .select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(),
        nodes, percent), "near-pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(
        pairs.select(F.col("b").alias("node"))).distinct()
    sets = stored(_sets(docs, wanted, nodes, id_col, text_col, shingle), "near-sets")
    links = stored(_confirmed(pairs, sets, percent), "near-links")
    labels = None if links.isEmpty() else components(links)
    found = stored(_block_links(docs, _open(members, labels), nodes, id_col, text_col, shingle,
                                percent), "near-links")
    links = links.unionByName(found)
    labels = None if links.isEmpty() else components(links)

    classes = _labelled(nodes.select("set_key", "class_id", "node"), labels)
    least = classes.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = classes.join(least, "component").select(
        F.col("set_key").alias("class_set"), "component_id", F.lit(True).alias("in_class"))
    joined = signed.drop("registers").join(
        named, (signed["set_key"] == named["class_set"]) & (signed["n_shingles"] > 0), "left")
    component = F.when(F.col("in_class"), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that :func:`near_groups` keeps, with all their columns; of kept rows
    with equal ids, or without ids, and equal texts any one."""
    return one_row_each(docs, near_groups(docs, id_col, text_col, shingle, percent), id_col,
                        text_col, BROADCAST_ROWS, "near-gone")
