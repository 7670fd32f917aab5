"""The trie of conversation prefixes: a count-min sketch proves most prefixes unshared, the rest is grouped exactly."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import quoted
from stationflow.storage import broadcast_if_small, stage

SEGMENT = 1 << 15


@dataclass(frozen=True)
class Trie:
    """``most_counters``: width limit of the sketch, one byte each in a worker and two bits each when sent.
    ``prefixes_a_sketch``: prefixes that go into one partial sketch. A conversation of more than ``block_rows`` turns
    is ordered in blocks. Nodes of more than ``many_children`` children are found by broadcast."""

    hashes: int = 2
    most_counters: int = 1 << 24
    prefixes_a_sketch: int = 1 << 22
    block_rows: int = 1_000_000
    many_children: int = 10_000


# ---- turns in order ----------------------------------------------------------------------------------------


def ordered_turns(turns: DataFrame, trie: Trie) -> DataFrame:
    """(conv_id, block, pos, h1, h2, chars) with ``pos`` from 1 in order of turn (null first), ties by content hash.

    Ordinary conversations are one block. One of more than ``block_rows`` turns is range-partitioned along its own
    order first, and each part numbers its turns after those of the parts before.
    """
    order = [F.col("turn").asc_nulls_first(), "h1", "h2"]
    turns = stage(turns, "turns")
    long = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > trie.block_rows)
    long = stage(long, "long")
    rows = long.agg(F.sum("n")).first()[0]
    if not rows:
        inside = Window.partitionBy("conv_id").orderBy(*order)
        return turns.select("conv_id", F.lit(0).alias("block"), F.row_number().over(inside).cast("bigint").alias("pos"), "h1", "h2", "chars")
    ids = broadcast_if_small(long.select("conv_id"))
    parts = math.ceil(rows / trie.block_rows) + 1
    blocks = turns.join(ids, "conv_id", "left_semi").repartitionByRange(parts, "conv_id", *order)
    # Written, so that a part keeps its number if an executor is lost.
    blocks = stage(blocks.withColumn("block", F.spark_partition_id()), "blocks")
    rest = turns.join(ids, "conv_id", "left_anti").withColumn("block", F.lit(0))
    every = blocks.unionByName(rest)
    inside = Window.partitionBy("conv_id", "block").orderBy(*order)
    every = every.withColumn("inside", F.row_number().over(inside))
    sums = blocks.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "block", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    every = every.join(broadcast_if_small(sums), ["conv_id", "block"], "left")
    pos = (F.coalesce("before", F.lit(0)) + F.col("inside")).cast("bigint")
    return every.select("conv_id", "block", pos.alias("pos"), "h1", "h2", "chars")


def shared_heads(conv_id: Column) -> tuple[Column, Column]:
    """Whose first turns a conversation starts with, and how many: the first of its hundred, crc32 of its id modulo 6."""
    return conv_id - conv_id % 100, (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("int")


def rebuilt_turns(ordered: DataFrame, heads, most_head: int = 5) -> tuple[DataFrame, DataFrame]:
    """(conv_id, block, depth, h1, h2, chars) of all rebuilt conversations, and (conv_id, length) of each."""
    base, h = heads(F.col("conv_id"))
    convs = ordered.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumns({"base": base, "h": h})
    turn = F.struct("pos", "h1", "h2", "chars")
    tops = ordered.where((F.col("pos") <= most_head) & (F.col("conv_id") == base))
    tops = tops.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(turn)).alias("top"))
    convs = convs.join(tops, "base", "left").select(
        "conv_id", "own", "h", F.filter("top", lambda t: t["pos"] <= F.col("h")).alias("head")
    )
    convs = convs.withColumn("head", F.coalesce("head", F.array().cast(convs.schema["head"].dataType)))
    convs = stage(convs.withColumn("m", F.size("head").cast("bigint")), "convs")
    heads_rows = convs.select("conv_id", F.explode("head").alias("t")).select(
        "conv_id", F.lit(0).alias("block"), F.col("t.pos").alias("depth"), "t.h1", "t.h2", "t.chars"
    )
    own = ordered.withColumn("h", h).where("pos > h").join(convs.select("conv_id", "m"), "conv_id")
    own = own.select("conv_id", "block", (F.col("m") + F.col("pos") - F.col("h")).alias("depth"), "h1", "h2", "chars")
    length = F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return heads_rows.unionByName(own), convs.select("conv_id", length.alias("length"))


def prefixes(rebuilt: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, d1, d2, p1, p2, before, chars, last): digests of each prefix and of its parent.

    A prefix's digest is the exclusive or of hashes of its turns with their places, two of 64 bits: it needs no order,
    so blocks of a long conversation are put together by one number each. ``before`` counts code points of all turns
    before the last one.
    """
    rows = rebuilt.withColumns({f"g{k}": F.xxhash64(F.lit(k), "depth", "h1", "h2") for k in (1, 2)})
    sums = rows.groupBy("conv_id", "block").agg(
        F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2"), F.sum("chars").alias("c"), F.min("depth").alias("at")
    )
    ahead = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "conv_id",
        "block",
        *[F.coalesce(agg(c).over(ahead), F.lit(0)).alias(f"{c}_") for agg, c in ((F.bit_xor, "x1"), (F.bit_xor, "x2"), (F.sum, "c"))],
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns(
        {"i1": F.bit_xor("g1").over(inside), "i2": F.bit_xor("g2").over(inside), "ic": F.sum("chars").over(inside)}
    )
    rows = rows.join(sums, ["conv_id", "block"]).join(lengths, "conv_id")
    d1, d2 = F.col("i1").bitwiseXOR(F.col("x1_")), F.col("i2").bitwiseXOR(F.col("x2_"))
    return rows.select(
        "conv_id",
        "depth",
        d1.alias("d1"),
        d2.alias("d2"),
        d1.bitwiseXOR(F.col("g1")).alias("p1"),
        d2.bitwiseXOR(F.col("g2")).alias("p2"),
        (F.col("c_") + F.col("ic") - F.col("chars")).alias("before"),
        "chars",
        (F.col("depth") == F.col("length")).alias("last"),
    )


# ---- the sketch --------------------------------------------------------------------------------------------


def _cells(d1: np.ndarray, d2: np.ndarray, row: int, width: int) -> np.ndarray:
    """Counters of a sketch row; the digests are hashes already, and each row takes another mix of the two."""
    mixed = (d1.view(np.uint64) + np.uint64(row) * (d2.view(np.uint64) | np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - (width.bit_length() - 1))).astype(np.int64)


def _digests(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(batch.schema.get_field_index(c)).to_numpy().view(np.int64) for c in ("d1", "d2"))


def _partial_sketch(hashes: int, width: int):
    """Per task: counters up to two, as segments of two bit sets (seen, seen twice)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(hashes * width, np.uint8)
        for batch in batches:
            d1, d2 = _digests(batch)
            for row in range(hashes):
                cell, n = np.unique(_cells(d1, d2, row, width) + row * width, return_counts=True)
                table[cell] = np.minimum(table[cell] + np.minimum(n, 2), 2)
        for at in range(0, len(table), SEGMENT):
            part = table[at : at + SEGMENT]
            if part.any():
                yield pa.record_batch(
                    [
                        pa.array([at // SEGMENT], pa.int32()),
                        pa.array([np.packbits(part > 0).tobytes()], pa.binary()),
                        pa.array([np.packbits(part > 1).tobytes()], pa.binary()),
                    ],
                    ["segment", "seen", "twice"],
                )

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up segments that follow each other sorted by number."""
    now, seen, twice = None, None, None

    def out() -> pa.RecordBatch:
        columns = [pa.array([now], pa.int32()), pa.array([seen.tobytes()], pa.binary()), pa.array([twice.tobytes()], pa.binary())]
        return pa.record_batch(columns, ["segment", "seen", "twice"])

    for batch in batches:
        for segment, a, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
            a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
            if segment == now:
                twice = twice | b | (seen & a)
                seen = seen | a
            else:
                if now is not None:
                    yield out()
                now, seen, twice = segment, a, b
    if now is not None:
        yield out()


def sketch_width(n: int, trie: Trie) -> int:
    """Counters a row: twice the prefixes, rounded up to a power of two, within the limit."""
    return max(SEGMENT, min(trie.most_counters, 1 << max(0, 2 * n - 1).bit_length()))


def shared_counters(rows: DataFrame, n: int, trie: Trie) -> bytes:
    """Bits of a count-min sketch of (d1, d2) over all rows: set where a counter reached two.

    Counters stop at two, as only the estimate one matters. Partial sketches are made by few tasks of many rows and
    added up by segments; what reaches the driver is as large as the sketch, which ``most_counters`` bounds.
    """
    width = sketch_width(n, trie)
    parts = max(1, math.ceil(n / trie.prefixes_a_sketch))
    segments = rows.select("d1", "d2").coalesce(parts).mapInArrow(
        _partial_sketch(trie.hashes, width), "segment int, seen binary, twice binary"
    )
    merged = segments.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge, segments.schema)
    bits = np.zeros(trie.hashes * width // 8, np.uint8)
    for row in merged.select("segment", "twice").toLocalIterator():
        at = row["segment"] * SEGMENT // 8
        bits[at : at + len(row["twice"])] = np.frombuffer(row["twice"], np.uint8)
    return bits.tobytes()


def _screened(bits, hashes: int, width: int):
    """Marks prefixes that the sketch, or a shorter prefix of the same conversation just before, proves unshared.

    ``single`` = 0: possibly shared, 1: the first of a tail, 2: later in a tail. Rows come in order of depth within a
    conversation; where a part begins inside one, its rows count as possibly shared until the sketch proves one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, np.uint8)
        last, tail = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            d1, d2 = _digests(batch)
            proven = np.zeros(len(d1), bool)
            for row in range(hashes):
                cell = _cells(d1, d2, row, width) + row * width
                proven |= (table[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 0
            conv = batch.column(0).to_numpy()
            first = np.r_[last is None or conv[0] != last, conv[1:] != conv[:-1]]
            starts = np.flatnonzero(np.r_[True, first[1:]])
            run_of = np.cumsum(np.r_[True, first[1:]]) - 1
            total = np.cumsum(proven)
            before = np.r_[0, total][starts][run_of]
            if not first[0] and tail:
                before = np.where(run_of == 0, -1, before)
            inside = total - before
            single = np.where(inside == 0, 0, np.where(proven & (inside == 1), 1, 2)).astype(np.int8)
            last, tail = conv[-1], bool(inside[-1] > 0)
            yield pa.record_batch([*batch.columns, pa.array(single)], [*batch.schema.names, "single"])

    return run


# ---- digests of members ------------------------------------------------------------------------------------


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over comma-joined ids of each (depth, d1, d2), rows sorted by these and the id: one id at a time."""
    now, state = None, None
    done: list[tuple] = []

    def out() -> pa.RecordBatch:
        depth, d1, d2, digest = zip(*done)
        done.clear()
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.record_batch([pa.array(x, k) for x, k in zip((depth, d1, d2, digest), kinds)], ["depth", "d1", "d2", "ends"])

    for batch in batches:
        for depth, d1, d2, conv in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if (depth, d1, d2) == now:
                state.update(b",%d" % conv)
            else:
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = (depth, d1, d2), hashlib.sha256(b"%d" % conv)
        if len(done) >= 4096:
            yield out()
    if now is not None:
        done.append((*now, state.hexdigest()))
    if done:
        yield out()


# ---- the trie ----------------------------------------------------------------------------------------------


def prefix_trie(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    heads=shared_heads,
    trie: Trie | None = None,
) -> DataFrame:
    """One row per node of the trie over rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    ``heads(conv_id)`` names the conversation that lends its first turns, and how many, up to five. Null roles and
    texts count as empty, turns of equal number are ordered by a hash of their content, repeated rows are repeated
    turns. Rows without a conversation id take no part; without rows there are no nodes, not even the root. Other
    columns are not used, whatever their names.

    Turns are reduced to hashes where they are read. A prefix whose estimate in the sketch is one has one member, and
    so have all that extend it: such tails are given out from the task that holds them. Only prefixes that may be
    shared are grouped, by 128-bit digests, with partial counts before the shuffle. Sums over subtrees are sums
    over members: a node is charged to its smallest member, so every conversation pays from the depth on where
    it is the smallest, and what is saved below a node is what its members share above that depth. Ids of a node's
    ending members are hashed in order by one task, one at a time, as SHA-256 asks.
    """
    trie = trie or Trie()
    spark = turns.sparkSession
    said, text_ = (F.coalesce(quoted(c).cast("string"), F.lit("")) for c in (role, text))
    turns = turns.where(quoted(conv_id).isNotNull()).select(
        quoted(conv_id).cast("bigint").alias("conv_id"),
        quoted(turn).alias("turn"),
        F.xxhash64(F.lit(1), said, F.length(said), text_).alias("h1"),
        F.xxhash64(F.lit(2), said, F.length(said), text_).alias("h2"),
        F.length(text_).cast("bigint").alias("chars"),
    )
    ordered = stage(ordered_turns(turns, trie), "ordered")
    rebuilt, lengths = rebuilt_turns(ordered, heads)
    rows = prefixes(stage(rebuilt, "rebuilt"), lengths)
    rows = stage(rows.sortWithinPartitions("conv_id", "depth"), "prefixes")

    n = rows.count()
    bits = spark.sparkContext.broadcast(shared_counters(rows, n, trie))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", single tinyint"
    screened = stage(rows.mapInArrow(_screened(bits, trie.hashes, sketch_width(n, trie)), kinds), "screened")
    bits.unpersist()

    # The root holds every conversation; those without turns end there.
    root = lengths.select(
        "conv_id",
        F.lit(0).cast("bigint").alias("depth"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("d1", "d2")],
        *[F.lit(None).cast("bigint").alias(c) for c in ("p1", "p2")],
        *[F.lit(0).cast("bigint").alias(c) for c in ("before", "chars")],
        (F.col("length") == 0).alias("last"),
    )
    shared = screened.where("single = 0").drop("single").unionByName(root)
    tails = screened.where("single > 0")
    firsts = tails.where("single = 1")
    key = ["depth", "d1", "d2"]
    nodes = shared.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("before").alias("before"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
    )
    nodes = stage(nodes, "nodes")

    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")]
    children = nodes.where("depth > 0").select(*up).unionByName(firsts.select(*up))
    children = children.groupBy(*key).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stage(nodes.join(children, key, "left").fillna(0, ["n_children"]), "nodes")

    # Up to where each conversation shares its turns with a smaller one, and whether it is the smallest of a leaf.
    ends = shared.where("last").select(*key, F.col("conv_id").alias("member"), (F.col("before") + F.col("chars")).alias("all"))
    ends = stage(ends, "ends")
    reach = (
        nodes.select("conv_id", "before")
        .unionByName(firsts.select("conv_id", "before"))
        .unionByName(ends.select(F.col("member").alias("conv_id"), F.col("all").alias("before")))
    )
    leaf = nodes.where("n_children = 0").join(ends, key).where("member = conv_id").select("conv_id")
    leaf = leaf.unionByName(tails.where("last").select("conv_id"))
    marks = reach.withColumn("leaf", F.lit(0)).unionByName(
        leaf.select("conv_id", F.lit(None).cast("bigint").alias("before"), F.lit(1).alias("leaf"))
    )
    marks = marks.groupBy("conv_id").agg(F.min("before").alias("reach"), F.max("leaf").alias("leaf"))
    below = shared.select(*key, "conv_id", "before").join(marks, "conv_id")
    below = below.groupBy(*key).agg(
        F.sum("leaf").alias("n_leaves"), F.sum(F.greatest(F.col("reach") - F.col("before"), F.lit(0))).alias("saved_tokens")
    )
    digests = ends.select(*key, "member").repartition(*key).sortWithinPartitions(*key, "member")
    digests = digests.mapInArrow(_end_digests, "depth bigint, d1 bigint, d2 bigint, ends string")
    nodes = nodes.join(below, key).join(digests, key, "left")

    # Parents: those of very many children go to the children, the others meet them in a shuffle.
    parents = nodes.select(*key, F.col("conv_id").alias("parent_conv_id"), "n_children")
    asked = nodes.select("conv_id", "depth", *(c.alias(f"u_{n}") for c, n in zip(up, key)), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    own_end = F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).alias("ends")
    lone = [one.alias("n_convs"), F.when(F.col("last"), 0).otherwise(1).cast("bigint").alias("n_children"), one.alias("n_leaves")]
    asked = asked.unionByName(
        firsts.select("conv_id", "depth", *(c.alias(f"u_{n}") for c, n in zip(up, key)), *lone, none.alias("saved_tokens"), own_end)
    )
    asked = stage(asked, "asked")
    parents = stage(parents.select(*(F.col(c).alias(f"u_{c}") for c in key), "parent_conv_id", "n_children"), "parents")
    over = [f"u_{c}" for c in key]
    crowded = parents.where(F.col("n_children") > trie.many_children).drop("n_children").withColumn("found", F.lit(True))
    met = asked.join(broadcast_if_small(crowded), over, "left")
    rest = met.where("found is null").drop("parent_conv_id", "found")
    calm = parents.where(F.col("n_children") <= trie.many_children).drop("n_children")
    found = rest.join(calm, over, "left").unionByName(met.where("found").drop("found"))
    # A parent that is no node of the shared part is the same conversation's prefix in the part before.
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id")
    later = tails.where("single = 2").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), *lone, none.alias("saved_tokens"), own_end
    )
    columns = ["n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    every = found.select("conv_id", "depth", parent, *columns).unionByName(later)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return every.select("conv_id", "depth", "parent_conv_id", *columns[:-1], F.coalesce("ends", nothing).alias("ends_sha256"))
