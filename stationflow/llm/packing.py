"""Vector best-fit packing of documents into sequences of bounded tokens, documents and attention cost."""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from stationflow.llm.common import free_name, per_text, quoted
from stationflow.llm.tokens import encoder
from stationflow.storage import stage

# Rows of one staged part are numbered in blocks of this many, so that no length is ordered in one task.
BLOCK_ROWS = 1 << 17
RANK_BITS = 44


@dataclass(frozen=True)
class Capacities:
    """What one sequence holds: tokens, documents, and the sum of squared lengths that attention within documents costs.

    ``None`` stands for the tightest value that can never bind: as many documents as tokens, the square of the
    tokens. ``rule`` is "norm" (smallest weighted norm of what stays free) or "dot" (largest weighted product of
    item and free room).
    """

    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6)
    rule: str = "norm"

    def limits(self) -> tuple[int, int, int]:
        return self.tokens, self.documents or self.tokens, self.attention or self.tokens**2


def plan(counts: dict[int, int], room: Capacities) -> np.ndarray:
    """Where the pieces of each length go: best fit decreasing, over counts of lengths instead of single pieces.

    Sequences with equal free room are handled together: a step puts as many pieces of one length as fit into
    each sequence of the best run. A run is split in at most two more by a step, so there are at most
    2 * lengths runs, and 2 * lengths ** 2 steps, however many pieces there are. Columns of the result: length,
    first rank, first sequence, pieces for each sequence, first offset. Rows are ordered by length and rank.
    """
    caps = np.array(room.limits(), np.int64)
    weights = np.array(room.weights) / caps.astype(float) ** 2
    free = np.empty((0, 3), np.int64)
    run = np.empty((0, 2), np.int64)  # first sequence, sequences
    out, sequences = [], 0
    for length in sorted(counts, reverse=True):
        item, left, rank = np.array([length, 1, length * length], np.int64), counts[length], 0
        if (item > caps).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while left:
            fits = np.flatnonzero((free >= item).all(axis=1))
            if len(fits):
                if room.rule == "dot":
                    best = fits[np.argmax(free[fits] @ (weights * item))]
                else:
                    best = fits[np.argmin(((free[fits] - item) ** 2) @ weights)]
                (first, n), now = run[best], free[best]
                free, run = np.delete(free, best, 0), np.delete(run, best, 0)
            else:
                first, n, now = sequences, -(-left // int((caps // item).min())), caps
                sequences += n
            each = int((now // item).min())
            put = min(left, n * each)
            whole, rest = divmod(put, each)
            out.append((length, rank, first, each, caps[0] - now[0]))
            parts = [(now - each * item, first, whole), (now - rest * item, first + whole, int(rest > 0))]
            parts.append((now, first + whole + (rest > 0), n - whole - (rest > 0)))
            for state, at, many in parts:
                if many and state[0] > 0 and state[1] > 0:
                    free, run = np.vstack([free, state]), np.vstack([run, [at, many]])
            left, rank = left - put, rank + put
    return np.array(sorted(out), np.int64).reshape(-1, 5)


PIECES = "array<struct<piece: int, start: bigint, length: bigint, ids_crc32: bigint{ids}>>"


def token_pieces(
    df: DataFrame, path: str, doc_id: str, text: str, tokens: int, end_id: int, with_ids: bool = True
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and ids (array of int) unless they are not wanted.

    Only documents over ``tokens`` are cut, and the first piece takes the odd remainder. A null text is empty: its
    only token is ``end_id``."""

    def start():
        encode = encoder(path)

        def cut(data: bytes | None) -> list[dict]:
            ids = encode.ids((data or b"").decode("utf-8", "replace"))
            ids = np.append(ids, end_id).astype("<u4")
            edges = [0, *range(len(ids) % tokens or tokens, len(ids) + 1, tokens)]
            pieces = []
            for i, (a, b) in enumerate(zip(edges, edges[1:])):
                piece = {"piece": i, "start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[a:b].tobytes())}
                pieces.append({**piece, "ids": ids[a:b].astype(np.int32)} if with_ids else piece)
            return pieces

        return cut

    kind = PIECES.format(ids=", ids: array<int>" if with_ids else "")
    return df.select(quoted(doc_id).alias("doc_id"), F.inline(per_text(start, kind)(quoted(text))))


def pack(pieces: DataFrame, room: Capacities | None = None) -> DataFrame:
    """``pieces`` (any columns, ``length`` among them) with sequence_id and offset.

    Pieces are staged once, which fixes a number for each row; ranks within a length come from counts of blocks of
    rows and a numbering inside each block, so a length that a third of all pieces share is spread over tasks. Only
    the histogram of lengths (one row per length up to the token capacity) reaches the driver. Equal rows are
    packed one by one; null ids are ordinary; an empty frame gives an empty frame. Columns sequence_id and offset
    are replaced, all others pass through. A null or non-positive length or one beyond the capacity raises an error.
    """
    room = room or Capacities()
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    seat, part, rank, before, place = (
        free_name(pieces, name) for name in ("_seat", "_block", "_rank", "_before", "_place")
    )
    found = stage(pieces.select(*map(quoted, kept)).withColumn(seat, F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(length is None or length < 1 for length in counts):
        raise ValueError("every piece needs a positive length")
    steps = plan(counts, room)
    block = F.col(seat).bitwiseAND((1 << 33) - 1)
    block = F.shiftright(seat, 33) * F.lit(1 << 17) + F.floor(block / BLOCK_ROWS)
    blocks = found.withColumn(part, block)
    earlier = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy("length", part).agg(F.count(F.lit(1)).alias("n"))
    sums = sums.select("length", part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    inside = F.row_number().over(Window.partitionBy("length", part).orderBy(seat)) - 1
    ranked = blocks.withColumn(rank, inside).join(sums, ["length", part])
    ranked = ranked.withColumn(rank, F.col(rank) + F.col(before))
    shared = found.sparkSession.sparkContext.broadcast(steps)
    kind = DataType.fromDDL("sequence_id bigint, offset bigint")

    def places(length: pa.Array, rank: pa.Array) -> pa.Array:
        steps = shared.value
        size = length.to_numpy(zero_copy_only=False).astype(np.int64)
        number = rank.to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.searchsorted((steps[:, 0] << RANK_BITS) | steps[:, 1], (size << RANK_BITS) | number, "right") - 1
        _, first_rank, first, each, offset = steps[at].T
        nth = number - first_rank
        return pa.StructArray.from_arrays(
            [pa.array(first + nth // each), pa.array(offset + nth % each * size)], ["sequence_id", "offset"]
        )

    placed = ranked.withColumn(place, F.arrow_udf(places, kind)("length", rank))
    return placed.select(*map(quoted, kept), f"{place}.sequence_id", f"{place}.offset")


def pack_documents(
    df: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    room: Capacities | None = None,
    end_id: int = 2,
    with_ids: bool = True,
) -> DataFrame:
    """Tokenise, cut and pack: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset."""
    room = room or Capacities()
    return pack(token_pieces(df, path, doc_id, text, room.tokens, end_id, with_ids), room)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length, ids: what ``pack_documents`` has placed, put together; a group is at most one sequence."""
    part = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = F.flatten(F.transform(part, lambda p: p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), whole.alias("ids"))


def sequences_needed(tokens: int, capacity: int) -> int:
    """The least number of sequences that could hold so many tokens."""
    return math.ceil(tokens / capacity)
