"""SimHash fingerprints of word shingles, and near-duplicate groups found by pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import free_name, per_text, quoted, words
from stationflow.llm.components import components
from stationflow.storage import stage

SEED = 42
SEGMENTS = 4
SEGMENT_BITS = 64 // SEGMENTS
# A bucket beyond this many fingerprints is compared in blocks: every pair of blocks meets in some task.
BLOCK = 2048


def fingerprint(data: bytes | None, width: int) -> int:
    """64-bit SimHash of the ``width``-word shingles, repeats included; bit set where over half the hashes set it.

    A-Z are lower-cased. A text of fewer words is one shingle, a text without words (or null) has fingerprint zero.
    """
    found = words((data or b"").lower())
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate(([0], ends[:-width])).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())], "<u8")
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str, into: str, width: int) -> DataFrame:
    """``df`` with the fingerprint as a bigint (the bits of an unsigned 64-bit integer)."""

    def signed(data: bytes | None) -> int:
        value = fingerprint(data, width)
        return value - (1 << 64) if value >> 63 else value

    return df.withColumn(into, per_text(lambda: signed, "bigint")(quoted(text)))


def _rotated(value: np.ndarray, bits: int) -> np.ndarray:
    return value if not bits else (value << np.uint64(bits)) | (value >> np.uint64(64 - bits))


def chain_keys(value: np.ndarray, most: int) -> list[np.ndarray]:
    """Bucket keys of the first links of every chain, for ``most`` < 4 differing bits over four segments.

    If two fingerprints differ in at most ``most`` bits, then from some segment on, going round, the first j
    segments differ in at most j * most / 4 bits in total, for every j. With three bits, that is none in the first
    segment and one in the first two. So the first agrees, and so does one half of the second: 24 bits, 8 keys.
    """
    if not 0 <= most < SEGMENTS:
        raise ValueError(f"between 0 and {SEGMENTS - 1} differing bits")
    half = SEGMENT_BITS // 2
    out = []
    for i in range(SEGMENTS):
        turned = _rotated(value, i * SEGMENT_BITS)
        first, second = turned >> np.uint64(64 - SEGMENT_BITS), (turned >> np.uint64(64 - 2 * SEGMENT_BITS))
        for part in range(2):
            some = (second >> np.uint64(half * (1 - part))) & np.uint64((1 << half) - 1)
            out.append((np.uint64(2 * i + part) << np.uint64(SEGMENT_BITS + half)) | (first << np.uint64(half)) | some)
    return out


def in_chain(difference: np.ndarray, most: int) -> np.ndarray:
    """Whether some chain of segments keeps every proportional budget: the filter before the Hamming check."""
    parts = [
        np.bitwise_count(difference & np.uint64(((1 << SEGMENT_BITS) - 1) << (64 - SEGMENT_BITS * (i + 1))))
        for i in range(SEGMENTS)
    ]
    found = np.zeros(difference.shape, bool)
    for i in range(SEGMENTS):
        total, good = np.zeros(difference.shape, np.uint8), np.ones(difference.shape, bool)
        for j in range(SEGMENTS):
            total = total + parts[(i + j) % SEGMENTS]
            good &= total <= (j + 1) * most // SEGMENTS
        found |= good
    return found


def linked(one: np.uint64, others: np.ndarray, most: int) -> np.ndarray:
    """Indices of the fingerprints within ``most`` bits of one: pigeonring first, then all bits."""
    difference = others ^ one
    at = np.flatnonzero(in_chain(difference, most))
    return at[np.bitwise_count(difference[at]) <= most]


def spanning_links(bucket: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that connect what the bucket's links connect, one fewer than fingerprints in each component."""
    out, rest = [], bucket
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            near = linked(one, rest, most)
            if len(near):
                out += [(one, other) for other in rest[near]]
                queue += list(rest[near])
                rest = np.delete(rest, near)
    return out


def _bucket_links(most: int):
    """Over batches of (bucket, fp) sorted by bucket: spanning links of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_key, kept_value = np.empty(0, np.int64), np.empty(0, np.uint64)

        def links(key: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
            edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            size = np.diff(edge)
            two = edge[:-1][size == 2]
            good = two[in_chain(value[two] ^ value[two + 1], most)]
            good = good[np.bitwise_count(value[good] ^ value[good + 1]) <= most]
            a, b = [value[good]], [value[good + 1]]
            for at, n in zip(edge[:-1][size > 2], size[size > 2]):
                if found := spanning_links(value[at : at + n], most):
                    x, y = zip(*found)
                    a.append(np.array(x, np.uint64))
                    b.append(np.array(y, np.uint64))
            return pa.record_batch(
                [pa.array(np.concatenate(a).view(np.int64)), pa.array(np.concatenate(b).view(np.int64))], ["a", "b"]
            )

        for batch in batches:
            key = np.concatenate([kept_key, batch.column(0).to_numpy()])
            value = np.concatenate([kept_value, batch.column(1).to_numpy().view(np.uint64)])
            if not len(key):
                continue
            last = np.searchsorted(key, key[-1])  # the last bucket may go on in the next batch
            kept_key, kept_value = key[last:], value[last:]
            if last:
                yield links(key[:last], value[:last])
        if len(kept_key):
            yield links(kept_key, kept_value)

    return run


def near_links(prints: DataFrame, most: int = 3) -> DataFrame:
    """Links (a, b) that connect exactly the components of all pairs of ``fp`` within ``most`` differing bits.

    ``prints`` holds distinct fingerprints in ``fp``. They meet in buckets by the first links of a chain. Buckets
    are compared inside the task and give a spanning forest instead of all pairs. A bucket of n > BLOCK
    fingerprints is dealt out as pairs of blocks, n / BLOCK copies of each member, so every pair still meets.
    """
    value = F.col("fp")

    def keys(batch: pa.Array) -> pa.Array:
        found = np.stack(chain_keys(batch.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), most), 1)
        edges = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(edges), pa.array(found.ravel().view(np.int64)))

    keyed = prints.select("fp", F.explode(F.arrow_udf(keys, "array<bigint>")(value)).alias("key"))
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = keyed.join(counts, "key")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    other = F.explode(F.when(F.col("n") <= BLOCK, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), blocks - 1)))
    dealt = shared.select("fp", "key", own.alias("own"), blocks.alias("blocks"), other.alias("other"))
    bucket = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    dealt = dealt.select(bucket.alias("bucket"), "fp")
    sorted_parts = dealt.repartition("bucket").sortWithinPartitions("bucket", "fp")
    return sorted_parts.mapInArrow(_bucket_links(most), "a bigint, b bigint").distinct()


def group_prints(prints: DataFrame, most: int = 3) -> DataFrame:
    """(fp, root) of the fingerprints that have a link."""
    return components(near_links(prints, most)).toDF("fp", "root")


def _named(prints: DataFrame, fp: str, key: str, most: int) -> DataFrame:
    """(fp, root, least) of each fingerprint of ``prints``: smallest fingerprint and smallest key of its group."""
    distinct = prints.groupBy(quoted(fp).alias("fp")).agg(F.min(quoted(key)).alias("least"))
    roots = group_prints(distinct.select("fp"), most)
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = named.groupBy("root").agg(F.min("least").alias("least"))
    return named.select("fp", "root").join(groups, "root").select("fp", "root", "least")


def simhash_groups(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    most: int = 3,
    print_into: str = "fingerprint",
    group_into: str = "component_id",
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """``df`` with its fingerprint (16 hex digits) and the smallest ``doc_id`` that links reach.

    Exact copies share a fingerprint and count as one from the start; only distinct fingerprints are linked, and
    groups reach the documents by a join on the fingerprint whose large keys adaptive execution splits. Null ids
    never name a group unless it has no other; then the name is null. Null and empty texts have fingerprint zero
    and link like any other. Repeated rows stay as they are; columns with the names of the new ones are replaced.
    ``keep`` names the columns to return, all by default; without the text, less is written in between.
    """
    fp, least = free_name(df, "fp"), free_name(df, "least")
    columns = df.columns if keep is None else list(keep)
    printed = fingerprints(df, text, fp, width).select(*map(quoted, dict.fromkeys([*columns, doc_id])), fp)
    printed = stage(printed, "prints")
    named = _named(printed, fp, doc_id, most).select(F.col("fp").alias(fp), F.col("least").alias(least))
    kept = [quoted(c) for c in columns if c not in (print_into, group_into)]
    return printed.join(named, fp).select(
        *kept, F.lpad(F.lower(F.hex(F.col(fp))), 16, "0").alias(print_into), F.col(least).alias(group_into)
    )


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, most: int = 3) -> DataFrame:
    """The rows of ``df`` with one document of each group: the one of the smallest id (null comes last).

    Several rows with that id are settled by a hash of their columns; of equal rows any one stays.
    """
    fp, seat = free_name(df, "fp"), free_name(df, "seat")
    printed = fingerprints(df.withColumn(seat, F.monotonically_increasing_id()), text, fp, width)
    printed = stage(printed, "prints")
    key = quoted(doc_id)
    rank = F.struct(key.isNull().alias("n"), key.alias("k"), F.xxhash64(*map(quoted, df.columns)).alias("h"), F.col(seat))
    # Only numbers go through the search for groups; the documents themselves move once, to meet the chosen seats.
    firsts = stage(printed.groupBy(F.col(fp).alias("fp")).agg(F.min(rank).alias("first")), "firsts")
    roots = group_prints(firsts.select("fp"), most)
    choice = firsts.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp")).agg(F.min("first")[seat].alias(seat))
    return printed.join(choice.select(seat), seat, "left_semi").select(*map(quoted, df.columns))
