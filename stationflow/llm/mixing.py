"""Mixing sources to target weights: blocks of words, drawn for output shards through index permutations.

Everything here is DataFrame functions, so it runs inside Spark's generated code.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import WORD_SQL, free_name, quoted
from stationflow.storage import stage

# A word with the white space after it, so that pieces of a text keep their lines.
SPACED_WORD_SQL = WORD_SQL + r"[\x20\x09-\x0D]*"
CHUNK = 1 << 14
PART_DRAWS = 1 << 19


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources in code point order, null last. A target stops at ``most_repeats`` times
    its source's words. ``block_words`` is the length of a block, ``shard_blocks`` that of an output shard, and
    ``between`` stands between texts of two documents in a block."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    most_repeats: int = 3
    block_words: int = 32
    shard_blocks: int = 4096
    seed: int = 7
    rounds: int = 8
    bucket_rows: int = 4_096
    between: str = "\n\n"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_SQL)), F.lit(0)).cast("bigint")


def permuted(df: DataFrame, index: str, n: Column, key: list[Column], rounds: int, into: str) -> DataFrame:
    """``df`` with a pseudorandom permutation of ``index`` over 0 .. n-1, another one for each key.

    Swap-or-not: each round pairs i with (k - i) mod n and swaps the two on a hash bit that both share. It works
    for any n, is undone by running back, and needs a few hashes of a row and no table.
    """
    df = df.withColumn(into, F.col(index))
    for turn in range(rounds):
        shift = F.pmod(F.xxhash64(*key, F.lit(turn)), n)
        df = df.withColumn("_partner", F.pmod(shift - F.col(into), n))
        bit = F.xxhash64(F.greatest(into, "_partner"), *key, F.lit(-1 - turn)).bitwiseAND(1)
        df = df.withColumn(into, F.when(bit == 1, F.col("_partner")).otherwise(F.col(into)))
    return df.drop("_partner")


def source_targets(sized: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: source, source_size, n_docs, number (from 1 in code point order, null last), weight, target.

    All words are shared by weight, sources stop at their cap, and the rest shares what is over: that is one level
    for the uncapped sources, found in order of cap by weight. The table has a row per source, no more.
    """
    everything = Window.partitionBy(F.lit(0))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    number = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last()))
    weights = F.array(*map(F.lit, mix.weights))
    sources = sources.withColumn("number", number).withColumn(
        "weight", F.element_at(weights, F.pmod(F.col("number") - 1, F.lit(len(mix.weights))) + 1)
    )
    cap = F.col("source_size") * float(mix.most_repeats)
    by_cap = everything.orderBy(cap / F.col("weight"), "number")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    sources = sources.withColumn("_level", level).withColumn("_rank", F.row_number().over(by_cap))
    free = F.when(cap / F.col("weight") >= F.col("_level"), F.struct("_rank", "_level"))
    target = F.least(cap, F.col("weight") * F.min(free).over(everything)["_level"])
    return sources.select("source", "source_size", "n_docs", "number", "weight", target.alias("target"))


def plan_blocks(sources: DataFrame, mix: Mix) -> DataFrame:
    """``sources`` with n_blocks, n_slots (blocks the mix takes) and first_slot among all slots, and all_slots."""
    blocks = F.ceil(F.col("source_size") / mix.block_words).cast("bigint")
    taken = F.when(
        F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * F.col("n_blocks")).cast("bigint")
    )
    planned = sources.withColumn("n_blocks", blocks).withColumn(
        "n_slots", F.least(F.col("n_blocks") * mix.most_repeats, F.coalesce(taken, F.lit(0)))
    )
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return planned.withColumn("first_slot", F.coalesce(F.sum("n_slots").over(before), F.lit(0))).withColumn(
        "all_slots", F.sum("n_slots").over(everything)
    )


def shard_slots(planned: DataFrame, mix: Mix) -> DataFrame:
    """One row per slot of the mix: shard, slot, number (of the source), nth (of its draws), pass, block.

    A permutation of all slots deals the draws of every source out to the shards. The counts of sources in a
    shard are then multinomial with the targets as weights, given that all shards together meet the targets. The
    nth draw of a source reads block permutation(nth mod n_blocks) of pass nth div n_blocks: no block comes
    twice in a pass.
    """
    chunks = planned.where("n_slots > 0").withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n_slots") - 1) / CHUNK)))
    )
    first = F.col("_chunk") * CHUNK
    last = F.least(first + (CHUNK - 1), F.col("n_slots") - 1)
    # A fixed number of parts, because the chunks are small but what they unfold into is not.
    slots = planned.agg(F.max("all_slots")).first()[0] or 0
    draws = chunks.repartition(max(1, math.ceil(slots / PART_DRAWS)), "number", "_chunk").select(
        "number", "n_blocks", "first_slot", "all_slots", F.explode(F.sequence(first, last)).alias("nth")
    )
    draws = draws.withColumn("_seat", F.col("first_slot") + F.col("nth"))
    draws = permuted(draws, "_seat", F.col("all_slots"), [F.lit(mix.seed)], mix.rounds, "_slot")
    draws = draws.withColumn("pass", F.floor(F.col("nth") / F.col("n_blocks"))).withColumn(
        "_index", F.pmod(F.col("nth"), F.col("n_blocks"))
    )
    key = [F.lit(mix.seed + 1), F.col("number"), F.col("pass")]
    draws = permuted(draws, "_index", F.col("n_blocks"), key, mix.rounds, "block")
    return draws.select(
        F.floor(F.col("_slot") / mix.shard_blocks).alias("shard"),
        F.pmod(F.col("_slot"), F.lit(mix.shard_blocks)).alias("slot"),
        "number",
        "nth",
        "pass",
        "block",
    )


def shard_counts(slots: DataFrame) -> DataFrame:
    """shard, number, draws: how many blocks of each source a shard holds."""
    return slots.groupBy("shard", "number").agg(F.count(F.lit(1)).alias("draws"))


def _located(docs: DataFrame, bucket_rows: int) -> DataFrame:
    """``docs`` with the words of its source before it. Order: hash bucket, then id and content hash. Sums of
    buckets come first, so no source is ordered as a whole; a source has as many buckets as its rows fill."""
    buckets = F.ceil(F.col("n_docs") / bucket_rows)
    docs = docs.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "_tie"), buckets))
    sums = docs.groupBy("number", "_bucket").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("number").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("number", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("number", "_bucket").orderBy("doc_id", "_tie", "_seat")
    inside = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return docs.withColumn("_inside", inside).join(sums, ["number", "_bucket"]).withColumn(
        "_start", F.col("_before") + F.col("_inside")
    )


def _plan(
    df: DataFrame, doc_id: str, text: str, source: str, mix: Mix, seat: Column | None, tie: Column | None
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` (doc_id, size, _tie, _seat, and number, source_size, target, n_docs of their source), and sources."""
    sized = df.select(
        quoted(doc_id).alias("doc_id"),
        quoted(source).cast("string").alias("source"),
        n_words(quoted(text)).alias("size"),
        (F.xxhash64(*map(quoted, df.columns)) if tie is None else tie).alias("_tie"),
        (F.monotonically_increasing_id() if seat is None else seat).alias("_seat"),
    )
    sized = stage(sized, "sizes")
    sources = stage(plan_blocks(source_targets(sized, mix), mix), "sources")
    named = sized.join(sources.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")))
    return named.select("doc_id", "size", "_tie", "_seat", "number", "source_size", "target", "n_docs"), sources


def block_pieces(located: DataFrame, mix: Mix) -> DataFrame:
    """One row per piece of a document in a block: _seat, doc_id, number, block, at (its first word's place in the
    stream of the source), first_word (that in the document), words; and piece, its text, if ``located`` has a
    column ``_words`` with the words of each text."""
    length = F.lit(mix.block_words)
    end = F.col("_start") + F.col("size")
    found = located.where("size > 0").select(
        *located.columns,
        end.alias("_end"),
        F.explode(F.sequence(F.floor(F.col("_start") / length), F.floor((end - 1) / length))).alias("block"),
    )
    at = F.greatest("_start", F.col("block") * length)
    first, n = at - F.col("_start"), F.least("_end", (F.col("block") + 1) * length) - at
    own = ["_seat", "doc_id", "number", "block", at.alias("at"), first.alias("first_word"), n.alias("words")]
    if "_words" in located.columns:
        own.append(F.array_join(F.slice("_words", (first + 1).cast("int"), n.cast("int")), "").alias("piece"))
    return found.select(*own)


def _drawn(pieces: DataFrame, sources: DataFrame, mix: Mix) -> DataFrame:
    """The blocks of the mix, a row per slot: those of ``shard_slots``, parts, and text if the pieces have theirs.

    Pieces are put together once per block, of which there are at most as many as words in it; slots then meet
    blocks in a join on (number, block), and a block comes at most ``most_repeats`` times.
    """
    part = F.struct("at", "_seat", "doc_id", "first_word", "words")
    made = [F.sort_array(F.collect_list(part)).alias("parts")]
    if "piece" in pieces.columns:
        found = F.sort_array(F.collect_list(F.struct("at", "piece")))
        made.append(F.array_join(F.transform(found, lambda x: x["piece"]), mix.between).alias("text"))
    blocks = pieces.groupBy("number", "block").agg(*made)
    # Written before it is joined: pushing filters through the rounds of a permutation would multiply them.
    slots = stage(shard_slots(sources, mix), "slots")
    return slots.join(blocks, ["number", "block"])


def mix_blocks(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    mix: Mix | None = None,
) -> DataFrame:
    """The mix itself, one row per slot: shard, slot, source, pass, block, n_words, text, documents.

    The words of a source form one stream in a hash order of its documents, cut into blocks; ``text`` is what a
    block holds, with the white space after each word, and ``mix.between`` between documents. ``documents`` says
    whose words these are, in order: doc_id, first_word, words. Slots of all shards but the last run from 0 to
    ``shard_blocks`` - 1. White space before a text's first word is not kept. What holds for nulls, empty texts and
    repeated rows is said at ``mix_sources``.
    """
    mix = mix or Mix()
    seat, words = free_name(df, "seat"), free_name(df, "words")
    tie = F.xxhash64(*map(quoted, df.columns))
    fixed = stage(df.withColumn(seat, F.monotonically_increasing_id()), "mixing")
    named, sources = _plan(fixed, doc_id, text, source, mix, F.col(seat), tie)
    located = _located(named, mix.bucket_rows).select("_seat", "doc_id", "number", "size", "_start")
    texts = fixed.select(
        F.col(seat).alias("_seat"), F.regexp_extract_all(quoted(text), F.lit(SPACED_WORD_SQL), F.lit(0)).alias("_words")
    )
    drawn = _drawn(block_pieces(located.join(texts, "_seat"), mix), sources, mix)
    names = F.broadcast(sources.select("number", "source"))
    return drawn.join(names, "number").select(
        "shard",
        "slot",
        "source",
        "pass",
        "block",
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, x: n + x["words"]).alias("n_words"),
        "text",
        F.transform("parts", lambda x: F.struct(x["doc_id"], x["first_word"], x["words"])).alias("documents"),
    )


def mix_sources(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    mix: Mix | None = None,
    seat: Column | None = None,
    tie: Column | None = None,
) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row for each row of ``df``.

    ``seat`` may name rows and ``tie`` hash them; both are returned if they are given.

    ``taken`` counts the words of a document in the blocks of the mix (``mix_blocks`` gives those with their text), with
    repeats, never over ``most_repeats`` times its size. Slots and blocks meet in a join on (source, block), which has
    about as many keys as blocks, so a hot source spreads over all tasks. Null texts and texts without words have size 0 and take nothing; null sources are a source, the
    last one; null ids are ordinary; equal rows are interchangeable; an empty frame gives an empty frame. The
    result depends on the rows alone, not on their order or partitions.
    """
    mix = mix or Mix()
    named, sources = _plan(df, doc_id, text, source, mix, seat, tie)
    drawn = _drawn(block_pieces(_located(named, mix.bucket_rows), mix), sources, mix)
    taken = drawn.select(F.explode("parts").alias("p")).groupBy("p._seat").agg(F.sum("p.words").alias("taken"))
    out = named.join(taken, "_seat", "left")
    kept = ["doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")]
    if seat is None:
        return out.select(*kept)
    return out.select(*kept, F.col("_seat").alias("seat"), F.col("_tie").alias("tie"))


def mixed_documents(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", mix: Mix | None = None
) -> DataFrame:
    """The mix as rows of ``df``: one for each document and pass, with the text cut to what the drawn blocks hold.

    The words are those of ``mix_blocks``, put back to the documents they come from, so a source has as many words as
    its slots hold, and a document as many as ``mix_sources`` counts. A pass that takes all blocks of a document gives
    its text unchanged; otherwise neighbouring blocks make a passage, with the white space between words kept, and
    ``mix.between`` stands between passages. No document comes more than ``most_repeats`` times; one without words, or
    without a drawn block, does not come. What holds for nulls, repeated rows and empty frames is said at
    ``mix_sources``. A task holds the passages of a document, whose number its own words bound.
    """
    mix = mix or Mix()
    seat, passages = free_name(df, "seat"), free_name(df, "passages")
    fixed = stage(df.withColumn(seat, F.monotonically_increasing_id()), "mixing")
    tie = F.xxhash64(*map(quoted, df.columns))
    named, sources = _plan(fixed, doc_id, text, source, mix, F.col(seat), tie)
    drawn = _drawn(block_pieces(_located(named, mix.bucket_rows), mix), sources, mix)
    parts = drawn.select("pass", F.explode("parts").alias("p")).select("pass", "p._seat", "p.first_word", "p.words")
    one = Window.partitionBy("_seat", "pass").orderBy("first_word")
    ends = F.lag(F.col("first_word") + F.col("words")).over(one)
    parts = parts.repartition("_seat").withColumn("_new", F.when(ends == F.col("first_word"), 0).otherwise(1))
    parts = parts.withColumn("_run", F.sum("_new").over(one))
    runs = parts.groupBy("_seat", "pass", "_run").agg(F.min("first_word").alias("first"), F.sum("words").alias("n"))
    rows = runs.groupBy("_seat", "pass").agg(F.sum("n").alias("_n"), F.collect_list(F.struct("first", "n")).alias("_runs"))
    rows = rows.join(named.select("_seat", "size"), "_seat").select(
        F.col("_seat").alias(seat), F.when(F.col("_n") < F.col("size"), F.sort_array("_runs")).alias(passages)
    )
    # Bound to a name of its own, so that a text is split once and not once for each passage.
    split = F.array(F.regexp_extract_all(quoted(text), F.lit(SPACED_WORD_SQL), F.lit(0)))
    cut = F.transform(
        split,
        lambda w: F.array_join(
            F.transform(
                F.col(passages), lambda r: F.array_join(F.slice(w, (r["first"] + 1).cast("int"), r["n"].cast("int")), "")
            ),
            mix.between,
        ),
    )[0]
    mixed = F.when(F.col(passages).isNull(), quoted(text)).otherwise(cut)
    return fixed.join(rows, seat).select(*[mixed.alias(c) if c == text else quoted(c) for c in df.columns])
