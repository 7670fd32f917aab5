"""Prefix token counts, token pieces and packing: against the tokenizers library and brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stationflow.llm import packing, tokens
from stationflow.llm.common import per_text, slices
from stationflow.llm.queries import BPE, QUERIES

LIBRARY = Tokenizer.from_file(BPE)
PARTS = [
    *"ab' _é日😀²\t\x1c\x85\x00", "  ", "\n", "'re", "'l", "l", "ve", "the ", "ing", "1", "23", "...", "!!", "<|endoftext|>",
    "<|end", "aaaa", "ation", "Don't", "0000", " " * 9, " ",
]


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_every_prefix_of_made_up_texts():
    rng = random.Random(5)
    counter = tokens.PrefixCounter(BPE)
    encoder = tokens.Encoder(BPE)
    for _ in range(600):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 13)))
        assert list(counter.prefixes(text)) == [len(ids(text[:i])) for i in range(len(text) + 1)]
        assert list(encoder.ids(text)) == ids(text)


def test_counts_of_whole_table(spark, small):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op8_prefix_counts"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), len(ids(text)))
        assert r["over_limit"] == (r["n_tokens"] > 1024)
        assert len(ids(text[: r["fit_chars"]])) <= 1024
        assert r["fit_chars"] == len(text) or len(ids(text[: r["fit_chars"] + 1])) > 1024


def test_stored_prefixes_answer_without_encoding(spark):
    df = spark.createDataFrame([(1, "Don't  stop the music"), (2, None), (3, "")], "doc_id int, text string")
    kept = tokens.add_prefix_counts(df, BPE)
    asked = kept.select(
        "doc_id",
        "text",
        tokens.tokens_of_prefix(F.col("prefix_tokens"), 7).alias("first"),
        tokens.tokens_of_prefix(F.col("prefix_tokens"), 99).alias("all"),
        tokens.longest_prefix(F.col("prefix_tokens"), 3).alias("fits"),
    )
    for r in asked.collect():
        text = r["text"] or ""
        assert r["first"] == len(ids(text[:7])) and r["all"] == len(ids(text))
        assert r["fits"] == max(i for i in range(len(text) + 1) if len(ids(text[:i])) <= 3)


def check_places(rows, room=1024):
    at = {}
    for r in rows:
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= room
    return len(at)


def test_pieces_and_places_of_whole_table(spark, small):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op3_vector_best_fit"](spark, small).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(texts)
    total = 0
    for doc, parts in by_doc.items():
        all_ids = np.array([*ids(texts[doc]), 2], "<u4")
        total += len(all_ids)
        parts.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts))) and len(parts) == -(-len(all_ids) // 1024)
        end = 0
        for r in parts:
            assert r["start"] == end
            end += r["length"]
            assert r["ids_crc32"] == zlib.crc32(all_ids[r["start"] : end].tobytes())
        assert end == len(all_ids) and all(r["length"] == 1024 for r in parts[1:])
    assert check_places(rows) <= 1.02 * packing.sequences_needed(total, 1024) + 1


def one_by_one(lengths, caps, weights, rule):
    """Best fit decreasing, piece by piece."""
    bins = []
    scale = np.array(weights) / np.array(caps, float) ** 2
    for length in sorted(lengths, reverse=True):
        item = np.array([length, 1, length * length])
        fits = [b for b in bins if (b >= item).all()]
        if fits:
            if rule == "dot":
                best = max(fits, key=lambda b: float(b @ (scale * item)))
            else:
                best = min(fits, key=lambda b: float(((b - item) ** 2) @ scale))
        else:
            best = np.array(caps)
            bins.append(best)
        best -= item
    return len(bins)


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", [(60, None, None), (60, 4, None), (60, 6, 900)])
def test_every_capacity_holds_and_counts_match_single_pieces(spark, rule, limits):
    rng = random.Random(8)
    lengths = [min(rng.randint(1, 30), rng.randint(1, 30)) for _ in range(500)]
    room = packing.Capacities(*limits, rule=rule)
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id int, length bigint")
    rows = packing.pack(df, room).collect()
    assert Counter(r["length"] for r in rows) == Counter(lengths)
    used = check_places(rows, room.tokens)
    tokens_cap, docs, cost = room.limits()
    groups = {}
    for r in rows:
        groups.setdefault(r["sequence_id"], []).append(r["length"])
    assert all(len(g) <= docs and sum(n * n for n in g) <= cost for g in groups.values())
    assert used <= one_by_one(lengths, room.limits(), room.weights, rule) * 1.03 + 1


def test_names_of_columns_do_not_clash(spark):
    names = ["_block", "_seat", "_rank", "_place", "_before", "n", "sequence_id", "offset"]
    df = spark.createDataFrame([(i, 1 + i % 30) for i in range(200)], "doc_id int, length bigint")
    for name in names:
        df = df.withColumn(name, F.col("doc_id") * 2)
    out = packing.pack(df, packing.Capacities(60))
    assert out.columns == [c for c in df.columns if c not in ("sequence_id", "offset")] + ["sequence_id", "offset"]
    rows = out.collect()
    assert all(r[name] == 2 * r["doc_id"] for r in rows for name in names[:6]) and len(rows) == 200
    check_places(rows, 60)


def test_packed_sequences_hold_the_ids_of_their_pieces(spark):
    texts = [(i, "word and more " * (37 * i % 400)) for i in range(40)] + [(None, None)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    packed = packing.pack_documents(df, BPE)
    pieces = packed.collect()
    by_place = {(r["sequence_id"], r["offset"]): r for r in pieces}
    for r in pieces:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
    for r in packing.sequences(packing.pack_documents(df, BPE)).collect():
        want = []
        while len(want) < r["length"]:
            want += by_place[r["sequence_id"], len(want)]["ids"]
        assert r["ids"] == want and len(want) <= 1024
    for doc, text in texts:
        mine = sorted((r for r in pieces if r["doc_id"] == doc), key=lambda r: r["piece"])
        assert [x for r in mine for x in r["ids"]] == [*ids(text or ""), 2]
    assert "ids" not in packing.pack_documents(df, BPE, with_ids=False).columns


def bins_of(steps, counts):
    bins = {}
    for length, rank, first, each, _ in steps:
        later = [r for n, r, *_ in steps if n == length and r > rank]
        for nth in range(min(later, default=counts[length]) - rank):
            bins.setdefault(first + nth // each, []).append(length)
    return bins


def test_choices_by_tokens_and_by_all_capacities_hold_every_capacity():
    """Pieces go from the largest down, so the choice of the weights changes the number of sequences by little."""
    rng = random.Random(12)
    for _ in range(30):
        counts = dict(Counter(rng.choice([4, 5, 7, 9, 11, 14, 17, 23, 29]) for _ in range(300)))
        needed = {}
        for name, weights in (("tokens", (1.0, 0.0, 0.0)), ("vector", (1.0, 1.0, 1.0))):
            room = packing.Capacities(60, 8, 1000, weights)
            bins = bins_of(packing.plan(counts, room).tolist(), counts)
            assert Counter(n for b in bins.values() for n in b) == Counter(counts)
            assert all(len(b) <= 8 and sum(b) <= 60 and sum(n * n for n in b) <= 1000 for b in bins.values())
            needed[name] = len(bins)
        assert abs(needed["vector"] - needed["tokens"]) <= 0.02 * needed["tokens"] + 1


def test_slices_of_a_batch_are_bounded_in_bytes(spark):
    texts = [None, "", "x" * 50, "é" * 30, None, "y" * 300, "z", "", "w" * 99, "v", None]
    array = pa.array(texts).slice(0)
    for part in (array, array.slice(2, 7), pa.array([], pa.string()), pa.array(texts, pa.large_string())):
        found = list(slices(part, 100))
        assert [t for s in found for t in s.to_pylist()] == part.to_pylist()
        assert all(len(s) == 1 or sum(len((t or "").encode()) for t in s.to_pylist()) <= 100 for s in found)
    long = spark.range(0, 120, 1, 1).select("id", F.repeat(F.lit("a b c d e "), 50_000).alias("text"))
    sizes = long.select("id", per_text(lambda: len, "bigint")(F.col("text")).alias("n")).collect()
    assert sorted((r["id"], r["n"]) for r in sizes) == [(i, 500_000) for i in range(120)]


def test_awkward_pieces(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, "word " * 30_000), (3, "x" * 5_000), (4, "<|endoftext|> a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("length", F.lit(1)).withColumn("seat", F.lit(2))
    found = packing.pack_documents(df, BPE).collect()
    check_places(found)
    assert Counter(r["doc_id"] for r in found if r["length"] == 1)[1] == 2
    assert sum(r["length"] for r in found if r["doc_id"] == 2) == len(ids("word " * 30_000)) + 1
    assert packing.pack_documents(df.where("false"), BPE).count() == 0
    counted = tokens.count_tokens(df, BPE)
    assert counted.columns == [*df.columns, "tokens"]
    assert {r["doc_id"]: r["tokens"]["n_tokens"] for r in counted.collect()}[None] == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(0,)], "length bigint"))
