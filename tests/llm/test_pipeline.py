"""The stages of the corpus pipeline, each against what its operator decides."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from stationflow.llm import mixing, quality, simhash
from stationflow.llm.queries import ORACLES, QUERIES

from oracle_check import connect, difference, rows_of_spark, rows_of_sql

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_follow_one_another(spark):
    small = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{small}/documents.parquet").cache()
    (_, toxic), (_, poor), (_, copies), (_, mix), (_, pack) = pipeline.STAGES
    calm = toxic(spark, docs, small).cache()
    assert calm.columns == docs.columns and 0.7 * docs.count() < calm.count() < docs.count()
    good = poor(spark, calm, small).cache()
    want = {r["doc_id"] for r in quality.judge_quality(calm).where("quality.kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == want
    one = copies(spark, good, small).cache()
    groups = simhash.simhash_groups(good, width=3)
    assert {r["doc_id"] for r in one.collect()} == {r["component_id"] for r in groups.collect()}
    mixed = mix(spark, one, small)
    assert mixed.columns == docs.columns
    times = [r["count"] for r in mixed.groupBy("doc_id").count().collect()]
    assert times and max(times) <= 3
    packed = pack(spark, mixed, small)
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def words_of(text):
    return WORD.findall(text or "")


def is_made_of(cut, whole, between):
    """Whether passages of ``cut`` are runs of words of ``whole``, in order."""
    at = 0
    for passage in cut.split(between):
        found = whole.find(passage, at)
        if found < 0:
            return False
        at = found + len(passage)
    return True


def test_mixing_stage_gives_the_words_of_the_drawn_blocks(spark):
    """Also where one document is most of its source."""
    rng = random.Random(6)
    rows = [(i, "".join(f"w{i}.{j} " for j in range(70)), "a") for i in range(9)]
    rows += [(9, "".join(f"long{j}\n" for j in range(5000)), "a"), (10, "x y " * 4000, "b"), (11, "z " * 900, "c")]
    rows += [(20 + i, " ".join(f"q{rng.randrange(999)}" for _ in range(rng.randint(1, 300))), "b") for i in range(60)]
    docs = spark.createDataFrame(rows + [(12, " ", "c"), (13, None, "b")], "doc_id bigint, text string, source string")
    for name in ("size", "_size", "copy", "words", "seat", "passages", "pass", "_runs"):
        docs = docs.withColumn(name, F.lit(1))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got, texts = Counter(), defaultdict(list)
    for r in mixed.collect():
        got[r["doc_id"]] += len(words_of(r["text"]))
        texts[r["doc_id"]].append(r["text"])
    # Words of each document are those that the operator counts, pair by pair of source and block those of mix_blocks.
    counted = {r["doc_id"]: r for r in mixing.mix_sources(docs).collect()}
    assert dict(got) == {i: r["taken"] for i, r in counted.items() if r["taken"]}
    blocks = Counter()
    for r in mixing.mix_blocks(docs).collect():
        for part in r["documents"]:
            blocks[part["doc_id"]] += part["words"]
    assert blocks == got
    by_source = Counter()
    for i, _, source in rows:
        by_source[source] += got[i]
    for i, source in ((0, "a"), (10, "b"), (11, "c")):
        assert abs(by_source[source] - counted[i]["target"]) <= 1.5 * mixing.Mix().block_words, (source, by_source)
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i, found in texts.items():
        assert len(found) <= 3
        assert all(t == whole[i] or is_made_of(t, whole[i] + " ", mixing.Mix().between) for t in found)
    assert {12, 13}.isdisjoint(got) and any(t != whole[i] for i, found in texts.items() for t in found)


def test_stages_take_an_empty_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, small).count() == 0


def test_run_goes_through_all_stages(spark, small):
    assert pipeline.run(spark, small).count() > 0


def test_oracles(spark, small):
    con = connect(small)
    for name, sql in ORACLES.items():
        assert difference(rows_of_spark(QUERIES[name](spark, small)), rows_of_sql(con, sql)) is None
