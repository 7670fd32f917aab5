"""A training corpus from raw documents: toxicity, quality, near-duplicates, source mix, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stationflow.llm import mixing, packing, quality, simhash, toxicity
from stationflow.llm.common import free_name, quoted, reach_workers
from stationflow.llm.queries import BPE, fold, table
from stationflow.storage import work_dir

# No stage but the first learns, and SQL has no logistic noisy-or, zstandard or XXH64: tests hold every stage
# against its operator instead.
ORACLE_SQL = None


def _kept(judged: DataFrame, docs: DataFrame, verdict: str) -> DataFrame:
    return judged.where(verdict).select(*map(quoted, docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below the threshold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), usable=fold("_id", 3) != 1)
    name = free_name(docs, "toxicity")
    return _kept(toxicity.score_toxicity(docs, model, into=name), docs, f"{name}.predicted = 0")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the compression bands keep."""
    reach_workers(spark)
    name = free_name(docs, "quality")
    return _kept(quality.judge_quality(docs, into=name), docs, f"{name}.kept")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    reach_workers(spark)
    return simhash.keep_one(docs, width=3, most=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of the sources take them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    reach_workers(spark)
    return packing.pack_documents(docs, BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("SimHash near-dedup", drop_copies),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            path = f"{work_dir(spark)}/pipeline-{at}-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
