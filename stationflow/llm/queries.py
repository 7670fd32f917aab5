"""Registered queries of the corpus operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import (
    collocations,
    decontamination,
    language_model,
    licenses,
    mixing,
    packing,
    prefix_trie,
    quality,
    search,
    simhash,
    tokens,
    toxicity,
    urls,
)
from stationflow.llm.common import reach_workers
from stationflow.llm.sql import COLLOCATIONS, PASSAGES, PREFIX_TRIE

BPE = public_tokenizers.path("byte_bpe_50k.json")
RULES = (
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts))


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "quality.*")


def op2_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return judged.select("page_id", "url_verdict.*")


def op3_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BPE)


def op4_pigeonring_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), width=3, most=3, keep=("doc_id",))


def op5_gated_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = language_model.score_documents(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return scored.select(
        "doc_id", (~F.col("training")).alias("held_out"), *[c for c in scored.columns if c not in ("doc_id", "training")]
    )


def op6_impact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(50)) == 0)


def op7_conditional_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return licenses.license_rows(scanned)


def op8_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), BPE)
    return counted.select("doc_id", "tokens.*")


def op9_multiple_instance_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(documents, labels, usable=fold("_id", 3) != 1)
    scored = toxicity.score_toxicity(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "toxicity.*")


def op10_multinomial_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op11_vertical_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_winnowed_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.find_passages(documents.select("doc_id", "text"), benchmark.select("item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op13_screened_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_compression_bands": op1_compression_bands,
    "op2_url_trees": op2_url_trees,
    "op3_vector_best_fit": op3_vector_best_fit,
    "op4_pigeonring_simhash": op4_pigeonring_simhash,
    "op5_gated_language_model": op5_gated_language_model,
    "op6_impact_top_k": op6_impact_top_k,
    "op7_conditional_licenses": op7_conditional_licenses,
    "op8_prefix_counts": op8_prefix_counts,
    "op9_multiple_instance_toxicity": op9_multiple_instance_toxicity,
    "op10_multinomial_mix": op10_multinomial_mix,
    "op11_vertical_collocations": op11_vertical_collocations,
    "op12_winnowed_passages": op12_winnowed_passages,
    "op13_screened_prefix_trie": op13_screened_prefix_trie,
}

ORACLES = {
    "op6_impact_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
            from embeddings
            where vec_id is not null and embedding is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.vec_id as query_id, c.vec_id,
                   cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
            from v q join v c on c.vec_id <> q.vec_id and len(c.e) = len(q.e)
            where q.vec_id % 50 = 0
        ), ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
        )
        select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
    """,
    "op11_vertical_collocations": COLLOCATIONS,
    "op12_winnowed_passages": PASSAGES,
    "op13_screened_prefix_trie": PREFIX_TRIE,
}
