"""One query for each operator, with production parameters, over the whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadtables.llm import circulant, decontamination, divergence, fim, language, line_dedup, ngram_join, packing, repeats, sharding, toxicity, urlfilter, vptree

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Hosts with one of these labels are on the block list.
BLOCKED_LABELS = ("spam-farm", "cheap-pills", "casino", "adult")


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages", "page_id", "url")
    return urlfilter.judge(pages, RULES, urlfilter.hosts_with_label(pages, BLOCKED_LABELS))


def op2_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"), 24)


def op3_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return vptree.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op6_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language.fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    return language.predict(docs, model).withColumn("held_out", language.held_out("doc_id", 4, 2))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_pattern_packing(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer)


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(_table(spark, sf_dir, "documents", "doc_id", "text")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontamination.contamination(decontamination.verbatim_matches(docs, items))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(_table(spark, sf_dir, "documents", "lang", "source", "text"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(fim.fill_in_middle(_table(spark, sf_dir, "documents", "doc_id", "text")))


def op13_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


ALL = [op1_bloom_cascade, op2_kd_sharding, op3_vantage_point_search, op4_line_dedup, op5_toxicity, op6_language_codes, op7_ngram_jaccard_join, op8_pattern_packing, op9_suffix_array_dedup, op10_decontamination,
       op11_source_divergence, op12_fill_in_middle, op13_circulant_minhash]
