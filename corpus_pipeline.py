"""From raw documents to packed training sequences: each stage calls one operator of threadtables/llm.

A row is known by 64 bits of its doc_id, null or not, and its text, so rows without doc_id are judged like others and rows
that share a doc_id by their own texts. Rows alike in both are one document: they stay or go together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from driver.session import give_work_dir
from threadtables.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from threadtables.session import scratch, stage

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _by_key(docs: DataFrame) -> DataFrame:
    """doc_id, text, row: the key of each row in place of its doc_id, and the row as it was."""
    return docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text", F.struct(*docs.columns).alias("row"))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents judged toxic."""
    give_work_dir(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.drop_toxic(docs, labels, without_id=True).select(*docs.columns)


def fuzzy_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of similar lines stays; documents that consist of removed lines go. `n_chars` follows."""
    give_work_dir(spark)
    return line_dedup.drop_emptied(docs, line_dedup.dedup_texts(docs)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the smallest doc_id, one without doc_id only where none has any."""
    give_work_dir(spark)
    rows = _by_key(docs)
    found = ngram_join.similar_documents(rows.select("doc_id", "text")).select("doc_id", "component_id").distinct()
    order = F.struct(F.col("row.doc_id").isNull().alias("lacks"), F.col("row.doc_id").alias("id"), F.col("doc_id").alias("key"))
    named = stage(found.join(rows.select("doc_id", order.alias("name")).distinct(), "doc_id"), "named")
    first = named.groupBy("component_id").agg(F.min("name").alias("kept"))
    gone = named.join(first, "component_id").where("name.key <> kept.key").select("doc_id").distinct()
    return rows.join(gone, "doc_id", "left_anti").select("row.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold benchmark passages."""
    give_work_dir(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontamination.remove_contaminated(_by_key(docs), items).select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document, with their sequences and places."""
    give_work_dir(spark)
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", toxicity_filter),
    ("line dedup", fuzzy_line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: The stages learn a model, search inverted lists and suffix arrays, and tokenize, which SQL cannot express; tests
#: compare them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; each but the last is written and read again, and what it staged on the
    way is emptied then."""
    give_work_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        with scratch(spark):
            docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
