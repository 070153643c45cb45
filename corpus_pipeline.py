"""A corpus from raw documents to packed sequences: five stages, each written and read again before the next.

`documents` go through language identification, line deduplication, near-deduplication, decontamination and
packing. A stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of
documents; the last returns pieces of sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlens.llm import decontamination, language_id, line_dedup, near_dedup, packing
from harvestlens.session import write_and_read

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; lang is the given one, or the predicted one where it is null."""
    found = language_id.identify_language(docs, keep=COLUMNS[1:]).filter(F.col("lang_pred") != language_id.UNDETERMINED)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of later equal windows; documents of which nothing is left go."""
    cleaned = line_dedup.remove_repeated_lines(docs, keep=["lang", "source", "n_chars"]).filter("n_removed = 0 or n_removed < n_lines")
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.select("doc_id", F.col("kept").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, the one with the smallest id."""
    return near_dedup.one_of_each_group(docs, keep=COLUMNS[2:])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage.

    What is found is written first: a small table is then sent to the documents, and their texts are not shuffled.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hashed = docs.withColumn("h", F.xxhash64("text"))
    held = decontamination.contaminated(hashed, benchmark, keep=["h"]).select(F.col("doc_id").alias("id"), "h").distinct()
    held = write_and_read(held, "pipeline-held")
    return docs.join(held, docs.doc_id.eqNullSafe(held.id) & (F.xxhash64(docs.text) == held.h), "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", identified),
    ("line dedup", without_repeated_lines),
    ("near-dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: The first stage is a trained network and the last one a tokenizer: SQL can express neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_and_read(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
