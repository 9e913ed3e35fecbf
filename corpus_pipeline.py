"""The corpus pipeline over ``documents``; its stages apply operators of ``jobloom.llm``.

Every stage but the last returns the columns of its documents, extra ones included. Stages that drop documents decide row by row:
each row has an identity of its own, which the operators carry, so ids that are null or repeated keep or drop nothing else.
Empty tables stay empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm import block_naming, cutting_stock, mixing, token_combinations, weak_labels
from jobloom.llm.common import keep_rows, table, with_row, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go. The model is fitted on the labelled rows among ``docs``."""
    score = weak_labels.scored(weak_labels.fit(docs, table(spark, sf_dir, "labels")))
    return docs.filter(score("text") < weak_labels.THRESHOLD)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest doc_id stays; a null id is smaller than any other, and of rows that
    repeat the largest id one stays."""
    docs, row = with_row(docs)
    ranked = docs.select(F.struct("doc_id", F.col(row).alias("row")).alias("doc_id"), "text")
    kept = block_naming.exact_duplicates(ranked).filter("kept")
    return keep_rows(docs, row, kept.select(F.col("doc_id.row").alias(row)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by Jaccard similarities of 0.75 or more on 5-word shingles the row with the smallest doc_id stays; a null
    id comes after all others, and of rows that repeat the smallest id one stays."""
    docs, row = with_row(docs)
    ranked = docs.select(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col(row).alias("row")).alias("doc_id"), "text")
    found = token_combinations.jaccard_components(ranked)
    return keep_rows(docs, row, found.filter("doc_id = component_id").select(F.col("doc_id.row").alias(row)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the last one of a source may be cut to its first words."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 2048 tokens."""
    return cutting_stock.pack(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix), ("pack", pack)]

#: packing tokenizes, which SQL cannot express; tests compare the stages with brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order; each result is written and read again as the next stage's documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
