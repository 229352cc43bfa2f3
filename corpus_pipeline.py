"""The corpus pipeline: quality rules, near-duplicates, repeated passages, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over everything its predecessor kept;
``run`` writes each result as Parquet to the shared folder and reads it again for the next stage.
Null texts count as empty, and extra columns of ``documents`` pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import common, near_dup, packing, quality_rules, suffix_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that the base rules or the learned list reject go."""
    return quality_rules.filter_documents(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each group at five-word shingles and similarity 0.8 stays."""
    return near_dup.keep_one(docs, 5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: bytes of 200-byte strings that occur elsewhere go; documents stay."""
    return suffix_dedup.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: pieces of sequences of 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", pack),
]

#: SQL can express neither the learned list nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.work_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
