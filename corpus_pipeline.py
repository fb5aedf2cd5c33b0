"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from askloom.llm import decontamination, near_dedup, packing, pii, quality_rules
from askloom.llm.common import staged
from askloom.llm.queries import tokenizer_file
from askloom.llm.registry import table

#: SQL expresses neither the robust estimate nor the learned spans nor the tokenizer:
#: tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the quality rules keep, whatever their id."""
    row = new_name(docs, "_row")
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    judged = quality_rules.quality_rules(numbered.select(row, "text", "lang", "source"), id_col=row)
    kept = judged.where(F.col("kept")).select(row)
    return numbered.join(kept, row, "left_semi").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class, one with the smallest id; rows without an id stay.

    Rows are numbered in the order of their ids, so that each is judged for itself.
    """
    row, place = new_name(docs, "_row"), new_name(docs, "_place")
    ordered = docs.withColumn(place, F.monotonically_increasing_id()).sort("doc_id", F.xxhash64("text"), place)
    numbered = staged(ordered.drop(place).withColumn(row, F.monotonically_increasing_id()), "numbered")
    named = F.when(F.col("doc_id").isNotNull(), F.col(row)).alias(row)
    classes = near_dedup.near_duplicates(numbered.select(named, "text"), id_col=row)
    gone = classes.where(~F.col("kept")).select(row)
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def new_name(docs: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark go."""
    clean = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return recounted(clean)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return recounted(pii.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences, with their token ids."""
    return packing.pack(docs, tokenizer_file())


def recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("private", private),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
