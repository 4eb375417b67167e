"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before has kept; all but the last return
the columns of documents. Stages are written as Parquet and read again, so that a stage never repeats another's work
and a lost executor costs only its own tasks.

Every stage takes an empty table and any further columns, whatever they are called; repeated rows are documents of
their own; a null id is an id like others; a null text has no words and goes with the quality rules.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import bpe, decontaminate, line_dedup, near_dup, quality
from skyloom.llm.common import ship, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    ship(spark)
    return quality.keep(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in ten documents or more go; the documents stay, with an empty text if all lines went. n_chars follows the text."""
    ship(spark)
    kept = line_dedup.drop_frequent_lines(docs)
    return kept.withColumn("n_chars", _length(kept)) if "n_chars" in kept.columns else kept


def _length(docs: DataFrame):
    return F.length("text").cast(docs.schema["n_chars"].dataType)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id, a null id last; of rows equal in id and text, the first by their other columns. Documents without words stay."""
    ship(spark)
    return near_dup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and digests of them and of what they decode to; an empty text has no ids."""
    ship(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", byte_bpe),
]
#: The near-duplicate stage needs components of a similarity graph over word shingles of the lines that are left; SQL does not express that at this size, so a test holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
