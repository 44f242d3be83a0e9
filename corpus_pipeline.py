"""The corpus pipeline: each stage works on all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyplane.llm import stages
from tallyplane.llm.common import read_table, staged

STAGES = [
    ("quality classifier", stages.quality),
    ("n-gram jaccard join", stages.near_duplicates),
    ("benchmark decontamination", stages.decontaminate),
    ("secret scans", stages.redact),
    ("bpe encoding", stages.tokenize),
]

#: Models and tokenizers are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"pipeline{k}")
    return docs
