"""A training corpus from documents: language, near copies, benchmark passages, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's
docs.  All but the last return the columns they got.  Nulls, empty and very long texts, ties, repeated rows, empty tables
and extra columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import stages
from tidemill.llm.staging import staged

STAGES = [
    ("language", stages.keep_languages),
    ("near_copies", stages.drop_near_copies),
    ("benchmark", stages.drop_benchmark_passages),
    ("secrets", stages.hide_secrets),
    ("tokens", stages.encode_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
