"""The operators as stages of a corpus pipeline: each takes (spark, docs, sf_dir) and returns a frame.

``docs`` is a written table of documents (doc_id, text, lang, source, n_chars); all columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemill.llm import decontaminate, language, neardup, pieces, secrets
from tidemill.llm.registry import table, with_bounded_batches

#: Below this mean probability no language is taken as found; with more than four languages the bound is lower.
LEAST_SCORE = 0.3


@with_bounded_batches
def keep_languages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without a letter, and those of no clear language, go."""
    return language.recognised(docs, language.learned_language(docs), LEAST_SCORE)


@with_bounded_batches
def drop_near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id, its first row if rows repeat."""
    return neardup.representatives(docs)


@with_bounded_batches
def drop_benchmark_passages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


@with_bounded_batches
def hide_secrets(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return secrets.redact_secrets(docs, secrets.learned_secrets(docs))


@with_bounded_batches
def encode_pieces(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, ids, decoded_crc32, exact`` of every document."""
    return pieces.encode_documents(docs)
