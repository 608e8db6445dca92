"""Post enrichment: decode, clean, classify, look up parents, store."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators.cells import to_cells
from tidemill.operators.clean import as_results, clean_posts
from tidemill.operators.decode import decode_posts
from tidemill.operators.documents import latest_by
from tidemill.operators.enrich import classify, lookup_parents, split_failures
from tidemill.streaming.logs import BatchLog
from tidemill.streaming.run import BatchFunction, Snapshot, fan_out, start

POSITION = ["topic", "partition", "offset"]


def enrich_posts(
    posts: DataFrame, dimension: DataFrame, make_scorer: Callable, key: list[str] | None = None,
    classify_options: dict | None = None, lookup_options: dict | None = None,
) -> DataFrame:
    """Cleaned, classified posts with their parent industries.  Nothing is
    shuffled unless the dimension is too large to inline."""
    cleaned = clean_posts(posts)
    classified = classify(cleaned, make_scorer, **(classify_options or {}))
    return lookup_parents(classified, dimension, key, stage=True, **(lookup_options or {}))


def enrich_messages(
    messages: DataFrame, dimension: DataFrame, make_scorer: Callable, **options
) -> DataFrame:
    """The same from JSON messages; malformed ones are skipped."""
    return enrich_posts(decode_posts(messages).good, dimension, make_scorer, POSITION, **options)


@dataclass(frozen=True)
class EnrichmentTables:
    """Output logs below one shared directory."""

    base: str

    def log(self, name: str, *partition_by: str) -> BatchLog:
        return BatchLog(f"{self.base}/{name}", partition_by)

    @property
    def results(self) -> BatchLog:
        return self.log("results", "enrich_status")

    @property
    def cells(self) -> BatchLog:
        return self.log("cells")

    @property
    def documents(self) -> BatchLog:
        return self.log("documents")

    @property
    def rejects(self) -> BatchLog:
        return self.log("rejects")

    def read_cells(self, spark: SparkSession) -> DataFrame:
        """The cell table; the batch id is the version."""
        return self.cells.read(spark).drop("batch_id")

    def read_documents(self, spark: SparkSession) -> DataFrame:
        """The document index: one document per id."""
        return self.documents.latest(spark, ["meta_id"])

    def read_dead_letters(self, spark: SparkSession) -> DataFrame:
        """Results that failed; other results' files are not read."""
        return split_failures(self.results.read(spark))[1]


def as_documents(results: DataFrame) -> DataFrame:
    """Result rows as documents under their row key, which stays a field."""
    return results.select(F.col("rowkey").alias("meta_id"), *results.columns)


def start_enrichment(
    messages: DataFrame,
    dimension: Snapshot,
    make_scorer: Callable,
    tables: EnrichmentTables,
    checkpoint: str,
    once: bool = False,
    sinks: Sequence[BatchFunction] = (),
    **options,
) -> StreamingQuery:
    """Run the flow on a message stream.  Each batch is enriched once and
    written to ``results``, failures included; the last result of each row key
    goes to the document index and the cell table.  Messages that cannot be
    decoded go to ``rejects``.  ``sinks`` get each written batch of results as
    well, for instance ``writer_sink(...)`` to an index or a topic."""

    def enrich(batch: DataFrame, batch_id: int) -> DataFrame:
        tables.rejects.write(decode_posts(batch).rejects, batch_id)
        return enrich_messages(batch, dimension.at(batch_id), make_scorer, **options)

    def documents(batch: DataFrame, batch_id: int) -> None:
        keyed = split_failures(batch)[0].filter(F.col("rowkey").isNotNull())
        last = as_results(latest_by(keyed, ["rowkey"], F.struct(*POSITION)))
        tables.documents.write(as_documents(last), batch_id)

    def cells(batch: DataFrame, batch_id: int) -> None:
        # from the documents just written: one row per key already
        last = tables.documents.read_batch(batch.sparkSession, batch_id).drop("meta_id")
        tables.cells.write(to_cells(last, version=batch_id), batch_id)

    process = fan_out(tables.results, [documents, cells, *sinks], enrich)
    logs = [tables.rejects, tables.documents, tables.cells]
    return start(messages, process, checkpoint, once=once, logs=logs)
