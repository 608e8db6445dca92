"""Running streams: checkpoints, fan-out and dimension snapshots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemill import fixed_values as fv
from tidemill.streaming.logs import BatchLog, refuse_stale

# A batch function gets a bounded frame and the id of its micro-batch.
BatchFunction = Callable[[DataFrame, int], None]


def start(
    stream: DataFrame,
    process: BatchFunction,
    checkpoint: str,
    output_mode: str = "append",
    once: bool = False,
    name: str | None = None,
    logs: Sequence[BatchLog] = (),
) -> StreamingQuery:
    """Run ``process`` on every micro-batch, resuming from ``checkpoint``.

    A new checkpoint over a log that has batches is refused: they would be
    overwritten.  The logs of ``log_sink``, ``fan_out`` and ``LateSplit`` are
    known; those that a function of the caller's writes are named in ``logs``.

    Batches start every 60 seconds, or with ``once`` the available input is
    worked off and the query ends.  A batch may be repeated after a failure,
    so ``process`` must write by batch id or by key.
    """
    refuse_stale(stream.sparkSession, checkpoint, [*logs, *written_logs(process)])
    writer = (
        stream.writeStream.foreachBatch(process)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if once else {"processingTime": f"{fv.CHECKPOINT_SECONDS} seconds"}
    return writer.trigger(**trigger).start()


def written_logs(process: BatchFunction) -> list[BatchLog]:
    """The logs that a batch function says it writes (``logs`` of the function,
    or of the object whose method it is)."""
    return list(getattr(process, "logs", None) or getattr(getattr(process, "__self__", None), "logs", None) or [])


def fan_out(stage: BatchLog, sinks: list[BatchFunction], transform=None) -> BatchFunction:
    """One batch to several sinks.

    The (transformed) batch is written once and every sink reads the written
    rows.  A cached frame would be recomputed when an executor is lost, calling
    an external model again and possibly giving the sinks different rows.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch, batch_id) if transform else batch
        stage.write(rows, batch_id)
        staged = stage.read_batch(batch.sparkSession, batch_id, rows.schema)
        for sink in sinks:
            sink(staged, batch_id)

    process.logs = [stage, *[log for sink in sinks for log in written_logs(sink)]]
    return process


def log_sink(log: BatchLog, shape: Callable[[DataFrame, int], DataFrame] | None = None) -> BatchFunction:
    """Write the (shaped) batch to a log."""

    def write(batch: DataFrame, batch_id: int) -> None:
        log.write(shape(batch, batch_id) if shape else batch, batch_id)

    write.logs = [log]
    return write


def writer_sink(
    file_format: str, shape: Callable[[DataFrame, int], DataFrame] | None = None, **options: str
) -> BatchFunction:
    """Append the (shaped) batch with any batch writer, for instance messages to
    ``kafka``.  A repeated batch is sent again: at least once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch, batch_id) if shape else batch
        rows.write.format(file_format).mode("append").options(**options).save()

    return write


class Snapshot:
    """A dimension read again every ``every`` batches.

    ``load`` must build a new frame on each call: a frame lists its files when
    it is created, so an old one does not see new files.
    """

    def __init__(self, load: Callable[[], DataFrame], every: int = 1):
        self._load = load
        self._every = every
        self._frame: DataFrame | None = None
        self._loaded_at: int | None = None

    def at(self, batch_id: int) -> DataFrame:
        due = self._loaded_at is None or batch_id - self._loaded_at >= self._every
        if due:
            self._frame, self._loaded_at = self._load(), batch_id
        return self._frame
