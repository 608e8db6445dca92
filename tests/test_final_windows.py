"""Windows that are told once: late rows, lateness and the size of the state."""

import pytest

from tests.test_streams import run, write_files
from tidemill.session import shared_dir
from tidemill.sources.streams import file_stream
from tidemill.streaming import windows as W
from tidemill.streaming.final_windows import final_windows
from tidemill.streaming.logs import BatchLog
from tidemill.streaming.run import log_sink, start

SIZE, SLIDE = 60_000, 20_000


def told(spark, batches, delay_ms=5_000, lateness_ms=0):
    frames = [spark.createDataFrame(b, "k string, ms long, v long") for b in batches]
    stream = file_stream(spark, write_files(spark, "final", frames), frames[0].schema, files_per_batch=1)
    timed = W.with_watermark(W.with_event_time(stream, "ms", "millis"), lateness_ms=lateness_ms, delay_ms=delay_ms)
    base = shared_dir(spark, "final")
    log = BatchLog(f"{base}/log")
    query = start(final_windows(timed, ["k"], "v", SIZE, SLIDE), log_sink(log), f"{base}/ck", once=True)
    run(query)
    return {(r.k, r.window_start): (r.n, r.sum, r.min, r.max) for r in log.read(spark).collect()}, query.recentProgress


def expected(batches, delay_ms):
    """One batch after another in one run; a row counts if its pane ends behind the watermark with which the batch before it
    freed its state."""
    mark, before, kept = 0, 0, []
    for batch in batches:
        kept += [r for r in batch if r[1] // SLIDE * SLIDE + SLIDE > before]
        before, mark = mark, max([mark, *[r[1] - delay_ms for r in batch]])
    found = {}
    for k, ms, v in kept:
        pane = ms // SLIDE * SLIDE
        for start_ms in range(pane - SIZE + SLIDE, pane + 1, SLIDE):
            if start_ms + SIZE <= mark:
                found.setdefault((k, start_ms), []).append(v)
    return {key: (len(v), sum(v), min(v), max(v)) for key, v in found.items()}


BATCHES = [
    [("a", 100_000, 1), ("a", 110_000, 2), ("b", 170_000, 3)],
    [("a", 105_000, 4), ("a", 161_000, 5), ("b", 300_000, 6)],
    [("a", 250_000, 7), ("b", 299_000, 8), ("a", 400_000, 9), ("b", 130_000, 10)],
]


@pytest.mark.parametrize("lateness_ms", [0, 100_000])
def test_windows_are_told_once_and_late_rows_left_out(spark, lateness_ms):
    found, _ = told(spark, BATCHES, lateness_ms=lateness_ms)
    assert found == expected(BATCHES, 5_000 + lateness_ms)


def test_lateness_changes_the_result(spark):
    assert expected(BATCHES, 5_000) != expected(BATCHES, 105_000)


def test_state_is_freed(spark):
    """However long the stream: what the state holds is what lies behind the watermark."""
    batches = [[("a", n * 200_000 + k * 10_000, k) for k in range(20)] for n in range(6)]
    found, progress = told(spark, batches)
    assert found == expected(batches, 5_000)
    held = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in progress if p["stateOperators"]]
    assert held and max(held) <= 2 * (200_000 + SIZE) // SLIDE + 10 and held[-1] <= 2 * SIZE // SLIDE + 2


def test_a_size_is_whole_slides(spark):
    with pytest.raises(ValueError, match="multiple"):
        final_windows(spark.range(1), [], "id", 50, 20)
