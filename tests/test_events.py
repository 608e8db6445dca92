import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import events as V
from tidemill.streaming.windows import sliding_stream, with_event_time


def brute_late(data, delay=2500, high=None):
    high = dict(high or {})
    late = set()
    for key, arrival, ms in sorted(data, key=lambda r: r[1]):
        if ms is not None:
            if key in high and ms <= high[key] - delay:
                late.add(arrival)
            high[key] = max(high.get(key, ms), ms)
    return late


def random_events(n=3000, seed=5):
    """One key holds most events; some keys and times are NULL."""
    rnd = random.Random(seed)
    return [
        (
            rnd.choice(["hot"] * 6 + ["a", "b", None]),
            i * 3,
            None if rnd.random() < 0.02 else i * 100 - rnd.randint(0, 6000),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("block_rows", [1, 7, 500, 10**6])
def test_late_flags(spark, block_rows):
    data = random_events()
    frame = spark.createDataFrame(data, "k string, arrival long, ms long").repartition(5)
    flagged = V.flag_late(frame, "ms", "arrival", ["k"], block_rows=block_rows).collect()
    assert len(flagged) == len(data)
    assert {r.arrival for r in flagged if r.late} == brute_late(data)


def test_late_flags_without_key(spark):
    data = [(0, 1, 100_000), (0, 2, 200_000), (0, 3, 100_000), (0, 4, 199_000), (0, 5, 300_000), (0, 6, 400_000)]
    frame = spark.createDataFrame(data, "k int, arrival long, ms long")
    for block_rows in (2, 100):
        flagged = V.flag_late(frame, "ms", "arrival", block_rows=block_rows).collect()
        assert {r.arrival for r in flagged if r.late} == {3}


@pytest.mark.parametrize("step,levels", [(1, 1), (999_983, 2), (10**12, 2), (10**12, 0)])
def test_late_flags_of_sparse_arrivals(spark, step, levels):
    """Blocks of one record, over several spans, with negative numbers; NULL arrivals come first and are not lost."""
    data = [(k, (a - 4000) * step, ms) for k, a, ms in random_events(1200)]
    frame = spark.createDataFrame([*data, ("a", None, -(10**9))], "k string, arrival long, ms long").repartition(5)
    flagged = V.flag_late(frame, "ms", "arrival", ["k"], block_rows=2, levels=levels).collect()
    assert len(flagged) == len(data) + 1
    assert {r.arrival for r in flagged if r.late} == brute_late(data)
    whole = V.flag_late(frame, "ms", "arrival", block_rows=2, levels=levels).collect()
    assert {r.arrival for r in whole if r.late} == brute_late([("", a, ms) for _, a, ms in data])


def test_late_flags_with_carried_state(spark):
    data = random_events()
    first, second = data[:1500], data[1500:]
    frames = [spark.createDataFrame(d, "k string, arrival long, ms long") for d in (first, second)]
    carry = V.high_event_times(frames[0], "ms", ["k"])
    late = {
        r.arrival
        for f, c in ((frames[0], None), (frames[1], carry))
        for r in V.flag_late(f, "ms", "arrival", ["k"], block_rows=100, carry=c).collect()
        if r.late
    }
    assert late == brute_late(data)


@pytest.mark.parametrize(
    "size,slide,offset", [(60_000, 10_000, -8 * 3_600_000), (3_600_000, 300_000, 0), (30_000, 10_000, 3_000), (5_000, 5_000, 0)]
)
def test_panes_equal_direct_windows(spark, size, slide, offset):
    rnd = random.Random(9)
    data = [(rnd.choice("ab"), 1_600_000_000_000 + rnd.randint(0, 400_000), rnd.randint(-9, 9) or None) for _ in range(400)]
    frame = with_event_time(spark.createDataFrame(data, "k string, ms long, v long"), "ms", "millis")
    panes = V.sliding_aggregate(frame, "event_time", ["k"], "v", size, slide, offset)
    direct = sliding_stream(frame, ["k"], "v", size, slide, offset)
    got = {tuple(r) for r in panes.collect()}
    assert got == {tuple(r) for r in direct.collect()}
    brute = {}
    for k, ms, v in data:
        start = (ms - offset) // slide * slide + offset
        while start > ms - size:
            brute.setdefault((k, start), []).append(v)
            start -= slide
    assert {(r[0], r[1]): r[3] for r in got} == {k: sum(x is not None for x in v) for k, v in brute.items()}


def test_windows_must_tile(spark):
    with pytest.raises(ValueError, match="multiple"):
        V.sliding_aggregate(spark.range(1), "id", [], "id", 70, 20)


def test_event_times(spark):
    row = spark.createDataFrame([(1_600_000_000, 1_600_000_000_123)], "s long, ms long")
    got = row.select(
        F.unix_millis(V.event_time_from_seconds("s")), F.unix_millis(V.event_time_from_millis("ms"))
    ).first()
    assert tuple(got) == (1_600_000_000_000, 1_600_000_000_123)
