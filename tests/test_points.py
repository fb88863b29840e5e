"""Time points of a stream against the batch form, for many ways to cut the rows into batches."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetrace.operators import metrics
from kinetrace.streaming import points

SCHEMA = "session long, animal int, frame_idx long, event boolean, inside boolean, near boolean, slow boolean, calm boolean"


def made(seed: int, sessions: int = 3, n: int = 260):
    """Frames and events of sessions of unlike habits; flags may be null, frames may be missing."""
    rng = random.Random(seed)
    flag = lambda p: None if rng.random() < 0.05 else rng.random() < p
    frames, events = [], []
    for s in range(sessions):
        looms = sorted(rng.sample(range(n + 20), rng.randint(0, 6)))
        for a in (1, 2):
            habit = [rng.choice([0.02, 0.1, 0.5, 0.95]) for _ in range(4)]
            last = rng.randint(n // 2, n)
            frames += [(s, a, f, False, *[flag(p) for p in habit]) for f in range(last) if rng.random() < 0.97]
        if s == 2:
            frames = [r for r in frames if r[:2] != (2, 2)]
        events += [(s, f) for f in looms]
    return frames, events


def batch(spark, frames, events):
    df = spark.createDataFrame(frames, SCHEMA)
    looms = spark.createDataFrame([(s, "loom", float(f), f) for s, f in events], "session long, event_type string, time_start double, frame_start long")
    out = metrics.time_points(df, metrics.loom_events(looms, ["session"]), ["session"])
    return sorted(tuple(r) for r in out.collect())


def rows_of(frames, events):
    return frames + [(s, a, f, True, None, None, None, None) for s, f in events for a in (1, 2)]


def as_array(rows):
    """Rows as the machine takes them, a frame a second."""
    out = [(r[2] * 1_000_000, int(r[3]), r[2], int(r[4] or 0), int(r[6] or 0), int(not r[7]), int(r[5] is False)) for r in rows]
    return np.array(out, np.int64).reshape(-1, 7)


@pytest.mark.parametrize("seed", range(6))
def test_any_split_gives_the_batch_result(spark, seed):
    frames, events = made(seed)
    expected = batch(spark, frames, events)
    assert expected
    rng = random.Random(seed)
    for delay, width in [(0, 1), (0, 7), (15, 10), (40, 90), (10, 1000)]:
        got = []
        for s in range(3):
            for a in (1, 2):
                mine = [r for r in rows_of(frames, events) if r[:2] == (s, a)]
                arrival = {id(r): r[2] + rng.randint(0, delay) for r in mine}
                mine.sort(key=lambda r: arrival[id(r)])
                state, latest = points._new(), -1
                for k in range(0, 600, width):
                    batch_rows = [r for r in mine if k <= arrival[id(r)] < k + width]
                    mark = latest - delay - 1
                    waiting = np.concatenate([np.array(state["waiting"], np.int64).reshape(-1, 7), as_array(batch_rows)])
                    state, out = points.drain(state, waiting, mark * 1_000_000, 10**12)
                    got += [(s, a, *o) for o in out]
                    latest = max([latest, *[r[2] for r in batch_rows]])
                state, out = points.drain(state, np.array(state["waiting"], np.int64).reshape(-1, 7), 10**15, 10**12)
                got += [(s, a, *o) for o in out]
                assert state == points._new()
        assert sorted(got, key=lambda r: r[:3]) == expected, (delay, width)


def test_pauses_end_sessions():
    frames = [(0, 1, f, False, True, True, False, True) for f in [*range(10), *range(100, 110)]] + [(0, 1, f, True, None, None, None, None) for f in (2, 104)]
    _, out = points.drain(points._new(), as_array(frames), 10**15, 20_000_000)
    assert [o[:4] for o in out] == [(1, 2, None, 0), (1, 104, None, 0)]


def test_state_stays_small():
    """Neither frames nor finished events stay in the state."""
    state, size = points._new(), 0
    for k in range(0, 6000, 50):
        rows = [(0, 1, f, False, True, f % 3 > 0, True, f % 4 > 0) for f in range(k, k + 50)] + [(0, 1, k, True, None, None, None, None)]
        state, _ = points.drain(state, as_array(rows), (k + 49) * 1_000_000, 10**9)
        size = max(size, len(state["events"]) + len(state["tail"]) + len(state["waiting"]))
    assert size <= points.LOOK_BACK + 3


def test_stream_with_late_rows(spark, tmp_path):
    frames, events = made(11, n=200)
    rng = random.Random(1)
    rows = rows_of(frames, events)
    arrival = sorted(rows, key=lambda r: r[2] + rng.randint(0, 12))
    step = -(-len(arrival) // 4)
    put = lambda some, extra: spark.createDataFrame(some, SCHEMA).withColumn("time", F.timestamp_seconds(F.col("frame_idx") + extra)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for k in range(0, len(arrival), step):
        put(arrival[k : k + step], 0)
    put([(99, 1, 0, False, None, None, None, None)], 10**6)
    # A row far behind the watermark is lost, and says so by changing nothing.
    put([(0, 1, 3, True, None, None, None, None)], 0)
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = points.time_points(stream, ["session"], "40 seconds", 1000)
    q = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "marks")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.schema(found.schema).parquet(str(tmp_path / "out")).collect())
    assert got == batch(spark, frames, events)
