"""Queries over whole tables, at sizes where a cut would show."""

import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from kinetrace.plans.base import pose
from kinetrace.plans.queries import ORACLES, QUERIES
from tests.compare import DATA, connection, same

SF = f"{DATA}/sf0.01"


def one(sql: str) -> int:
    return connection(SF).execute(sql).fetchone()[0]


def test_event_metrics_of_all_tracks(spark):
    sessions = one("SELECT count(DISTINCT user_id // 2) FROM events")
    for name in ("loom_time_points", "event_metrics"):
        same(spark, QUERIES[name], ORACLES[name], SF)
        assert QUERIES[name](spark, SF).select("session").distinct().count() == sessions


def test_shared_windows_of_all_pairs(spark):
    same(spark, QUERIES["shared_windows"], ORACLES["shared_windows"], SF)
    assert QUERIES["shared_windows"](spark, SF).select("pair").distinct().count() == one("SELECT count(DISTINCT user_id // 2) FROM events WHERE event_type = 'error'")


def test_widen_tracks_of_all_pairs(spark):
    """Slots are numbered by the tracks that a session has."""
    same(spark, QUERIES["widen_tracks"], ORACLES["widen_tracks"], SF)
    got = QUERIES["widen_tracks"](spark, SF).select(F.sum(F.col("value_1").isNotNull().cast("int") + F.col("value_2").isNotNull().cast("int"))).first()[0]
    assert got == one("SELECT count(value) FROM events")


def test_missing_in_both_of_all_pairs(spark):
    same(spark, QUERIES["missing_in_both"], ORACLES["missing_in_both"], SF)


def test_event_log_of_all_users(spark):
    assert same(spark, QUERIES["event_log"], ORACLES["event_log"], SF) == one("SELECT count(*) FROM events")


def test_line_crossing_of_all_frames(spark):
    """Against exact fractions; near-parallel lines meet far away, so numbers are compared relative to their size."""
    same(spark, QUERIES["line_crossing"], ORACLES["line_crossing"], SF)
    got = {(r.session, r.frame_idx): (r.x, r.y) for r in QUERIES["line_crossing"](spark, SF).collect()}
    rows = pose(spark, SF).select("session", "frame_idx", *[f"{p}_1_{a}" for p in ("nose", "ear_left", "ear_right", "head") for a in "xy"]).collect()
    assert len(rows) == len(got) == one("SELECT count(*) FROM embeddings")
    for session, frame, *v in rows:
        (ax, ay), (bx, by), (cx, cy), (dx, dy) = (map(Fraction, v[k : k + 2]) for k in (0, 2, 4, 6))
        t = ((ax - cx) * (cy - dy) - (ay - cy) * (cx - dx)) / ((ax - bx) * (cy - dy) - (ay - by) * (cx - dx))
        assert got[session, frame] == pytest.approx((float(ax + t * (bx - ax)), float(ay + t * (by - ay))), rel=1e-6, abs=0.051)


def test_line_crossing_of_parallel_lines(spark, tmp_path):
    apart = [0.0, 0.0, 1.0, 1.0, 0.0, 1.0, 1.0, 0.0]
    vectors = [apart + [0.0] * 28, [0.0] * 36]
    spark.createDataFrame([(1, k, v) for k, v in enumerate(vectors)], "label int, vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.frame_idx: r for r in QUERIES["line_crossing"](spark, str(tmp_path)).collect()}
    assert len(got) == 2 and got[0].x is not None
    assert (got[1].x, got[1].y) == (None, None)


def test_densify_days_counts_all_events(spark):
    same(spark, QUERIES["densify_days"], ORACLES["densify_days"], SF)
    assert QUERIES["densify_days"](spark, SF).agg(F.sum("n")).first()[0] == one("SELECT count(*) FROM events")


def test_densify_days_fills_days_without_events(spark, tmp_path):
    rows = [(1, "view", "2024-01-01"), (2, "view", "2024-01-01"), (4, "click", "2024-01-03")]
    df = spark.createDataFrame(rows, "event_id long, event_type string, ts string")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    got = {(r.kind, r.day): r.n for r in QUERIES["densify_days"](spark, str(tmp_path)).collect()}
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert got == {("view", d): n for d, n in zip(days, (2, 0, 0), strict=True)} | {("click", d): n for d, n in zip(days, (0, 0, 1), strict=True)}


def frechet(p, q):
    table = {}
    for i, a in enumerate(p):
        for j, b in enumerate(q):
            past = [table[c] for c in ((i - 1, j), (i, j - 1), (i - 1, j - 1)) if c in table]
            table[i, j] = max(math.dist(a, b), min(past)) if past else math.dist(a, b)
    return table[len(p) - 1, len(q) - 1]


def test_loom_paths_of_whole_sessions(spark):
    """A window that the session's end cuts is compared as far as it goes."""
    sessions = {}
    for r in pose(spark, SF).select("session", "frame_idx", *[f"body_center_{i}_{a}" for i in (1, 2) for a in "xy"]).orderBy("session", "frame_idx").collect():
        sessions.setdefault(r.session, []).append(((r[2], r[3]), (r[4], r[5])))
    expected = {}
    for session, rows in sessions.items():
        for loom, at in enumerate(range(5, len(rows), 25), 1):
            window = rows[at : at + 12]
            if len(window) > 1:
                expected[session, loom] = frechet([w[0] for w in window], [w[1] for w in window])
    got = {(r.session, r.loom): r.frechet for r in QUERIES["loom_paths"](spark, SF).collect()}
    assert max(loom for _, loom in got) > 2
    assert got == pytest.approx(expected, abs=1e-4)
