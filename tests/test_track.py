import pytest
from pyspark.sql import functions as F

from kinetrace.operators import align, reshape, stats, trajectory
from kinetrace.operators.track import Track, consecutive, densify, filled_runs, runs

T = Track(("k",), "t")


def frame(spark, values, kind="double"):
    return spark.createDataFrame([("a", i, None if v is None else float(v)) for i, v in enumerate(values)], f"k string, t long, v {kind}")


def column(df, c):
    return [r[0] for r in df.select(c.alias("c"), "t").orderBy("t").select("c").collect()]


GAPPY = [None, 1.0, None, None, None, None, 6.0, None, None, None]


def test_fill(spark):
    df = frame(spark, GAPPY)
    assert column(df, T.filled("v", 2)) == [None, 1, 2, 3, None, None, 6, 6, 6, None]
    assert column(df, T.filled("v", both=True)) == [1, 1, 2, 3, 4, 5, 6, 6, 6, 6]


def test_fill_never_alters_known_values(spark):
    df = frame(spark, GAPPY).withColumn("f", T.filled("v", 3))
    assert df.where("v is not null and v <> f").count() == 0


def test_rank_and_rolling(spark):
    assert column(frame(spark, [1.0, 1.0, 2.0, None, 5.0]), T.percentile_rank("v")) == [0.375, 0.375, 0.75, None, 1.0]
    df = frame(spark, [1.0, None, 3.0, 9.0])
    assert column(df, T.rolling("v", 3)) == [1, 1, 2, 6]
    assert column(df, T.rolling("v", 3, "median")) == [1, 1, 2, 6]


def test_previous(spark):
    assert column(frame(spark, [None, 2.0, 3.0]), T.previous("v")) == [2, 2, 2]


def test_parity_and_rises(spark):
    df = frame(spark, [0.0, 0, 0, 1, 0, 1, 0, 0])
    flags = column(df, T.odd(F.col("v") == 1))
    assert [i for i, f in enumerate(flags) if f] == [3, 4]
    assert column(df, T.rises(F.col("v") == 1)) == [False, False, False, True, False, True, False, False]


def test_densify_runs_and_gaps(spark):
    df = spark.createDataFrame([("a", 2, 1.0), ("a", 5, 2.0), ("b", 1, 3.0)], "k string, t long, v double")
    assert sorted((r.k, r.t, r.v) for r in densify(df, T).collect()) == [("a", 2, 1.0), ("a", 3, None), ("a", 4, None), ("a", 5, 2.0), ("b", 1, 3.0)]
    assert densify(df, T, start=0).count() == 6 + 2
    assert sorted(map(tuple, runs(frame(spark, GAPPY), T, F.col("v").isNull()).collect())) == [("a", 0, 0, 1), ("a", 2, 5, 4), ("a", 7, 9, 3)]
    assert sorted(map(tuple, consecutive(df, T).collect())) == [("a", 2, 2, 1), ("a", 5, 5, 1), ("b", 1, 1, 1)]
    filled = frame(spark, GAPPY).withColumn("f", T.filled("v", 2))
    assert sorted(map(tuple, filled_runs(filled, T, "v", "f").collect())) == [("a", 2, 3), ("a", 7, 8)]


def test_empty_tables(spark):
    df = frame(spark, GAPPY).limit(0)
    assert densify(df, T).count() == 0 and runs(df, T, F.col("v").isNull()).count() == 0
    assert df.select(T.filled("v", 2)).count() == 0


def test_nearest(spark):
    pts = spark.createDataFrame([("a", 0, 0.0), ("a", 1, 0.5), ("a", 2, 1.0)], "k string, f long, p double")
    events = spark.createDataFrame([("a", 0.25), ("a", 0.375), ("a", -1.0), ("a", 9.0), ("b", 1.0), ("a", None)], "k string, t double")
    got = {(r.k, r.t): (r.frame, r.frame_error) for r in align.nearest(events, pts, ["k"], "t", "p", "f").collect()}
    assert got == {("a", 0.25): (0, -0.25), ("a", 0.375): (1, 0.125), ("a", -1.0): (0, 1.0), ("a", 9.0): (2, -8.0), ("b", 1.0): (None, None), ("a", None): (None, None)}


def test_windows_of_frames(spark):
    frames = spark.createDataFrame([("a", i) for i in range(40)], "k string, frame_idx long")
    windows = spark.createDataFrame([("a", 1, -3, 5), ("a", 2, 30, 99), ("a", 3, 7, 7), ("a", 4, None, 9)], "k string, w int, start long, `end` long")
    got = align.in_windows(frames, windows, ["k"], bucket=8).groupBy("w").agg(F.count("*"), F.min("frame_idx"), F.max("frame_idx")).collect()
    assert sorted(map(tuple, got)) == [(1, 5, 0, 4), (2, 10, 30, 39)]


def test_latency_counts_frames_without_a_reset(spark):
    frames = spark.createDataFrame([("a", i, i in (12, 14, 15, 16, 17)) for i in range(40)], "k string, frame_idx long, inside boolean")
    windows = spark.createDataFrame([("a", 1, 10, 30)], "k string, w int, start long, `end` long")
    met = align.in_windows(frames, windows, ["k"])
    assert align.nth_in_window(met, ["k", "w"], F.col("inside"), 5).first().nth_frame == 13


def test_frechet(spark):
    point = "array<struct<x:double,y:double>>"
    cases = [([(0, 0), (1, 0), (2, 0)], [(0, 1), (1, 1), (2, 1)]), ([(0, 0)], [(3, 4), (0, 1)]), ([], [(1, 1)])]
    df = spark.createDataFrame([(i, [(float(a), float(b)) for a, b in p], [(float(a), float(b)) for a, b in q]) for i, (p, q) in enumerate(cases)], f"i int, p {point}, q {point}")
    native = [r[0] for r in df.orderBy("i").select(trajectory.frechet(F.col("p"), F.col("q"))).collect()]
    arrow = [r.frechet for r in trajectory.frechet_groups(df, "p", "q").orderBy("i").collect()]
    assert native == [1.0, 5.0, None]
    assert arrow[:2] == [1.0, 5.0] and (arrow[2] is None or arrow[2] != arrow[2])


def test_frechet_is_at_least_the_distance_of_ends():
    import random

    rng = random.Random(2)
    for _ in range(50):
        p, q = ([(rng.random(), rng.random()) for _ in range(rng.randint(1, 9))] for _ in range(2))
        d = trajectory.coupled([a for a, _ in p], [b for _, b in p], [a for a, _ in q], [b for _, b in q])
        for e in (0, -1):
            assert d >= ((p[e][0] - q[e][0]) ** 2 + (p[e][1] - q[e][1]) ** 2) ** 0.5 - 1e-12


def test_intervals(spark):
    df = spark.createDataFrame([("a", i, float(p)) for i, p in enumerate((0, 1, 2, 4))] + [("b", 0, 1.0)], "k string, t long, pts_seconds double")
    got = {r.k: r for r in stats.intervals(df, T).collect()}
    assert got["a"].fps == 0.75 and got["a"].ifi_mean_sec == pytest.approx(4 / 3) and got["a"].ifi_std_sec == pytest.approx(0.4714, abs=1e-4) and got["a"].is_vfr
    assert got["b"].fps is None


def test_tracks_are_checked(spark):
    df = spark.createDataFrame([("s", 0, 0), ("s", 0, 1), ("s", 1, None), ("s", 1, 2)], "k string, frame_idx long, track int")
    assert reshape.check_tracks(df, ["k"], "single").count() == 2
    with pytest.raises(ValueError):
        reshape.check_tracks(df, ["k"], "paired")
    with pytest.raises(ValueError):
        reshape.check_tracks(df, ["k"])


def test_widen_and_lengthen(spark):
    df = spark.createDataFrame([("s", 0, 5, 1.0), ("s", 0, 9, 2.0), ("s", 1, 9, 3.0), ("s", 1, 9, 4.0)], "k string, frame_idx long, track int, x double")
    wide = reshape.widen(df, ["k"], ["x"], 2)
    assert sorted(map(tuple, wide.collect())) == [("s", 0, 1.0, 2.0), ("s", 1, None, 3.0)]
    assert sorted(map(str, map(tuple, reshape.lengthen(wide, ["k"], ["x"], 2).collect()))) == ["('s', 0, 0, 1.0)", "('s', 0, 1, 2.0)", "('s', 1, 0, None)", "('s', 1, 1, 3.0)"]
    assert reshape.parts_of(["nose_1_x", "tail_base_2_x", "foo_1_x", "nose_1_y"]) == {1: ["nose"], 2: ["tail_base"]}


def test_long_paths_take_memory_by_their_length():
    """Three antidiagonals of a table of 400 million cells."""
    import tracemalloc

    import numpy as np

    t = np.linspace(0, 50, 20_000)
    tracemalloc.start()
    try:
        d = trajectory.coupled(np.cos(t), np.sin(t), np.cos(t) + 0.25, np.sin(t), above=10.0)
        assert tracemalloc.get_traced_memory()[1] < 20 << 20
    finally:
        tracemalloc.stop()
    assert 0.2 < d <= 0.25 + 1e-9


def test_a_distance_above_the_bound_is_infinite():
    import numpy as np

    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (1, 7), (30, 30), (40, 11)):
        p, q = rng.normal(size=(2, n)), rng.normal(size=(2, m))
        table = np.full((n + 1, m + 1), np.inf)
        table[0, 0] = 0
        for i in range(n):
            for j in range(m):
                table[i + 1, j + 1] = max(min(table[i, j + 1], table[i + 1, j], table[i, j]), float(np.hypot(*(p[:, i] - q[:, j]))))
        d = table[n, m]
        assert trajectory.coupled(*p, *q) == d and trajectory.coupled(*p, *q, above=d) == d
        assert trajectory.coupled(*p, *q, above=d - 1e-9) in (d, np.inf) and trajectory.coupled(*p, *q + 100, above=1.0) == np.inf
