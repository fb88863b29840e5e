import pytest
from pyspark.sql import functions as F

from kinetrace.operators import clean, correct, features, metrics, zones
from kinetrace.operators.track import Track
from kinetrace.schema import BODY_PARTS, wide_columns

S = ["session"]


def pose_rows(positions):
    """Long poses: {(frame, track): (x, y)} with all parts at offsets from one place."""
    rows = []
    for (frame, track), (x, y) in positions.items():
        rows.append(("s", frame, track, *[v for k in range(6) for v in (float(x + k), float(y + k), 0.9)]))
    return rows


LONG = "session string, frame_idx long, track int, " + ", ".join(f"{p}_{a} double" for p in BODY_PARTS for a in ("x", "y", "score"))


def test_identities_that_crossed_in_a_gap_are_exchanged(spark):
    positions = {(f, 0): (0, 0) for f in range(5)} | {(f, 1): (500, 500) for f in range(5)}
    positions |= {(f, 0): (500, 500) for f in range(8, 12)} | {(f, 1): (0, 0) for f in range(8, 12)}
    out = {r.frame_idx: r for r in clean.clean_paired(spark.createDataFrame(pose_rows(positions), LONG), S).collect()}
    assert len(out) == 12 and out[7].swap_here and not out[4].swap_here
    assert all(out[f].nose_x_1 == 0.0 and out[f].nose_x_2 == 500.0 for f in range(12))


def test_collisions_drop_the_one_that_jumped(spark):
    positions = {(f, 0): (100, 100) for f in range(4)} | {(f, 1): (400, 400) for f in range(4)} | {(2, 1): (101, 101)}
    df = spark.createDataFrame(pose_rows(positions), LONG)
    out = {r.frame_idx: r for r in clean.clean_paired(df, S, limit=5).collect()}
    assert [(f, out[f].drop_1, out[f].drop_2) for f in (1, 2, 3)] == [(1, False, False), (2, False, True), (3, False, False)]
    assert out[2].nose_x_2 == pytest.approx(400.0)
    made = clean.report(clean.clean_paired(df, S), S).first()
    assert made.identity_1 == [2] and '"total_swaps":0' in made.report


def test_exchanging_twice_changes_nothing(spark):
    rows = [("s", f, *[float(10 * i + f) for i in (1, 2) for _ in range(18)], f in (2, 5)) for f in range(8)]
    names = [f"{p}_{a}_{i}" for i in (1, 2) for p in BODY_PARTS for a in ("x", "y", "score")]
    df = spark.createDataFrame(rows, ["session", "frame_idx", *names, "swap_here"])
    track = Track(("session",))
    twice = clean.exchanged(clean.exchanged(df, track).drop("flipped"), track)
    assert twice.select(names).exceptAll(df.select(names)).count() == 0


def wide(spark, frames, animals=2):
    names = wide_columns(animals)
    rows = [("s", f, *[float((f * 7 + k * 13) % 50 + 100 * (k // 18)) for k in range(len(names))]) for f in range(frames)]
    return spark.createDataFrame(rows, ["session", "frame_idx", *names])


@pytest.mark.parametrize(("animals", "columns"), [(2, 299), (1, 117)])
def test_feature_columns(spark, animals, columns):
    out = features.extract(wide(spark, 12, animals), S, animals)
    assert len(out.columns) == columns + 2 and len(set(out.columns)) == len(out.columns)
    first = out.orderBy("frame_idx").first()
    assert first["movement_mouse_1_nose"] == 0.0 and all(v is not None for v in first)


def test_pairwise_statistics_count_pairs_twice_and_skip_zeros(spark):
    row = ["s", 0, 3.0, 4.0, 0.5, *[0.0, 0.0, 0.5] * 5]
    out = features.extract(spark.createDataFrame([row], ["session", "frame_idx", *wide_columns(1)]), S, 1).first()
    assert [out[f"m1_hull_{k}_euclidean"] for k in features.HULL] == [5, 5, 5, 50]


def test_a_lost_animal_has_zero_features(spark):
    row = ["s", 0, *[0.0] * 18]
    out = features.extract(spark.createDataFrame([row], ["session", "frame_idx", *wide_columns(1)]), S, 1).first()
    assert out.poly_area_1 == 0 and out.m1_hull_mean_euclidean == 0 and out.nose_angle_1 == 0


def test_zone_columns(spark):
    z = zones.Zones(((0, 0), (10, 0), (10, 10), (0, 10)), (5, 5), 3)
    df = zones.add(wide(spark, 3), z)
    assert len([c for c in df.columns if c.startswith(("Nest", "Loom"))]) == 52
    assert df.select(zones.inside(1).alias("a"), zones.any_inside(1).alias("b")).first().a in (True, False)


def looms(spark, frames):
    return metrics.loom_events(spark.createDataFrame([("s", "loom", float(f), f) for f in frames], "session string, event_type string, time_start double, frame_start long"), S)


def flags(spark, n, inside=(), near=None, slow=(), calm=()):
    near = set(inside) if near is None else set(near)
    rows = [("s", 1, f, f in set(inside), f in near, f in set(slow), f in set(calm)) for f in range(n)]
    return spark.createDataFrame(rows, "session string, animal int, frame_idx long, inside boolean, near boolean, slow boolean, calm boolean")


def test_latency_and_stay(spark):
    frames = flags(spark, 60, inside=[12, 14, 15, 16, 17, *range(18, 25)], near=range(12, 26))
    p = metrics.time_points(frames, looms(spark, [10, 40]), S).orderBy("loom").collect()
    assert (p[0].latency, p[0].entry_frame, p[0].stay) == (3, 13, 13)
    assert (p[1].latency, p[1].stay, p[1].freeze_start) == (None, None, None)


def test_freezing(spark):
    frames = flags(spark, 120, slow=range(20, 70), calm=range(20, 90))
    p = metrics.time_points(frames, looms(spark, [10]), S).first()
    assert (p.freeze_start, p.freeze_length) == (10, 69)  # fast frames from 90 on; the fifth is 94


def test_no_events(spark):
    frames = flags(spark, 20)
    points = metrics.time_points(frames, looms(spark, [5]).limit(0), S)
    assert points.count() == 0
    assert metrics.measure(frames.withColumn("v", F.lit(1.0)), points, S, [metrics.Metric("m", "mean", "v", metrics.Span(end_offset=3))]).count() == 0


def test_windows_before_the_start_and_missing_points(spark):
    frames = flags(spark, 20).withColumn("v", F.col("frame_idx").cast("double"))
    points = metrics.time_points(frames, looms(spark, [2]), S)
    wanted = [metrics.Metric("before", "mean", "v", metrics.Span(start_offset=-10)), metrics.Metric("entry", "mean", "v", metrics.Span(end="latency")), metrics.Metric("top", "max_smoothed", "v", metrics.Span(end_offset=6), 5)]
    r = metrics.measure(frames, points, S, wanted).first()
    assert (r.before, r.entry, r.top) == (0.5, None, 5.0)


def test_catalogue_sizes():
    # Besides four time points, and four path distances of pairs.
    assert len(metrics.catalogue(paired=True)) + 4 + 4 == 42 and len(metrics.catalogue(paired=False)) + 4 == 21
    names = [m.name for m in metrics.catalogue()]
    assert len(names) == len(set(names))


def scores(spark, rows, names):
    return spark.createDataFrame(rows, ", ".join(["k string, loom int", *[f"{n} double" for n in names]]))


def test_swap_by_error(spark):
    a, b = scores(spark, [("s", 1, 8.0, 1.0), ("s", 2, 2.0, 5.0)], correct.VALUES), scores(spark, [("s", 1, 2.0, 5.0), ("s", 2, 8.0, 1.0)], correct.VALUES)
    manual = scores(spark, [("s", 1, 2.0, 5.0, 8.0, 1.0)], ["latency_a", "time_in_nest_a", "latency_b", "time_in_nest_b"])
    out = correct.correct(a, b, manual, ["k"], correct.VALUES).orderBy("loom").collect()
    assert (out[0].swapped, out[0].swap_before, out[0].latency_a, out[0].error_latency_a) == (True, 1, 2.0, 0.0)
    assert (out[1].swapped, out[1].swap_before, out[1].error_latency_a) == (False, 0, 0.0)
    assert '"swapped":1' in correct.report(correct.correct(a, b, manual, ["k"], correct.VALUES), ["k"]).first().report


def test_swap_with_one_side_missing(spark):
    def decide(m, f):
        cells = [F.lit(v).cast("double") for v in (*m, *f)]
        c = [(cells[i], cells[i + 1]) for i in range(0, 8, 2)]
        return spark.range(1).select(correct.should_swap(c[:2], c[2:])).first()[0]

    assert decide((1, 2, None, None), (-1, -1, 3, 4)) is True
    assert decide((1, 2, None, None), (3, 4, -1, -1)) is False
    assert decide((None, 0, 5, 1), (5, 1, -1, -1)) is True
    assert decide((None, None, None, None), (1, 1, 2, 2)) is False


def test_features_do_not_depend_on_ranges(spark):
    """Rolling windows, means and ranks across ranges of 7 frames, of sessions of unlike length, one of them null and frames missing."""
    df = wide(spark, 40, 1).unionByName(wide(spark, 9, 1).withColumn("session", F.lit(None).cast(wide(spark, 1, 1).schema["session"].dataType))).where("frame_idx % 11 <> 5")
    shown = lambda out: sorted(([round(v, 9) if isinstance(v, float) else v for v in r] for r in out.collect()), key=repr)
    cut = shown(features.extract(df, S, 1, size=7))
    assert cut == shown(features.extract(df, S, 1)) and len(cut) == df.count()


def test_no_event_meets_all_later_frames(spark):
    """Time points look frames up by their count: a session of n frames makes no n * n rows."""
    frames = spark.range(20).selectExpr("1L AS session", "1 AS animal", "id AS frame_idx", *[f"id % 3 = 0 AS {c}" for c in ("inside", "near", "slow", "calm")])
    looms = frames.selectExpr("session", "CAST(frame_idx + 1 AS INT) AS loom", "frame_idx AS at", "frame_idx + 1 AS until")
    plan = metrics.time_points(frames, looms, ["session"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" not in plan
