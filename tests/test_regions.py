"""Regions, lines and backgrounds against plain computations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetrace.functions import regions as R
from kinetrace.operators import lines as L
from kinetrace.operators.track import Track
from kinetrace.sources import events

BOX = [(100.0, 50.0), (420.0, 60.0), (410.0, 300.0), (90.0, 290.0)]


def literal(points):
    return [(F.lit(float(x)), F.lit(float(y))) for x, y in points]


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def pairs(rows):
    return [(r.x, r.y) for r in rows]


def test_corners_come_in_order(spark):
    for turn in range(4):
        assert pairs(value(spark, R.ordered_corners(literal(BOX[turn:] + BOX[:turn])))) == BOX


@pytest.mark.parametrize(("p", "inside"), [((200, 100), True), ((100, 50), True), ((90, 290), True), ((80, 100), False), ((415, 310), False), ((95, 170), True)])
def test_contains(spark, p, inside):
    assert value(spark, R.contains(literal(BOX), literal([p])[0])) is inside


def test_perspective_takes_corners_to_the_frame(spark):
    w, h = 640.0, 480.0
    matrix = R.perspective(literal(BOX), F.lit(w), F.lit(h))
    frame = [(0, 0), (w, 0), (w, h), (0, h)]
    rows, right = [], []
    for (x, y), (u, v) in zip(BOX, frame, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        right += [u, v]
    assert np.allclose(value(spark, matrix), [*np.linalg.solve(rows, right), 1.0], atol=1e-6)
    for corner, wanted in zip(literal(BOX), frame, strict=True):
        assert np.allclose(value(spark, F.array(*R.mapped(matrix, corner))), wanted, atol=1e-6)
    assert value(spark, R.perspective(literal([(5, 5)] * 4), F.lit(w), F.lit(h))) is None


@pytest.mark.parametrize("degrees", [0, 30, 90, 135])
def test_enclosing_rectangle(spark, degrees):
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    turned = [(200 + x * c - y * s, 200 + x * s + y * c) for x, y in ((-40, -10), (40, -10), (40, 10), (-40, 10), (0, 0))]
    got = value(spark, R.enclosing(literal(turned)))
    assert (round(got.area, 4), round(got.width, 4), round(got.height, 4)) == (1600.0, 80.0, 20.0)
    assert math.isclose(got.angle, degrees, abs_tol=1e-4) and (round(got.center.x, 6), round(got.center.y, 6)) == (200.0, 200.0)


def test_checked_boxes(spark):
    upright = literal([(100, 100), (500, 100), (500, 300), (100, 300)])
    fit = value(spark, R.checked(upright, F.lit(640), F.lit(480), 2.0))
    share = 400 * 200 / (640 * 480)
    assert fit.valid and math.isclose(fit.area_ratio, share) and abs(fit.angle_error) < 1e-6
    assert math.isclose(fit.confidence, 0.35 * (share - 1 / 6) / (1 / 3) + 0.35 + 0.30, abs_tol=1e-6)
    assert not value(spark, R.checked(upright, F.lit(640), F.lit(480), 3.0)).valid
    assert value(spark, R.checked(upright, F.lit(6400), F.lit(480))).confidence == 0


def test_box_from_lines(spark):
    across = [tuple(literal([(0, 100), (640, 100)])), tuple(literal([(0, 400), (640, 400)]))]
    down = [tuple(literal([(100, 0), (100, 480)])), tuple(literal([(500, 0), (500, 480)]))]
    assert pairs(value(spark, R.box_from_lines(across, down, F.lit(640), F.lit(480)))) == [(100, 100), (500, 100), (500, 400), (100, 400)]
    assert value(spark, R.box_from_lines(across, across, F.lit(640), F.lit(480))) is None
    assert value(spark, R.box_from_lines(across, down, F.lit(200), F.lit(480))) is None


def test_adjacent_boxes(spark):
    box = lambda x, y: literal([(x, y), (x + 200, y), (x + 200, y + 150), (x, y + 150)])
    assert value(spark, R.adjacent(box(0, 0), box(220, 0))) == "vertical"
    assert value(spark, R.adjacent(box(0, 0), box(0, 170))) == "horizontal"
    assert value(spark, R.adjacent(box(0, 0), box(900, 900))) == ""


def test_choice_among_detections(spark):
    made = lambda name, c: F.struct(F.lit(name).alias("method"), F.lit(c).cast("double").alias("confidence")) if c is not None else F.lit(None).cast("struct<method:string,confidence:double>")

    def choice(lines, edges, space, merged, n, known):
        got = value(spark, R.chosen(made("lines", lines), made("edges", edges), made("space", space), made("merged", merged), F.lit(n), F.lit(known)))
        return got and got.method

    assert choice(0.8, 0.9, None, None, 10, False) == "lines"
    assert choice(0.6, 0.65, 0.9, None, 10, False) == "edges"
    assert choice(0.6, 0.65, 0.9, None, 60, False) == "space"
    assert choice(0.5, None, None, 0.6, 10, True) == "merged"
    assert choice(0.5, None, None, 0.6, 10, False) == "lines"
    assert choice(None, None, None, None, 10, True) is None


def test_records_round_trip(spark):
    text = R.as_record(literal(BOX), R.enclosing(literal(BOX)), F.lit(0.5), F.lit("lines"))
    got = value(spark, R.from_record(text))
    assert [tuple(p) for p in got.corners] == BOX and (got.confidence, got.method) == (0.5, "lines")
    assert value(spark, R.from_record(F.lit('{"confidence": 1}'))).method == "unknown"


def test_floor_metadata(spark):
    got = value(spark, R.metadata(literal([(0, 0), (40, 0), (40, 30), (0, 30)])))
    assert (list(got.center), got.width, got.height, got.angle) == ([20.0, 15.0], 40.0, 30.0, 0.0)


def image_lines(spark, shift: float = 0.0):
    """Five lines across and five down, of which the outer ones bound (100, 80) to (540, 400)."""
    rows = []
    for k in range(5):
        y, x = 80.0 + 80 * k, 100.0 + 110 * k
        rows += [("a", 2.0 + shift, 440.0, 100.0, y, 540.0, y), ("a", 90.0 + shift, 320.0, x, 80.0, x, 400.0)]
    rows.append(("b", 10.0, 5.0, 0.0, 0.0, 5.0, 1.0))
    return spark.createDataFrame(rows, "key string, angle double, length double, x1 double, y1 double, x2 double, y2 double")


def test_lines_give_directions_and_a_box(spark):
    lines = image_lines(spark)
    (row,) = L.directions(lines, ["key"]).collect()
    assert row.key == "a" and {row.angle_1, row.angle_2} == {1.25, 91.25}
    met = L.clustered(lines, ["key"])
    assert met.groupBy("cluster").count().where("cluster is not null").count() == 2
    (angles,) = L.cluster_angles(met, ["key"]).collect()
    assert (angles.n_1, angles.n_2, angles.angle_between) == (5, 5, 88.0)
    (box,) = L.box_of_lines(lines, ["key"], 640, 480).collect()
    assert pairs(box.corners) == [(100, 80), (540, 80), (540, 400), (100, 400)] and box.checked.valid
    assert L.box_of_lines(lines.limit(0), ["key"], 640, 480).count() == 0


def test_merged_regions(spark):
    box = lambda x, y, w, h: [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    rows = [("a", 1, box(100.0, 100.0, 190.0, 200.0)), ("a", 2, box(310.0, 100.0, 190.0, 200.0)), ("b", 1, box(0.0, 0.0, 50.0, 50.0))]
    boxes = spark.createDataFrame(rows, "key string, region int, corners array<struct<x:double,y:double>>")
    (row,) = L.merged_regions(boxes, ["key"], 640, 480, 2.0).collect()
    assert row.key == "a" and sorted((round(p.x, 6), round(p.y, 6)) for p in row.corners) == [(100, 100), (100, 300), (500, 100), (500, 300)]


def test_pixel_background(spark):
    frames = spark.createDataFrame([("a", [1, 10]), ("a", [2, 20]), ("a", [6, 31]), ("b", None)], "key string, pixels array<int>")
    assert sorted(map(tuple, L.pixel_background(frames, ["key"]).collect())) == [("a", 0, 2), ("a", 1, 20)]
    assert sorted(map(tuple, L.pixel_background(frames, ["key"], median=False).collect())) == [("a", 0, 3), ("a", 1, 20)]


def test_zero_counts_as_missing(spark):
    seen = {0: 0.0, 1: 10.0, 2: 0.0, 3: 0.0, 4: 40.0, 5: 0.0}
    df = spark.createDataFrame([("s", f, x, x) for f, x in seen.items()], "session string, frame_idx long, x double, y double")
    got = df.select("frame_idx", Track(("session",)).bridged("x", "x", "y").alias("v")).orderBy("frame_idx").collect()
    assert [r.v for r in got] == [10.0, 10.0, 20.0, 30.0, 40.0, 40.0]


def test_configured_sources():
    config = {"paths": {"log": "/a/log.csv"}, "events": {"sources": [{"type": "csv", "path_key": "log"}, {"type": "csv", "path": "/b.csv"}]}}
    assert events.configured(config) == [{"type": "csv", "path": "/a/log.csv"}, {"type": "csv", "path": "/b.csv"}]
    assert events.configured({}) == []
