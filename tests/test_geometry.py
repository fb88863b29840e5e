import math
import random

import pytest
from pyspark.sql import functions as F

from kinetrace.functions import geometry as G
from kinetrace.functions import names


def one(spark, *columns):
    row = spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()
    return list(row)


SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10)]
FLOOR = [(0, 0), (10, 0), (10, 20), (0, 20)]


def at(x, y):
    return F.lit(float(x)), F.lit(float(y))


def test_angles(spark):
    got = one(spark, G.angle_at(at(1, 0), at(0, 0), at(0, 1)), G.angle_at(at(0, 1), at(0, 0), at(1, 0)), G.wrapped(F.lit(270.0)), G.angle_between(at(0, 0), at(1, 0), at(0, 0), at(0, 2)), G.angle_between(at(0, 0), at(0, 0), at(0, 0), at(0, 2)))
    assert got == pytest.approx([90, 270, -90, 90, 0])


def test_polygon_borders(spark):
    points = [(5, 5), (5, 0), (5, 10), (0, 5), (10, 5)]
    assert one(spark, *[G.in_polygon(at(*p), SQUARE) for p in points]) == [1, 0, 1, 0, 1]


def test_facing(spark):
    assert one(spark, G.facing(at(1, 0), at(0, 0), (5, 0)), G.facing(at(1, 0), at(0, 0), (1, 5)), G.facing(at(0, 0), at(0, 0), (1, 5))) == [1, 0, 0]


def test_circle_and_distance(spark):
    assert one(spark, G.in_circle(at(3, 4), (0, 0), 5), G.in_circle(at(3, 4.1), (0, 0), 5), G.polygon_distance(at(13, 14), SQUARE), G.polygon_distance(at(5, 5), SQUARE)) == [1, 0, 5.0, 0.0]


def hull_length(points):
    points = sorted(set(points))
    if len(points) < 2:
        return 0.0
    if len(points) == 2:
        return 2 * math.dist(*points)

    def half(ps):
        out = []
        for p in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    ring = half(points) + half(points[::-1])
    return sum(math.dist(a, b) for a, b in zip(ring, ring[1:] + ring[:1], strict=True))


def test_hull_equals_a_monotone_chain_also_in_degenerate_cases(spark):
    rng = random.Random(5)
    cases = [[(rng.randint(0, 3), rng.randint(0, 3)) for _ in range(6)] for _ in range(300)]
    cases += [[(0, 0)] * 6, [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (4, 4)], [(0, 0), (1, 0), (1, 1), (0, 1), (0.5, 0.5), (0.2, 0.7)]]
    rows = [[i, *[float(v) for p in c for v in p]] for i, c in enumerate(cases)]
    df = spark.createDataFrame(rows, ["i", *[f"{a}{k}" for k in range(6) for a in "xy"]])
    points = [(f"x{k}", f"y{k}") for k in range(6)]
    got = {r.i: r.p for r in df.select("i", G.hull_perimeter(points).alias("p")).collect()}
    for i, c in enumerate(cases):
        assert got[i] == pytest.approx(hull_length([tuple(map(float, p)) for p in c])), c


def test_names_numbers_and_columns_give_the_same(spark):
    points = [(1.0, 2.0), (4.0, -6.0), (0.5, 0.25), (3.0, 3.0)]
    df = spark.createDataFrame([[v for p in points for v in p]], [f"{a}{k}" for k in range(4) for a in "xy"])
    forms = [[(f"x{k}", f"y{k}") for k in range(4)], points, [(F.col(f"x{k}"), F.col(f"y{k}")) for k in range(4)]]
    got = [df.select(G.distance(p, q), G.squared(p, q), G.angle_at(p, q, r), G.angle_between(p, q, r, s), G.frame_cost([p, q], [r, s]), G.heading_to(p, q, r), G.facing(p, q, r, 90.0), G.in_polygon(s, [p, q, r]), G.in_circle(p, q, 9.0), G.polygon_distance(s, [p, q, r]), G.segment_distance(p, q, s)).first() for p, q, r, s in forms]
    assert got[0] == pytest.approx(got[1]) and got[0] == pytest.approx(got[2])
    gone = df.withColumn("x0", F.lit(None).cast("double"))
    p, q, r, s = forms[0]
    assert gone.select(G.frame_cost([p, q], [r, s]), G.frame_cost([p], [r])).first() == (1 + 81, None)
    with pytest.raises(TypeError, match="names"):
        G.hull_perimeter(forms[2])


def test_zones_from_a_floor(spark):
    nest = [v for p in G.nest_corners(FLOOR, 0.2, 1) for v in p]
    loom = G.loom_center(FLOOR, 0.1506)
    assert one(spark, *nest) == pytest.approx([-4, 16, 14, 16, 14, 21, -4, 21])
    assert one(spark, *loom, G.pixels_per_cm(FLOOR, 10)) == pytest.approx([5, 3.012, 2.0])


def test_rotation(spark):
    assert one(spark, G.rotation_angle((0, 0), (1, 1)), G.rotation_angle((0, 0), (1, 100), 5.0), *G.rotated((1, 0), (0, 0), 90), G.expanded_canvas(100, 50, 30)[0]) == pytest.approx([45, 0, 0, -1, 112], abs=1e-9)


def test_lines(spark):
    assert one(spark, *G.line_crossing((0, 0), (2, 2), (0, 2), (2, 0)), *G.line_crossing((0, 0), (1, 0), (0, 1), (1, 1))) == [1.0, 1.0, None, None]


def test_crop_window(spark):
    assert one(spark, *G.crop_window([(30, 30), (130, 40), (120, 90), (20, 100)], 200, 110, 10)) == [10, 20, 128, 80]


def test_distances_do_not_depend_on_rotation(spark):
    turned = [G.rotated(p, (3, 4), 37) for p in ((0, 0), (5, 9))]
    assert one(spark, G.distance(*turned))[0] == pytest.approx(math.dist((0, 0), (5, 9)))


def test_names(spark):
    df = spark.createDataFrame([("TRAP2-150_D1",), ("TRAP2-153+154_D3_x",), ("none",)], "s string")
    got = [tuple(r) for r in df.select(F.array_join(names.animal_ids(F.col("s")), ","), F.array_join(names.animal_ids(F.col("s"), True), ","), names.loom_session(F.col("s"))).collect()]
    assert got == [("150", "2", "L1"), ("153,154", "153,154", "L3"), ("1", "1", "L1")]
    assert one(spark, names.fraction(F.lit("30000/1001")), names.fraction(F.lit("5/0")), names.fraction(F.lit("x")))[1:] == [None, None]
