"""Images by tiles against plain loops over whole images."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetrace.functions import geometry as G
from kinetrace.operators import pixels, voting
from kinetrace.plans import pixel_queries
from tests.compare import DATA, rows_of

KIND = "image string, y long, values array<long>"


def table(spark, images):
    rows = [(n, y, row) for n, a in images.items() for y, row in enumerate(np.asarray(a).tolist())]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, KIND)


def matrices(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.image, {})[r.y] = r["values"]
    return {n: np.array([rows[y] for y in sorted(rows)]) for n, rows in out.items()}


def labels(mask, corners=True):
    """The region of each pixel that is on, as its topmost and then leftmost pixel, by a walk."""
    out, near = {}, [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy or dx) and (corners or not (dy and dx))]
    for y, x in np.argwhere(mask).tolist():
        if (y, x) in out:
            continue
        out[y, x], todo = (y, x), [(y, x)]
        while todo:
            a, b = todo.pop()
            for p in ((a + dy, b + dx) for dy, dx in near):
                if 0 <= p[0] < mask.shape[0] and 0 <= p[1] < mask.shape[1] and mask[p] and p not in out:
                    out[p] = (y, x)
                    todo.append(p)
    return out


def clamp(a, y, x):
    return a[min(max(y, 0), a.shape[0] - 1), min(max(x, 0), a.shape[1] - 1)]


def plain_candidates(a, low, high):
    h, w = a.shape
    five = (1, 4, 6, 4, 1)
    tall = np.array([[sum(k * clamp(a, y + j - 2, x) for j, k in enumerate(five)) for x in range(w)] for y in range(h)])
    b = np.array([[(sum(k * clamp(tall, y, x + j - 2) for j, k in enumerate(five)) + 128) // 256 for x in range(w)] for y in range(h)])
    at = lambda y, x: int(clamp(b, y, x))
    sm = lambda f, y, x: f(y - 1, x) + 2 * f(y, x) + f(y + 1, x)
    m, g = np.zeros((h, w), int), {}
    for y in range(h):
        for x in range(w):
            cx = lambda j: sm(at, y, min(max(j, 0), w - 1))  # noqa: B023, E731
            gx = cx(x + 1) - cx(x - 1)
            dy = lambda j: at(y + 1, min(max(j, 0), w - 1)) - at(y - 1, min(max(j, 0), w - 1))  # noqa: B023, E731
            gy = dy(x - 1) + 2 * dy(x) + dy(x + 1)
            m[y, x], g[y, x] = abs(gx) + abs(gy), (gx, gy)
    out = np.zeros((h, w), int)
    v = lambda y, x: m[y, x] if 0 <= y < h and 0 <= x < w else 0
    for (y, x), (gx, gy) in g.items():
        t = abs(gy) / abs(gx) if gx else math.inf if gy else 0
        if abs(gy) * 32768 < abs(gx) * 13573:
            ridge = m[y, x] > v(y, x - 1) and m[y, x] >= v(y, x + 1)
        elif t > 2.414 and abs(gy) * 32768 > abs(gx) * (13573 + 65536):
            ridge = m[y, x] > v(y - 1, x) and m[y, x] >= v(y + 1, x)
        elif (gx < 0) != (gy < 0):
            ridge = m[y, x] > v(y - 1, x + 1) and m[y, x] > v(y + 1, x - 1)
        else:
            ridge = m[y, x] > v(y - 1, x - 1) and m[y, x] > v(y + 1, x + 1)
        if ridge and m[y, x] > low:
            out[y, x] = 1 + (m[y, x] > high)
    return out


def plain_edges(a, low, high):
    c = plain_candidates(a, low, high)
    own = labels(c > 0)
    strong = {own[p] for p in own if c[p] == 2}
    return np.array([[int(own.get((y, x)) in strong) if (y, x) in own else 0 for x in range(a.shape[1])] for y in range(a.shape[0])])


def drawn(seed, h, w):
    """Bright boxes over noise."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 40, (h, w))
    for _ in range(4):
        y, x = rng.integers(0, max(1, h - 4)), rng.integers(0, max(1, w - 4))
        a[y : y + rng.integers(2, max(3, h // 2)), x : x + rng.integers(2, max(3, w // 2))] += rng.integers(40, 150)
    return np.minimum(a, 255)


IMAGES = {"a": drawn(1, 37, 29), "b": drawn(2, 9, 41), "dot": np.array([[200]]), "flat": np.full((12, 6), 7), "line": drawn(3, 40, 5)}


@pytest.fixture(scope="module")
def images(spark):
    return table(spark, IMAGES).cache()


def boxes(mask, values, corners=True):
    own, out = labels(mask, corners), {}
    for p, root in own.items():
        out.setdefault(root, []).append(p)
    found = []
    for (y, x), ps in out.items():
        ys, xs = zip(*ps, strict=True)
        found.append((y, x, len(ps), min(xs), max(xs), min(ys), max(ys), sum(xs) / len(ps), sum(ys) / len(ps), max(int(values[p]) for p in ps)))
    return found


@pytest.mark.parametrize(("tile", "corners"), [(1, True), (4, True), (4, False), (1000, True), (1000, False)])
def test_regions_equal_a_walk(spark, tile, corners):
    rng = np.random.default_rng(5)
    masks = {"sparse": rng.random((30, 30)) < 0.35, "dense": rng.random((30, 24)) < 0.6, "full": np.ones((9, 7)), "none": np.zeros((8, 8)), "spiral": np.zeros((21, 21))}
    for k in range(0, 10, 2):  # nested frames, each open at one side, that only join across many rows
        masks["spiral"][k, k : 21 - k] = masks["spiral"][20 - k, k : 21 - k] = masks["spiral"][k : 21 - k, 20 - k] = 1
        masks["spiral"][k + 2 : 21 - k, k] = masks["spiral"][k + 2, k : k + 3] = 1
    values = {n: np.where(m, rng.integers(1, 90, m.shape), 0) for n, m in masks.items()}
    got = pixels.regions(table(spark, values), corners, tile).collect()
    want = [(n, *b) for n, m in masks.items() for b in boxes(m.astype(bool), values[n], corners)]
    assert sorted(tuple(r) for r in got) == sorted(want)


@pytest.mark.parametrize("tile", [3, 8, 1000])
def test_edges_equal_plain_loops(images, tile):
    low, high = 60, 200
    assert all((m == plain_candidates(IMAGES[n], low, high)).all() for n, m in matrices(pixels.edge_candidates(images, low, high, tile=tile)).items())
    found = matrices(pixels.as_rows(pixels.edges(images, low, high, tile=tile), images))
    assert sum(int(m.sum()) for m in found.values()) > 50
    for n, a in IMAGES.items():
        assert (found[n] == plain_edges(a, low, high)).all()


def window(a, r, how):
    return np.array([[how(a[max(0, y - r) : y + r + 1, max(0, x - r) : x + r + 1]) for x in range(a.shape[1])] for y in range(a.shape[0])])


@pytest.mark.parametrize("tile", [2, 7, 1000])
def test_sums_and_morphology_equal_plain_loops(images, tile):
    for r in (0, 1, 6, 50):
        found = pixels.box_sums(images, r, tile).collect()
        for n, a in IMAGES.items():
            rows = {x.y: x for x in found if x.image == n}
            assert [rows[y].sums for y in range(len(a))] == window(a, r, np.sum).tolist() and [rows[y].counts for y in range(len(a))] == window(a, r, np.size).tolist()
    for size in (3, 5):
        r = size // 2
        for f, first, then in ((pixels.closed, np.max, np.min), (pixels.opened, np.min, np.max)):
            for n, m in matrices(f(images, size, tile)).items():
                assert (m == window(window(IMAGES[n], r, first), r, then)).all()


def plain_smooth(a, radius, most, least, low, high, clean=3):
    e, r = plain_edges(a, low, high), clean // 2
    m = (window(e, radius, np.sum) <= most * window(e, radius, np.size)).astype(int)
    m = window(window(m, r, np.max), r, np.min)
    m = window(window(m, r, np.min), r, np.max)
    return [b for b in boxes(m.astype(bool), m) if b[2] >= least]


@pytest.mark.parametrize("tile", [5, 1000])
def test_smooth_regions_equal_plain_loops(spark, images, tile):
    got = pixels.smooth_regions(images, 2, 0.15, 6, 60, 200, tile=tile).collect()
    want = [(n, *b) for n, a in IMAGES.items() for b in plain_smooth(a, 2, 0.15, 6, 60, 200)]
    assert sorted(tuple(r) for r in got) == sorted(want) and len(want) > 5


def test_smooth_regions_of_a_whole_table(spark):
    sf = f"{DATA}/sf0.001"
    a = matrices(pixel_queries.image(spark, sf))
    got = pixel_queries.pixel_smooth_regions(spark, sf)
    want = [(n, *b[:7], round(b[7], 6), round(b[8], 6)) for n, m in a.items() for b in plain_smooth(m, 4, 0.1, 20, pixel_queries._LOW, pixel_queries._HIGH)]
    assert rows_of(got.columns, got.collect()) == rows_of(got.columns, want) and want


def test_masks_equal_point_in_polygon(spark):
    rng = random.Random(8)
    shapes = [[(rng.randint(-60, 60) / rng.choice([1, 4]), rng.randint(-60, 60) / rng.choice([1, 4])) for _ in range(4)] for _ in range(40)]
    shapes += [[(0, 0), (10, 0), (10, 10), (0, 10)], [(3, 3)] * 4, [(0, 5), (9, 5), (4, 5), (2, 5)]]
    df = spark.createDataFrame([(k, *map(float, [v for p in s for v in p])) for k, s in enumerate(shapes)], ["k", *[f"{a}{i}" for i in range(4) for a in "xy"]])
    corners = [(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(4)]
    got = {(r.k, r.y, r.x) for r in pixels.cells(pixels.mask_runs(df, ["k"], corners), ["k"]).collect()}
    grid = spark.range(-61, 62).withColumnRenamed("id", "py").crossJoin(spark.range(-61, 62).withColumnRenamed("id", "px"))
    inside = df.crossJoin(grid).where(G.in_polygon((F.col("px").cast("double"), F.col("py").cast("double")), corners) == 1)
    assert got == {(r.k, r.py, r.px) for r in inside.select("k", "py", "px").collect()}
    assert {r.k: r.cells for r in pixels.area_of(pixels.mask_runs(df, ["k"], corners), ["k"]).collect()}[40] == 100


def test_images_that_are_empty_null_or_ragged(spark):
    none = spark.createDataFrame([], KIND)
    for df in (pixels.edges(none), pixels.regions(none), pixels.box_sums(none, 2), pixels.smooth_regions(none, 2, 0.5, 1)):
        assert df.collect() == []
    odd = spark.createDataFrame([(None, 0, [1, None, 1]), (None, 1, None), (None, 2, [0, 0, 0, 5]), ("e", 0, [])], KIND)
    got = sorted(tuple(r)[:4] for r in pixels.regions(odd, tile=1).collect())
    assert got == [(None, 0, 0, 1), (None, 0, 2, 1), (None, 2, 3, 1)]


def test_lines_are_found_among_noise(spark):
    """Three drawn segments, two of them on one line with a gap, and stray pixels."""
    rng = random.Random(2)
    drawn_ = [((5, 10), (60, 10)), ((80, 10), (110, 10)), ((10, 20), (60, 95))]
    cells = {(round(a[0] + (b[0] - a[0]) * k / 200), round(a[1] + (b[1] - a[1]) * k / 200)) for a, b in drawn_ for k in range(201)} | {(rng.randrange(120), rng.randrange(120)) for _ in range(60)}
    df = spark.createDataFrame([("i", y, x) for x, y in cells], "image string, y long, x long")
    found = voting.segments(df, 28, 20, 6).collect()
    flat = [r for r in found if r.angle == 90]
    assert sorted((r.x1, r.x2) if r.x1 < r.x2 else (r.x2, r.x1) for r in flat if r.offset == 10) == [(5, 60), (80, 110)]
    assert any(abs(math.dist((r.x1, r.y1), (r.x2, r.y2)) - math.dist(*drawn_[2])) < 6 and abs(r.angle - 144) <= 3 for r in found)
    table_ = voting.turns(180)
    counted = {}
    for x, y in cells:
        for a, (c, s) in enumerate(table_):
            counted[a, (x * c + y * s + (1 << 13)) >> 14] = counted.get((a, (x * c + y * s + (1 << 13)) >> 14), 0) + 1
    best = {(r.angle, r.offset): r.votes for r in voting.lines(df, 28).collect()}
    assert best and all(counted[k] == v for k, v in best.items())
    for (a, o), n in counted.items():
        near = [((a + da) % 180, (-1 if not 0 <= a + da < 180 else 1) * (o + db)) for da in (-1, 0, 1) for db in (-1, 0, 1)]
        assert ((a, o) in best) == (n >= 28 and all((counted.get(k, 0), -k[0], -k[1]) <= (n, -a, -o) for k in near))
    assert voting.segments(df.where("false"), 1, 1, 1).collect() == []


def test_votes_are_never_broadcast(spark):
    """Their size is estimated as that of the pixels, so even the least estimate must not send them through the driver."""
    df = spark.range(9).select(F.lit("i").alias("image"), F.floor(F.col("id") / 3).alias("y"), (F.col("id") % 3).alias("x"))
    plan = voting.segments(df, 1, 1, 1)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
