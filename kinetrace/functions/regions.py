"""Rectangular regions as Column expressions: corners, rectification, enclosing rectangles, checks and choice.

A region is four (x, y) points. Functions that return several values return one
struct Column, null where the region is not there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinetrace.functions.geometry import Point, centroid, col, distance, line_crossing, shoelace, sum_of

#: Least and largest share of the image that a box may take, relative error of its aspect, weights of the confidence.
LEAST_AREA, MOST_AREA, ASPECT_ERROR, WEIGHTS = 1 / 6, 0.85, 0.20, (0.35, 0.35, 0.30)
#: Pixels between regions that count as adjacent, cosine of parallel edges, confidence that needs no other method, lines that crowd an image.
GAP, PARALLEL, SURE, MANY_LINES = 100.0, 0.9, 0.7, 50
_TINY = 1e-10


def _struct(x: Column, y: Column) -> Column:
    return F.struct(col(x).cast("double").alias("x"), col(y).cast("double").alias("y"))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def points_of(corners: Column, n: int = 4) -> list[Point]:
    """The points of an array of (x, y) structs."""
    return [(F.get(corners, F.lit(k))["x"], F.get(corners, F.lit(k))["y"]) for k in range(n)]


def array_of(points: Sequence[Point]) -> Column:
    return F.array(*[_struct(x, y) for x, y in points])


def ordered_corners(points: Sequence[Point]) -> Column:
    """Array of top left, top right, bottom right and bottom left: the two highest points, then the two lowest, each by x."""
    rows = F.array(*[F.struct(col(y).cast("double").alias("y"), F.lit(k).alias("k"), col(x).cast("double").alias("x")) for k, (x, y) in enumerate(points)])
    by_y = F.array_sort(rows)
    upper, lower = [F.array_sort(F.transform(F.slice(by_y, k, 2), lambda p: F.struct(p["x"].alias("x"), p["k"].alias("k"), p["y"].alias("y")))) for k in (1, 3)]
    at = lambda a, k: _struct(F.get(a, F.lit(k))["x"], F.get(a, F.lit(k))["y"])
    return F.array(at(upper, 0), at(upper, 1), at(lower, 1), at(lower, 0))


def contains(points: Sequence[Point], p: Point) -> Column:
    """Whether a point lies in the region, whose corners are cut to whole numbers, or on its border."""
    x, y = col(p[0]), col(p[1])
    corners = [(col(a).cast("int"), col(b).cast("int")) for a, b in points]
    crossings, border = [], F.lit(False)
    for (ax, ay), (bx, by) in zip(corners, [*corners[1:], corners[0]], strict=True):
        cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        border = border | ((cross == 0) & x.between(F.least(ax, bx), F.greatest(ax, bx)) & y.between(F.least(ay, by), F.greatest(ay, by)))
        at = F.try_divide((y - ay) * (bx - ax), by - ay) + ax
        crossings.append(F.when(((ay > y) != (by > y)) & (x < at), 1).otherwise(0))
    return border | (sum_of(crossings) % 2 == 1)


def perspective(points: Sequence[Point], width, height) -> Column:
    """Array of the nine numbers, row by row, of the map that takes the ordered corners to a frame of this size; null if there is none.

    The map of the unit square onto the corners in closed form, inverted and scaled.
    """
    sizes = (col(width), col(height), F.lit(1.0))

    def inverted(c: Column) -> Column:
        (x0, y0), (x1, y1), (x2, y2), (x3, y3) = points_of(c)
        dx1, dy1, dx2, dy2 = x1 - x2, y1 - y2, x3 - x2, y3 - y2
        sx, sy = x0 - x1 + x2 - x3, y0 - y1 + y2 - y3
        scale = dx1 * dy2 - dx2 * dy1
        skew = F.struct(F.try_divide(sx * dy2 - dx2 * sy, scale).alias("g"), F.try_divide(dx1 * sy - sx * dy1, scale).alias("k"))

        def cofactors(v: Column) -> Column:
            g, k = v["g"], v["k"]
            a, b, d, e = x1 - x0 + g * x1, x3 - x0 + k * x3, y1 - y0 + g * y1, y3 - y0 + k * y3
            return F.array(e - y0 * k, x0 * k - b, b * y0 - x0 * e, y0 * g - d, a - x0 * g, x0 * d - a * y0, d * k - e * g, b * g - a * k, a * e - b * d)

        return bound(skew, cofactors)

    at = lambda m, n: F.get(m, F.lit(n))
    made = bound(bound(ordered_corners(points), inverted), lambda m: F.array(*[F.try_divide(at(m, n) * sizes[n // 3], at(m, 8)) for n in range(9)]))
    return bound(made, lambda m: F.when(~F.exists(m, lambda v: v.isNull()), m))


def mapped(matrix: Column, p: Point) -> Point:
    """A point under such a map."""
    m = [F.get(matrix, F.lit(k)) for k in range(9)]
    x, y = col(p[0]), col(p[1])
    z = m[6] * x + m[7] * y + m[8]
    return F.try_divide(m[0] * x + m[1] * y + m[2], z), F.try_divide(m[3] * x + m[4] * y + m[5], z)


def enclosing(points: Sequence[Point]) -> Column:
    """The smallest rectangle at any angle around points: area, angle of the longer side in [0, 180), width (the longer), height, center and corners.

    One of its sides lies along two of the points, so the directions of all
    pairs are tried.
    """
    every = array_of(points)
    directions = []
    for a, b in combinations([(col(x).cast("double"), col(y).cast("double")) for x, y in points], 2):
        d = distance(a, b)
        directions.append(F.struct(F.try_divide(b[0] - a[0], d).alias("x"), F.try_divide(b[1] - a[1], d).alias("y")))

    def box(u: Column) -> Column:
        along, across = F.transform(every, lambda p: p["x"] * u["x"] + p["y"] * u["y"]), F.transform(every, lambda p: p["y"] * u["x"] - p["x"] * u["y"])
        return F.struct(u.alias("u"), F.array_min(along).alias("a"), F.array_max(along).alias("b"), F.array_min(across).alias("c"), F.array_max(across).alias("d"))

    def measured(r: Column) -> Column:
        w, h = r["b"] - r["a"], r["d"] - r["c"]
        turn = F.degrees(F.atan2(r["u"]["y"], r["u"]["x"]))
        angle = F.pmod(F.when(w < h, turn + 90).otherwise(turn), F.lit(180.0))
        angle = F.when(F.round(angle, 6) >= 180, 0.0).otherwise(angle)
        rank = F.struct(F.round(w * h, 6).alias("area"), F.round(angle, 6).alias("angle"))  # rounded to tell which rectangle is the least, not in the result
        at = lambda s, t: _struct(s * r["u"]["x"] - t * r["u"]["y"], s * r["u"]["y"] + t * r["u"]["x"])
        center = at((r["a"] + r["b"]) / 2, (r["c"] + r["d"]) / 2)
        corners = F.array(at(r["a"], r["c"]), at(r["b"], r["c"]), at(r["b"], r["d"]), at(r["a"], r["d"]))
        return F.struct(rank.alias("rank"), (w * h).alias("area"), angle.alias("angle"), F.greatest(w, h).alias("width"), F.least(w, h).alias("height"), center.alias("center"), corners.alias("corners"))

    known = F.filter(F.array(*directions), lambda u: u["x"].isNotNull())
    least = F.array_min(F.transform(F.transform(known, box), measured))
    return F.struct(*[least[n].alias(n) for n in ("area", "angle", "width", "height", "center", "corners")])


def aspect_error(width, height, ratio) -> Column:
    """Relative error of a box's aspect against a known ratio or its inverse, the less of both."""
    w, h, r = F.greatest(col(width), col(height)), F.least(col(width), col(height)), col(ratio)
    found = w / (h + _TINY)
    return F.least(F.abs(found - r) / (r + _TINY), F.abs(found - 1 / r) / (1 / r + _TINY))


def checked(corners: Sequence[Point], width, height, ratio=None, least: float = LEAST_AREA, most: float = MOST_AREA, tolerance: float = ASPECT_ERROR) -> Column:
    """Whether four corners, in their order around the box, make a fit box of an image: valid, confidence (0 if not), area_ratio, angle_error and the enclosing box.

    The confidence weighs the area, the aspect (1 without a known ratio) and how
    square the corners are.
    """
    share = shoelace(corners) / (col(width) * col(height))
    turns = []
    for i in range(4):
        p, q, r = corners[i], corners[(i + 1) % 4], corners[(i + 2) % 4]
        ux, uy, vx, vy = p[0] - q[0], p[1] - q[1], r[0] - q[0], r[1] - q[1]
        cosine = (ux * vx + uy * vy) / (F.sqrt(ux * ux + uy * uy) * F.sqrt(vx * vx + vy * vy) + _TINY)
        turns.append(F.abs(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))) - F.pi() / 2))
    error = sum_of(turns) / 4
    area = F.least(F.lit(1.0), (share - least) / (0.5 - least + _TINY))

    def judged(box: Column) -> Column:
        valid, aspect = share.between(least, most), F.lit(1.0)
        if ratio is not None:
            off = aspect_error(box["width"], box["height"], ratio)
            valid, aspect = valid & (off < tolerance), 1 - off
        confidence = WEIGHTS[0] * area + WEIGHTS[1] * aspect + WEIGHTS[2] * F.exp(-2 * error)
        return F.struct(valid.alias("valid"), F.when(valid, F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence))).otherwise(0.0).alias("confidence"), share.alias("area_ratio"), F.degrees(error).alias("angle_error"), box.alias("box"))

    return bound(enclosing(corners), judged)


def box_from_lines(across: Sequence[tuple[Point, Point]], down: Sequence[tuple[Point, Point]], width, height, margin: float = 0.1) -> Column:
    """Ordered corners where two lines across and two lines down meet.

    Null if two of them are parallel, if a corner lies further outside the
    image than ``margin`` of its size, or if a corner lies within the triangle
    of the others.
    """
    made = [line_crossing(*h, *v) for h in across for v in down]
    w, h = col(width), col(height)
    good = F.lit(True)
    for x, y in made:
        good = good & x.isNotNull() & x.between(-margin * w, (1 + margin) * w) & y.between(-margin * h, (1 + margin) * h)
    side = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    for k, p in enumerate(made):
        a, b, c = [q for j, q in enumerate(made) if j != k]
        sides = [side(a, b, p), side(b, c, p), side(c, a, p)]
        good = good & ~((F.least(*sides) >= 0) | (F.greatest(*sides) <= 0))
    return F.when(F.coalesce(good, F.lit(False)), ordered_corners(made))


def adjacent(a: Sequence[Point], b: Sequence[Point], gap: float = GAP) -> Column:
    """``horizontal`` or ``vertical``, after the first pair of nearly parallel edges of two boxes that lie close; empty if there is none."""
    out = F.lit("")
    edges = lambda box: list(zip(box, [*box[1:], box[0]], strict=True))
    for p, q in reversed(edges(a)):
        length = distance(p, q)
        ux, uy = F.try_divide(q[0] - p[0], length), F.try_divide(q[1] - p[1], length)
        for r, s in reversed(edges(b)):
            other = distance(r, s)
            vx, vy = F.try_divide(s[0] - r[0], other), F.try_divide(s[1] - r[1], other)
            mx, my = (r[0] + s[0] - p[0] - q[0]) / 2, (r[1] + s[1] - p[1] - q[1]) / 2
            near = (length >= 1) & (other >= 1) & (F.abs(ux * vx + uy * vy) >= PARALLEL) & (F.sqrt(mx * mx + my * my) < gap) & (F.abs(ux * my - uy * mx) < gap)
            out = F.when(near, F.when(F.abs(ux) > F.abs(uy), "horizontal").otherwise("vertical")).otherwise(out)
    return out


def chosen(lines: Column, edges: Column, space: Column, merged: Column, n_lines, known) -> Column:
    """The best of four detections, structs with ``confidence`` or null.

    That by lines is taken at once if it is sure; that by negative space counts
    only where lines crowd the image, that by merging only with a known aspect
    and while nothing is sure. Of equals the first holds.
    """

    def better(best: Column, other: Column, asked=None) -> Column:
        wins = other.isNotNull() & (best.isNull() | (other["confidence"] > best["confidence"]))
        return F.when(wins if asked is None else wins & asked, other).otherwise(best)

    best = better(better(lines, edges), space, col(n_lines) > MANY_LINES)
    best = better(best, merged, col(known) & (best.isNull() | (best["confidence"] < SURE)))
    return F.when(lines["confidence"] > SURE, lines).otherwise(best)


def metadata(floor: Sequence[Point]) -> Column:
    """Center, mean width and height, and angle of the upper edge of a floor drawn by hand."""
    tl, tr, br, bl = [(col(x), col(y)) for x, y in floor]
    cx, cy = centroid([tl, tr, br, bl])
    return F.struct(
        F.array(cx, cy).alias("center"),
        ((distance(tr, tl) + distance(br, bl)) / 2).alias("width"),
        ((distance(bl, tl) + distance(br, tr)) / 2).alias("height"),
        F.degrees(F.atan2(tr[1] - tl[1], tr[0] - tl[0])).alias("angle"),
        F.lit(1.0).alias("confidence"),
        F.lit("manual_gui_labeling").alias("method"),
    )


def as_record(corners: Sequence[Point], box: Column, confidence: Column, method: Column) -> Column:
    """A region as a JSON text with corners, center, width, height, angle, confidence and method."""
    flat = F.array(*[F.array(col(x).cast("double"), col(y).cast("double")) for x, y in corners])
    return F.to_json(F.struct(flat.alias("corners"), F.array(box["center"]["x"], box["center"]["y"]).alias("center"), box["width"].alias("width"), box["height"].alias("height"), box["angle"].alias("angle"), confidence.alias("confidence"), method.alias("method")))


def from_record(text: Column) -> Column:
    """Such a text as a struct; a missing method is ``unknown``."""
    kind = "struct<corners: array<array<double>>, center: array<double>, width: double, height: double, angle: double, confidence: double, method: string>"
    parsed = F.from_json(text, kind)
    return parsed.withField("method", F.coalesce(parsed["method"], F.lit("unknown")))

