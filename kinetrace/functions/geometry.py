"""Plane geometry as Column expressions; y grows downward, angles are in degrees.

Every function works on Columns or numbers and yields one Column, so a query
stays within generated JVM code. Division by zero yields null, which callers
turn into what they need.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

Point = tuple[Column, Column]
#: A point as the names of its columns (or numbers): expressions of many points are made as one SQL text,
#: since each operation on a Column is a call of its own into the JVM.
Names = tuple[str | float, str | float]


def col(value) -> Column:
    """A name or number as a Column."""
    return value if isinstance(value, Column) else F.col(value) if isinstance(value, str) else F.lit(float(value))


def point(prefix: str) -> Point:
    return F.col(f"{prefix}_x"), F.col(f"{prefix}_y")


def names(prefix: str) -> Names:
    return f"{prefix}_x", f"{prefix}_y"


def _text(value: str | float) -> str:
    return f"`{value}`" if isinstance(value, str) else f"{float(value)!r}D"


def _as_text(*points: Names) -> list[tuple[str, str]] | None:
    """The points' coordinates in SQL; None if one of them is a Column."""
    if any(isinstance(v, Column) for p in points for v in p):
        return None
    return [(_text(x), _text(y)) for x, y in points]


def _distance_text(a: tuple[str, str], b: tuple[str, str]) -> str:
    dx, dy = f"({a[0]} - {b[0]})", f"({a[1]} - {b[1]})"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def sum_of(parts: Sequence[Column]) -> Column:
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def distance(a: Point | Names, b: Point | Names) -> Column:
    if known := _as_text(a, b):
        return F.expr(_distance_text(*known))
    dx, dy = col(a[0]) - col(b[0]), col(a[1]) - col(b[1])
    return F.sqrt(dx * dx + dy * dy)


def squared(a: Point | Names, b: Point | Names) -> Column:
    if known := _as_text(a, b):
        (ax, ay), (bx, by) = known
        return F.expr(f"({ax} - {bx}) * ({ax} - {bx}) + ({ay} - {by}) * ({ay} - {by})")
    dx, dy = col(a[0]) - col(b[0]), col(a[1]) - col(b[1])
    return dx * dx + dy * dy


def frame_cost(a: Sequence[Point | Names], b: Sequence[Point | Names]) -> Column:
    """Sum of the squared distances of points and their counterparts, those missing on either side left out; null without any."""
    costs = [squared(p, q) for p, q in zip(a, b, strict=True)]
    return F.when(F.coalesce(*costs).isNotNull(), sum_of([F.coalesce(c, F.lit(0.0)) for c in costs]))


def angle_at(a: Point, vertex: Point, c: Point) -> Column:
    """Turn from ``a`` to ``c`` about ``vertex``, in [0, 360)."""
    if known := _as_text(a, vertex, c):
        p, v, q = known
        turn = f"degrees(atan2({q[1]} - {v[1]}, {q[0]} - {v[0]}) - atan2({p[1]} - {v[1]}, {p[0]} - {v[0]}))"
        return F.expr(f"if({turn} < 0, {turn} + 360, {turn})")
    turn = F.degrees(F.atan2(col(c[1]) - col(vertex[1]), col(c[0]) - col(vertex[0])) - F.atan2(col(a[1]) - col(vertex[1]), col(a[0]) - col(vertex[0])))
    return F.when(turn < 0, turn + 360).otherwise(turn)


def wrapped(angle: Column) -> Column:
    """An angle of [0, 360) in (-180, 180]."""
    return F.when(angle > 180, angle - 360).otherwise(angle)


def angle_between(p: Point, q: Point, r: Point, s: Point) -> Column:
    """Angle between the vectors p to q and r to s; 0 if one of them has no length."""
    if known := _as_text(p, q, r, s):
        (px, py), (qx, qy), (rx, ry), (sx, sy) = known
        ux, uy, vx, vy = f"({qx} - {px})", f"({qy} - {py})", f"({sx} - {rx})", f"({sy} - {ry})"
        lengths = f"sqrt({ux} * {ux} + {uy} * {uy}) * sqrt({vx} * {vx} + {vy} * {vy})"
        return F.expr(f"coalesce(degrees(acos(greatest(-1D, least(1D, try_divide({ux} * {vx} + {uy} * {vy}, {lengths}))))), 0D)")
    ux, uy, vx, vy = col(q[0]) - col(p[0]), col(q[1]) - col(p[1]), col(s[0]) - col(r[0]), col(s[1]) - col(r[1])
    cosine = F.try_divide(ux * vx + uy * vy, F.sqrt(ux * ux + uy * uy) * F.sqrt(vx * vx + vy * vy))
    return F.coalesce(F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))), F.lit(0.0))


def heading_to(head: Point, nose: Point, target: Point) -> Column:
    """Angle from the direction head to nose to the direction head to target; over 180 it counts from 360 back, negative ones stay."""
    if known := _as_text(head, nose, target):
        (hx, hy), (nx, ny), (tx, ty) = known
        a = f"degrees(atan2({ty} - {hy}, {tx} - {hx}) - atan2({ny} - {hy}, {nx} - {hx}))"
        return F.expr(f"if({a} > 180, 360 - {a}, {a})")
    a = F.degrees(F.atan2(col(target[1]) - col(head[1]), col(target[0]) - col(head[0])) - F.atan2(col(nose[1]) - col(head[1]), col(nose[0]) - col(head[0])))
    return F.when(a > 180, 360 - a).otherwise(a)


def facing(nose: Point, body: Point, target: Point, limit: float = 45.0) -> Column:
    """1 if the direction body to nose points at the target within ``limit`` degrees; 0 otherwise, also where a vector has no length."""
    if known := _as_text(nose, body, target):
        (nx, ny), (bx, by), (tx, ty) = known
        ux, uy, vx, vy = f"({nx} - {bx})", f"({ny} - {by})", f"({tx} - {nx})", f"({ty} - {ny})"
        cosine = f"try_divide({ux} * {vx} + {uy} * {vy}, sqrt({ux} * {ux} + {uy} * {uy}) * sqrt({vx} * {vx} + {vy} * {vy}))"
        return F.expr(f"if({cosine} IS NOT NULL AND degrees(acos(greatest(-1D, least(1D, {cosine})))) <= {float(limit)!r}D, 1, 0)")
    ux, uy, vx, vy = col(nose[0]) - col(body[0]), col(nose[1]) - col(body[1]), col(target[0]) - col(nose[0]), col(target[1]) - col(nose[1])
    cosine = F.try_divide(ux * vx + uy * vy, F.sqrt(ux * ux + uy * uy) * F.sqrt(vx * vx + vy * vy))
    angle = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))))
    return F.when(cosine.isNotNull() & (angle <= limit), 1).otherwise(0)  # bounds pass over a null cosine


def _in_polygon_text(p: tuple[str, str], corners: Sequence[tuple[str, str]]) -> str:
    (x, y), parts = p, []
    for (ax, ay), (bx, by) in zip(corners, [*corners[1:], corners[0]], strict=True):
        meets = f"{y} > least({ay}, {by}) AND {y} <= greatest({ay}, {by}) AND {x} <= greatest({ax}, {bx})"
        parts.append(f"if({meets} AND ({ax} = {bx} OR {x} <= try_divide(({y} - {ay}) * ({bx} - {ax}), {by} - {ay}) + {ax}), 1, 0)")
    return f"(({' + '.join(parts)}) % 2)"


def in_polygon(p: Point, corners: Sequence[Point]) -> Column:
    """1 inside the polygon by ray casting: edges take their upper end, points on a right or upper border count."""
    if known := _as_text(p, *corners):
        return F.expr(_in_polygon_text(known[0], known[1:]))
    x, y = col(p[0]), col(p[1])
    crossings = []
    for (ax, ay), (bx, by) in zip(corners, [*corners[1:], corners[0]], strict=True):
        ax, ay, bx, by = col(ax), col(ay), col(bx), col(by)
        meets = (y > F.least(ay, by)) & (y <= F.greatest(ay, by)) & (x <= F.greatest(ax, bx))
        at = F.try_divide((y - ay) * (bx - ax), by - ay) + ax
        crossings.append(F.when(meets & ((ax == bx) | (x <= at)), 1).otherwise(0))
    return sum_of(crossings) % 2


def in_circle(p: Point, center: Point, radius) -> Column:
    return F.coalesce((distance(p, center) <= col(radius)).cast("int"), F.lit(0))


def _segment_text(p: tuple[str, str], a: tuple[str, str], b: tuple[str, str]) -> str:
    (x, y), (ax, ay), (bx, by) = p, a, b
    dx, dy = f"({bx} - {ax})", f"({by} - {ay})"
    t = f"greatest(0D, least(1D, coalesce(try_divide(({x} - {ax}) * {dx} + ({y} - {ay}) * {dy}, {dx} * {dx} + {dy} * {dy}), 0D)))"
    return _distance_text(p, (f"({ax} + {t} * {dx})", f"({ay} + {t} * {dy})"))


def segment_distance(p: Point, a: Point, b: Point) -> Column:
    """Distance from a point to a segment, which may have no length."""
    x, y, ax, ay, bx, by = (col(v) for v in (*p, *a, *b))
    dx, dy = bx - ax, by - ay
    t = F.coalesce(F.try_divide((x - ax) * dx + (y - ay) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return distance((x, y), (ax + t * dx, ay + t * dy))


def polygon_distance(p: Point, corners: Sequence[Point]) -> Column:
    """0 inside, else the distance to the nearest edge."""
    if known := _as_text(p, *corners):
        q, ring = known[0], known[1:]
        near = ", ".join(_segment_text(q, a, b) for a, b in zip(ring, [*ring[1:], ring[0]], strict=True))
        return F.expr(f"if({_in_polygon_text(q, ring)} = 1, 0D, least({near}))")
    edges = [segment_distance(p, a, b) for a, b in zip(corners, [*corners[1:], corners[0]], strict=True)]
    return F.when(in_polygon(p, corners) == 1, F.lit(0.0)).otherwise(F.least(*edges))


def _turns(points: Sequence[tuple[str, str]]) -> dict[tuple[int, int, int], str]:
    """For each three points in order, on which side of the first two the third lies; the same text wherever it is used, so it is worked out once a row."""
    out = {}
    for i, j, k in combinations(range(len(points)), 3):
        (ax, ay), (bx, by), (cx, cy) = points[i], points[j], points[k]
        out[i, j, k] = f"(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))"
    return out


def _hull_edges(points: Sequence[tuple[str, str]]) -> list[tuple[str, tuple[str, str], tuple[str, str]]]:
    """All pairs of points with the condition that their segment is a whole edge of the convex hull.

    A pair is an edge if all points lie on one side of its line and, where
    others lie on the line itself, if they lie between the two. Of points in one
    place only the first counts.
    """
    turns, out = _turns(points), []
    for i, j in combinations(range(len(points)), 2):
        (ax, ay), (bx, by) = points[i], points[j]
        dx, dy = f"({bx} - {ax})", f"({by} - {ay})"
        length = f"({dx} * {dx} + {dy} * {dy})"
        left, right, within = [], [], []
        for k, (x, y) in enumerate(points):
            if k in (i, j):
                continue
            turn, flipped = turns[tuple(sorted((i, j, k)))], i < k < j
            left.append(f"{turn} {'<=' if flipped else '>='} 0")
            right.append(f"{turn} {'>=' if flipped else '<='} 0")
            within.append(f"({turn} <> 0 OR ({dx} * ({x} - {ax}) + {dy} * ({y} - {ay})) BETWEEN 0 AND {length})")
        fresh = [f"{length} > 0"]
        for k in range(j):
            if k != i:
                x, y = points[k]
                fresh.append(f"NOT ({x} = {bx} AND {y} = {by})")
                if k < i:
                    fresh.append(f"NOT ({x} = {ax} AND {y} = {ay})")
        out.append((f"(({' AND '.join(left)}) OR ({' AND '.join(right)})) AND {' AND '.join([*within, *fresh])}", points[i], points[j]))
    return out


def _required(points: Sequence[Names]) -> list[tuple[str, str]]:
    known = _as_text(*points)
    if known is None:
        raise TypeError("give the points' coordinates as names of columns or numbers")
    return known


def hull_perimeter(points: Sequence[Names]) -> Column:
    """Perimeter of the convex hull of a few points, given by names; points on one line have twice its length, one place has 0."""
    known = _required(points)
    total = " + ".join(f"if({edge}, {_distance_text(a, b)}, 0D)" for edge, a, b in _hull_edges(known))
    # All on one line: one edge, which the perimeter follows there and back.
    flat = " AND ".join(f"{turn} = 0" for (i, _, _), turn in _turns(known).items() if i == 0) or "true"
    return F.expr(f"if({flat}, 2D, 1D) * ({total})")


def hull_area(points: Sequence[Names]) -> Column:
    """Area of the convex hull of points given by names: its edges' triangles with the points' mean."""
    known = _required(points)
    mx, my = (f"(({' + '.join(p[k] for p in known)}) / {len(known)}D)" for k in (0, 1))
    return F.expr(" + ".join(f"if({edge}, abs(({a[0]} - {mx}) * ({b[1]} - {my}) - ({b[0]} - {mx}) * ({a[1]} - {my})) / 2D, 0D)" for edge, a, b in _hull_edges(known)))


def shoelace(corners: Sequence[Point]) -> Column:
    """Area of a simple polygon."""
    parts = [col(a[0]) * col(b[1]) - col(b[0]) * col(a[1]) for a, b in zip(corners, [*corners[1:], corners[0]], strict=True)]
    return F.abs(sum_of(parts)) / 2


def centroid(points: Sequence[Point | Names]) -> Point | Names:
    """Mean of points; numbers where all are."""
    if all(isinstance(v, (int, float)) for p in points for v in p):
        return sum(float(p[0]) for p in points) / len(points), sum(float(p[1]) for p in points) / len(points)
    return sum_of([col(p[0]) for p in points]) / len(points), sum_of([col(p[1]) for p in points]) / len(points)


def pair_distances(points: Sequence[Names]) -> Column:
    """Array of the distances of all pairs of points, given by names, that are not in one place."""
    every = ", ".join(_distance_text(a, b) for a, b in combinations(_required(points), 2))
    return F.expr(f"filter(array({every}), d -> d <> 0)")


def rotation_angle(top_left: Point, bottom_left: Point, least: float = 0.0) -> Column:
    """Angle by which a frame leans, from its left side; 0 below ``least`` in size."""
    a = F.degrees(F.atan2(col(bottom_left[0]) - col(top_left[0]), col(bottom_left[1]) - col(top_left[1])))
    return F.when(F.abs(a) < least, F.lit(0.0)).otherwise(a)


def expanded_canvas(width, height, angle) -> Point:
    """Width and height of the box that holds a rotated frame, rounded up."""
    w, h, a = col(width), col(height), F.radians(col(angle))
    c, s = F.abs(F.cos(a)), F.abs(F.sin(a))
    return F.ceil(w * c + h * s).cast("long"), F.ceil(w * s + h * c).cast("long")


def rotated(p: Point, center: Point, angle) -> Point:
    """A point turned about a center; a positive angle moves what lies below the center to the right."""
    a = F.radians(col(angle))
    dx, dy = col(p[0]) - col(center[0]), col(p[1]) - col(center[1])
    return col(center[0]) + dx * F.cos(a) + dy * F.sin(a), col(center[1]) + dy * F.cos(a) - dx * F.sin(a)


def into_crop(p: Point, frame: Point, angle, pad: Point, offset: Point) -> Point:
    """A point of the raw frame in the rotated, padded and cropped one."""
    x, y = rotated(p, (col(frame[0]) / 2, col(frame[1]) / 2), angle)
    return x + col(pad[0]) - col(offset[0]), y + col(pad[1]) - col(offset[1])


def nest_corners(floor: Sequence[Point], share: float, buffer: float) -> list[Point]:
    """The nest: the lowest ``share`` of the floor, four buffers wider on each side and one buffer lower.

    ``floor``: corners top left, top right, bottom right, bottom left; the
    buffers follow the direction of its lower side.
    """
    tl, tr, br, bl = [(col(x), col(y)) for x, y in floor]
    length = distance(bl, br)
    sx, sy = F.try_divide(br[0] - bl[0], length), F.try_divide(br[1] - bl[1], length)

    def moved(p: Point, wide: float, low: float) -> Point:
        return p[0] + wide * buffer * sx - low * buffer * sy, p[1] + wide * buffer * sy + low * buffer * sx

    def between(high: Point, low: Point) -> Point:
        return share * high[0] + (1 - share) * low[0], share * high[1] + (1 - share) * low[1]

    return [moved(between(tl, bl), -4, 0), moved(between(tr, br), 4, 0), moved(br, 4, 1), moved(bl, -4, 1)]


def loom_center(floor: Sequence[Point], share: float) -> Point:
    """The middle of the floor's upper side, moved down by ``share`` of its left side."""
    tl, tr, _, bl = [(col(x), col(y)) for x, y in floor]
    return (tl[0] + tr[0]) / 2 + (bl[0] - tl[0]) * share, (tl[1] + tr[1]) / 2 + (bl[1] - tl[1]) * share


def pixels_per_cm(floor: Sequence[Point], height_cm) -> Column:
    """Mean length of the floor's left and right side over its height."""
    tl, tr, br, bl = floor
    return (distance(bl, tl) + distance(br, tr)) / 2 / col(height_cm)


def line_crossing(a: Point, b: Point, c: Point, d: Point) -> Point:
    """Where the lines through a, b and c, d meet; null for parallel ones."""
    (ax, ay), (bx, by), (cx, cy), (dx, dy) = [(col(x), col(y)) for x, y in (a, b, c, d)]
    scale = (ax - bx) * (cy - dy) - (ay - by) * (cx - dx)
    first, second = ax * by - ay * bx, cx * dy - cy * dx
    scale = F.when(F.abs(scale) >= 1e-10, scale)
    return F.try_divide(first * (cx - dx) - (ax - bx) * second, scale), F.try_divide(first * (cy - dy) - (ay - by) * second, scale)


def crop_window(corners: Sequence[Point], width, height, buffer: int, step: int = 16) -> tuple[Column, Column, Column, Column]:
    """x, y, width and height of the box around corners, widened by ``buffer`` and kept inside the frame.

    Sizes are whole steps, at least one where the frame allows.
    """
    xs, ys, w, h = [col(p[0]) for p in corners], [col(p[1]) for p in corners], col(width).cast("long"), col(height).cast("long")
    low = lambda v: F.greatest(F.lit(0).cast("long"), F.least(*v).cast("long") - buffer)
    high = lambda v, most: F.least(most, F.greatest(*v).cast("long") + buffer)
    x, y = low(xs), low(ys)

    def size(begin: Column, end: Column, most: Column) -> Column:
        n = F.greatest(F.lit(step).cast("long"), (F.floor((end - begin) / step) * step).cast("long"))
        return F.when(begin + n > most, (F.floor((most - begin) / step) * step).cast("long")).otherwise(n)

    return x, y, size(x, high(xs, w), w), size(y, high(ys, h), h)
