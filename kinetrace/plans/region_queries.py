"""Queries of rectangular regions and of points where 0 means missing, with SQL written apart from them.

Four points of an animal are the corners of a region, and six points of two
animals the ends of lines.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from kinetrace.functions import geometry as G
from kinetrace.functions import regions as R
from kinetrace.plans.base import FRAMES, POSE, TRACK, frames, pose, query, r, rounded, sql_distance, sql_point

WITH = f"WITH {POSE}"
_PARTS = ("nose", "ear_left", "ear_right", "head")
#: Size of the image that regions are checked in.
WIDTH, HEIGHT = 320, 240


def _floor(i: int = 1):
    return [G.point(f"{p}_{i}") for p in _PARTS]


_FLOOR = [sql_point(f"{p}_1") for p in _PARTS]
_SQL_AT = {"tl": "u[1]", "tr": "u[2]", "br": "d[2]", "bl": "d[1]"}


def _ordered_sql(points) -> tuple[str, str]:
    """Two steps of SQL: the corners by height, then the upper (u) and the lower (d) ones by x."""
    first = "list_sort([" + ", ".join(f"{{'y': {y}, 'k': {k}, 'x': {x}}}" for k, (x, y) in enumerate(points)) + "]) AS o"
    two = lambda a, b: f"list_sort([{{'x': o[{a}].x, 'k': o[{a}].k, 'y': o[{a}].y}}, {{'x': o[{b}].x, 'k': o[{b}].k, 'y': o[{b}].y}}])"
    return first, f"{two(1, 2)} AS u, {two(3, 4)} AS d"


def _corner_columns(corners):
    return [F.get(corners, F.lit(k))[a].alias(f"{n}_{a}") for k, n in enumerate(_SQL_AT) for a in "xy"]


_ONE, _TWO = _ordered_sql(_FLOOR)


@query(f"{WITH}, a AS (SELECT session, frame_idx, {_ONE} FROM pose), b AS (SELECT *, {_TWO} FROM a) SELECT session, frame_idx, {', '.join(r(f'{at}.{a}', f'{n}_{a}') for n, at in _SQL_AT.items() for a in 'xy')} FROM b")
def region_corners(spark, sf_dir):
    df = pose(spark, sf_dir).select("session", "frame_idx", R.ordered_corners(_floor()).alias("c"))
    return rounded(df.select("session", "frame_idx", *_corner_columns(F.col("c"))))


def _contains_sql(p) -> str:
    corners = [(f"CAST(trunc({x}) AS INT)", f"CAST(trunc({y}) AS INT)") for x, y in _FLOOR]
    on, over = [], []
    for (ax, ay), (bx, by) in zip(corners, [*corners[1:], corners[0]], strict=True):
        on.append(f"(({bx} - {ax}) * ({p[1]} - {ay}) = ({by} - {ay}) * ({p[0]} - {ax}) AND {p[0]} BETWEEN least({ax}, {bx}) AND greatest({ax}, {bx}) AND {p[1]} BETWEEN least({ay}, {by}) AND greatest({ay}, {by}))")
        over.append(f"(CASE WHEN ({ay} > {p[1]}) <> ({by} > {p[1]}) AND {p[0]} < ({p[1]} - {ay}) * ({bx} - {ax}) / nullif({by} - {ay}, 0) + {ax} THEN 1 ELSE 0 END)")
    return f"({' OR '.join(on)} OR ({' + '.join(over)}) % 2 = 1)"


_INSIDE = ("body_center_1", "nose_2", "nose_1")


@query(f"{WITH} SELECT session, frame_idx, {', '.join(f'{_contains_sql(sql_point(p))} AS {p}' for p in _INSIDE)} FROM pose")
def region_contains(spark, sf_dir):
    return pose(spark, sf_dir).select("session", "frame_idx", *[R.contains(_floor(), G.point(p)).alias(p) for p in _INSIDE])


_MEAN = {a: "(" + " + ".join(p[k] for p in _FLOOR) + ") / 4" for k, a in enumerate("xy")}


@query(
    f"{WITH} SELECT session, frame_idx, {r(_MEAN['x'], 'cx')}, {r(_MEAN['y'], 'cy')}, {r(f'({sql_distance(_FLOOR[0], _FLOOR[1])} + {sql_distance(_FLOOR[2], _FLOOR[3])}) / 2', 'width')}, "
    f"{r(f'({sql_distance(_FLOOR[0], _FLOOR[3])} + {sql_distance(_FLOOR[1], _FLOOR[2])}) / 2', 'height')}, {r(f'degrees(atan2({_FLOOR[1][1]} - {_FLOOR[0][1]}, {_FLOOR[1][0]} - {_FLOOR[0][0]}))', 'angle')}, "
    "CAST(1 AS DOUBLE) AS confidence, 'manual_gui_labeling' AS method FROM pose"
)
def floor_metadata(spark, sf_dir):
    df = pose(spark, sf_dir).select("session", "frame_idx", R.metadata(_floor()).alias("m"))
    return rounded(df.select("session", "frame_idx", F.get("m.center", F.lit(0)).alias("cx"), F.get("m.center", F.lit(1)).alias("cy"), "m.width", "m.height", "m.angle", "m.confidence", "m.method"))


def _enclosing_sql() -> str:
    """CTE e: for each frame the least box over the directions of all pairs of corners."""
    units = ", ".join(f"{{'x': ({b[0]} - {a[0]}) / nullif({sql_distance(a, b)}, 0), 'y': ({b[1]} - {a[1]}) / nullif({sql_distance(a, b)}, 0)}}" for a, b in combinations(_FLOOR, 2))
    along = ", ".join(f"{x} * v.x + {y} * v.y" for x, y in _FLOOR)
    across = ", ".join(f"{y} * v.x - {x} * v.y" for x, y in _FLOOR)
    return f"""t AS (SELECT *, unnest([{units}]) AS v FROM pose),
s AS (SELECT *, least({along}) AS a0, greatest({along}) AS a1, least({across}) AS c0, greatest({across}) AS c1 FROM t WHERE v.x IS NOT NULL),
m AS (SELECT *, (a1 - a0) * (c1 - c0) AS area, degrees(atan2(v.y, v.x)) + CASE WHEN a1 - a0 < c1 - c0 THEN 90 ELSE 0 END AS turn FROM s),
n AS (SELECT *, CASE WHEN turn < 0 THEN turn + 180 WHEN turn >= 180 THEN turn - 180 ELSE turn END AS raw FROM m),
e AS (SELECT * EXCLUDE (raw), CASE WHEN round(raw, 6) >= 180 THEN 0.0 ELSE raw END AS angle, greatest(a1 - a0, c1 - c0) AS width, least(a1 - a0, c1 - c0) AS height FROM n
QUALIFY row_number() OVER (PARTITION BY session, frame_idx ORDER BY round(area, 6), round(CASE WHEN round(raw, 6) >= 180 THEN 0.0 ELSE raw END, 6)) = 1)"""


@query(
    f"{WITH}, {_enclosing_sql()} SELECT session, frame_idx, {r('area', 'area')}, {r('angle', 'angle')}, {r('width', 'width')}, {r('height', 'height')}, "
    f"{r('(a0 + a1) / 2 * v.x - (c0 + c1) / 2 * v.y', 'cx')}, {r('(a0 + a1) / 2 * v.y + (c0 + c1) / 2 * v.x', 'cy')} FROM e"
)
def enclosing_box(spark, sf_dir):
    df = pose(spark, sf_dir).select("session", "frame_idx", R.enclosing(_floor()).alias("b"))
    return rounded(df.select("session", "frame_idx", "b.area", "b.angle", "b.width", "b.height", F.col("b.center.x").alias("cx"), F.col("b.center.y").alias("cy")))


def _checked_sql(ratio: float) -> str:
    """Shares, weights and limits are the library's fixed values."""
    shoe = " + ".join(f"({a[0]} * {b[1]} - {b[0]} * {a[1]})" for a, b in zip(_FLOOR, [*_FLOOR[1:], _FLOOR[0]], strict=True))
    turns = []
    for i in range(4):
        p, q, s = _FLOOR[i], _FLOOR[(i + 1) % 4], _FLOOR[(i + 2) % 4]
        dot = f"(({p[0]} - {q[0]}) * ({s[0]} - {q[0]}) + ({p[1]} - {q[1]}) * ({s[1]} - {q[1]}))"
        turns.append(f"abs(acos(greatest(-1.0, least(1.0, {dot} / ({sql_distance(p, q)} * {sql_distance(s, q)} + 1e-10)))) - pi() / 2)")
    off = f"least(abs(width / (height + 1e-10) - {ratio}) / ({ratio} + 1e-10), abs(width / (height + 1e-10) - 1 / {ratio}) / (1 / {ratio} + 1e-10))"
    return f"""{WITH}, {_enclosing_sql()},
f AS (SELECT *, abs({shoe}) / 2 / ({WIDTH} * {HEIGHT}) AS share, ({' + '.join(turns)}) / 4 AS err, {off} AS off FROM e),
g AS (SELECT *, share BETWEEN CAST(1 AS DOUBLE) / 6 AND 0.85 AND off < 0.2 AS valid FROM f)
SELECT session, frame_idx, valid, round(CASE WHEN valid THEN greatest(0.0, least(1.0, 0.35 * least(1.0, (share - CAST(1 AS DOUBLE) / 6) / (0.5 - CAST(1 AS DOUBLE) / 6 + 1e-10)) + 0.35 * (1 - off) + 0.30 * exp(-2 * err))) ELSE 0.0 END, 4) AS confidence,
{r('share', 'area_ratio')}, {r('degrees(err)', 'angle_error')} FROM g"""


@query(_checked_sql(1.5))
def checked_boxes(spark, sf_dir):
    df = pose(spark, sf_dir).select("session", "frame_idx", R.checked(_floor(), F.lit(WIDTH), F.lit(HEIGHT), 1.5).alias("b"))
    return rounded(df.select("session", "frame_idx", "b.valid", "b.confidence", "b.area_ratio", "b.angle_error"))


def _box_sql() -> str:
    lines = {i: [(sql_point(f"nose_{i}"), sql_point(f"ear_left_{i}")), (sql_point(f"ear_right_{i}"), sql_point(f"head_{i}"))] for i in (1, 2)}
    met = []
    for k, ((a, b), (c, d)) in enumerate([(h, v) for h in lines[1] for v in lines[2]]):
        scale = f"(({a[0]} - {b[0]}) * ({c[1]} - {d[1]}) - ({a[1]} - {b[1]}) * ({c[0]} - {d[0]}))"
        scale = f"(CASE WHEN abs({scale}) >= 1e-10 THEN {scale} END)"
        one, two = f"({a[0]} * {b[1]} - {a[1]} * {b[0]})", f"({c[0]} * {d[1]} - {c[1]} * {d[0]})"
        met += [f"({one} * ({c[j]} - {d[j]}) - ({a[j]} - {b[j]}) * {two}) / {scale} AS {n}{k}" for j, n in enumerate("xy")]
    points = [(f"x{k}", f"y{k}") for k in range(4)]
    good = [f"{x} BETWEEN -0.1 * {WIDTH} AND 1.1 * {WIDTH} AND {y} BETWEEN -0.1 * {HEIGHT} AND 1.1 * {HEIGHT}" for x, y in points]
    side = lambda a, b, p: f"(({b[0]} - {a[0]}) * ({p[1]} - {a[1]}) - ({b[1]} - {a[1]}) * ({p[0]} - {a[0]}))"
    for k, p in enumerate(points):
        a, b, c = [q for j, q in enumerate(points) if j != k]
        sides = f"{side(a, b, p)}, {side(b, c, p)}, {side(c, a, p)}"
        good.append(f"NOT (least({sides}) >= 0 OR greatest({sides}) <= 0)")
    one, two = _ordered_sql(points)
    shown = ", ".join(f'round(CASE WHEN good THEN {at}.{a} END, 4) AS {n}_{a}' for n, at in _SQL_AT.items() for a in "xy")
    return f"""{WITH}, c AS (SELECT session, frame_idx, {', '.join(met)} FROM pose), g AS (SELECT *, coalesce({' AND '.join(good)}, false) AS good, {one} FROM c),
h AS (SELECT *, {two} FROM g) SELECT session, frame_idx, {shown} FROM h"""


@query(_box_sql())
def box_from_lines(spark, sf_dir):
    """A row for each frame; null corners where its lines make no box inside the image."""
    lines = [[(G.point(f"nose_{i}"), G.point(f"ear_left_{i}")), (G.point(f"ear_right_{i}"), G.point(f"head_{i}"))] for i in (1, 2)]
    df = pose(spark, sf_dir).select("session", "frame_idx", R.box_from_lines(*lines, F.lit(WIDTH), F.lit(HEIGHT)).alias("c"))
    return rounded(df.select("session", "frame_idx", *_corner_columns(F.col("c"))))


def _bridged_sql() -> str:
    known = "x <> 0 AND y <> 0"
    ends = {"l": ("last_value", "UNBOUNDED PRECEDING AND CURRENT ROW"), "r": ("first_value", "CURRENT ROW AND UNBOUNDED FOLLOWING")}
    sides = ", ".join(f"{f}(CASE WHEN {known} THEN {c} END IGNORE NULLS) OVER (PARTITION BY track ORDER BY frame_idx ROWS BETWEEN {rows}) AS {n}{c[0]}" for n, (f, rows) in ends.items() for c in ("frame_idx", "x"))
    return f"""WITH {FRAMES}, z AS (SELECT track, frame_idx, coalesce(gappy, 0) AS x, CASE WHEN event_id % 5 = 0 THEN 0 ELSE value END AS y FROM fr), n AS (SELECT *, {sides} FROM z)
SELECT track, frame_idx, round(CASE WHEN {known} THEN x WHEN lx IS NULL THEN rx WHEN rx IS NULL THEN lx ELSE lx + (rx - lx) * (frame_idx - lf) / (rf - lf) END, 4) AS x FROM n"""


@query(_bridged_sql())
def bridged_points(spark, sf_dir):
    """Points whose x or y is 0 were not seen."""
    f = frames(spark, sf_dir).withColumns({"x": F.coalesce("gappy", F.lit(0.0)), "y": F.when(F.col("event_id") % 5 == 0, 0.0).otherwise(F.col("value"))})
    return rounded(f.select("track", "frame_idx", TRACK.bridged("x", "x", "y").alias("x")))
