"""Queries of geometry, names and scalar rules, with SQL written apart from them."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from kinetrace.functions import geometry as G
from kinetrace.functions import names
from kinetrace.operators import correct, metrics, stats, trajectory
from kinetrace.operators.reshape import experiment_kind, track_number
from kinetrace.plans.base import POSE, pose, query, r, rounded, sql_angle, sql_between, sql_distance, sql_facing, sql_in_polygon, sql_point, sql_segment, table
from kinetrace.schema import BODY_PARTS
from kinetrace.sources import events as event_sources
from kinetrace.sources import tracking

WITH = f"WITH {POSE}"
#: A nest and a circle in the plane of the vectors.
NEST = ((150.0, 150.0), (260.0, 170.0), (250.0, 260.0), (140.0, 240.0))
LOOM, RADIUS = (210.0, 190.0), 60.0
_POINTS = [sql_point(f"{p}_1") for p in BODY_PARTS]
_NEST = [(repr(x), repr(y)) for x, y in NEST]
_LOOM = (repr(LOOM[0]), repr(LOOM[1]))


def _point(name):
    return G.point(name)


@query(f"{WITH} SELECT session, frame_idx, {r(sql_distance(sql_point('nose_1'), sql_point('nose_2')), 'nose_to_nose')}, {r(sql_distance(sql_point('nose_1'), sql_point('tail_base_1')), 'nose_to_tail')} FROM pose")
def euclidean_distance(spark, sf_dir):
    p = pose(spark, sf_dir)
    return rounded(p.select("session", "frame_idx", G.distance(_point("nose_1"), _point("nose_2")).alias("nose_to_nose"), G.distance(_point("nose_1"), _point("tail_base_1")).alias("nose_to_tail")))


_TURN = sql_angle(sql_point("ear_left_1"), sql_point("nose_1"), sql_point("ear_right_1"))


@query(
    f"{WITH} SELECT session, frame_idx, {r(sql_angle(sql_point('head_1'), sql_point('body_center_1'), sql_point('tail_base_1')), 'body_angle')}, "
    f"{r(f'CASE WHEN {_TURN} > 180 THEN {_TURN} - 360 ELSE {_TURN} END', 'nose_angle')}, {r(sql_between(sql_point('nose_1'), sql_point('tail_base_1'), sql_point('nose_2'), sql_point('tail_base_2')), 'midline')} FROM pose"
)
def angles(spark, sf_dir):
    p = pose(spark, sf_dir)
    body = G.angle_at(_point("head_1"), _point("body_center_1"), _point("tail_base_1"))
    nose = G.wrapped(G.angle_at(_point("ear_left_1"), _point("nose_1"), _point("ear_right_1")))
    return rounded(p.select("session", "frame_idx", body.alias("body_angle"), nose.alias("nose_angle"), G.angle_between(_point("nose_1"), _point("tail_base_1"), _point("nose_2"), _point("tail_base_2")).alias("midline")))


def _hull_sql(points, what: str) -> str:
    """Hull by its supporting lines: a pair is an edge if all others are on one side (general position)."""
    parts = []
    for a, b in combinations(points, 2):
        cross = [f"(({b[0]} - {a[0]}) * ({c[1]} - {a[1]}) - ({b[1]} - {a[1]}) * ({c[0]} - {a[0]}))" for c in points if c not in (a, b)]
        size = sql_distance(a, b) if what == "perimeter" else f"abs(({a[0]} - mx) * ({b[1]} - my) - ({b[0]} - mx) * ({a[1]} - my)) / 2"
        parts.append(f"CASE WHEN least({', '.join(cross)}) >= 0 OR greatest({', '.join(cross)}) <= 0 THEN {size} ELSE 0 END")
    return " + ".join(parts)


_MEAN = f"SELECT *, ({' + '.join(p[0] for p in _POINTS)}) / 6 AS mx, ({' + '.join(p[1] for p in _POINTS)}) / 6 AS my FROM pose"


@query(f"{WITH}, m AS ({_MEAN}) SELECT session, frame_idx, {r(_hull_sql(_POINTS, 'perimeter'), 'perimeter')}, {r(_hull_sql(_POINTS, 'area'), 'area', 2)} FROM m")
def hull(spark, sf_dir):
    points = [G.names(f"{p}_1") for p in BODY_PARTS]
    out = pose(spark, sf_dir).select("session", "frame_idx", G.hull_perimeter(points).alias("perimeter"), F.round(G.hull_area(points), 2).alias("area"))
    return rounded(out)


_COST = " + ".join(f"({p}_1_x - {p}_2_x) * ({p}_1_x - {p}_2_x) + ({p}_1_y - {p}_2_y) * ({p}_1_y - {p}_2_y)" for p in BODY_PARTS)


@query(f"{WITH} SELECT session, frame_idx, {r(_COST, 'cost')} FROM pose")
def frame_cost(spark, sf_dir):
    """How far the two animals' points lie apart, squared and summed."""
    sides = [[G.names(f"{p}_{i}") for p in BODY_PARTS] for i in (1, 2)]
    return rounded(pose(spark, sf_dir).select("session", "frame_idx", G.frame_cost(*sides).alias("cost")))


_SHOE = " + ".join(f"{a[0]} * {b[1]} - {b[0]} * {a[1]}" for a, b in zip(_POINTS[:4], [*_POINTS[1:4], _POINTS[0]], strict=True))


@query(f"{WITH} SELECT session, frame_idx, {r(f'abs({_SHOE}) / 2', 'area', 2)}, {r('(nose_1_x + ear_left_1_x + ear_right_1_x + head_1_x) / 4', 'cx')}, {r('(nose_1_y + ear_left_1_y + ear_right_1_y + head_1_y) / 4', 'cy')} FROM pose")
def polygon_area(spark, sf_dir):
    points = [_point(f"{p}_1") for p in BODY_PARTS[:4]]
    cx, cy = G.centroid(points)
    return rounded(pose(spark, sf_dir).select("session", "frame_idx", F.round(G.shoelace(points), 2).alias("area"), cx.alias("cx"), cy.alias("cy")))


_PAIRS = "[" + ", ".join(sql_distance(a, b) for a, b in combinations(_POINTS, 2)) + "]"


@query(
    f"{WITH}, l AS (SELECT session, frame_idx, list_filter({_PAIRS}, lambda d: d <> 0) AS d FROM pose) SELECT session, frame_idx, {r('list_max(d)', 'large')}, {r('list_min(d)', 'small')}, {r('list_avg(d)', 'mean')}, {r('2 * list_sum(d)', 'total')} FROM l"
)
def pairwise_stats(spark, sf_dir):
    from kinetrace.operators.features import spreads

    p = pose(spark, sf_dir).withColumn("_pairs_1", G.pair_distances([G.names(f"{x}_1") for x in BODY_PARTS]))
    made = spreads(1)
    return rounded(p.select("session", "frame_idx", *[made[f"m1_hull_{k}_euclidean"].alias(n) for k, n in (("large", "large"), ("small", "small"), ("mean", "mean"), ("sum", "total"))]))


@query(
    f"{WITH} SELECT session, frame_idx, {sql_in_polygon(sql_point('nose_1'), _NEST)} AS in_nest, CASE WHEN {sql_distance(sql_point('nose_1'), _LOOM)} <= {RADIUS} THEN 1 ELSE 0 END AS in_loom, "
    f"{sql_facing(sql_point('nose_1'), sql_point('body_center_1'), _LOOM)} AS facing, {r(f'CASE WHEN {sql_in_polygon(sql_point("nose_1"), _NEST)} = 1 THEN 0.0 ELSE least({", ".join(sql_segment(sql_point("nose_1"), a, b) for a, b in zip(_NEST, [*_NEST[1:], _NEST[0]], strict=True))}) END', 'nest_distance')} FROM pose"
)
def zone_tests(spark, sf_dir):
    nose = _point("nose_1")
    return rounded(pose(spark, sf_dir).select("session", "frame_idx", G.in_polygon(nose, NEST).alias("in_nest"), G.in_circle(nose, LOOM, RADIUS).alias("in_loom"), G.facing(nose, _point("body_center_1"), LOOM).alias("facing"), G.polygon_distance(nose, NEST).alias("nest_distance")))


_HEAD = f"degrees(atan2({_LOOM[1]} - head_1_y, {_LOOM[0]} - head_1_x) - atan2(nose_1_y - head_1_y, nose_1_x - head_1_x))"


@query(f"{WITH} SELECT session, frame_idx, {r(f'CASE WHEN {_HEAD} > 180 THEN 360 - {_HEAD} ELSE {_HEAD} END', 'angle')} FROM pose")
def heading_angle(spark, sf_dir):
    return rounded(pose(spark, sf_dir).select("session", "frame_idx", G.heading_to(_point("head_1"), _point("nose_1"), LOOM).alias("angle")))


_FLOOR = [sql_point(f"{p}_1") for p in ("nose", "ear_left", "ear_right", "head")]
_LEAN = f"degrees(atan2({_FLOOR[3][0]} - {_FLOOR[0][0]}, {_FLOOR[3][1]} - {_FLOOR[0][1]}))"
_SIDE = sql_distance(_FLOOR[3], _FLOOR[2])
_SX, _SY = f"(({_FLOOR[2][0]} - {_FLOOR[3][0]}) / nullif({_SIDE}, 0))", f"(({_FLOOR[2][1]} - {_FLOOR[3][1]}) / nullif({_SIDE}, 0))"


@query(
    f"{WITH} SELECT session, frame_idx, {r(f'CASE WHEN abs({_LEAN}) < 5 THEN 0.0 ELSE {_LEAN} END', 'angle')}, "
    f"CAST(ceil(round(640 * abs(cos(radians(30))) + 480 * abs(sin(radians(30))), 6)) AS BIGINT) AS canvas_w, CAST(ceil(round(640 * abs(sin(radians(30))) + 480 * abs(cos(radians(30))), 6)) AS BIGINT) AS canvas_h, "
    f"{r('320 + (nose_1_x - 320) * cos(radians(30)) + (nose_1_y - 240) * sin(radians(30)) + 5 - 11', 'x')}, {r('240 + (nose_1_y - 240) * cos(radians(30)) - (nose_1_x - 320) * sin(radians(30)) + 7 - 13', 'y')} FROM pose"
)
def rotate_transform(spark, sf_dir):
    floor = [_point(f"{p}_1") for p in ("nose", "ear_left", "ear_right", "head")]
    x, y = G.into_crop(_point("nose_1"), (640, 480), 30, (5, 7), (11, 13))
    w, h = G.expanded_canvas(640, 480, 30)
    out = pose(spark, sf_dir).select("session", "frame_idx", G.rotation_angle(floor[0], floor[3], 5.0).alias("angle"), w.alias("canvas_w"), h.alias("canvas_h"), x.alias("x"), y.alias("y"))
    return rounded(out)


@query(
    f"{WITH} SELECT session, frame_idx, {r(f'0.2 * {_FLOOR[0][0]} + 0.8 * {_FLOOR[3][0]} - 4 * 3 * {_SX}', 'nest_x1')}, {r(f'{_FLOOR[2][1]} + 4 * 3 * {_SY} + 3 * {_SX}', 'nest_y3')}, "
    f"{r(f'({_FLOOR[0][0]} + {_FLOOR[1][0]}) / 2 + ({_FLOOR[3][0]} - {_FLOOR[0][0]}) * 0.15', 'loom_x')}, {r(f'({sql_distance(_FLOOR[3], _FLOOR[0])} + {sql_distance(_FLOOR[2], _FLOOR[1])}) / 2 / 30', 'px_per_cm')} FROM pose"
)
def calibration(spark, sf_dir):
    floor = [_point(f"{p}_1") for p in ("nose", "ear_left", "ear_right", "head")]
    nest, loom = G.nest_corners(floor, 0.2, 3), G.loom_center(floor, 0.15)
    return rounded(pose(spark, sf_dir).select("session", "frame_idx", nest[0][0].alias("nest_x1"), nest[2][1].alias("nest_y3"), loom[0].alias("loom_x"), G.pixels_per_cm(floor, 30).alias("px_per_cm")))


def _low(k):
    return f"greatest(0, CAST(trunc(least({', '.join(p[k] for p in _FLOOR)})) AS BIGINT) - 20)"


def _high(k, most):
    return f"least({most}, CAST(trunc(greatest({', '.join(p[k] for p in _FLOOR)})) AS BIGINT) + 20)"


@query(
    f"""{WITH}, b AS (SELECT session, frame_idx, {_low(0)} AS x, {_low(1)} AS y, {_high(0, 640)} AS x1, {_high(1, 480)} AS y1 FROM pose),
s AS (SELECT *, greatest(16, ((x1 - x) // 16) * 16) AS w, greatest(16, ((y1 - y) // 16) * 16) AS h FROM b)
SELECT session, frame_idx, x, y, CAST(CASE WHEN x + w > 640 THEN ((640 - x) // 16) * 16 ELSE w END AS BIGINT) AS w, CAST(CASE WHEN y + h > 480 THEN ((480 - y) // 16) * 16 ELSE h END AS BIGINT) AS h FROM s"""
)
def crop_window(spark, sf_dir):
    floor = [_point(f"{p}_1") for p in ("nose", "ear_left", "ear_right", "head")]
    return pose(spark, sf_dir).select("session", "frame_idx", *[c.alias(n) for c, n in zip(G.crop_window(floor, 640, 480, 20), "xywh", strict=True)])


_D = f"(({_FLOOR[0][0]} - {_FLOOR[1][0]}) * ({_FLOOR[2][1]} - {_FLOOR[3][1]}) - ({_FLOOR[0][1]} - {_FLOOR[1][1]}) * ({_FLOOR[2][0]} - {_FLOOR[3][0]}))"
_C1, _C2 = f"({_FLOOR[0][0]} * {_FLOOR[1][1]} - {_FLOOR[0][1]} * {_FLOOR[1][0]})", f"({_FLOOR[2][0]} * {_FLOOR[3][1]} - {_FLOOR[2][1]} * {_FLOOR[3][0]})"


_SCALE = f"CASE WHEN abs({_D}) >= 1e-10 THEN {_D} END"


@query(
    f"{WITH} SELECT session, frame_idx, ({_C1} * ({_FLOOR[2][0]} - {_FLOOR[3][0]}) - ({_FLOOR[0][0]} - {_FLOOR[1][0]}) * {_C2}) / ({_SCALE}) AS x, "
    f"({_C1} * ({_FLOOR[2][1]} - {_FLOOR[3][1]}) - ({_FLOOR[0][1]} - {_FLOOR[1][1]}) * {_C2}) / ({_SCALE}) AS y FROM pose"
)
def line_crossing(spark, sf_dir):
    """Not rounded: lines that are nearly parallel meet far away, and the same operations give the same bits."""
    a, b, c, d = [_point(f"{p}_1") for p in ("nose", "ear_left", "ear_right", "head")]
    x, y = G.line_crossing(a, b, c, d)
    return pose(spark, sf_dir).select("session", "frame_idx", x.alias("x"), y.alias("y"))


_PS = [f"{p}_{i}_p" for i in (2, 1) for p in BODY_PARTS]


@query(f"{WITH} SELECT session, frame_idx, " + ", ".join(f"CAST({' + '.join(f'CASE WHEN {p} BETWEEN 0 AND {b} THEN 1 ELSE 0 END' for p in _PS)} AS INT) AS low_{n}" for n, b in (("10", 0.1), ("50", 0.5), ("75", 0.75))) + " FROM pose")
def low_probability(spark, sf_dir):
    return pose(spark, sf_dir).select("session", "frame_idx", *[stats.in_range([F.col(p) for p in _PS], 0.0, b).alias(f"low_{n}") for n, b in (("10", 0.1), ("50", 0.5), ("75", 0.75))])


def _frechet_sql(n: int, m: int) -> tuple[str, str, str]:
    """The table of coupled distances, an antidiagonal a step."""
    d = lambda i, j: f"sqrt((p[{i + 1}].x - q[{j + 1}].x) * (p[{i + 1}].x - q[{j + 1}].x) + (p[{i + 1}].y - q[{j + 1}].y) * (p[{i + 1}].y - q[{j + 1}].y))"
    steps = []
    for s in range(n + m - 1):
        cells = []
        for i in range(max(0, s - m + 1), min(n, s + 1)):
            j = s - i
            past = [f"c_{a}_{b}" for a, b in ((i - 1, j), (i, j - 1), (i - 1, j - 1)) if a >= 0 and b >= 0]
            cells.append(f"greatest({d(i, j)}, least({', '.join(past)})) AS c_{i}_{j}" if past else f"{d(i, j)} AS c_{i}_{j}")
        steps.append(f"s{s} AS (SELECT *, {', '.join(cells)} FROM {f's{s - 1}' if s else 'paths'})")
    return ", ".join(steps), f"s{n + m - 2}", f"c_{n - 1}_{m - 1}"


_STEPS, _LAST, _CELL = _frechet_sql(6, 6)
_PATHS = f"""{WITH}, paths AS (SELECT session, frame_idx // 6 AS part, list({{'x': nose_1_x, 'y': nose_1_y}} ORDER BY frame_idx) AS p, list({{'x': nose_2_x, 'y': nose_2_y}} ORDER BY frame_idx) AS q
FROM pose GROUP BY session, part HAVING count(*) = 6), {_STEPS} SELECT session, part, round({_CELL}, 4) AS distance FROM {_LAST}"""


def _paths(spark, sf_dir):
    p = pose(spark, sf_dir).groupBy("session", F.floor(F.col("frame_idx") / 6).alias("part")).agg(F.count(F.lit(1)).alias("n"), *[trajectory.path("frame_idx", F.col(f"nose_{i}_x"), F.col(f"nose_{i}_y")).alias(n) for i, n in ((1, "p"), (2, "q"))])
    return p.where("n = 6")


@query(_PATHS)
def frechet_distance(spark, sf_dir):
    return rounded(_paths(spark, sf_dir).select("session", "part", trajectory.frechet(F.col("p"), F.col("q")).alias("distance")))


@query(_PATHS)
def frechet_distance_arrow(spark, sf_dir):
    return rounded(trajectory.frechet_groups(_paths(spark, sf_dir), "p", "q", "distance").select("session", "part", "distance"))


# Names and scalar rules

_SAMPLE = "CASE page_id % 4 WHEN 0 THEN 'TRAP2-' || (100 + page_id % 800) || '+' || (100 + page_id % 700) || '_D' || (page_id % 9) WHEN 1 THEN 'TRAP2-' || (100 + page_id % 800) || '_D' || (page_id % 9) WHEN 2 THEN 'TRAP' || (100 + page_id % 800) || 'videoL' || (page_id % 7) ELSE 'x' || page_id END"


@query(
    f"""WITH s AS (SELECT page_id, {_SAMPLE} AS sample FROM pages), e AS (SELECT *, regexp_extract(sample, '(\\d{{3}})\\+(\\d{{3}})', 1) AS a, regexp_extract(sample, '(\\d{{3}})\\+(\\d{{3}})', 2) AS b,
regexp_extract(sample, 'TRAP2?[-_\\s]?(\\d{{3}})', 1) AS c, regexp_extract(sample, 'TRAP2?(\\d+)', 1) AS d, regexp_extract(sample, '(?i)[_]?[LD](\\d+)', 1) AS l FROM s)
SELECT page_id, sample, CASE WHEN a <> '' THEN a || ',' || b WHEN c <> '' THEN c ELSE '1' END AS ids, CASE WHEN a <> '' THEN a || ',' || b WHEN d <> '' THEN d ELSE '1' END AS analysis_ids,
CASE WHEN l <> '' THEN 'L' || l ELSE 'L1' END AS loom_session, CASE WHEN sample LIKE '%+%' THEN 'paired' ELSE 'single' END AS kind FROM e"""
)
def sample_names(spark, sf_dir):
    s = table(spark, sf_dir, "pages").select("page_id", F.expr(_SAMPLE).alias("sample"))
    c = F.col("sample")
    return s.select("page_id", "sample", F.array_join(names.animal_ids(c), ",").alias("ids"), F.array_join(names.animal_ids(c, True), ",").alias("analysis_ids"), names.loom_session(c).alias("loom_session"), experiment_kind(c).alias("kind"))


_RAW = "CASE event_id % 5 WHEN 0 THEN 'track_' || user_id WHEN 1 THEN CAST(user_id AS VARCHAR) WHEN 2 THEN user_id || '.0' WHEN 3 THEN 'none' ELSE NULL END"
_RATE = "CASE event_id % 4 WHEN 0 THEN '30000/1001' WHEN 1 THEN event_id || '/0' WHEN 2 THEN '25' ELSE 'abc' END"


@query(
    f"""WITH s AS (SELECT event_id, {_RAW} AS raw, {_RATE} AS rate FROM events) SELECT event_id, CAST(TRY_CAST(regexp_replace(raw, '^track_', '') AS DOUBLE) AS INT) AS track,
round(CASE WHEN rate LIKE '%/%' THEN TRY_CAST(split_part(rate, '/', 1) AS DOUBLE) / nullif(TRY_CAST(split_part(rate, '/', 2) AS DOUBLE), 0) ELSE TRY_CAST(rate AS DOUBLE) END, 6) AS fps FROM s"""
)
def parsed_values(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.expr(_RAW.replace("VARCHAR", "STRING")).alias("raw"), F.expr(_RATE).alias("rate"))
    return rounded(e.select("event_id", track_number(F.col("raw")).alias("track"), names.fraction(F.col("rate")).alias("fps")), 6)


@query(
    """SELECT event_id, round(CASE WHEN v >= 0 THEN v / 29.595 ELSE v END, 6) AS seconds, round(CASE WHEN v >= 0 THEN v * 29.595 / 8 ELSE v END, 6) AS cm_per_second, round(CASE WHEN v >= 0 THEN v / 8 ELSE v END, 6) AS cm
FROM (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN -29.595 ELSE CAST(event_id % 1000 AS DOUBLE) END AS v FROM events)"""
)
def unit_conversion(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 9 == 0, F.lit(-29.595)).otherwise((F.col("event_id") % 1000).cast("double")).alias("v"))
    v = F.col("v")
    return rounded(e.select("event_id", metrics.to_seconds(29.595)(v).alias("seconds"), metrics.to_cm_per_second(29.595, 8.0)(v).alias("cm_per_second"), metrics.to_cm(8.0)(v).alias("cm")), 6)


#: Scores made of the event's number: manual (m) and found (p) latency (l) and time (t) of two animals.
_SCORES = {
    "ml_a": "CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 7 = 0 THEN -1 ELSE CAST(event_id % 13 AS DOUBLE) END",
    "mt_a": "CASE WHEN event_id % 4 = 0 THEN 0 WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 11 AS DOUBLE) END",
    "ml_b": "CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(event_id % 17 AS DOUBLE) END",
    "mt_b": "CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(event_id % 3 AS DOUBLE) END",
    "pl_a": "CASE WHEN event_id % 8 = 0 THEN -1 ELSE CAST(event_id % 19 AS DOUBLE) END",
    "pt_a": "CASE WHEN event_id % 8 = 0 THEN -1 ELSE CAST(event_id % 5 AS DOUBLE) END",
    "pl_b": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(event_id % 7 AS DOUBLE) END",
    "pt_b": "CASE WHEN event_id % 9 = 0 THEN -1 ELSE CAST(event_id % 23 AS DOUBLE) END",
}
_SCORED = f"WITH s AS (SELECT event_id, {', '.join(f'{v} AS {k}' for k, v in _SCORES.items())} FROM events)"


def _gap(m: str, p: str) -> str:
    return f"CASE WHEN {m} IS NULL OR {m} = -1 OR {p} IS NULL OR {p} = -1 THEN 0 ELSE abs({m} - {p}) END"


def _known(*c: str) -> str:
    return "(" + " OR ".join(f"coalesce({x} <> -1, false)" for x in c) + ")"


_SWAP = f"""{_SCORED}, h AS (SELECT *, {_known('ml_a')} OR ({_known('mt_a')} AND NOT (NOT {_known('ml_a')} AND mt_a = 0)) AS ha, {_known('ml_b')} OR ({_known('mt_b')} AND NOT (NOT {_known('ml_b')} AND mt_b = 0)) AS hb,
{_known('pl_a', 'pt_a')} AS ga, {_known('pl_b', 'pt_b')} AS gb FROM s)
SELECT event_id, CASE WHEN ha AND NOT hb AND NOT ga AND gb THEN true WHEN NOT ha AND hb AND ga AND NOT gb THEN true WHEN ha AND NOT hb AND ga AND NOT gb THEN false WHEN NOT ha AND hb AND NOT ga AND gb THEN false
ELSE {_gap('ml_a', 'pl_b')} + {_gap('mt_a', 'pt_b')} + {_gap('ml_b', 'pl_a')} + {_gap('mt_b', 'pt_a')} < {_gap('ml_a', 'pl_a')} + {_gap('mt_a', 'pt_a')} + {_gap('ml_b', 'pl_b')} + {_gap('mt_b', 'pt_b')} END AS swap FROM h"""


@query(_SWAP)
def swap_decision(spark, sf_dir):
    s = table(spark, sf_dir, "events").select("event_id", *[F.expr(v).alias(k) for k, v in _SCORES.items()])
    c = F.col
    return s.select("event_id", correct.should_swap([(c("ml_a"), c("mt_a")), (c("ml_b"), c("mt_b"))], [(c("pl_a"), c("pt_a")), (c("pl_b"), c("pt_b"))]).alias("swap"))


_ZONE = """'{"regions":[{"floor":[[' || n_nationkey || ',0],[10,0],[10,20],[0,20]]},{"nest":[[-4,16],[14,16],[14,21],[-4,' || (n_nationkey + 0.5) || ']]},{"loom":[[5,3.25],' || (n_nationkey + 30) || ']}]}'"""


@query("SELECT n_nationkey, CAST(n_nationkey AS DOUBLE) AS floor_x1, CAST(n_nationkey + 0.5 AS DOUBLE) AS nest_y4, 5e0 AS loom_x, 3.25e0 AS loom_y, CAST(n_nationkey + 30 AS DOUBLE) AS loom_radius FROM nation")
def zone_files(spark, sf_dir):
    t = table(spark, sf_dir, "nation").select("n_nationkey", F.expr(_ZONE).alias("text"))
    made = tracking.zone_columns(F.col("text"))
    return t.select("n_nationkey", *[made[n].alias(n) for n in ("floor_x1", "nest_y4", "loom_x", "loom_y", "loom_radius")])


@query("SELECT user_id, 'bonsai_' || row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS event_id, event_type, CAST(value AS DOUBLE) AS time_start, CASE WHEN event_type = 'view' THEN NULL ELSE value + 1 END AS time_end FROM events")
def event_log(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("what"), F.col("value").cast("string").alias("timestamp"), F.when(F.col("event_type") != "view", F.col("value") + 1).cast("string").alias("until"))
    return event_sources.log_events(e, "what", "timestamp", "until", "event_id", ["user_id"])
