"""Queries of whole stages: cleaning, features, zones, event metrics, correction."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kinetrace.functions import geometry as G
from kinetrace.operators import clean, correct, features, metrics, zones
from kinetrace.operators.track import Track
from kinetrace.plans.base import FRAMES, POSE, SESSION, frames, pose, query, r, rounded, sql_angle, sql_between, sql_distance, sql_facing, sql_in_polygon, sql_point, sql_segment
from kinetrace.plans.geometry_queries import LOOM, NEST, RADIUS, _frechet_sql, _hull_sql
from kinetrace.schema import BODY_PARTS, FILL_LIMIT, ROLLING, wide_columns

_W = "PARTITION BY session ORDER BY frame_idx"
_VALUES = [f"{p}_{a}" for p in BODY_PARTS for a in ("x", "y", "score")]

# Cleaning: animal 1 misses every fifth frame, animal 2 others, and both miss frames 3 and 4 of each ten.

_KEEP = {1: "frame_idx % 5 <> 0 AND frame_idx % 10 NOT IN (3, 4)", 2: "frame_idx % 7 <> 1 AND frame_idx % 10 NOT IN (3, 4)"}
_APART, _JUMP, _LIMIT = 90.0, 700.0, 1


def _raw(spark, sf_dir):
    p = pose(spark, sf_dir)
    rows = [p.where(_KEEP[i]).select("session", "frame_idx", F.lit(i - 1).alias("track"), *[F.col(f"{q}_{i}_{'p' if a == 'score' else a}").alias(f"{q}_{a}") for q in BODY_PARTS for a in ("x", "y", "score")]) for i in (1, 2)]
    return rows[0].unionByName(rows[1])


def _clean_sql() -> str:
    raw = ", ".join(f"CASE WHEN {_KEEP[i]} THEN {q}_{i}_{'p' if a == 'score' else a} END AS {q}_{a}_{i}" for i in (1, 2) for q in BODY_PARTS for a in ("x", "y", "score"))
    apart = " + ".join(f"CASE WHEN {sql_distance((f'{q}_x_1', f'{q}_y_1'), (f'{q}_x_2', f'{q}_y_2'))} > {_APART} THEN 1 ELSE 0 END" for q in BODY_PARTS)
    moved = {i: " + ".join(f"coalesce({sql_distance((f'{q}_x_{i}', f'{q}_y_{i}'), (f'lag({q}_x_{i}) OVER w', f'lag({q}_y_{i}) OVER w'))}, 0)" for q in BODY_PARTS) for i in (1, 2)}
    values = [f"{v}_{i}" for v in _VALUES for i in (1, 2)]
    dropped = ", ".join(f"CASE WHEN NOT drop_{i} THEN {v}_{i} END AS {v}_{i}" for v in _VALUES for i in (1, 2))
    there = {i: " AND ".join(f"{q}_x_{i} IS NOT NULL" for q in BODY_PARTS) for i in (1, 2)}
    record = "{" + ", ".join(f"'{q}_{a}_{i}': {q}_{a}_{i}" for q in BODY_PARTS for a in ("x", "y") for i in (1, 2)) + "}"
    cost = lambda one, two: " + ".join(f"pow(nx.{q}_{a}_1 - la.{q}_{a}_{one}, 2) + pow(nx.{q}_{a}_2 - la.{q}_{a}_{two}, 2)" for q in BODY_PARTS for a in ("x", "y"))
    swapped = ", ".join(f"CASE WHEN flipped THEN {v}_{3 - i} ELSE {v}_{i} END AS {v}_{i}" for v in _VALUES for i in (1, 2))

    def fill(c: str) -> str:
        left = f"last_value(CASE WHEN {c} IS NOT NULL THEN {{'t': frame_idx, 'v': {c}}} END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        right = f"first_value(CASE WHEN {c} IS NOT NULL THEN {{'t': frame_idx, 'v': {c}}} END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        return f"{left} AS l_{c}, {right} AS r_{c}"

    shown = values
    lerp = lambda c: f"round(coalesce({c}, CASE WHEN frame_idx - l_{c}.t <= {_LIMIT} THEN CASE WHEN r_{c} IS NULL THEN l_{c}.v ELSE l_{c}.v + (r_{c}.v - l_{c}.v) * (frame_idx - l_{c}.t) / nullif(r_{c}.t - l_{c}.t, 0) END END), 4) AS {c}"
    return f"""WITH {POSE}, raw AS (SELECT session, frame_idx, {raw} FROM pose),
kept AS (SELECT * FROM (SELECT *, min(CASE WHEN nose_x_1 IS NOT NULL OR nose_x_2 IS NOT NULL THEN frame_idx END) OVER (PARTITION BY session) AS lo, max(CASE WHEN nose_x_1 IS NOT NULL OR nose_x_2 IS NOT NULL THEN frame_idx END) OVER (PARTITION BY session) AS hi FROM raw) WHERE frame_idx BETWEEN lo AND hi),
near AS (SELECT *, ({apart}) < 3 AND row_number() OVER w > 1 AS near, {moved[1]} AS m1, {moved[2]} AS m2 FROM kept WINDOW w AS ({_W})),
drops AS (SELECT *, near AND (m1 > {_JUMP} AND m2 > {_JUMP} OR m1 > m2) AS drop_1, near AND (m1 > {_JUMP} AND m2 > {_JUMP} OR m2 > m1) AS drop_2 FROM near),
valid AS (SELECT session, frame_idx, drop_1, drop_2, {dropped} FROM drops),
gaps AS (SELECT *, NOT ({there[1]} OR {there[2]}) AS gap FROM valid),
sides AS (SELECT *, last_value(CASE WHEN NOT gap THEN {record} END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS la, lead({record}) OVER w AS nx, lead(gap) OVER w AS next_gap FROM gaps WINDOW w AS ({_W})),
swaps AS (SELECT *, gap AND NOT coalesce(next_gap, true) AND coalesce({cost(2, 1)} < {cost(1, 2)}, false) AS swap_here FROM sides),
flips AS (SELECT *, sum(CASE WHEN swap_here THEN 1 ELSE 0 END) OVER ({_W}) % 2 = 1 AS flipped FROM swaps),
crossed AS (SELECT session, frame_idx, drop_1, drop_2, swap_here, flipped, {swapped} FROM flips),
filled AS (SELECT *, {', '.join(fill(c) for c in shown)} FROM crossed WINDOW w AS ({_W}))
SELECT session, frame_idx, drop_1, drop_2, swap_here, flipped, nose_x_1 IS NULL AS missing_1, nose_x_2 IS NULL AS missing_2, {', '.join(lerp(c) for c in shown)} FROM filled"""


@query(_clean_sql())
def clean_paired(spark, sf_dir):
    """All 36 repaired columns, and what was dropped, exchanged and missing."""
    return rounded(clean.clean_paired(_raw(spark, sf_dir), ["session"], limit=_LIMIT, apart=_APART, jump=_JUMP))


def _single_sql() -> str:
    raw = ", ".join(f"CASE WHEN {_KEEP[1]} THEN {q}_1_{'p' if a == 'score' else a} END AS {q}_{a}" for q in BODY_PARTS for a in ("x", "y", "score"))
    known = lambda c: f"CASE WHEN {c} IS NOT NULL THEN {{'t': frame_idx, 'v': {c}}} END IGNORE NULLS"
    sides = ", ".join(f"last_value({known(c)}) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l_{c}, first_value({known(c)}) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r_{c}" for c in _VALUES)
    shown = ", ".join(f"round(coalesce({c}, CASE WHEN frame_idx - l_{c}.t <= {FILL_LIMIT} THEN l_{c}.v + (r_{c}.v - l_{c}.v) * (frame_idx - l_{c}.t) / nullif(r_{c}.t - l_{c}.t, 0) END), 4) AS {c}" for c in _VALUES)
    return f"""WITH {POSE}, d AS (SELECT session, frame_idx, {raw} FROM pose),
k AS (SELECT * FROM (SELECT *, min(CASE WHEN nose_x IS NOT NULL THEN frame_idx END) OVER (PARTITION BY session) AS lo, max(CASE WHEN nose_x IS NOT NULL THEN frame_idx END) OVER (PARTITION BY session) AS hi FROM d) WHERE frame_idx BETWEEN lo AND hi),
n AS (SELECT *, {sides} FROM k WINDOW w AS ({_W})) SELECT session, frame_idx, 0 AS track, nose_x IS NULL AS missing_1, {shown} FROM n"""


@query(_single_sql())
def clean_single(spark, sf_dir):
    """All 18 columns of one animal."""
    return rounded(clean.clean_single(_raw(spark, sf_dir).where("track = 0"), ["session"]))


def _steps_sql() -> str:
    of = lambda one, two: " + ".join(f"{sql_distance((f'{q}_{i}_x', f'{q}_{i}_y'), (f'lag({q}_{j}_x) OVER w', f'lag({q}_{j}_y) OVER w'))}" for q in BODY_PARTS for i, j in ((1, one), (2, two)))
    return f"WITH {POSE} SELECT session, frame_idx FROM (SELECT session, frame_idx, {of(2, 1)} < {of(1, 2)} AS s FROM pose WINDOW w AS ({_W})) WHERE s"


@query(_steps_sql())
def step_swaps(spark, sf_dir):
    p = pose(spark, sf_dir)
    p = p.select("session", "frame_idx", *[F.col(f"{q}_{i}_{a}").alias(f"{q}_{a}_{i}") for q in BODY_PARTS for i in (1, 2) for a in ("x", "y")])
    return clean.step_swaps(p, SESSION).where("swap_here").select("session", "frame_idx")


# Features


def _feature_steps(animals: int) -> tuple[str, str, list[str]]:
    """The chain of steps, the last one's name, and the names of what they make."""
    every, pair = range(1, animals + 1), animals == 2
    pts = lambda i: [sql_point(f"{q}_{i}") for q in BODY_PARTS]
    at = lambda q, i: sql_point(f"{q}_{i}")
    one: dict[str, str] = {}
    for i in every:
        one[f"poly_area_{i}"] = _hull_sql(pts(i), "perimeter")
        one[f"nose_to_tail_{i}"] = sql_distance(at("nose", i), at("tail_base", i))
        one[f"ear_distance_{i}"] = sql_distance(at("ear_left", i), at("ear_right", i))
        one[f"body_center_angle_{i}"] = sql_angle(at("head", i), at("body_center", i), at("tail_base", i))
        turn = sql_angle(at("ear_left", i), at("nose", i), at("ear_right", i))
        one[f"nose_angle_{i}"] = f"CASE WHEN {turn} > 180 THEN {turn} - 360 ELSE {turn} END"
        one[f"d{i}"] = "[" + ", ".join(sql_distance(a, b) for a, b in combinations(pts(i), 2)) + "]"
    if pair:
        for n, q in (("nose_to_nose", "nose"), ("body_to_body", "body_center"), ("tail_to_tail", "tail_base")):
            one[f"{n}_distance"] = sql_distance(at(q, 1), at(q, 2))
        one["nose_1_to_tail_2_distance"] = sql_distance(at("nose", 1), at("tail_base", 2))
        one["nose_2_to_tail_1_distance"] = sql_distance(at("nose", 2), at("tail_base", 1))
        one["relative_midline_angle"] = sql_between(at("nose", 1), at("tail_base", 1), at("nose", 2), at("tail_base", 2))
        one["relative_nose_head_angle"] = sql_between(at("nose", 1), at("head", 1), at("nose", 2), at("head", 2))
    ps = [f"{q}_{i}_p" for i in reversed(every) for q in BODY_PARTS]
    one["sum_probabilities"] = " + ".join(ps)
    for b in ("0.1", "0.5", "0.75"):
        one[f"low_prob_detections_{b}"] = " + ".join(f"CASE WHEN {p} BETWEEN 0 AND {b} THEN 1 ELSE 0 END" for p in ps)
    two = {f"m{i}_hull_{n}_euclidean": e.format(d=f"d{i}") for i in every for n, e in (("large", "list_max({d})"), ("small", "list_min({d})"), ("mean", "list_avg({d})"), ("sum", "2 * list_sum({d})"))}
    was = lambda c: f"coalesce(lag({c}) OVER w, {c})"
    three = {"sum_euclidean_distance_hull": "m1_hull_sum_euclidean + m2_hull_sum_euclidean"} if pair else {}
    for i in every:
        for q in BODY_PARTS:
            x, y = at(q, i)
            three[f"movement_mouse_{i}_{q}"] = sql_distance((was(x), was(y)), (x, y))
        for c in ("poly_area", "nose_to_tail", "ear_distance", "body_center_angle", "nose_angle"):
            three[f"movement_mouse_{i}_{c}"] = f"{was(f'{c}_{i}')} - {c}_{i}"
    for c in ("nose_to_nose_distance", "tail_to_tail_distance", "relative_midline_angle", "relative_nose_head_angle") if pair else ():
        three[f"movement_{c}"] = f"{was(c)} - {c}"
    total = lambda i: " + ".join(f"movement_mouse_{i}_{q}" for q in BODY_PARTS)
    four = {f"total_movement_all_bodyparts_m{i}": total(i) for i in every}
    if pair:
        four |= {
            "total_movement_all_bodyparts_both_mice": f"{total(1)} + {total(2)}",
            "total_movement_nose": "movement_mouse_1_nose + movement_mouse_2_nose",
            "total_movement_tail_base": "movement_mouse_1_tail_base + movement_mouse_2_tail_base",
        }
    rolled = (
        "sum_euclidean_distance_hull total_movement_all_bodyparts_both_mice nose_to_nose_distance tail_to_tail_distance m1_hull_mean_euclidean m2_hull_mean_euclidean m1_hull_small_euclidean m2_hull_small_euclidean "
        "m1_hull_large_euclidean m2_hull_large_euclidean movement_mouse_1_tail_base movement_mouse_2_tail_base movement_mouse_1_nose movement_nose_to_nose_distance"
    ).split()
    hulls = [f"m{i}_hull_{k}_euclidean" for i in every for k in ("small", "large", "mean")]
    both = ("total_movement_all_bodyparts_both_mice", "sum_euclidean_distance_hull") if pair else ()
    if not pair:
        rolled = [*hulls, "movement_mouse_1_tail_base", "movement_mouse_1_nose"]
    five = {f"{c}_{h}_{n}": f"{f}({c}) OVER (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for c in rolled for n in ROLLING for h, f in (("median", "median"), ("mean", "avg"))}
    gap = lambda c: f"avg({c}) OVER s - {c}"
    six = {f"{c}_deviation": gap(c) for c in (*both, *hulls[:3], *[f"movement_mouse_{i}_nose" for i in every], *[f"poly_area_{i}" for i in every], "sum_probabilities")}
    for n in ROLLING:
        for c in (*both, *hulls, *(["movement_nose_to_nose_distance"] if pair else [])):
            six[f"{c}_mean_deviation_{n}"] = gap(f"{c}_mean_{n}")
        for c in (*both, *hulls, *(["nose_to_nose_distance"] if pair else [])):
            six[f"{c}_mean_{n}_percentile_rank"] = gap(f"{c}_mean_{n}")
    rank = lambda c: f"(rank() OVER (PARTITION BY session ORDER BY {c}) + (count(*) OVER (PARTITION BY session, {c}) - 1) / 2.0) / count(*) OVER s"
    seven = {f"movement_mouse_{i}_percentile_rank": rank(f"movement_mouse_{i}_nose") for i in every} | {f"movement_mouse_{i}_deviation_percentile_rank": rank(f"movement_mouse_{i}_nose_deviation") for i in every}
    if pair:
        seven |= {"movement_percentile_rank": rank("total_movement_nose"), "distance_percentile_rank": rank("nose_to_nose_distance")}
    seven["sum_probabilities_deviation_percentile_rank"] = rank("sum_probabilities_deviation")
    eight = {"sum_probabilities_percentile_rank": rank("sum_probabilities_deviation_percentile_rank")}
    steps, last = [POSE], "pose"
    for k, made in enumerate((one, two, three, four, five, six, seven, eight)):
        steps.append(f"f{k} AS (SELECT *, " + ", ".join(f'{e} AS "{n}"' for n, e in made.items()) + f" FROM {last} WINDOW w AS ({_W}), s AS (PARTITION BY session))")
        last = f"f{k}"
    names = [n for made in (one, two, three, four, five, six, seven, eight) for n in made if n not in ("d1", "d2")]
    return ", ".join(steps), last, names


def _features_sql(animals: int) -> str:
    steps, last, names = _feature_steps(animals)
    shown = ", ".join(f'round("{n}", 3) AS "{n}"' if "low_prob" not in n else f'CAST("{n}" AS INT) AS "{n}"' for n in [*wide_columns(animals), *names])
    return f"WITH {steps} SELECT session, frame_idx, {shown} FROM {last}"


@query(_features_sql(2))
def features_paired(spark, sf_dir):
    """All 299 columns of two animals."""
    return rounded(features.extract(pose(spark, sf_dir), ["session"], 2), 3)


@query(_features_sql(1))
def features_single(spark, sf_dir):
    """All 117 columns of one animal."""
    return rounded(features.extract(pose(spark, sf_dir, 1), ["session"], 1), 3)


# Zones

_NEST = [(repr(x), repr(y)) for x, y in NEST]
_CENTER = (f"({' + '.join(p[0] for p in _NEST)}) / 4", f"({' + '.join(p[1] for p in _NEST)}) / 4")
_LOOM = (repr(LOOM[0]), repr(LOOM[1]))


def _zones_sql() -> str:
    out = []
    for i in (1, 2):
        for q in BODY_PARTS:
            at = sql_point(f"{q}_{i}")
            out += [
                r(sql_distance(at, _CENTER), f"Nest Animal_{i} {q}_{i} distance"),
                f'{sql_in_polygon(at, _NEST)} AS "Nest Animal_{i} {q}_{i} in zone"',
                r(sql_distance(at, _LOOM), f"Loom Animal_{i} {q}_{i} distance"),
                f'CASE WHEN {sql_distance(at, _LOOM)} <= {RADIUS} THEN 1 ELSE 0 END AS "Loom Animal_{i} {q}_{i} in zone"',
            ]
        nose, body = sql_point(f"nose_{i}"), sql_point(f"body_center_{i}")
        out += [f'{sql_facing(nose, body, _CENTER)} AS "Nest Animal_{i} facing"', f'{sql_facing(nose, body, _LOOM)} AS "Loom Animal_{i} facing"']
    return f"WITH {POSE} SELECT session, frame_idx, {', '.join(out)} FROM pose"


@query(_zones_sql())
def zone_features(spark, sf_dir):
    df = zones.add(pose(spark, sf_dir), zones.Zones(NEST, LOOM, RADIUS))
    return rounded(df.select("session", "frame_idx", *[c for c in df.columns if c.startswith(("Nest", "Loom"))]))


def _away(q: str, i: int, nest=_NEST) -> str:
    at = sql_point(f"{q}_{i}")
    edges = ", ".join(sql_segment(at, a, b) for a, b in zip(nest, [*nest[1:], nest[0]], strict=True))
    return f"CASE WHEN {sql_in_polygon(at, nest)} = 1 THEN 0.0 ELSE least({edges}) END AS d_{q}_{i}"


def _approach_sql() -> str:
    points = [(q, i) for i in (1, 2) for q in BODY_PARTS]
    made = ", ".join(f"{r(f'd_{q}_{i}', f'roi_distance_{q}_animal_{i}')}, {r(f'coalesce(d_{q}_{i} - lag(d_{q}_{i}) OVER w, lead(d_{q}_{i}) OVER w - d_{q}_{i})', f'roi_velocity_{q}_animal_{i}')}" for q, i in points)
    return f"WITH {POSE}, d AS (SELECT session, frame_idx, {', '.join(_away(q, i) for q, i in points)} FROM pose) SELECT session, frame_idx, {made} FROM d WINDOW w AS ({_W})"


@query(_approach_sql())
def nest_approach(spark, sf_dir):
    """Distance to the nest and its change, of all twelve points."""
    df = pose(spark, sf_dir)
    for i in (1, 2):
        df = zones.approach(df, SESSION, zones.Zones(NEST), i)
    return rounded(df.select("session", "frame_idx", *[c for c in df.columns if c.startswith("roi_")]))


# Event metrics, over tracks of the event table: pairs of users are sessions, their frames the session's.

_PAIR_FRAMES = f"""WITH {FRAMES}, p AS (SELECT track // 2 AS session, CAST(track % 2 + 1 AS INT) AS animal, frame_idx, kind, value,
kind IN ('view', 'click') AS slow, kind <> 'error' AS calm, kind = 'view' AS inside, kind IN ('view', 'click', 'scroll') AS near FROM fr)"""


def _with_points(head: str) -> str:
    """Adds the events of all frames p and each animal's time points."""
    return head + """,
ends AS (SELECT session, max(frame_idx) + 1 AS e FROM p GROUP BY session),
lo AS (SELECT session, CAST(row_number() OVER (PARTITION BY session ORDER BY frame_idx) AS INT) AS loom, frame_idx AS at_, lead(frame_idx) OVER (PARTITION BY session ORDER BY frame_idx) AS until FROM (SELECT DISTINCT session, frame_idx FROM p WHERE frame_idx % 25 = 5)),
who AS (SELECT a.session, a.animal, loom, at_, until, ends.e, least(coalesce(until, ends.e), ends.e) AS nxt FROM (SELECT DISTINCT session, animal FROM p) a JOIN lo USING (session) JOIN ends USING (session)),
m AS (SELECT who.*, frame_idx, frame_idx - at_ AS t, slow, calm, inside, near FROM who JOIN p ON p.session = who.session AND p.animal = who.animal AND p.frame_idx >= at_),
c AS (SELECT *, sum(inside::INT) OVER o AS n_in, sum(slow::INT) OVER o AS n_slow FROM m WINDOW o AS (PARTITION BY session, animal, loom ORDER BY frame_idx)),
a AS (SELECT session, animal, loom, min(t) FILTER (n_in >= 5 AND frame_idx < nxt) - 4 AS latency, min(t) FILTER (n_slow >= 35) AS fz FROM c GROUP BY ALL),
b AS (SELECT session, animal, loom, latency, CASE WHEN latency > 0 AND fz >= latency THEN NULL ELSE fz - 34 END AS freeze_start FROM a),
d AS (SELECT m.*, latency, freeze_start, sum((freeze_start IS NOT NULL AND t >= freeze_start AND NOT calm)::INT) OVER (PARTITION BY m.session, m.animal, m.loom ORDER BY frame_idx) AS n_fast FROM m JOIN b USING (session, animal, loom)),
e AS (SELECT session, animal, loom, any_value(latency) AS latency, any_value(freeze_start) AS freeze_start, min(t - latency) FILTER (t >= latency AND NOT near) AS stay, min(t - freeze_start - 5) FILTER (n_fast >= 5) AS len, max(t + 1) AS rest FROM d GROUP BY ALL),
points AS (SELECT who.session, who.animal, who.loom, at_ AS loom_frame, until, latency, at_ + latency AS entry_frame, stay, freeze_start, CASE WHEN freeze_start IS NOT NULL THEN coalesce(len, rest - freeze_start) END AS freeze_length, who.e FROM who LEFT JOIN e USING (session, animal, loom))"""


_PAIR = _with_points(_PAIR_FRAMES)


def _pairs(spark, sf_dir):
    f = frames(spark, sf_dir)
    k = F.col("kind")
    return f.select(
        F.floor(F.col("track") / 2).cast("long").alias("session"),
        (F.col("track") % 2 + 1).cast("int").alias("animal"),
        "frame_idx",
        "kind",
        "value",
        k.isin("view", "click").alias("slow"),
        (k != "error").alias("calm"),
        (k == "view").alias("inside"),
        k.isin("view", "click", "scroll").alias("near"),
    )


def _looms(p):
    events = p.where("frame_idx % 25 = 5").select("session", "frame_idx").distinct()
    return metrics.loom_events(events.select("session", F.lit("loom").alias("event_type"), F.col("frame_idx").cast("double").alias("time_start"), F.col("frame_idx").alias("frame_start")), ["session"])


def _points(p):
    return metrics.time_points(p, _looms(p), ["session"])


@query(f"{_PAIR} SELECT session, animal, loom, loom_frame, until, latency, entry_frame, stay, freeze_start, freeze_length FROM points")
def loom_time_points(spark, sf_dir):
    return _points(_pairs(spark, sf_dir))


_METRICS = [
    metrics.Metric("calm_percent", "percent", "calm", metrics.Span(end_offset=12)),
    metrics.Metric("mean_before", "mean", "value", metrics.Span(start_offset=-10)),
    metrics.Metric("mean_to_entry", "mean", "value", metrics.Span(end="latency")),
    metrics.Metric("mean_to_entry_shared", "mean", "value", metrics.Span(end="latency", both=True)),
    metrics.Metric("sum_around", "sum", "value", metrics.Span(start_offset=-5, end_offset=9)),
    metrics.Metric("most_smoothed", "max_smoothed", "value", metrics.Span(start_offset=-4, end_offset=16, most=15), 5, metrics.to_cm(2.0)),
]


def _metrics_sql() -> str:
    def span(k: int, start: str, end: str) -> str:
        return f"SELECT session, animal, loom, {k} AS k, {start} AS s, CASE WHEN {end} IS NOT NULL THEN least({end}, e) END AS f FROM points"

    windows = " UNION ALL ".join([span(0, "loom_frame", "loom_frame + 12"), span(1, "loom_frame - 10", "loom_frame"), span(2, "loom_frame", "entry_frame"), span(4, "loom_frame - 5", "loom_frame + 9"), span(5, "loom_frame - 4", "least(loom_frame + 16, loom_frame - 4 + 15)")])
    return f"""{_PAIR}, w0 AS ({windows}), w1 AS (SELECT * FROM w0 WHERE k <> 2 OR f > s),
sh AS (SELECT session, loom, max(s) AS s, min(f) AS f FROM w0 WHERE k = 2 GROUP BY session, loom HAVING count(CASE WHEN f IS NOT NULL THEN s END) = count(*)),
w AS (SELECT * FROM w1 UNION ALL SELECT points.session, points.animal, points.loom, 3, sh.s, sh.f FROM points JOIN sh ON sh.session = points.session AND sh.loom = points.loom WHERE sh.s < sh.f),
sm AS (SELECT *, avg(value) OVER o AS v5, count(*) OVER o AS n5 FROM p WINDOW o AS (PARTITION BY session, animal ORDER BY frame_idx ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
j AS (SELECT w.*, frame_idx, value, calm, v5, n5 FROM w JOIN sm ON sm.session = w.session AND sm.animal = w.animal AND frame_idx >= s AND frame_idx < f),
g AS (SELECT session, animal, loom, 100 * avg(calm::INT) FILTER (k = 0) AS calm_percent, avg(value) FILTER (k = 1) AS mean_before, avg(value) FILTER (k = 2) AS mean_to_entry, avg(value) FILTER (k = 3) AS mean_to_entry_shared,
sum(value) FILTER (k = 4) AS sum_around, max(v5) FILTER (k = 5 AND n5 = 5 AND frame_idx + 5 <= f) / 2 AS most_smoothed FROM j GROUP BY ALL)
SELECT session, animal, loom, round(calm_percent, 4) AS calm_percent, round(mean_before, 4) AS mean_before, round(mean_to_entry, 4) AS mean_to_entry, round(mean_to_entry_shared, 4) AS mean_to_entry_shared, round(sum_around, 2) AS sum_around, round(most_smoothed, 4) AS most_smoothed
FROM points LEFT JOIN g USING (session, animal, loom)"""


@query(_metrics_sql())
def event_metrics(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    p = p.withColumn("calm", F.col("calm").cast("int"))
    points = _points(p.withColumn("calm", F.col("calm") == 1))
    return rounded(metrics.measure(p, points, ["session"], _METRICS))


_STEPS, _LAST, _ = _frechet_sql(12, 12)
_PATH = "list({{'x': body_center_{i}_x, 'y': body_center_{i}_y}} ORDER BY frame_idx)"


_WHOLE = " ".join(f"WHEN {n} THEN c_{n - 1}_{n - 1}" for n in range(2, 13))


@query(
    f"""WITH {POSE}, paths AS (SELECT session, CAST((frame_idx - 5) // 25 + 1 AS INT) AS loom, {_PATH.format(i=1)} AS p, {_PATH.format(i=2)} AS q
FROM pose WHERE frame_idx >= 5 AND (frame_idx - 5) % 25 < 12 GROUP BY ALL HAVING count(*) > 1), {_STEPS} SELECT session, loom, round(CASE len(p) {_WHOLE} END, 4) AS frechet FROM {_LAST}"""
)
def loom_paths(spark, sf_dir):
    """Frechet distance of both animals' paths over the windows they share, which the session's end may cut."""
    wide = pose(spark, sf_dir)
    rows = metrics.stacked(wide, ["session"], {"body_center_x": lambda i: F.col(f"body_center_{i}_x"), "body_center_y": lambda i: F.col(f"body_center_{i}_y")}, 2)
    looms = wide.where("frame_idx % 25 = 5").select("session", F.lit("loom").alias("event_type"), F.col("frame_idx").cast("double").alias("time_start"), F.col("frame_idx").alias("frame_start"))
    looms = metrics.loom_events(looms, ["session"])
    points = rows.select("session", "animal").distinct().join(looms, "session").select("session", "animal", "loom", F.col("at").alias("loom_frame"), F.lit(None).cast("long").alias("entry_frame"))
    return rounded(metrics.path_distances(rows, points, ["session"], metrics.Span(end_offset=12), "body_center"))


# The whole analysis at the default rate. The nest is so wide that animals enter it, and pixels so many a centimetre that they freeze.

_FPS, _CM = 29.595, 1600.0
WIDE = ((60.0, 70.0), (350.0, 50.0), (360.0, 340.0), (40.0, 350.0))
_WIDE = [(repr(x), repr(y)) for x, y in WIDE]
_DURING, _BLINK, _TWO, _TEN, _AROUND = 221, 5, 59, 295, 517  # 7.5, 0.2, 2, 10 and 17.5 seconds in frames
_SHARED = ("relative_midline_angle", "nose_to_nose_distance", "nose_1_to_tail_2_distance", "nose_2_to_tail_1_distance")
_LOOM_TURN = "degrees(atan2({y} - head_{i}_y, {x} - head_{i}_x) - atan2(nose_{i}_y - head_{i}_y, nose_{i}_x - head_{i}_x))"
#: Names of the metrics; how each is taken: kind, column, begin, end, whether all animals' windows are intersected, and the factor of its unit.
_METRIC_SQL = [
    ("Freeze Percent (2s window starting at loom)", "percent", "calm", "loom_frame", f"loom_frame + {_TWO}", False, 1),
    ("Freeze Percent (window over whole loom)", "percent", "calm", "loom_frame", f"loom_frame + {_DURING}", False, 1),
    ("Angle to loom(during loom)", "mean", "angle_to_loom", "loom_frame", f"loom_frame + {_DURING}", False, 1),
    ("Angle to loom(0.2 seconds after loom)", "mean", "angle_to_loom", "loom_frame", f"loom_frame + {_BLINK}", False, 1),
    ("Angle to loom(10s before loom)", "mean", "angle_to_loom", f"loom_frame - {_TEN}", "loom_frame", False, 1),
    ("Facing loom percent", "percent", "facing_loom", "loom_frame", f"loom_frame + {_DURING}", False, 1),
    ("Max velocity(start loom - nest entry)", "most5", "speed", "loom_frame - 4", f"CASE WHEN entry_frame IS NOT NULL THEN least(entry_frame + 4, loom_frame - 4 + {_TEN}) END", False, _FPS / _CM),
    ("Max velocity(10s before loom)", "most5", "speed", f"loom_frame - {_TEN} - 4", f"least(loom_frame + 4, loom_frame - {_TEN} - 4 + {_TEN})", False, _FPS / _CM),
    ("Max velocity to nest(start loom - nest entry)", "most3", "nest_speed", "loom_frame - 4", f"CASE WHEN entry_frame IS NOT NULL THEN least(entry_frame + 4, loom_frame - 4 + {_TEN}) END", False, _FPS / _CM),
    ("Max velocity to nest(10s before loom)", "most3", "nest_speed", f"loom_frame - {_TEN} - 4", f"least(loom_frame + 4, loom_frame - {_TEN} - 4 + {_TEN})", False, _FPS / _CM),
    *[
        (f"{title} ({where})", "mean", column, start, end, both, 1 if column == "relative_midline_angle" else 1 / _CM)
        for title, column in zip(("Midline angle average", "Nose to nose average", "Nose1 to tail2 average", "Nose2 to tail1 average"), _SHARED, strict=True)
        for where, start, end, both in (
            ("during loom", "loom_frame", f"loom_frame + {_DURING}", True),
            ("start loom - nest entry", "loom_frame", "entry_frame", True),
            ("10s before loom", f"loom_frame - {_TEN}", "loom_frame", False),
            ("10s after nest entry", "entry_frame", f"entry_frame + {_TEN}", False),
        )
    ],
    ("Midline angle average (0.2 seconds after loom)", "mean", "relative_midline_angle", "loom_frame", f"loom_frame + {_BLINK}", True, 1),
    *[(f"Missing {title} Frames", "sum", f"still_{q}", f"loom_frame - {_TEN}", f"loom_frame + {_AROUND}", False, 1) for q, title in (("body_center", "Body Center"), ("ear_left", "Left Ear"), ("ear_right", "Right Ear"), ("head", "Head"), ("nose", "Nose"), ("tail_base", "Tail Base"))],
    ("Missing Identity Frames", "sum", "still_all", f"loom_frame - {_TEN}", f"loom_frame + {_AROUND}", False, 1),
]


def _session_head() -> str:
    """CTEs up to p: each animal's frames with the columns that the metrics name."""
    steps, last, _ = _feature_steps(2)
    points = [(q, i) for i in (1, 2) for q in BODY_PARTS]
    zone = [f"{sql_in_polygon(sql_point(f'{q}_{i}'), _WIDE)} AS in_{q}_{i}" for q, i in points] + [_away(q, i, _WIDE) for q, i in points]
    zone += [f"{sql_facing(sql_point(f'nose_{i}'), sql_point(f'body_center_{i}'), _LOOM)} AS facing_{i}" for i in (1, 2)]
    moved = [f"coalesce(d_{q}_{i} - lag(d_{q}_{i}) OVER w, lead(d_{q}_{i}) OVER w - d_{q}_{i}) AS v_{q}_{i}" for q, i in points]
    moved += [f"avg(movement_mouse_{i}_tail_base) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS speed6_{i}" for i in (1, 2)]

    def animal(i: int) -> str:
        turn = _LOOM_TURN.format(i=i, x=_LOOM[0], y=_LOOM[1])
        speed = " + ".join(f"movement_mouse_{i}_{q}" for q in ("nose", "tail_base", "ear_left", "ear_right"))
        inside, near = (f"{f}({', '.join(f'in_{q}_{i}' for q in parts)}) = 1" for f, parts in (("least", BODY_PARTS), ("greatest", [q for q in BODY_PARTS if q != "tail_base"])))
        own = ", ".join(f"{q}_{i}_x AS {q}_x" for q in BODY_PARTS)
        return (
            f"SELECT session, CAST({i} AS INT) AS animal, frame_idx, {inside} AS inside, {near} AS near, coalesce(speed6_{i} < 3.0 * {_CM} / {_FPS}, false) AS slow, coalesce(speed6_{i} < 4.0 * {_CM} / {_FPS}, false) AS calm, facing_{i} AS facing_loom, "
            f"CASE WHEN {turn} > 180 THEN 360 - {turn} ELSE {turn} END AS angle_to_loom, ({speed}) / 4 AS speed, ({' + '.join(f'v_{q}_{i}' for q in BODY_PARTS)}) / 6 AS nest_speed, {', '.join(_SHARED)}, {own} FROM v"
        )

    return f"""WITH {steps}, z AS (SELECT *, {', '.join(zone)} FROM {last}), v AS (SELECT *, {', '.join(moved)} FROM z WINDOW w AS ({_W})),
p AS MATERIALIZED ({animal(1)} UNION ALL {animal(2)})"""


def _session_sql() -> str:
    head = _session_head()
    each = "PARTITION BY session, animal ORDER BY frame_idx"
    flat = ", ".join(f"coalesce(abs({q}_x - 2 * lag({q}_x, 1) OVER o + lag({q}_x, 2) OVER o) < 0.02, false) AS flat_{q}" for q in BODY_PARTS)
    runs = ", ".join(f"frame_idx - row_number() OVER (PARTITION BY session, animal, flat_{q} ORDER BY frame_idx) AS k_{q}" for q in BODY_PARTS)
    still = ", ".join(f"CASE WHEN flat_{q} AND count(*) OVER (PARTITION BY session, animal, flat_{q}, k_{q}) >= 8 THEN 1 ELSE 0 END AS still_{q}" for q in BODY_PARTS)
    smooth = ", ".join(f"avg({c}) OVER (o ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS s{n}, count(*) OVER (o ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS n{n}" for c, n in (("speed", 5), ("nest_speed", 3)))
    spans = list(dict.fromkeys((s, e, both) for _, _, _, s, e, both, _ in _METRIC_SQL))
    raw = " UNION ALL ".join(f"SELECT session, animal, loom, {k} AS k, CASE WHEN ({e}) IS NOT NULL THEN {s} END AS s, CASE WHEN ({s}) IS NOT NULL THEN least({e}, e) END AS f, {str(both).lower()} AS both_ FROM points" for k, (s, e, both) in enumerate(spans))

    def measure(name: str, kind: str, column: str, s: str, e: str, both: bool, unit: float) -> str:
        here = f"FILTER (k = {spans.index((s, e, both))})"
        if kind.startswith("most"):
            n = int(kind[4:])
            value = f"max(s{n}) FILTER (k = {spans.index((s, e, both))} AND n{n} = {n} AND frame_idx + {n} <= f)"
        else:
            value = {"percent": f"100 * avg({column}::INT) {here}", "mean": f"avg({column}) {here}", "sum": f"CAST(sum({column}) {here} AS DOUBLE)"}[kind]
        return f'round(CASE WHEN {value} >= 0 THEN {value} * {unit!r} ELSE {value} END, 7) AS "{name}"'

    measured = ", ".join(measure(*m) for m in _METRIC_SQL)
    seconds = ", ".join(f'round({c} / {_FPS}, 7) AS "{n}"' for n, c in (("Freeze start", "freeze_start"), ("Freeze length", "freeze_length"), ("Latency to nest", "latency"), ("Time in nest", "stay")))
    return f"""{_with_points(head)}, fl AS (SELECT *, {flat} FROM p WINDOW o AS ({each})), rn AS (SELECT *, {runs} FROM fl), sl AS (SELECT *, {still} FROM rn),
fr2 AS (SELECT *, least({', '.join(f'still_{q}' for q in BODY_PARTS)}) AS still_all, {smooth} FROM sl WINDOW o AS ({each})),
w0 AS ({raw}), sh AS (SELECT session, loom, k, max(s) AS s, min(f) AS f FROM w0 WHERE both_ GROUP BY ALL HAVING count(s) = count(*) AND max(s) < min(f)),
w1 AS (SELECT session, animal, loom, k, s, f FROM w0 WHERE NOT both_ UNION ALL SELECT w0.session, w0.animal, w0.loom, w0.k, sh.s, sh.f FROM w0 JOIN sh ON sh.session = w0.session AND sh.loom = w0.loom AND sh.k = w0.k WHERE both_),
g AS (SELECT w1.session, w1.animal, w1.loom, {measured} FROM w1 JOIN fr2 ON fr2.session = w1.session AND fr2.animal = w1.animal AND frame_idx >= w1.s AND frame_idx < w1.f GROUP BY ALL)
SELECT points.session, points.animal, points.loom, {seconds}, {', '.join(f'"{m[0]}"' for m in _METRIC_SQL)} FROM points LEFT JOIN g ON g.session = points.session AND g.animal = points.animal AND g.loom = points.loom"""


def _analysis(spark, sf_dir):
    from kinetrace.plans.session import analyse

    wide = pose(spark, sf_dir)
    looms = wide.where("frame_idx % 25 = 5").select("session", F.lit("loom").alias("event_type"), F.col("frame_idx").cast("double").alias("time_start"), F.col("frame_idx").alias("frame_start"))
    return analyse(wide, looms, zones.Zones(WIDE, LOOM, RADIUS), ["session"], 2, px_per_cm=_CM)


@query(_session_sql())
def session_metrics(spark, sf_dir):
    """The whole analysis from wide poses, zones and events to the metrics of each animal and event; paths are shown apart."""
    out = _analysis(spark, sf_dir)
    return rounded(out.select(*[F.col(f"`{c}`") for c in out.columns if not c.startswith("Frechet")]), 7)


def _paths_sql() -> str:
    """Coupled distances by antidiagonals: a step of the recursion takes each pair's lists of the two before to the next."""
    here = "sqrt((p[i + 1].x - q[{j} + 1].x) * (p[i + 1].x - q[{j} + 1].x) + (p[i + 1].y - q[{j} + 1].y) * (p[i + 1].y - q[{j} + 1].y))"
    kinds = [(part, k) for part in ("body_center", "head") for k in (0, 1)]
    titles = ("start loom - nest entry", "10s before loom - loom")
    pair = " UNION ALL ".join(
        f"SELECT sh.session, sh.loom, {n} AS kind, list({{'x': {part}_1_x, 'y': {part}_1_y}} ORDER BY frame_idx) AS p, list({{'x': {part}_2_x, 'y': {part}_2_y}} ORDER BY frame_idx) AS q "
        f"FROM sh JOIN pose ON pose.session = sh.session AND frame_idx >= sh.s AND frame_idx < sh.f WHERE sh.k = {k} GROUP BY sh.session, sh.loom HAVING count(*) > 1"
        for n, (part, k) in enumerate(kinds)
    )
    shown = ", ".join(f'round(max(d) FILTER (kind = {n}), 7) AS "Frechet Distance {part} ({titles[k]})"' for n, (part, k) in enumerate(kinds))
    return f"""{_with_points(_session_head()).replace("WITH ", "WITH RECURSIVE ", 1)},
w0 AS (SELECT session, animal, loom, 0 AS k, CASE WHEN entry_frame IS NOT NULL THEN loom_frame END AS s, least(entry_frame, ends.e) AS f FROM points JOIN ends USING (session)
  UNION ALL SELECT session, animal, loom, 1, loom_frame - {_TEN}, least(loom_frame, ends.e) FROM points JOIN ends USING (session)),
sh AS (SELECT session, loom, k, max(s) AS s, min(f) AS f FROM w0 GROUP BY ALL HAVING count(s) = count(*) AND max(s) < min(f)),
pr AS MATERIALIZED (SELECT *, len(p) AS n, len(q) AS m FROM ({pair})),
fr(session, loom, kind, p, q, n, m, step, one, two) AS (
  SELECT session, loom, kind, p, q, n, m, 0, list_transform(range(-1, n), lambda i: CASE WHEN i = 0 THEN {here.format(j='0')} ELSE 'inf'::DOUBLE END), list_transform(range(-1, n), lambda i: 'inf'::DOUBLE) FROM pr
  UNION ALL SELECT session, loom, kind, p, q, n, m, step + 1, list_transform(range(-1, n), lambda i: CASE WHEN i >= 0 AND step + 1 - i BETWEEN 0 AND m - 1
    THEN greatest(least(one[i + 1], one[i + 2], two[i + 1]), {here.format(j='(step + 1 - i)')}) ELSE 'inf'::DOUBLE END), one FROM fr WHERE step < n + m - 2),
dist AS (SELECT session, loom, kind, one[n + 1] AS d FROM fr WHERE step = n + m - 2)
SELECT points.session, points.animal, points.loom, {shown} FROM points LEFT JOIN dist ON dist.session = points.session AND dist.loom = points.loom GROUP BY points.session, points.animal, points.loom"""


@query(_paths_sql())
def session_paths(spark, sf_dir):
    """The analysis' path distances between the two animals over windows that they share."""
    out = _analysis(spark, sf_dir)
    return rounded(out.select("session", "animal", "loom", *[F.col(f"`{c}`") for c in out.columns if c.startswith("Frechet")]), 7)


# Correction

_SCORE = {"a": ("event_id % 20", "event_id % 9"), "b": ("event_id % 13", "event_id % 17")}
_FOUND = {"a": ("(event_id + 3) % 13", "event_id % 16"), "b": ("(event_id + 1) % 19", "event_id % 9")}
_ORDER = "PARTITION BY track ORDER BY loom"


def _correct_sql() -> str:
    d = lambda e: f"CAST({e} AS DOUBLE)"
    manual = ", ".join(f"{d(e)} AS m{n}_{s}" for s in "ab" for n, e in zip("lt", _SCORE[s], strict=True))
    found = ", ".join(f"{d(e)} AS p{n}_{s}" for s in "ab" for n, e in zip("lt", _FOUND[s], strict=True))
    gap = lambda m, p: f"(CASE WHEN {m} IS NULL THEN 0 ELSE abs({m} - {p}) END)"
    cost = lambda x, y: " + ".join(gap(f"m{n}_{s}", f"p{n}_{o}") for s, o in (("a", x), ("b", y)) for n in "lt")
    out = {f"{n}_{s}": f"CASE WHEN swapped THEN p{k}_{o} ELSE p{k}_{s} END" for s, o in (("a", "b"), ("b", "a")) for n, k in (("latency", "l"), ("time_in_nest", "t"))}
    errors = {f"error_{n}_{s}": gap(f"m{k}_{s}", f"({out[f'{n}_{s}']})") for s in "ab" for n, k in (("latency", "l"), ("time_in_nest", "t"))}
    return f"""WITH {FRAMES}, s AS (SELECT track, frame_idx AS loom, {found}, CASE WHEN event_id % 4 = 0 THEN NULL ELSE 1 END AS scored, {manual} FROM fr),
n AS (SELECT track, loom, pl_a, pt_a, pl_b, pt_b, {', '.join(f'CASE WHEN scored = 1 THEN m{k}_{x} END AS m{k}_{x}' for x in 'ab' for k in 'lt')} FROM s), w AS (SELECT *, {cost('b', 'a')} < {cost('a', 'b')} AS swapped FROM n)
SELECT track, loom, {', '.join(f'{e} AS {k}' for k, e in out.items())}, swapped, CAST(swapped AND NOT coalesce(lag(swapped) OVER ({_ORDER}), false) AS INT) AS swap_before, {', '.join(f'CAST({e} AS DOUBLE) AS {k}' for k, e in errors.items())} FROM w"""


@query(_correct_sql())
def identity_correction(spark, sf_dir):
    f = frames(spark, sf_dir).withColumnRenamed("frame_idx", "loom")
    side = lambda s: f.select("track", "loom", *[F.expr(e).cast("double").alias(n) for n, e in zip(correct.VALUES, _FOUND[s], strict=True)])
    manual = f.where("event_id % 4 <> 0").select("track", "loom", *[F.expr(e).cast("double").alias(f"{n}_{s}") for s in "ab" for n, e in zip(correct.VALUES, _SCORE[s], strict=True)])
    return correct.correct(side("a"), side("b"), manual, ["track"], correct.VALUES)


@query(f"SELECT track, count(*) AS events, count(*) FILTER (swapped) AS swapped, CAST(sum(swap_before) AS BIGINT) AS changes FROM ({_correct_sql()}) GROUP BY track")
def correction_counts(spark, sf_dir):
    done = identity_correction(spark, sf_dir)
    return done.groupBy("track").agg(F.count(F.lit(1)).alias("events"), F.count_if("swapped").alias("swapped"), F.sum("swap_before").alias("changes"))


@query(
    f"""WITH {FRAMES}, s AS (SELECT track, frame_idx, kind <> 'error' AS a, kind IN ('view', 'click') AS b FROM fr),
i AS (SELECT *, frame_idx - row_number() OVER (PARTITION BY track, a ORDER BY frame_idx) AS ka, frame_idx - row_number() OVER (PARTITION BY track, b ORDER BY frame_idx) AS kb FROM s)
SELECT track, count(*) FILTER (a AND b AND na >= 3 AND nb >= 2) AS missing FROM (SELECT *, count(*) OVER (PARTITION BY track, a, ka) AS na, count(*) OVER (PARTITION BY track, b, kb) AS nb FROM i) GROUP BY track"""
)
def missing_everywhere(spark, sf_dir):
    """Frames where all parts are in a long run, from two runs of different lengths."""
    f = frames(spark, sf_dir)
    t = Track(("track",))
    for n, flag, least in (("a", F.col("kind") != "error", 3), ("b", F.col("kind").isin("view", "click"), 2)):
        f = f.withColumn("_f", flag).withColumn("_i", t.island(F.col("_f")))
        f = f.withColumn(f"still_{n}", (F.col("_f") & (F.count(F.lit(1)).over(Window.partitionBy("track", "_i")) >= least)).cast("int")).drop("_f", "_i")
    return f.groupBy("track").agg(F.sum(metrics.still_everywhere(("a", "b"))).alias("missing"))
