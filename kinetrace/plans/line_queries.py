"""Directions and clusters of lines, over the segments between neighbouring points of poses; backgrounds of pixels; stores and results."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinetrace.operators import lines as L
from kinetrace.plans.base import POSE, pose, query, table
from kinetrace.plans.session_queries import _PAIR_FRAMES, _pairs
from kinetrace.schema import BODY_PARTS
from kinetrace.sources import sinks, tracking
from kinetrace.sources.stage import shared_folder

#: Frames of a session whose lines make one picture.
TOGETHER = 4
_KEYS = ["session", "picture"]
_ENDS = [(f"{a}_{i}", f"{b}_{i}") for i in (1, 2) for a, b in zip(BODY_PARTS, BODY_PARTS[1:], strict=False)]


def segments(spark, sf_dir):
    """Lines of pictures: session, picture, end points, length and angle from 0 to below 180."""
    line = lambda a, b: F.struct(*[F.round(F.col(f"{p}_{c}"), 3).alias(f"{c}{k}") for k, p in ((1, a), (2, b)) for c in "xy"])
    df = pose(spark, sf_dir).select("session", F.floor(F.col("frame_idx") / TOGETHER).alias("picture"), F.explode(F.array(*[line(a, b) for a, b in _ENDS])).alias("l")).select(*_KEYS, "l.*")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    turned = F.round(F.degrees(F.atan2(dy, dx)), 6)
    turned = F.when(turned < 0, turned + 180).otherwise(turned)
    return df.withColumns({"length": F.round(F.sqrt(dx * dx + dy * dy), 6), "angle": F.when(turned >= 180, turned - 180).otherwise(turned)})


def _segments_sql() -> str:
    one = lambda a, b: f"SELECT session, frame_idx // {TOGETHER} AS picture, round({a}_x, 3) AS x1, round({a}_y, 3) AS y1, round({b}_x, 3) AS x2, round({b}_y, 3) AS y2 FROM pose"
    return f"""{POSE}, s0 AS ({' UNION ALL '.join(one(a, b) for a, b in _ENDS)}),
s1 AS (SELECT *, round(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 6) AS length, round(degrees(atan2(y2 - y1, x2 - x1)), 6) AS d FROM s0),
s2 AS (SELECT *, CASE WHEN d < 0 THEN d + 180 ELSE d END AS t FROM s1), seg AS (SELECT * EXCLUDE (d, t), CASE WHEN t >= 180 THEN t - 180 ELSE t END AS angle FROM s2)"""


def _apart(a: str, b: str) -> str:
    return f"least(abs({a} - {b}), 180 - abs({a} - {b}))"


_WIDTH = 180.0 / L.BINS
_DIRECTIONS = f"""WITH {_segments_sql()}, bw AS (SELECT session, picture, least(CAST(floor(angle / {_WIDTH}) AS INT), {L.BINS - 1}) AS bin, sum(length * length) AS w, count(*) AS n FROM seg GROUP BY ALL),
tot AS (SELECT session, picture, sum(w) AS w FROM bw GROUP BY ALL HAVING sum(n) >= 4),
sh AS (SELECT g.session, g.picture, g.bin, coalesce(bw.w, 0.0) / g.w AS v FROM (SELECT tot.*, CAST(b AS INT) AS bin FROM tot, range({L.BINS}) r(b)) g LEFT JOIN bw ON bw.session = g.session AND bw.picture = g.picture AND bw.bin = g.bin),
ws(k, w) AS (VALUES {', '.join(f'({k}, {w!r})' for k, w in zip(range(-L.REACH, L.REACH + 1), L.smoothing(), strict=True))}),
sm AS (SELECT session, picture, (bin - k + {L.BINS}) % {L.BINS} AS bin, round(sum(v * ws.w), 9) AS v FROM sh, ws GROUP BY ALL),
pk AS (SELECT a.session, a.picture, a.v, (a.bin + 0.5) * {_WIDTH} AS at_ FROM sm a JOIN sm b ON b.session = a.session AND b.picture = a.picture AND b.bin = (a.bin + {L.BINS - 1}) % {L.BINS}
  JOIN sm c ON c.session = a.session AND c.picture = a.picture AND c.bin = (a.bin + 1) % {L.BINS} WHERE a.v > b.v AND a.v > c.v AND a.v > {L.LEAST_PEAK}),
pr AS (SELECT *, row_number() OVER (PARTITION BY session, picture ORDER BY v DESC, at_ DESC) AS i FROM pk QUALIFY i <= {L.PEAKS}),
pp AS (SELECT p.session, p.picture, p.i, q.i AS j, p.at_ AS a1, q.at_ AS a2, (p.v + q.v) * (1 - (90 - {_apart('p.at_', 'q.at_')}) / {L.OFF}) AS score FROM pr p JOIN pr q ON p.session = q.session AND p.picture = q.picture AND p.i < q.i
  WHERE {_apart('p.at_', 'q.at_')} >= {90 - L.OFF}),
dirs AS (SELECT session, picture, a1 AS angle_1, a2 AS angle_2 FROM pp WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY session, picture ORDER BY score DESC, i, j) = 1)"""


@query(f"{_DIRECTIONS} SELECT * FROM dirs")
def line_directions(spark, sf_dir):
    """The two dominant directions of each picture's lines."""
    return L.directions(segments(spark, sf_dir), _KEYS)


def _clusters_sql() -> str:
    a, b = _apart("angle", "angle_1"), _apart("angle", "angle_2")
    of = lambda most: f"CASE WHEN {a} < {b} AND {a} < {most} THEN 1 WHEN {b} <= {a} AND {b} < {most} THEN 2 END"
    mean = "CASE WHEN max(angle) - min(angle) > 90 THEN sum(CASE WHEN angle > 90 THEN angle - 180 ELSE angle END * length) / sum(length) ELSE sum(angle * length) / sum(length) END"
    m = [f"max(CASE WHEN cluster = {k} THEN CASE WHEN mean < 0 THEN mean + 180 ELSE mean END END)" for k in (1, 2)]
    return f"""{_DIRECTIONS}, ne AS (SELECT seg.*, {of(L.NEAR)} AS near, {of(1.5 * L.NEAR)} AS wide FROM seg JOIN dirs USING (session, picture)),
cl AS (SELECT session, picture, angle, length, CASE WHEN least(count(*) FILTER (near = 1) OVER k, count(*) FILTER (near = 2) OVER k) < {L.LEAST_LINES} THEN wide ELSE near END AS cluster FROM ne WINDOW k AS (PARTITION BY session, picture)),
mc AS (SELECT session, picture, cluster, count(*) AS n, {mean} AS mean FROM cl WHERE cluster IS NOT NULL GROUP BY ALL)
SELECT session, picture, coalesce(max(n) FILTER (cluster = 1), 0) AS n_1, coalesce(max(n) FILTER (cluster = 2), 0) AS n_2, round(coalesce({_apart(*m)}, 90), 4) AS angle_between
FROM (SELECT DISTINCT session, picture FROM cl) LEFT JOIN mc USING (session, picture) GROUP BY session, picture"""


@query(_clusters_sql())
def line_clusters(spark, sf_dir):
    """Lines near each of a picture's directions, and the degrees between their means."""
    found = L.cluster_angles(L.clustered(segments(spark, sf_dir), _KEYS), _KEYS)
    return found.withColumn("angle_between", F.round("angle_between", 4))


@query("""WITH p AS (SELECT label, CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS v, unnest(range(len(embedding))) AS position FROM embeddings)
SELECT label, CAST(position AS INT) AS position, CAST(floor(median(v)) AS INT) AS middle, CAST(floor(avg(v)) AS INT) AS mean FROM p GROUP BY label, position""")
def pixel_backgrounds(spark, sf_dir):
    """The median and the mean of each pixel over all frames of a label."""
    e = table(spark, sf_dir, "embeddings").select("label", F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("pixels"))
    middle, mean = (L.pixel_background(e, ["label"], median=m).withColumnRenamed("value", n) for m, n in ((True, "middle"), (False, "mean")))
    key = [middle["label"].eqNullSafe(mean["label"]), middle["position"] == mean["position"]]
    return middle.join(mean, key).select(middle["label"], middle["position"], "middle", "mean")


@query("SELECT 'v' || page_id AS video, CASE WHEN page_id % 3 > 0 THEN page_id * 2 ELSE page_id END AS x FROM pages")
def saved_corners(spark, sf_dir):
    """A store of drawn corners after new ones replaced some of the old and were added."""
    p = table(spark, sf_dir, "pages")
    some = lambda rows, times: rows.select(F.concat(F.lit("v"), F.col("page_id")).alias("video"), F.array(F.array(F.col("page_id") * times, F.lit(1))).alias("corners"))
    both = tracking.saved_zones(some(p.where("page_id % 3 < 2"), 1), some(p.where("page_id % 3 > 0"), 2))
    return both.select("video", F.get(F.get("corners", F.lit(0)), F.lit(0)).alias("x"))


@query(f"{_PAIR_FRAMES} SELECT session, animal, CAST(sum(slow::INT) AS BIGINT) AS slow, sum(value) AS total FROM p GROUP BY session, animal")
def result_files(spark, sf_dir):
    """Results of each animal written as CSV, a folder for each, and read back."""
    path = f"{shared_folder(spark)}/results"
    made = _pairs(spark, sf_dir).groupBy("session", "animal").agg(F.sum(F.col("slow").cast("int")).alias("slow"), F.sum("value").alias("total"))
    sinks.write_results(made, path)
    return spark.read.schema("session bigint, slow bigint, total double, animal int").option("header", "true").csv(path)


def _outermost_sql() -> str:
    a, b = _apart("angle", "angle_1"), _apart("angle", "angle_2")
    of = lambda most: f"CASE WHEN {a} < {b} AND {a} < {most} THEN 1 WHEN {b} <= {a} AND {b} < {most} THEN 2 END"
    share, over = {"low": "high - pos", "high": "pos - low"}, "PARTITION BY session, picture, cluster"
    edge = {"low": f"pos <= low + (high - low) * {L.OUTER}", "high": f"pos >= low + (high - low) * {1 - L.OUTER}"}
    ends = ", ".join(f"max({c}) FILTER ({s}_k = 1) AS {s}_{c}" for s in share for c in ("x1", "y1", "x2", "y2"))
    rank = ", ".join(f"row_number() OVER ({over} ORDER BY CASE WHEN {edge[s]} THEN 0 ELSE 1 END, length * (0.7 + 0.3 * ({share[s]}) / (high - low + 1)) DESC, pos) AS {s}_k" for s in share)
    return f"""{_DIRECTIONS}, ne AS (SELECT seg.*, {of(L.NEAR)} AS near, {of(1.5 * L.NEAR)} AS wide FROM seg JOIN dirs USING (session, picture)),
cl AS (SELECT * EXCLUDE (near, wide), CASE WHEN least(count(*) FILTER (near = 1) OVER k, count(*) FILTER (near = 2) OVER k) < {L.LEAST_LINES} THEN wide ELSE near END AS cluster FROM ne WINDOW k AS (PARTITION BY session, picture)),
o1 AS (SELECT *, CASE WHEN max(angle) OVER k - min(angle) OVER k > 90 AND angle > 90 THEN angle - 180 ELSE angle END AS turned, length >= max(length) OVER k * {L.LEAST_LENGTH} AS long_ FROM cl WHERE cluster IS NOT NULL WINDOW k AS ({over})),
o2 AS (SELECT *, avg(turned) OVER k + CASE WHEN avg(turned) OVER k < 0 THEN 180 ELSE 0 END AS mean, count(*) OVER k AS n, count(*) FILTER (long_) OVER k AS n_long FROM o1 WINDOW k AS ({over})),
o3 AS (SELECT *, CASE WHEN mean < 45 OR mean > 135 THEN y1 + y2 ELSE x1 + x2 END / 2 AS pos FROM o2 WHERE n >= 2 AND (long_ OR n_long < 2)),
o4 AS (SELECT *, min(pos) OVER k AS low, max(pos) OVER k AS high FROM o3 WINDOW k AS ({over})),
o5 AS (SELECT *, {rank} FROM o4)
SELECT session, picture, cluster, {ends} FROM o5 GROUP BY session, picture, cluster"""


@query(_outermost_sql())
def outermost_lines(spark, sf_dir):
    """The outermost lines of each direction of each picture."""
    found = L.outermost(L.clustered(segments(spark, sf_dir), _KEYS), _KEYS)
    return found.select(*_KEYS, "cluster", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("low", "high") for c in ("x1", "y1", "x2", "y2")])
