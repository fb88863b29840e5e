"""Queries over images, with their SQL: a label's vectors, one below the other, are an image's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinetrace.functions import geometry as G
from kinetrace.operators import pixels, voting
from kinetrace.plans.base import POSE, pose, query, sql_in_polygon, table
from kinetrace.sources.stage import shared_folder, stored

#: Rows of a tile: several for each image of the smallest tables.
TILE = 16
_SCALE, _ON, _LOW, _HIGH, _RADIUS = 512.0, 190, 120, 220, 4


def image(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    y = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    return e.select(F.col("label").alias("image"), y.cast("long").alias("y"), pixels.number("embedding", _SCALE).alias("values"))


IMAGE = f"""im AS (SELECT image, y, CAST(unnest(range(0, len(e))) AS BIGINT) AS x, greatest(0, least(255, CAST(floor(CAST(unnest(e) AS DOUBLE) * {_SCALE}) AS BIGINT) + 128)) AS v
  FROM (SELECT label AS image, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS BIGINT) AS y, embedding AS e FROM embeddings))"""


def _along(source: str, into: str, down: bool, make, more: str = "") -> str:
    """A CTE that sees each pixel's neighbours along one axis: ``make`` gets a function from a distance to SQL of the value there."""
    w = "(PARTITION BY image, x ORDER BY y)" if down else "(PARTITION BY image, y ORDER BY x)"
    return f"{into} AS (SELECT *{more}, {make} FROM {source} WINDOW w AS {w})"


def _near(c: str, k: int) -> str:
    """The value k pixels on, or the nearest one within the image."""
    out = c
    for j in range(1, abs(k) + 1):
        out = f"coalesce({'lead' if k > 0 else 'lag'}({c}, {j}) OVER w, {out})"
    return out


def _candidate_sql(low: int, high: int) -> list[str]:
    five = lambda c: " + ".join(f"{w} * {_near(c, k)}" for k, w in zip(range(-2, 3), (1, 4, 6, 4, 1), strict=True))
    side = "coalesce({f}({c}) OVER w, 0)"
    steps = [
        _along("im", "b1", True, f"{five('v')} AS bv"),
        _along("b1", "b2", False, f"({five('bv')} + 128) // 256 AS b"),
        _along("b2", "g1", True, f"{_near('b', -1)} + 2 * b + {_near('b', 1)} AS tall, {_near('b', 1)} - {_near('b', -1)} AS steep"),
        _along("g1", "g2", False, f"{_near('tall', 1)} - {_near('tall', -1)} AS gx, {_near('steep', -1)} + 2 * steep + {_near('steep', 1)} AS gy"),
        "g3 AS (SELECT image, y, x, gx, gy, abs(gx) + abs(gy) AS m FROM g2)",
        _along("g3", "g4", False, f"{side.format(f='lag', c='m')} AS w0, {side.format(f='lead', c='m')} AS e0"),
        _along("g4", "g5", True, ", ".join(f"{side.format(f=f, c=c)} AS {n}" for f, c, n in (("lag", "m", "n0"), ("lead", "m", "s0"), ("lag", "w0", "nw"), ("lag", "e0", "ne"), ("lead", "w0", "sw"), ("lead", "e0", "se")))),
        f"""cand AS (SELECT image, y, x, CASE WHEN m > {low} AND CASE WHEN abs(gy) * 32768 < abs(gx) * 13573 THEN m > w0 AND m >= e0 WHEN abs(gy) * 32768 > abs(gx) * 13573 + abs(gx) * 65536 THEN m > n0 AND m >= s0
  WHEN (gx < 0) <> (gy < 0) THEN m > ne AND m > sw ELSE m > nw AND m > se END THEN CASE WHEN m > {high} THEN 2 ELSE 1 END ELSE 0 END AS c FROM g5)""",
    ]
    return steps


def _labels_sql(mask: str, corners: bool) -> str:
    """CTEs ``on_`` (numbered pixels), and ``lab``: for each the least number that can be reached."""
    near = "abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1" if corners else "abs(a.y - b.y) + abs(a.x - b.x) <= 1"
    return f"""on_ AS MATERIALIZED (SELECT image, y, x, v, y * 10000 + x AS k FROM ({mask})),
adj AS MATERIALIZED (SELECT a.image, a.k AS a, b.k AS b FROM on_ a JOIN on_ b ON a.image = b.image AND b.y BETWEEN a.y - 1 AND a.y + 1 AND {near}),
reach(image, k, r) AS (SELECT image, k, k FROM on_ UNION SELECT reach.image, reach.k, adj.b FROM reach JOIN adj ON adj.image = reach.image AND adj.a = reach.r),
lab AS MATERIALIZED (SELECT image, k, min(r) AS root FROM reach GROUP BY ALL)"""


@query(f"WITH {IMAGE}, {', '.join(_candidate_sql(_LOW, _HIGH))} SELECT image, y, x, CAST(c AS BIGINT) AS value FROM cand WHERE c > 0")
def pixel_edge_candidates(spark, sf_dir):
    found = pixels.edge_candidates(image(spark, sf_dir), _LOW, _HIGH, tile=TILE)
    return found.select("image", "y", F.posexplode("values").alias("x", "value")).where("value > 0").select("image", "y", F.col("x").cast("long").alias("x"), "value")


_EDGES = f"""WITH RECURSIVE {IMAGE}, {', '.join(_candidate_sql(_LOW, _HIGH))}, {_labels_sql('SELECT image, y, x, c AS v FROM cand WHERE c > 0', True)},
edge AS MATERIALIZED (SELECT image, y, x FROM on_ JOIN lab USING (image, k) WHERE (image, root) IN (SELECT (image, root) FROM on_ JOIN lab USING (image, k) WHERE v = 2))"""


@query(f"{_EDGES} SELECT image, y, x FROM edge")
def pixel_edges(spark, sf_dir):
    return pixels.cells(pixels.edges(image(spark, sf_dir), _LOW, _HIGH, tile=TILE), ["image"])


@query(
    f"""WITH RECURSIVE {IMAGE}, {_labels_sql(f'SELECT image, y, x, v FROM im WHERE v >= {_ON}', True)}
SELECT image, min(k) // 10000 AS first_y, min(k) % 10000 AS first_x, count(*) AS area, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, round(avg(x), 6) AS center_x, round(avg(y), 6) AS center_y, max(v) AS peak
FROM on_ JOIN lab USING (image, k) GROUP BY image, root"""
)
def pixel_regions(spark, sf_dir):
    mask = image(spark, sf_dir).withColumn("values", F.transform("values", lambda v: F.when(v >= _ON, v).otherwise(0)))
    found = pixels.regions(mask, tile=TILE)
    return found.withColumns({c: F.round(c, 6) for c in ("center_x", "center_y")})


_BOX = """CAST(sum({v}) OVER (PARTITION BY image, {a} ORDER BY {b} ROWS BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS BIGINT)"""


@query(
    f"WITH {IMAGE}, a AS (SELECT *, {_BOX.format(v='v', a='y', b='x', r=_RADIUS)} AS s, {_BOX.format(v='1', a='y', b='x', r=_RADIUS)} AS n FROM im) "
    f"SELECT image, y, x, {_BOX.format(v='s', a='x', b='y', r=_RADIUS)} AS total, {_BOX.format(v='n', a='x', b='y', r=_RADIUS)} AS n FROM a"
)
def pixel_box_sums(spark, sf_dir):
    found = pixels.box_sums(image(spark, sf_dir), _RADIUS, TILE)
    return found.select("image", "y", F.posexplode(F.arrays_zip("sums", "counts")).alias("x", "p")).select("image", "y", F.col("x").cast("long").alias("x"), F.col("p.sums").alias("total"), F.col("p.counts").alias("n"))


@query()
def pixel_smooth_regions(spark, sf_dir):
    """From pixels to boxes of regions where edges are rare; SQL that labels large regions would not end, so a test compares it with a plain version."""
    found = pixels.smooth_regions(image(spark, sf_dir), _RADIUS, 0.1, 20, _LOW, _HIGH, tile=TILE)
    return found.withColumns({c: F.round(c, 6) for c in ("center_x", "center_y")}).drop("peak")


_QUAD = ("nose_1", "ear_left_1", "ear_right_1", "head_1")
_CORNERS = [(f"({p}_x / 16)", f"({p}_y / 16)") for p in _QUAD]


@query(
    f"""WITH {POSE}, grid AS (SELECT CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y FROM (SELECT unnest(range(-20, 50)) AS x), (SELECT unnest(range(-20, 50)) AS y))
SELECT session, frame_idx, count(*) AS cells, sum(x)::BIGINT AS sum_x, sum(y)::BIGINT AS sum_y FROM pose, grid WHERE {sql_in_polygon(('x', 'y'), _CORNERS)} = 1 GROUP BY ALL"""
)
def polygon_mask(spark, sf_dir):
    corners = [tuple(c / 16 for c in G.point(p)) for p in _QUAD]
    found = pixels.cells(pixels.mask_runs(pose(spark, sf_dir), ["session", "frame_idx"], corners), ["session", "frame_idx"])
    return found.groupBy("session", "frame_idx").agg(F.count(F.lit(1)).alias("cells"), F.sum("x").alias("sum_x"), F.sum("y").alias("sum_y"))


_ANGLES, _VOTES, _LENGTH, _GAP = 60, 10, 6, 5
_TURNS = ", ".join(f"({k}, {c}, {s})" for k, (c, s) in enumerate(voting.turns(_ANGLES)))
_LINES = f"""{_EDGES}, tr(angle, c, s) AS (VALUES {_TURNS}),
vo AS MATERIALIZED (SELECT image, y, x, angle, CAST(x * c + y * s + {1 << 13} AS BIGINT) >> 14 AS off, y * c - x * s AS along FROM (SELECT image, CAST(y AS BIGINT) AS y, CAST(x AS BIGINT) AS x FROM edge), tr),
ac AS MATERIALIZED (SELECT image, angle, off, count(*) AS votes FROM vo GROUP BY ALL HAVING count(*) >= {_VOTES}),
li AS MATERIALIZED (SELECT * FROM ac a WHERE NOT EXISTS (SELECT 1 FROM ac b, (SELECT unnest([-1, 0, 1]) AS da) WHERE b.image = a.image AND b.angle = (a.angle + da + {_ANGLES}) % {_ANGLES}
  AND abs(CASE WHEN a.angle + da BETWEEN 0 AND {_ANGLES - 1} THEN b.off - a.off ELSE b.off + a.off END) <= 1 AND (b.votes, -b.angle, -b.off) > (a.votes, -a.angle, -a.off)))"""


@query(f"{_LINES} SELECT image, CAST(angle AS INT) AS angle, off AS offset_, votes FROM li")
def pixel_lines(spark, sf_dir):
    cells = pixels.cells(pixels.edges(image(spark, sf_dir), _LOW, _HIGH, tile=TILE), ["image"])
    return voting.lines(cells, _VOTES, _ANGLES).withColumnRenamed("offset", "offset_")


@query(
    f"""{_LINES}, pl AS (SELECT vo.*, votes, CASE WHEN along - lag(along) OVER w > {_GAP << 14} THEN 1 ELSE 0 END AS cut FROM vo JOIN li USING (image, angle, off) WINDOW w AS (PARTITION BY image, angle, off ORDER BY along, y, x)),
pn AS (SELECT *, sum(cut) OVER (PARTITION BY image, angle, off ORDER BY along, y, x) AS part FROM pl)
SELECT image, CAST(angle AS INT) AS angle, off AS offset_, votes, (min((along, y, x)))[3] AS x1, (min((along, y, x)))[2] AS y1, (max((along, y, x)))[3] AS x2, (max((along, y, x)))[2] AS y2, count(*) AS pixels
FROM pn GROUP BY image, angle, off, votes, part HAVING max(along) - min(along) >= {_LENGTH << 14}"""
)
def pixel_segments(spark, sf_dir):
    # Lines and their pixels both read the edges.
    edges = stored(pixels.edges(image(spark, sf_dir), _LOW, _HIGH, tile=TILE), shared_folder(spark), "edges")
    return voting.segments(pixels.cells(edges, ["image"]), _VOTES, _LENGTH, _GAP, _ANGLES).withColumnRenamed("offset", "offset_")
