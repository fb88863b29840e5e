"""The driver's tables seen as tracking data, in Spark and in DuckDB SQL.

``events``: a user is a track, an event a frame, its value a signal. In
``embeddings`` a label is a session, a vector a frame, and its numbers are the
points of two animals and their probabilities.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinetrace.operators.track import Track
from kinetrace.schema import BODY_PARTS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TRACK = Track(("track",))
SESSION = Track(("session",))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL."""

    def take(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return take


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """track, frame_idx (from 0), pts, event_id, kind, value, and gappy (value with holes)."""
    e = table(spark, sf_dir, "events")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    pts = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)") / 1e6
    hole = (F.col("event_id") % 7).isin(1, 2, 3) | (F.col("event_id") % 11 == 0)
    e = e.withColumn("value", F.round(F.col("value") * 100))  # whole numbers: sums do not depend on their order
    e = e.withColumn("frame_idx", (F.row_number().over(order) - 1).cast("long"))  # before the new name, so that later windows reuse its shuffle
    return e.select(F.col("user_id").alias("track"), "frame_idx", pts.alias("pts"), "event_id", F.col("event_type").alias("kind"), "value", F.when(~hole, F.col("value")).alias("gappy"))


FRAMES = """fr AS (SELECT user_id AS track, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS frame_idx,
  epoch_us(ts) / 1e6 AS pts, event_id, event_type AS kind, round(value * 100) AS value,
  CASE WHEN event_id % 7 IN (1, 2, 3) OR event_id % 11 = 0 THEN NULL ELSE round(value * 100) END AS gappy FROM events)"""

#: Numbers of the vector: x and y of six points of each animal, then their probabilities.
_XY = {(p, i): 12 * (i - 1) + 2 * k for i in (1, 2) for k, p in enumerate(BODY_PARTS)}
_P = {(p, i): 24 + 6 * (i - 1) + k for i in (1, 2) for k, p in enumerate(BODY_PARTS)}


def pose(spark: SparkSession, sf_dir: str, animals: int = 2) -> DataFrame:
    """session, frame_idx (from 0) and wide pose of one or two animals."""
    return pose_of(table(spark, sf_dir, "embeddings"), animals)


def pose_of(vectors: DataFrame, animals: int = 2) -> DataFrame:
    """Wide poses from rows of ``embeddings``."""
    e = vectors.withColumn("frame_idx", (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).cast("long"))
    v = lambda k: F.get("embedding", F.lit(k)).cast("double")
    columns = []
    for i in range(1, animals + 1):
        for p in BODY_PARTS:
            k = _XY[p, i]
            columns += [(200 + 600 * v(k)).alias(f"{p}_{i}_x"), (200 + 600 * v(k + 1)).alias(f"{p}_{i}_y"), F.least(F.lit(1.0), F.abs(v(_P[p, i]))).alias(f"{p}_{i}_p")]
    return e.select(F.col("label").alias("session"), "frame_idx", *columns)


def _pose_sql() -> str:
    v = lambda k: f"CAST(embedding[{k + 1}] AS DOUBLE)"
    columns = []
    for i in (1, 2):
        for p in BODY_PARTS:
            k = _XY[p, i]
            columns += [f"200 + 600 * {v(k)} AS {p}_{i}_x", f"200 + 600 * {v(k + 1)} AS {p}_{i}_y", f"least(1.0, abs({v(_P[p, i])})) AS {p}_{i}_p"]
    return f"pose AS (SELECT label AS session, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS BIGINT) AS frame_idx, {', '.join(columns)} FROM embeddings)"


POSE = _pose_sql()


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, which makes sums in another order equal."""
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if kind == "double" else F.col(f"`{c}`") for c, kind in df.dtypes])


def r(sql: str, name: str, digits: int = 4) -> str:
    return f'round({sql}, {digits}) AS "{name}"'


# Geometry in SQL, written apart from the library's expressions.


def sql_distance(a: tuple[str, str], b: tuple[str, str]) -> str:
    return f"sqrt(({a[0]} - {b[0]}) * ({a[0]} - {b[0]}) + ({a[1]} - {b[1]}) * ({a[1]} - {b[1]}))"


def sql_point(prefix: str) -> tuple[str, str]:
    return f"{prefix}_x", f"{prefix}_y"


def sql_angle(a: tuple[str, str], v: tuple[str, str], c: tuple[str, str]) -> str:
    turn = f"degrees(atan2({c[1]} - {v[1]}, {c[0]} - {v[0]}) - atan2({a[1]} - {v[1]}, {a[0]} - {v[0]}))"
    return f"(CASE WHEN {turn} < 0 THEN {turn} + 360 ELSE {turn} END)"


def sql_between(p, q, r_, s) -> str:
    dot = f"(({q[0]} - {p[0]}) * ({s[0]} - {r_[0]}) + ({q[1]} - {p[1]}) * ({s[1]} - {r_[1]}))"
    return f"coalesce(degrees(acos(greatest(-1.0, least(1.0, {dot} / nullif({sql_distance(p, q)} * {sql_distance(r_, s)}, 0))))), 0.0)"


def sql_facing(nose, body, target, limit: float = 45.0) -> str:
    return f"(CASE WHEN {sql_distance(body, nose)} > 0 AND {sql_distance(nose, target)} > 0 AND {sql_between(body, nose, nose, target)} <= {limit} THEN 1 ELSE 0 END)"


def sql_in_polygon(p, corners) -> str:
    parts = []
    for (ax, ay), (bx, by) in zip(corners, [*corners[1:], corners[0]], strict=True):
        line = f"({p[1]} - {ay}) * ({bx} - {ax}) / nullif({by} - {ay}, 0) + {ax}"
        parts.append(f"(CASE WHEN {p[1]} > least({ay}, {by}) AND {p[1]} <= greatest({ay}, {by}) AND {p[0]} <= greatest({ax}, {bx}) AND ({ax} = {bx} OR {p[0]} <= {line}) THEN 1 ELSE 0 END)")
    return f"(({' + '.join(parts)}) % 2)"


def sql_segment(p, a, b) -> str:
    dx, dy = f"({b[0]} - {a[0]})", f"({b[1]} - {a[1]})"
    t = f"greatest(0.0, least(1.0, coalesce((({p[0]} - {a[0]}) * {dx} + ({p[1]} - {a[1]}) * {dy}) / nullif({dx} * {dx} + {dy} * {dy}, 0), 0.0)))"
    return sql_distance(p, (f"({a[0]} + {t} * {dx})", f"({a[1]} + {t} * {dy})"))
