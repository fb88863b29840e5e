"""Queries that write the given tables in the formats of a recording's files and read them back, and scoring sheets made of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinetrace.functions import geometry as G
from kinetrace.operators import correct, reshape
from kinetrace.plans.base import FRAMES, POSE, frames, pose, query, table
from kinetrace.plans.session_queries import _correct_sql, identity_correction
from kinetrace.schema import BODY_PARTS
from kinetrace.sources import events, sinks, tracking, video
from kinetrace.sources.stage import shared_folder

#: Folders of frame times: tracks are short and many.
FOLDERS = 64
_VALUES = [(f"{p}_{a}", f"{p}_{{i}}_{'p' if a == 'score' else a}") for p in BODY_PARTS for a in ("x", "y", "score")]
_POSES = " UNION ALL ".join(f"SELECT session, frame_idx, {i - 1} AS track, {', '.join(f'{c.format(i=i)} AS {n}' for n, c in _VALUES)} FROM pose" for i in (1, 2))


@query(f"WITH {POSE}, p AS ({_POSES}) SELECT session, frame_idx, track, {', '.join(f'CASE WHEN (frame_idx + track) % 5 > 0 THEN {n} END AS {n}' for n, _ in _VALUES)} FROM p")
def pose_files(spark, sf_dir):
    """Poses of both animals, every fifth without values, written as CSV and read by the pose reader."""
    wide, path = pose(spark, sf_dir), f"{shared_folder(spark)}/poses"
    rows = [wide.select("session", "frame_idx", F.lit(i - 1).alias("track"), *[F.col(c.format(i=i)).alias(n) for n, c in _VALUES]) for i in (1, 2)]
    long = rows[0].unionByName(rows[1])
    sinks.write_pose_csv(long.withColumns({n: F.when((F.col("frame_idx") + F.col("track")) % 5 > 0, F.col(n)) for n, _ in _VALUES}), path, ["session"])
    return tracking.poses(spark, path).drop("source")


@query(f"WITH {FRAMES} SELECT track, frame_idx, CAST(format('{{:.6f}}', pts) AS DOUBLE) AS pts_seconds FROM fr")
def frame_time_files(spark, sf_dir):
    """Frame times of all tracks, written as CSV and read back."""
    path = f"{shared_folder(spark)}/times"
    sinks.write_frame_times(frames(spark, sf_dir).withColumnRenamed("pts", "pts_seconds"), path, ["track"], FOLDERS)
    read = spark.read.option("header", "true").csv(path)
    return read.select(F.col("track").cast("long").alias("track"), F.col("frame_idx").cast("long").alias("frame_idx"), F.col("pts_seconds").cast("double").alias("pts_seconds"))


_CORNERS = ("nose", "ear_left", "ear_right", "head")


@query(
    f"WITH {POSE} SELECT session, frame_idx, {', '.join(f'{p}_{i}_{a} AS {z}_{a}{k}' for i, z in ((1, 'floor'), (2, 'nest')) for k, p in enumerate(_CORNERS, 1) for a in 'xy')}, "
    "body_center_1_x AS loom_x, body_center_1_y AS loom_y, abs(body_center_2_x) AS loom_radius FROM pose"
)
def zone_records(spark, sf_dir):
    """Zones written as the text of zone files and read by the zone reader."""
    corners = lambda i: F.array(*[F.array(*G.point(f"{p}_{i}")) for p in _CORNERS])
    text = sinks.zone_record(corners(1), corners(2), F.array(*G.point("body_center_1")), F.abs(F.col("body_center_2_x")))
    made = tracking.zone_columns(F.col("text"))
    written = pose(spark, sf_dir).select("session", "frame_idx", text.alias("text"))
    return written.select("session", "frame_idx", *[c.alias(n) for n, c in made.items()])


# Scoring sheets: a user's events are a sheet's rows; errors name an animal and begin its section, other text ends one.

_ANIMAL = "CASE event_type WHEN 'error' THEN CASE event_id % 3 WHEN 0 THEN 'animal 150' WHEN 1 THEN 'animal 151' ELSE 'notes' END END"
_SHEET = f"sh AS (SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) AS row, {_ANIMAL} AS head, event_id % 9 AS loom, value, event_id FROM events)"


def _sheet(spark, sf_dir):
    order = F.expr("row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)") - 1
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("source"), F.lit("L1").alias("sheet"), order.cast("int").alias("row"), F.expr(_ANIMAL).alias("head"), "event_id", "value")
    # Of ten events one has no time and one a text in its place.
    time = F.when(F.col("event_id") % 10 == 3, F.lit(None)).when(F.col("event_id") % 10 == 7, F.lit("?")).otherwise((F.col("value") - 5).cast("string"))
    cells = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")) for k, v in ((0, F.col("head")), (1, F.col("event_id") % 9), (4, time), (17, F.col("value")), (26, F.col("value") * 2))]), lambda c: c["v"].isNotNull()))
    return e.select("source", "sheet", "row", cells.alias("cells"))


@query(
    f"""WITH {_SHEET}, f AS (SELECT *, min(CASE WHEN head LIKE '%150%' OR head LIKE '%151%' THEN row END) FILTER (row > 0) OVER (PARTITION BY user_id) AS first,
  CASE event_id % 10 WHEN 3 THEN 0 WHEN 7 THEN NULL ELSE value - 5 END AS t FROM sh),
g AS (SELECT *, max(CASE WHEN t IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY row) AS ended FROM f WHERE row > first AND row <= first + 6)
SELECT CAST(user_id AS VARCHAR) AS source, 'loom_' || row_number() OVER (PARTITION BY user_id ORDER BY row) AS event_id, 'loom' AS event_type, t AS time_start, CAST(NULL AS DOUBLE) AS time_end FROM g WHERE ended = 0 AND t > 0"""
)
def scoring_sheet_events(spark, sf_dir):
    """Looms of every user's sheet: the rows after the first that names an animal."""
    return events.sheet_events(_sheet(spark, sf_dir), "L1", ["150", "151"], keys=["source"])


@query(
    f"""WITH {_SHEET}, s AS (SELECT *, last_value(head IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY row) AS section FROM sh)
SELECT CAST(user_id AS VARCHAR) AS source, CAST(loom AS INT) AS loom, arg_max(value, row) AS latency, arg_max(value * 2, row) AS time_in_nest FROM s WHERE section LIKE '%150%' GROUP BY user_id, loom"""
)
def scoring_sheet_scores(spark, sf_dir):
    """Manual scores in one animal's sections of every user's sheet; the last row of a loom holds."""
    return events.sheet_scores(_sheet(spark, sf_dir), "L1", "150", ["source"])


@query(
    f"""WITH {_SHEET}, e AS (SELECT user_id, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events)
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS logs, round(sum(value), 2) AS total FROM e GROUP BY event_type"""
)
def collected_logs(spark, sf_dir):
    """Events of all users' logs, written as CSV, one folder for each type of event, and collected through the registry of sources by name; an unknown type of source is passed over."""
    path = f"{shared_folder(spark)}/logs"
    e = table(spark, sf_dir, "events").select("event_type", F.col("event_type").alias("what"), "user_id", F.col("value").cast("string").alias("timestamp"))
    e.write.partitionBy("event_type").option("header", "true").csv(path)
    kinds = [r[0] for r in e.select("event_type").distinct().collect()]  # a handful of types
    sources = [{"type": "bonsai_csv", "path": f"{path}/event_type={k}", "event_type_column": "what", "session": {"kind": k}} for k in kinds] + [{"type": "unknown", "path": "nowhere"}]
    users = e.groupBy("event_type").agg(F.countDistinct("user_id").alias("logs"))
    found = events.collect(spark, sources).where(F.col("event_type") == F.col("kind")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("time_start"), 2).alias("total"))
    return found.join(users, "event_type").select("event_type", "n", "logs", "total")


# Folders of sessions, and the reports and tables of a whole analysis.

_PLACES = ("(user_id % 5)", "'D' || (user_id % 3)", "CASE user_id % 4 WHEN 0 THEN 'mkv' WHEN 1 THEN 'mp4' WHEN 2 THEN 'csv' ELSE 'avi' END")
_RANK = "CASE ending WHEN 'mp4' THEN 1 WHEN 'avi' THEN 2 WHEN 'mov' THEN 3 ELSE 4 END"


def _tree(spark, sf_dir, name: str) -> str:
    """A small file for each user of the event table, in folders of identities and days."""
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    identity, day, ending = (F.expr(e) for e in _PLACES)
    base = f"{shared_folder(spark)}/{name}"
    path = F.concat(F.lit("TRAP"), identity, F.lit("/"), day, F.lit("/raw_data/u"), F.col("user_id"), F.lit("."), ending)
    video.write_files(users.select(path.alias("name"), F.col("n").cast("string").alias("content")), base, "name", "content")
    return base


@query(f"""WITH f AS (SELECT DISTINCT 'TRAP' || {_PLACES[0]} AS identity, {_PLACES[1]} AS day, 'u' || user_id AS stem, {_PLACES[2]} AS ending FROM events)
SELECT identity, day, arg_min(stem, ({_RANK}) || stem) AS video_stem, arg_min(ending, ({_RANK}) || stem) AS ending FROM f WHERE ending <> 'csv' GROUP BY identity, day""")
def session_folders(spark, sf_dir):
    """Sessions found in a tree of folders, each with the video of its preferred ending."""
    found = tracking.samples(spark, _tree(spark, sf_dir, "sessions"))
    return found.select("identity", "day", "video_stem", F.regexp_extract("video_path", r"([^.]+)$", 1).alias("ending"))


@query(f"SELECT DISTINCT {_PLACES[1]} AS day, CAST(user_id AS VARCHAR) AS user_id FROM events WHERE {_PLACES[2]} IN ('csv', 'avi') AND user_id % 2 = 0 OR {_PLACES[2]} = 'avi' AND user_id % 10 = 7")
def matching_files(spark, sf_dir):
    """Files anywhere in a tree by a pattern of their names."""
    pattern = r"(?:D\d/raw_data/u\d*[02468]\.(?:csv|avi))|(?:D\d/raw_data/u\d*7\.avi)"
    found = tracking.matching_files(spark, _tree(spark, sf_dir, "tree"), pattern)
    return found.select(F.regexp_extract("path", r"/(D\d)/", 1).alias("day"), F.regexp_extract("path", r"/u(\d+)\.", 1).alias("user_id"))


_TABLE = [f"{p}_1_{a}" for p in BODY_PARTS for a in "xyp"]


@query(f"WITH {POSE} SELECT session, frame_idx, {', '.join(f'round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 6) AS {c}' for c in _TABLE)} FROM pose")
def feature_files(spark, sf_dir):
    """A feature table written as floats in CSV, a folder for each session, and scanned again."""
    path = f"{shared_folder(spark)}/features"
    sinks.write_features(pose(spark, sf_dir).select("session", "frame_idx", *_TABLE), path, ["session"], csv=True)
    read = tracking.features(spark, path)
    return read.select(F.col("session").cast("long").alias("session"), F.col("frame_idx").cast("long").alias("frame_idx"), *[F.round(F.col(c).cast("float").cast("double"), 6).alias(c) for c in _TABLE])


@query(f"""WITH {FRAMES} SELECT CAST(event_id AS VARCHAR) AS event_id, kind AS event_type, format('{{:.6f}}', value / 64) AS time_start, CASE WHEN gappy IS NOT NULL THEN format('{{:.6f}}', gappy / 64 + 1) END AS time_end,
frame_idx AS frame_start, CASE WHEN gappy IS NOT NULL THEN frame_idx + 30 END AS frame_end, '0.000000' AS frame_error_start, CAST(NULL AS VARCHAR) AS frame_error_end FROM fr""")
def event_files(spark, sf_dir):
    """Converted events written as CSV with six decimals, blank where missing, and read as text."""
    path, end = f"{shared_folder(spark)}/events", F.when(F.col("gappy").isNotNull(), F.col("frame_idx") + 30)
    f = frames(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_id"), F.col("kind").alias("event_type"), (F.col("value") / 64).alias("time_start"), (F.col("gappy") / 64 + 1).alias("time_end"),
        F.col("frame_idx").alias("frame_start"), end.alias("frame_end"), F.lit(0.0).alias("frame_error_start"), F.lit(None).cast("double").alias("frame_error_end"),
    )
    sinks.write_events(f, path)
    read = spark.read.option("header", "true").csv(path)
    return read.withColumns({c: F.col(c).cast("long") for c in ("frame_start", "frame_end")})


@query(f"""SELECT track, count(*) AS total, count(*) FILTER (swapped) AS swapped, CAST(sum(swap_before) AS BIGINT) AS changes,
coalesce(string_agg(loom, ',' ORDER BY loom) FILTER (swap_before = 1), '') AS begins FROM ({_correct_sql()}) GROUP BY track""")
def correction_reports(spark, sf_dir):
    """Reports of corrected identities written as lines of JSON and read back."""
    path = f"{shared_folder(spark)}/reports"
    made = correct.report(identity_correction(spark, sf_dir), ["track"])
    sinks.write_json(made.select(F.to_json(F.struct("track", "report")).alias("report")), path)
    line = F.from_json("value", "track long, report string").alias("l")
    body = F.from_json("l.report", "total long, swapped long, changes long, events array<struct<loom: long, begins: boolean>>").alias("b")
    read = spark.read.text(path).select(line).select("l.track", body)
    starts = F.transform(F.filter("b.events", lambda e: e["begins"]), lambda e: e["loom"].cast("string"))
    return read.select("track", "b.total", "b.swapped", "b.changes", F.array_join(starts, ",").alias("begins"))


@query("""SELECT page_id, CASE WHEN page_id % 4 > 0 THEN round((20 + page_id % 50) / (1 + page_id % 3), 6) ELSE 29.595 END AS fps, CASE WHEN page_id % 7 > 0 THEN round(30000 / (1000.0 + page_id % 3), 6) END AS fps_nominal,
CAST(640 + page_id % 9 AS INT) AS width, CASE WHEN page_id % 5 > 0 THEN page_id / 8 END AS crop_x, page_id % 2 = 1 AS rotated FROM pages""")
def metadata_files(spark, sf_dir):
    """Metadata written as JSON, one file's text for each page, and read with the default rate where there is none."""
    path, k = f"{shared_folder(spark)}/metadata", F.col("page_id")
    made = table(spark, sf_dir, "pages").select(
        k, (640 + k % 9).alias("width"), F.when(k % 4 > 0, (20 + k % 50) / (1 + k % 3)).alias("fps"), F.when(k % 7 > 0, F.concat(F.lit("30000/"), 1000 + k % 3)).alias("fps_nominal"),
        F.when(k % 5 > 0, F.struct((k / 8).alias("x"))).alias("crop_offset"), F.struct((k % 2 == 1).alias("applied")).alias("rotation_correction"),
    )
    text = sinks.as_json(made, ["page_id"])
    video.write_files(text.select(F.concat(k.cast("string"), F.lit(".json")).alias("name"), F.col("report").alias("content")), path, "name", "content")
    read = tracking.metadata(spark, path)
    page = F.regexp_extract("source", r"(\d+)\.json$", 1).cast("long")
    return read.select(page.alias("page_id"), F.round("fps", 6).alias("fps"), F.round("fps_nominal", 6).alias("fps_nominal"), "width", F.col("crop_offset.x").alias("crop_x"), F.col("rotation_correction.applied").alias("rotated"))


@query(f"WITH {FRAMES} SELECT track, frame_idx, kind FROM fr WHERE frame_idx < 60 AND frame_idx % 7 = 0")
def sampled_frames(spark, sf_dir):
    """Every seventh of the first sixty frames, the rule by which background frames are picked."""
    return tracking.sampled_frames(frames(spark, sf_dir), 60, 7).select("track", "frame_idx", "kind")


@query("""WITH e AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS position FROM events WHERE event_type IN ('view', 'click'))
SELECT user_id, CAST(position AS INT) AS position, max(CASE WHEN event_type = 'view' THEN value END) AS views, max(CASE WHEN event_type = 'click' THEN value END) AS clicks FROM e GROUP BY user_id, position""")
def ragged_columns(spark, sf_dir):
    """Lists of unlike length side by side, null beyond the shorter one's end."""
    e = table(spark, sf_dir, "events").where("event_type in ('view', 'click')")
    of = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col("event_type") == k, F.struct("ts", "event_id", "value")))), lambda s: s["value"])
    return sinks.ragged(e.groupBy("user_id").agg(of("view").alias("views"), of("click").alias("clicks")), ["user_id"])


@query("""WITH t AS (SELECT user_id, event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 4 THEN 1 ELSE 0 END AS track FROM events)
SELECT user_id, event_id, CAST(track AS INT) AS track FROM (SELECT *, count(DISTINCT track) OVER (PARTITION BY user_id) AS n FROM t) WHERE n <= 1 OR track = 0 OR track IS NULL""")
def single_tracks(spark, sf_dir):
    """Rows of single animals without their spurious second tracks."""
    track = F.expr("CASE event_id % 5 WHEN 0 THEN NULL WHEN 4 THEN 1 ELSE 0 END")
    return reshape.check_tracks(table(spark, sf_dir, "events").select("user_id", "event_id", track.cast("int").alias("track")), ["user_id"], "single")
