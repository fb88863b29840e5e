"""Readers of tracking data: sessions, poses, frame times, zones, metadata, features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetrace.functions.names import fraction
from kinetrace.operators.reshape import track_number
from kinetrace.schema import BODY_PARTS, DEFAULT_FPS, PTS

#: Fixed value: endings of video files, the preferred first.
VIDEO_ENDINGS = ("mp4", "avi", "mov", "mkv")


def matching_files(spark: SparkSession, base: str, pattern: str, names: Sequence[str] = ()) -> DataFrame:
    """Files anywhere below ``base`` whose path from there fits ``pattern`` (to its end): path, and a column for each of its groups.

    Names alone are listed, no file is opened. The pattern begins at the start of a name.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base).select("path")
    whole = f"/({pattern})$"
    return files.where(F.col("path").rlike(whole)).select("path", *[F.regexp_extract("path", whole, k).alias(n) for k, n in enumerate(names, 2)])


def samples(spark: SparkSession, base: str, endings: Sequence[str] = VIDEO_ENDINGS) -> DataFrame:
    """Sessions found as ``base/{identity}/{day}/raw_data/{video}``: identity, day, video_stem, video_path.

    Only file names are listed; of a session's videos the one with the
    preferred ending, then the first name, holds.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join(endings) + "}").load(base).select("path")
    at = r"([^/]+)/([^/]+)/raw_data/([^/]+)\.([^./]+)$"
    found = files.where(F.col("path").rlike(at)).select(*[F.regexp_extract("path", at, k).alias(n) for k, n in enumerate(("identity", "day", "video_stem", "ending"), 1)], F.col("path").alias("video_path"))
    rank = F.array_position(F.array(*[F.lit(e) for e in endings]), F.lower("ending"))
    return found.groupBy("identity", "day").agg(F.min_by(F.struct("video_stem", "video_path"), F.struct(rank, "video_stem")).alias("v")).select("identity", "day", "v.*")


def pose_columns(df: DataFrame) -> DataFrame:
    """Dotted column names as ``{part}_{axis}``; an old ``.p`` is a score; the track becomes a number.

    Missing values, written as NaN or blank, become null.
    """
    plain = df.toDF(*[c.replace(".score", "_score").replace(".p", "_score").replace(".", "_") for c in df.columns])
    values = [f"{p}_{a}" for p in BODY_PARTS for a in ("x", "y", "score") if f"{p}_{a}" in plain.columns]
    number = lambda c: F.nanvl(F.col(c).cast("string").try_cast("double"), F.lit(None).cast("double"))
    others = [c for c in plain.columns if c not in values and c not in ("track", "frame_idx")]
    track = [track_number(F.col("track")).alias("track")] if "track" in plain.columns else [F.lit(None).cast("int").alias("track")]
    return plain.select(*track, F.col("frame_idx").cast("double").cast("long").alias("frame_idx"), *others, *[number(c).alias(c) for c in values])


def poses(spark: SparkSession, path: str | list[str], quote: str = '"') -> DataFrame:
    """Raw poses from CSV: a row for each frame and track; ``source`` is the file they come from."""
    raw = spark.read.option("header", "true").option("quote", quote).csv(path)
    return pose_columns(raw.withColumn("source", F.input_file_name()))


def frame_times(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Frame numbers and seconds from CSV; rows without a number are left out."""
    raw = spark.read.option("header", "true").csv(path)
    return raw.select(F.col("frame_idx").try_cast("long").alias("frame_idx"), F.col("pts_seconds").try_cast("double").alias("pts_seconds")).where("pts_seconds is not null").to(PTS)


def features(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A feature table from CSV whose first column, named or not, is the frame."""
    raw = spark.read.option("header", "true").option("inferSchema", "true").csv(path)
    return raw.withColumnRenamed(raw.columns[0], "frame_idx")


#: The zone file: an array of regions, of which one holds the floor, one the nest, and one the circle (mixed values, kept as text).
_REGIONS = "struct<regions: array<struct<floor: array<array<double>>, nest: array<array<double>>, loom: array<string>>>, corners: array<array<double>>, confidence: double>"


def zone_columns(text: Column) -> dict[str, Column]:
    """Corners of floor and nest, and the circle, from a zone file's text; null where there are none."""
    parsed = F.from_json(text, _REGIONS)
    of = lambda field: F.get(F.filter(F.transform(parsed["regions"], lambda r: r[field]), lambda v: v.isNotNull()), F.lit(0))
    floor = F.coalesce(of("floor"), F.when(parsed["confidence"] > 0, parsed["corners"]))
    nest, loom = of("nest"), of("loom")
    out = {}
    for name, corners in (("floor", floor), ("nest", nest)):
        for k in range(4):
            for axis, j in (("x", 0), ("y", 1)):
                out[f"{name}_{axis}{k + 1}"] = F.get(F.get(corners, F.lit(k)), F.lit(j))
    center = F.from_json(F.get(loom, F.lit(0)), "array<double>")
    return out | {"loom_x": F.get(center, F.lit(0)), "loom_y": F.get(center, F.lit(1)), "loom_radius": F.get(loom, F.lit(1)).try_cast("double")}


def zones(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A row of zone columns for each zone file."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("source"), F.col("value"))
    made = zone_columns(F.col("value"))
    return text.select("source", *[c.alias(n) for n, c in made.items()])


def metadata(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rate, sizes and crop of each metadata file; the rate falls back to the default."""
    kind = "struct<width: int, height: int, fps: double, fps_nominal: string, frame_count: bigint, crop_offset: struct<x: double, y: double, w: double, h: double>, rotation_correction: struct<applied: boolean, correction_angle_deg: double, pad_x: double, pad_y: double>>"
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("source"), F.from_json("value", kind).alias("m"))
    return text.select("source", "m.*").withColumns({"fps": F.coalesce("fps", F.lit(DEFAULT_FPS)), "fps_nominal": fraction(F.col("fps_nominal"))})


def saved_zones(old: DataFrame, new: DataFrame) -> DataFrame:
    """Hand-drawn corners by video, the new ones replacing the old."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return both.groupBy("video").agg(F.max_by("corners", "_new").alias("corners"))


def sampled_frames(frames: DataFrame, span: int, step: int, frame: str = "frame_idx") -> DataFrame:
    """Every ``step``-th of the first ``span`` frames."""
    return frames.where((F.col(frame) < span) & (F.col(frame) % step == 0))
