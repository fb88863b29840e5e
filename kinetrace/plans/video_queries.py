"""Frame times by way of video files: each track of the event table becomes the boxes of a film without pictures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetrace.plans.base import FRAMES, frames, query
from kinetrace.sources import video
from kinetrace.sources.stage import shared_folder

SCALE, DROPPED = 100, 50


def number(c: Column | int, size: int = 4) -> Column:
    """A whole number as bytes, the highest first."""
    c = F.lit(c) if isinstance(c, int) else c
    return F.unhex(F.lpad(F.hex(c.cast("bigint")), 2 * size, "0"))


def box(kind: str, *parts: Column) -> Column:
    body = F.concat(F.lit(b""), *parts)
    return F.concat(number(F.length(body) + 8), F.lit(kind.encode()), body)


def pairs(c: Column) -> Column:
    """A table of runs, each a struct of two whole numbers."""
    rows = F.transform(c, lambda s: F.concat(F.lpad(F.hex(s["n"].cast("bigint")), 8, "0"), F.lpad(F.hex(s["v"].cast("bigint")), 8, "0")))
    return F.concat(number(0), number(F.size(c)), F.unhex(F.array_join(rows, "")))


def film(steps: Column, offsets: Column, handlers: tuple[str, ...] = ("soun", "vide")) -> Column:
    """A film with the same times in a track of each kind; its first ``DROPPED`` units are cut off by an edit."""
    made = []
    for k, kind in enumerate(handlers, 1):
        entry = box("avc1", number(0, 6), number(1, 2), number(0, 16), number(640, 2), number(480, 2), number(0, 50))
        table = box("stbl", box("stsd", number(0), number(1), entry), box("stts", pairs(steps)), box("ctts", pairs(offsets)))
        media = box("mdia", box("mdhd", number(0), number(0), number(0), number(SCALE), number(0), number(0)), box("hdlr", number(0), number(0), F.lit(kind.encode()), number(0, 12)), box("minf", table))
        made.append(box("trak", box("tkhd", number(7), number(0), number(0), number(k), number(0, 68)), box("edts", box("elst", number(0), number(1), number(0), number(DROPPED), number(1 << 16))), media))
    return F.concat(box("ftyp", F.lit(b"isom"), number(0)), box("mdat", number(0, 16)), box("moov", box("mvhd", number(0), number(0), number(0), number(1000), number(0, 84)), *made))


def films(spark, sf_dir: str) -> DataFrame:
    """A film for each track of the event table, its frames at the events' times; every third is shown 40 units late.

    A step between frames has 32 bits: at 100 units a second, up to 497 days.
    """
    f = frames(spark, sf_dir).select("track", "frame_idx", F.round(F.col("pts") * 1e6).cast("bigint").alias("us"))
    step = F.coalesce(F.floor(F.lead("us").over(Window.partitionBy("track").orderBy("frame_idx")) / 10000) - F.floor(F.col("us") / 10000), F.lit(0))
    run = lambda v: F.struct(F.lit(1).alias("n"), v.alias("v"))
    rows = f.select("track", "frame_idx", step.alias("step"), F.when(F.col("frame_idx") % 3 == 1, 40).otherwise(0).alias("late"))
    lists = rows.groupBy("track").agg(F.array_sort(F.collect_list(F.struct("frame_idx", "step", "late"))).alias("l"))
    whole = film(F.transform("l", lambda s: run(s["step"])), F.transform("l", lambda s: run(s["late"])))
    return lists.select("track", whole.alias("content"))


@query(f"""WITH {FRAMES}, s AS (SELECT track, frame_idx, epoch // 10000 - first // 10000 AS u0 FROM (
  SELECT track, frame_idx, CAST(round(pts * 1e6) AS BIGINT) AS epoch, min(CAST(round(pts * 1e6) AS BIGINT)) OVER (PARTITION BY track) AS first FROM fr)),
u AS (SELECT track, frame_idx, u0 + CASE WHEN frame_idx % 3 = 1 THEN 40 ELSE 0 END AS u FROM s)
SELECT track, row_number() OVER (PARTITION BY track ORDER BY u, frame_idx) - 1 AS frame_idx, round((u - {DROPPED}) / {SCALE}.0, 4) AS pts_seconds FROM u""")
def video_frame_times(spark, sf_dir):
    """Films written as files and their frame times read back from the boxes; only picture tracks are read."""
    folder = f"{shared_folder(spark)}/films"
    video.write_files(films(spark, sf_dir).select(F.concat(F.col("track").cast("string"), F.lit(".mp4")).alias("name"), "content"), folder, "name", "content")
    times = video.frame_times(video.video_runs(spark, folder).where("handler = 'vide'"))
    track = F.regexp_extract("path", r"(\d+)\.mp4$", 1).cast("bigint")
    return times.select(track.alias("track"), "frame_idx", F.round("pts_seconds", 4).alias("pts_seconds"))
