"""Queries of ordered operators over ranges of a session; their SQL is that of the whole-session forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetrace.operators import split
from kinetrace.plans.base import FRAMES, ORACLES, query, rounded, table

#: Seconds and frames of a range: some ranges for each user of the smallest tables.
SECONDS, FRAMES_A_RANGE = 7 * 86400.0, 16
BY_FRAME = split.SplitTrack(("track",), "frame_idx", FRAMES_A_RANGE)


def split_frames(spark, sf_dir) -> DataFrame:
    """As :func:`kinetrace.plans.base.frames`, numbered over ranges of time."""
    e = table(spark, sf_dir, "events")
    pts = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)") / 1e6
    value = F.round(F.col("value") * 100)
    hole = (F.col("event_id") % 7).isin(1, 2, 3) | (F.col("event_id") % 11 == 0)
    narrow = e.select(F.col("user_id").alias("track"), pts.alias("pts"), "event_id", F.col("event_type").alias("kind"), value.alias("value"), F.when(~hole, value).alias("gappy"))
    return split.SplitTrack(("track",), "pts", SECONDS, ("event_id",)).numbered(narrow)


@query(f"WITH {FRAMES} SELECT track, frame_idx, event_id, round(pts, 3) AS pts FROM fr")
def split_numbers(spark, sf_dir):
    return split_frames(spark, sf_dir).select("track", "frame_idx", "event_id", F.round("pts", 3).alias("pts"))


_W = "PARTITION BY track ORDER BY frame_idx"


@query(
    f"""WITH {FRAMES} SELECT track, frame_idx, coalesce(lag(gappy) OVER ({_W}), first_value(gappy IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS previous,
coalesce(lag(value) OVER ({_W}), value) - value AS change FROM fr"""
)
def split_lag(spark, sf_dir):
    df = BY_FRAME.previous(split_frames(spark, sf_dir), {"previous": "gappy"})
    return BY_FRAME.change(df, {"change": "value"}).select("track", "frame_idx", "previous", "change")


@query(ORACLES["fill_limited"])
def split_fill_limited(spark, sf_dir):
    return rounded(BY_FRAME.filled(split_frames(spark, sf_dir), {"filled": "gappy"}, 2).select("track", "frame_idx", "filled"))


@query(ORACLES["fill_both_ways"])
def split_fill_both_ways(spark, sf_dir):
    return rounded(BY_FRAME.filled(split_frames(spark, sf_dir), {"filled": "gappy"}, both=True).select("track", "frame_idx", "filled"))


@query(ORACLES["parity_swap"])
def split_parity_swap(spark, sf_dir):
    df = BY_FRAME.odd(split_frames(spark, sf_dir), F.col("kind") == "error", "flipped")
    return df.select("track", "frame_idx", "flipped", F.when(F.col("flipped"), F.col("pts")).otherwise(F.col("value")).alias("a"), F.when(F.col("flipped"), F.col("value")).otherwise(F.col("pts")).alias("b"))


@query(ORACLES["gap_runs"])
def split_gap_runs(spark, sf_dir):
    return BY_FRAME.runs(split_frames(spark, sf_dir), F.col("gappy").isNull())


@query(ORACLES["filled_gaps"])
def split_filled_gaps(spark, sf_dir):
    """The filled part of each gap: of its run, the frames that have a value now."""
    df = BY_FRAME.filled(split_frames(spark, sf_dir), {"filled": "gappy"}, 2)
    kept = F.col("filled").isNotNull()
    found = BY_FRAME.runs(df, F.col("gappy").isNull(), [F.min(F.when(kept, F.col("frame_idx"))).alias("a"), F.max(F.when(kept, F.col("frame_idx"))).alias("b")])
    return found.where("a is not null").select("track", F.col("a").alias("first"), F.col("b").alias("last"))


@query(ORACLES["nearest_frame"])
def split_nearest_frame(spark, sf_dir):
    f = split_frames(spark, sf_dir)
    stimuli = f.where("kind = 'error'").select("track", "event_id", (F.col("pts") + 10 * (F.col("event_id") % 5 - 2)).alias("t"))
    return split.nearest(stimuli, f, ["track"], "t", "pts", "frame_idx", size=SECONDS).select("track", "event_id", "frame", F.round("frame_error", 3).alias("frame_error"))
