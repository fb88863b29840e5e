"""Aligning events with frames: nearest frame, ranges of frames, and what follows an event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Frames in a bucket of a range join.
BUCKET = 512


def nearest(events: DataFrame, frames: DataFrame, keys: Sequence[str], time: str, pts: str, frame: str, into: str = "frame", error: str = "frame_error") -> DataFrame:
    """Adds to each event its nearest frame by time and the error (frame's time minus event's).

    Of two equally near frames the earlier holds; events before the first or
    after the last frame take that one. Both sides meet in one shuffle and are
    sorted by time, forward and backward;
    events of a key without frames, or with a null time, get nulls.
    """
    columns = events.columns
    whole = F.struct(*[F.col(c) for c in columns])
    e = events.select(*keys, F.col(time).cast("double").alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast(frames.schema[frame].dataType).alias("_frame"), whole.alias("_event"))
    f = frames.where(F.col(pts).isNotNull()).select(*keys, F.col(pts).cast("double").alias("_t"), F.lit(0).alias("_kind"), F.col(frame).alias("_frame"), F.lit(None).cast(e.schema["_event"].dataType).alias("_event"))
    order = ("_t", "_kind", "_frame")
    known = F.when(F.col("_kind") == 0, F.struct("_t", "_frame"))
    # The next frame is the last one met on the way back from the end, which takes one step a row.
    seen = {name: F.last(known, True).over(Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)) for name, by in (("_before", order), ("_after", [F.col(c).desc() for c in order]))}
    met = f.unionByName(e).withColumns(seen)
    t = F.col("_t")
    earlier = F.col("_after").isNull() | (t - F.col("_before._t") <= F.col("_after._t") - t)
    best = F.when(t.isNotNull(), F.when(earlier, F.col("_before")).otherwise(F.col("_after")))
    met = met.where("_kind = 1").withColumn("_best", best)
    return met.select(*[F.col("_event")[c].alias(c) for c in columns], F.col("_best._frame").alias(into), (F.col("_best._t") - t).alias(error))


def in_windows(frames: DataFrame, windows: DataFrame, keys: Sequence[str], frame: str = "frame_idx", start: str = "start", end: str = "end", bucket: int = BUCKET) -> DataFrame:
    """All pairs of a window and a frame in [start, end) of the same key.

    Windows are cut into buckets of frames, so the join is an equality join and
    neither side has to be broadcast. Empty windows and ones with a null end
    have no pair.
    """
    cut = windows.where(F.col(start) < F.col(end)).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(start) / bucket), F.floor((F.col(end) - 1) / bucket))))
    met = frames.withColumn("_bucket", F.floor(F.col(frame) / bucket)).join(cut, [*keys, "_bucket"])
    return met.where((F.col(frame) >= F.col(start)) & (F.col(frame) < F.col(end))).drop("_bucket")


def shared_window(windows: DataFrame, keys: Sequence[str], parties: int, start: str = "start", end: str = "end") -> DataFrame:
    """The intersection of the windows of all parties of a key; null where a party has none or they do not meet."""
    low, high = F.max(start), F.min(end)
    met = windows.groupBy(*keys).agg(low.alias("_low"), high.alias("_high"), F.count(F.when(F.col(start).isNotNull() & F.col(end).isNotNull(), 1)).alias("_n"))
    good = (F.col("_n") >= parties) & (F.col("_low") < F.col("_high"))
    return met.select(*keys, F.when(good, F.col("_low")).alias(start), F.when(good, F.col("_high")).alias(end))


def event_windows(events: DataFrame, keys: Sequence[str], at: str, start: int, end: int, event: str = "event", most: int | None = None) -> DataFrame:
    """Windows [at + start, at + end) around events, cut to ``most`` frames."""
    last = F.col(at) + end
    if most is not None:
        last = F.least(last, F.col(at) + start + most)
    return events.select(*keys, event, (F.col(at) + start).alias("start"), last.alias("end"))


def until_next(events: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Adds ``until``: where the next event of the key begins; null for the last."""
    return events.withColumn("until", F.lead(at).over(Window.partitionBy(*keys).orderBy(at)))


def nth_in_window(met: DataFrame, keys: Sequence[str], flag: Column, n: int, frame: str = "frame_idx") -> DataFrame:
    """For each window of :func:`in_windows`, the frame where ``flag`` has held n times, minus n - 1.

    The count never starts anew. Windows without such a frame are left out.
    """
    order = Window.partitionBy(*keys).orderBy(frame).rowsBetween(Window.unboundedPreceding, 0)
    counted = met.withColumn("_n", F.sum(F.coalesce(flag, F.lit(False)).cast("int")).over(order))
    return counted.where(F.col("_n") >= n).groupBy(*keys).agg((F.min(frame) - (n - 1)).alias("nth_frame"))


def first_in_window(met: DataFrame, keys: Sequence[str], flag: Column, frame: str = "frame_idx") -> DataFrame:
    """The first frame of each window where ``flag`` holds."""
    return met.where(flag).groupBy(*keys).agg(F.min(frame).alias("first_frame"))
