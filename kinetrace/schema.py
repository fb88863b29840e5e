"""Names, types and constants of the tracking data model."""

from __future__ import annotations

from pyspark.sql import types as T

#: Body parts in order, frame rate, windows of the rolling features.
BODY_PARTS = ("nose", "ear_left", "ear_right", "head", "body_center", "tail_base")
DEFAULT_FPS = 29.595
ROLLING = (3, 6, 9, 15)
#: Fixed values of cleaning: frames that interpolation may fill, pixels that count as apart, parts that must be apart, pixels of a jump.
FILL_LIMIT, APART_PX, APART_PARTS, JUMP_PX = 90, 50.0, 3, 150.0
#: Fixed values of event metrics: frames in the nest, frozen frames for an onset, fast frames for an offset; speeds; near-zero acceleration and its run.
NEST_FRAMES, FREEZE_ON, FREEZE_OFF, SLOW, FAST, STILL, STILL_RUN = 5, 35, 5, 3.0, 4.0, 0.02, 8

SESSION = ("identity", "day")
POSE = T.StructType(
    [
        T.StructField("track", T.StringType()),
        T.StructField("frame_idx", T.LongType()),
        T.StructField("instance_score", T.DoubleType()),
        *[T.StructField(f"{bp}_{axis}", T.DoubleType()) for bp in BODY_PARTS for axis in ("x", "y", "score")],
    ]
)
PTS = T.StructType([T.StructField("frame_idx", T.LongType()), T.StructField("pts_seconds", T.DoubleType())])
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("time_start", T.DoubleType()),
        T.StructField("time_end", T.DoubleType()),
        T.StructField("frame_start", T.LongType()),
        T.StructField("frame_end", T.LongType()),
        T.StructField("frame_error_start", T.DoubleType()),
        T.StructField("frame_error_end", T.DoubleType()),
    ]
)
SCORES = T.StructType(
    [
        T.StructField("session", T.StringType()),
        T.StructField("animal", T.StringType()),
        T.StructField("loom", T.IntegerType()),
        T.StructField("time_start", T.DoubleType()),
        T.StructField("latency", T.DoubleType()),
        T.StructField("time_in_nest", T.DoubleType()),
    ]
)


def wide_columns(animals: int) -> list[str]:
    """Columns of wide pose in order: part, animal, axis."""
    return [f"{bp}_{i}_{axis}" for i in range(1, animals + 1) for bp in BODY_PARTS for axis in ("x", "y", "p")]
