"""Repairing trajectories: collisions, identity swaps over gaps, and interpolation.

A session is one row per frame with both animals side by side, so every step is
an expression over the row and its neighbours, and the whole repair needs one
shuffle and one sort by session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrace.functions.geometry import sum_of
from kinetrace.operators.reshape import lengthen, widen
from kinetrace.operators.track import Track, densify
from kinetrace.schema import APART_PARTS, APART_PX, BODY_PARTS, FILL_LIMIT, JUMP_PX

AXES = ("x", "y", "score")


def _xy(part: str, i: int) -> tuple[Column, Column]:
    return F.col(f"{part}_x_{i}"), F.col(f"{part}_y_{i}")


def collisions(df: DataFrame, track: Track, parts: Sequence[str] = BODY_PARTS, apart: float = APART_PX, least: int = APART_PARTS, jump: float = JUMP_PX) -> DataFrame:
    """Adds ``drop_1`` and ``drop_2``: whose points are not to be trusted in a frame.

    Animals collide where fewer than ``least`` parts are more than ``apart``
    pixels from the other's; missing ones count as not apart. If both jumped
    more than ``jump`` pixels since the frame before, both drop; else the one
    that moved more, and none if they moved alike. The first frame is exempt.
    """
    apart_parts = []
    for p in parts:
        (ax, ay), (bx, by) = _xy(p, 1), _xy(p, 2)
        d = F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))
        apart_parts.append(F.coalesce((d > apart).cast("int"), F.lit(0)))
    moved = {}
    for i in (1, 2):
        steps = []
        for p in parts:
            x, y = _xy(p, i)
            dx, dy = x - F.lag(x).over(track.window), y - F.lag(y).over(track.window)
            steps.append(F.coalesce(F.sqrt(dx * dx + dy * dy), F.lit(0.0)))
        moved[f"_moved_{i}"] = sum_of(steps)
    df = df.withColumns({"_near": (sum_of(apart_parts) < least) & (F.row_number().over(track.window) > 1), **moved})
    a, b = F.col("_moved_1"), F.col("_moved_2")
    both = F.col("_near") & (a > jump) & (b > jump)
    df = df.withColumns({"drop_1": both | (F.col("_near") & (a > b)), "drop_2": both | (F.col("_near") & (b > a))})
    return df.drop("_near", "_moved_1", "_moved_2")


def without_collisions(df: DataFrame, parts: Sequence[str] = BODY_PARTS) -> DataFrame:
    """Nulls for dropped points."""
    return df.withColumns({f"{p}_{a}_{i}": F.when(~F.col(f"drop_{i}"), F.col(f"{p}_{a}_{i}")) for p in parts for a in AXES for i in (1, 2)})


def gap_swaps(df: DataFrame, track: Track, parts: Sequence[str] = BODY_PARTS) -> DataFrame:
    """Adds ``swap_here``: at the last frame of a gap of both animals, whether they fit better exchanged.

    An animal is there if all its parts have an x. The frames next to the gap
    are compared; a missing value there means no swap.
    """
    there = [sum_of([F.col(f"{p}_x_{i}").isNull().cast("int") for p in parts]) == 0 for i in (1, 2)]
    df = df.withColumn("_gap", ~(there[0] | there[1]))
    values = F.struct(*[F.col(f"{p}_{a}_{i}") for p in parts for a in ("x", "y") for i in (1, 2)])
    df = df.withColumns({"_last": F.last(F.when(~F.col("_gap"), values), True).over(track.before), "_next": F.lead(values).over(track.window), "_gap_next": F.lead("_gap").over(track.window)})
    straight, crossed = [], []
    for p in parts:
        for a in ("x", "y"):
            old = [F.col(f"_last.{p}_{a}_{i}") for i in (1, 2)]
            new = [F.col(f"_next.{p}_{a}_{i}") for i in (1, 2)]
            straight += [(new[0] - old[0]) * (new[0] - old[0]), (new[1] - old[1]) * (new[1] - old[1])]
            crossed += [(new[0] - old[1]) * (new[0] - old[1]), (new[1] - old[0]) * (new[1] - old[0])]
    ends = F.col("_gap") & ~F.coalesce(F.col("_gap_next"), F.lit(True))
    here = ends & F.coalesce(sum_of(crossed) < sum_of(straight), F.lit(False))
    return df.withColumn("swap_here", here).drop("_gap", "_last", "_next", "_gap_next")


def step_swaps(df: DataFrame, track: Track, parts: Sequence[str] = BODY_PARTS) -> DataFrame:
    """Adds ``swap_here``: where the animals continue the frame before better exchanged than straight."""
    straight, crossed = [], []
    for p in parts:
        for i, j in ((1, 2), (2, 1)):
            x, y = _xy(p, i)
            for other, into in ((i, straight), (j, crossed)):
                ox, oy = (F.lag(v).over(track.window) for v in _xy(p, other))
                into.append(F.coalesce(F.sqrt((x - ox) * (x - ox) + (y - oy) * (y - oy)), F.lit(0.0)))
    return df.withColumn("swap_here", F.coalesce(sum_of(crossed) < sum_of(straight), F.lit(False)))


def exchanged(df: DataFrame, track: Track, parts: Sequence[str] = BODY_PARTS, flag: str = "swap_here") -> DataFrame:
    """Exchanges the animals from each flagged frame on, until the next."""
    df = df.withColumn("_flip", track.odd(F.col(flag)))
    names = [(f"{p}_{a}_1", f"{p}_{a}_2") for p in parts for a in AXES]
    first = {a: F.when(F.col("_flip"), F.col(b)).otherwise(F.col(a)) for a, b in names}
    second = {b: F.when(F.col("_flip"), F.col(a)).otherwise(F.col(b)) for a, b in names}
    return df.withColumns(first | second).withColumnRenamed("_flip", "flipped")


def clean_paired(pose: DataFrame, keys: Sequence[str], parts: Sequence[str] = BODY_PARTS, limit: int = FILL_LIMIT, apart: float = APART_PX, jump: float = JUMP_PX) -> DataFrame:
    """The whole repair of sessions with two tracks: one row per frame, ``{part}_{axis}_{animal}``.

    Adds ``drop_1``, ``drop_2``, ``swap_here`` and ``flipped``, from which
    :func:`report` is made.
    """
    values = [f"{p}_{a}" for p in parts for a in AXES]
    track = Track(tuple(keys))
    wide = densify(widen(pose, keys, values, 2), track)
    wide = exchanged(gap_swaps(without_collisions(collisions(wide, track, parts, apart, jump=jump), parts), track, parts), track, parts)
    wide = wide.withColumn("missing_1", F.col(f"{parts[0]}_x_1").isNull()).withColumn("missing_2", F.col(f"{parts[0]}_x_2").isNull())
    return wide.withColumns({f"{v}_{i}": track.filled(f"{v}_{i}", limit) for v in values for i in (1, 2)})


def clean_single(pose: DataFrame, keys: Sequence[str], parts: Sequence[str] = BODY_PARTS, limit: int = FILL_LIMIT) -> DataFrame:
    """A row for each frame with short gaps filled; the track becomes 0."""
    values = [f"{p}_{a}" for p in parts for a in AXES]
    track = Track(tuple(keys))
    dense = densify(pose.select(*keys, "frame_idx", *values), track)
    dense = dense.withColumn("missing_1", F.col(f"{parts[0]}_x").isNull())
    return dense.withColumns({v: track.filled(v, limit) for v in values}).withColumn("track", F.lit(0))


def as_long(wide: DataFrame, keys: Sequence[str], parts: Sequence[str] = BODY_PARTS) -> DataFrame:
    """Cleaned pairs as one row per frame and track again."""
    return lengthen(wide, keys, [f"{p}_{a}" for p in parts for a in AXES], 2)


def report(clean: DataFrame, keys: Sequence[str], limit: int = FILL_LIMIT) -> DataFrame:
    """Counts and frames of what :func:`clean_paired` did, with a JSON text for each session."""
    at = lambda c: F.sort_array(F.collect_list(F.when(c, F.col("frame_idx"))))
    out = clean.groupBy(*keys).agg(
        at(F.col("swap_here")).alias("swap_events"),
        at(F.col("drop_1") & ~F.col("drop_2")).alias("identity_0"),
        at(F.col("drop_2") & ~F.col("drop_1")).alias("identity_1"),
        at(F.col("drop_1") & F.col("drop_2")).alias("both"),
    )
    body = F.struct(F.col("swap_events"), F.struct("identity_0", "identity_1", "both").alias("collision_removals"), F.size("swap_events").alias("total_swaps"), F.lit(limit).alias("interpolation_limit"))
    return out.withColumn("report", F.to_json(body))
