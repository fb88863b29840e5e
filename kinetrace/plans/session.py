"""The whole analysis of sessions as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetrace.functions import geometry as G
from kinetrace.operators import features, metrics, zones
from kinetrace.operators.split import SplitTrack, dealt, own
from kinetrace.operators.track import Track, in_stages
from kinetrace.schema import BODY_PARTS, DEFAULT_FPS, FAST, SLOW, STILL_RUN
from kinetrace.sources.stage import shared_folder, stored


def animal_frames(table: DataFrame, area: zones.Zones, keys: Sequence[str], animals: int, fps: float = DEFAULT_FPS, px_per_cm: float = 1.0) -> DataFrame:
    """One row for each animal and frame with the columns that the metrics name, worked out by ranges of a session."""
    track = Track((*keys, "range__"), "row__")
    table = SplitTrack(tuple(keys)).numbered(table, "row__")
    # A still run's rows lie up to STILL_RUN - 1 before and after, and each reads two rows back.
    table = zones.add(dealt(table, STILL_RUN + 1, STILL_RUN - 1), area)
    for i in range(1, animals + 1):
        table = zones.approach(table, track, area, i)
    speed = {f"_speed6_{i}": track.rolling(f"movement_mouse_{i}_tail_base", 6) for i in range(1, animals + 1)}
    table = in_stages(table.withColumns(speed), metrics.still_stages(track, {f"_still_{p}_{i}": f"{p}_{i}_x" for i in range(1, animals + 1) for p in BODY_PARTS})).where(own())
    limit = lambda v: v * px_per_cm / fps
    mean = lambda names: G.sum_of([F.col(n) for n in names]) / len(names)
    per = {
        "inside": zones.inside,
        "near": zones.any_inside,
        "slow": lambda i: F.col(f"_speed6_{i}") < limit(SLOW),
        "calm": lambda i: F.col(f"_speed6_{i}") < limit(FAST),
        "angle_to_loom": lambda i: G.heading_to(G.names(f"head_{i}"), G.names(f"nose_{i}"), area.loom),
        "facing_loom": lambda i: F.col(f"`{zones.name('Loom', i, None, 'facing')}`"),
        "speed": lambda i: mean([f"movement_mouse_{i}_{p}" for p in ("nose", "tail_base", "ear_left", "ear_right")]),
        "nest_speed": lambda i: mean([f"roi_velocity_{p}_animal_{i}" for p in BODY_PARTS]),
    } | {f"{p}_{a}": (lambda i, p=p, a=a: F.col(f"{p}_{i}_{a}")) for p in BODY_PARTS for a in ("x", "y")}
    per |= {f"still_{p}": (lambda i, p=p: F.col(f"_still_{p}_{i}")) for p in BODY_PARTS}
    shared = [c for c in ("relative_midline_angle", "nose_to_nose_distance", "nose_1_to_tail_2_distance", "nose_2_to_tail_1_distance") if animals == 2]
    rows = metrics.stacked(table, keys, per, animals, shared)
    return rows.withColumn("still_all", metrics.still_everywhere()).withColumn("calm_flag", F.col("calm").cast("int"))


def analyse(pose: DataFrame, events: DataFrame, area: zones.Zones, keys: Sequence[str], animals: int, fps: float = DEFAULT_FPS, px_per_cm: float = 1.0) -> DataFrame:
    """Metrics of every animal and event from wide poses, converted events and zones.

    Results are null where they are missing; latencies and durations are in
    seconds. Features, frames by animal and time points are written to the
    shared folder, since several steps read each.
    """
    table = stored(features.extract(pose, keys, animals), shared_folder(pose.sparkSession), "features")
    return measured(table, events, area, keys, animals, fps, px_per_cm)


def measured(table: DataFrame, events: DataFrame, area: zones.Zones, keys: Sequence[str], animals: int, fps: float = DEFAULT_FPS, px_per_cm: float = 1.0, paths: bool = True) -> DataFrame:
    """The metrics of :func:`analyse` from a written feature table; without ``paths`` the distances between the animals' paths are left out."""
    folder = shared_folder(table.sparkSession)
    rows = stored(animal_frames(table, area, keys, animals, fps, px_per_cm), folder, "frames")
    points = stored(metrics.time_points(rows, metrics.loom_events(events, keys), keys), folder, "points")
    wanted = [metrics.Metric(m.name, m.kind, "calm_flag" if m.column == "calm" else m.column, m.span, m.smooth, m.post) for m in metrics.catalogue(fps, px_per_cm, animals == 2)]
    found = metrics.measure(rows, points, keys, wanted)
    who = [*keys, "animal", "loom"]
    out = points.select(*who, (F.col("freeze_start") / fps).alias("Freeze start"), (F.col("freeze_length") / fps).alias("Freeze length"), (F.col("latency") / fps).alias("Latency to nest"), (F.col("stay") / fps).alias("Time in nest")).join(found, who)
    if animals == 2 and paths:
        for part in ("body_center", "head"):
            for where, span in (("start loom - nest entry", metrics.Span(end="latency")), ("10s before loom - loom", metrics.Span(start_offset=-int(10 * fps)))):
                d = metrics.path_distances(rows, points, keys, span, part).withColumnRenamed("frechet", f"Frechet Distance {part} ({where})")
                out = out.join(d, [*keys, "loom"], "left")
    return out
