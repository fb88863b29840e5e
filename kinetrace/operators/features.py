"""The per-frame feature table of one or two animals.

Input is wide pose, one row per frame: ``{part}_{animal}_{x,y,p}``, missing
values 0 or null. Features come in a few stages of generated columns, each a
single projection; all ordered stages share one shuffle and sort by ranges of a
session. What needs the whole session, its means and ranks, is made of a few
columns first and joined with the pose, so no task sorts or holds the wide rows
of a session.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrace.functions import geometry as G
from kinetrace.operators.split import ROWS, SplitTrack, dealt, own
from kinetrace.operators.track import Track, in_stages
from kinetrace.schema import BODY_PARTS, ROLLING, wide_columns
from kinetrace.sources.stage import shared_folder, stored

#: Names of features that get movements, rolling windows and deviations.
CHANGES = ("poly_area", "nose_to_tail", "ear_distance", "body_center_angle", "nose_angle")
PAIR_CHANGES = ("nose_to_nose_distance", "tail_to_tail_distance", "relative_midline_angle", "relative_nose_head_angle")
HULL = ("large", "small", "mean", "sum")
LOW_P = ("0.1", "0.5", "0.75")
ROLLED = {
    1: ("m1_hull_mean_euclidean", "m1_hull_small_euclidean", "m1_hull_large_euclidean", "movement_mouse_1_tail_base", "movement_mouse_1_nose"),
    2: (
        "sum_euclidean_distance_hull", "total_movement_all_bodyparts_both_mice", "nose_to_nose_distance", "tail_to_tail_distance",
        "m1_hull_mean_euclidean", "m2_hull_mean_euclidean", "m1_hull_small_euclidean", "m2_hull_small_euclidean",
        "m1_hull_large_euclidean", "m2_hull_large_euclidean", "movement_mouse_1_tail_base", "movement_mouse_2_tail_base",
        "movement_mouse_1_nose", "movement_nose_to_nose_distance",
    ),
}
DEVIATIONS = {
    1: ("m1_hull_small_euclidean", "m1_hull_large_euclidean", "m1_hull_mean_euclidean", "movement_mouse_1_nose", "poly_area_1"),
    2: (
        "total_movement_all_bodyparts_both_mice", "sum_euclidean_distance_hull", "m1_hull_small_euclidean", "m1_hull_large_euclidean",
        "m1_hull_mean_euclidean", "movement_mouse_1_nose", "movement_mouse_2_nose", "poly_area_1", "poly_area_2",
    ),
}
ROLLED_DEVIATIONS = {
    1: ("m1_hull_small_euclidean", "m1_hull_large_euclidean", "m1_hull_mean_euclidean"),
    2: (
        "total_movement_all_bodyparts_both_mice", "sum_euclidean_distance_hull", "m1_hull_small_euclidean", "m1_hull_large_euclidean",
        "m2_hull_small_euclidean", "m2_hull_large_euclidean", "m1_hull_mean_euclidean", "m2_hull_mean_euclidean", "movement_nose_to_nose_distance",
    ),
}
#: Names that end in percentile_rank but hold the mean minus the value.
RANK_NAMED = {
    1: ("m1_hull_mean_euclidean", "m1_hull_small_euclidean", "m1_hull_large_euclidean"),
    2: (
        "total_movement_all_bodyparts_both_mice", "sum_euclidean_distance_hull", "m1_hull_mean_euclidean", "m1_hull_small_euclidean",
        "m1_hull_large_euclidean", "m2_hull_mean_euclidean", "m2_hull_small_euclidean", "m2_hull_large_euclidean", "nose_to_nose_distance",
    ),
}


def shapes(animals: int) -> dict[str, Column]:
    """Hull, distances and angles of each frame."""
    out: dict[str, Column] = {}
    at = lambda part, i: G.names(f"{part}_{i}")
    for i in range(1, animals + 1):
        out[f"poly_area_{i}"] = G.hull_perimeter([at(p, i) for p in BODY_PARTS])
        out[f"nose_to_tail_{i}"] = G.distance(at("nose", i), at("tail_base", i))
        out[f"ear_distance_{i}"] = G.distance(at("ear_left", i), at("ear_right", i))
        out[f"body_center_angle_{i}"] = G.angle_at(at("head", i), at("body_center", i), at("tail_base", i))
        out[f"nose_angle_{i}"] = G.wrapped(G.angle_at(at("ear_left", i), at("nose", i), at("ear_right", i)))
        out[f"_pairs_{i}"] = G.pair_distances([at(p, i) for p in BODY_PARTS])
    if animals == 2:
        for name, a, b in (("nose_to_nose", "nose", "nose"), ("body_to_body", "body_center", "body_center"), ("tail_to_tail", "tail_base", "tail_base")):
            out[f"{name}_distance"] = G.distance(at(a, 1), at(b, 2))
        out["nose_1_to_tail_2_distance"] = G.distance(at("nose", 1), at("tail_base", 2))
        out["nose_2_to_tail_1_distance"] = G.distance(at("nose", 2), at("tail_base", 1))
        out["relative_midline_angle"] = G.angle_between(at("nose", 1), at("tail_base", 1), at("nose", 2), at("tail_base", 2))
        out["relative_nose_head_angle"] = G.angle_between(at("nose", 1), at("head", 1), at("nose", 2), at("head", 2))
    return out


def spreads(animals: int) -> dict[str, Column]:
    """Largest, smallest, mean and summed distance between an animal's points; the sum counts each pair both ways."""
    out = {}
    for i in range(1, animals + 1):
        pairs = F.col(f"_pairs_{i}")
        total = F.aggregate(pairs, F.lit(0.0), lambda a, b: a + b)
        out[f"m{i}_hull_large_euclidean"] = F.coalesce(F.array_max(pairs), F.lit(0.0))
        out[f"m{i}_hull_small_euclidean"] = F.coalesce(F.array_min(pairs), F.lit(0.0))
        out[f"m{i}_hull_mean_euclidean"] = F.coalesce(F.try_divide(total, F.size(pairs)), F.lit(0.0))
        out[f"m{i}_hull_sum_euclidean"] = 2 * total
    if animals == 2:
        out["sum_euclidean_distance_hull"] = sum_names(out, "m1_hull_sum_euclidean", "m2_hull_sum_euclidean")
    return out


def sum_names(made: dict[str, Column], *names: str) -> Column:
    return G.sum_of([made[n] for n in names])


def movements(track: Track, animals: int) -> dict[str, Column]:
    """Steps of each part, and changes of shapes against the frame before (previous minus this); no value is missing here."""
    out = {}
    for i in range(1, animals + 1):
        for p in BODY_PARTS:
            out[f"movement_mouse_{i}_{p}"] = track.step(f"{p}_{i}_x", f"{p}_{i}_y", known=True)
        for c in CHANGES:
            out[f"movement_mouse_{i}_{c}"] = track.change(f"{c}_{i}", known=True)
    for c in PAIR_CHANGES if animals == 2 else ():
        out[f"movement_{c}"] = track.change(c, known=True)
    return out


def totals(animals: int) -> dict[str, Column]:
    order = ("nose", "tail_base", "ear_left", "ear_right", "head", "body_center")
    both = {i: G.sum_of([F.col(f"movement_mouse_{i}_{p}") for p in order]) for i in range(1, animals + 1)}
    out = {f"total_movement_all_bodyparts_m{i}": c for i, c in both.items()}
    if animals == 2:
        out["total_movement_nose"] = F.col("movement_mouse_1_nose") + F.col("movement_mouse_2_nose")
        out["total_movement_tail_base"] = F.col("movement_mouse_1_tail_base") + F.col("movement_mouse_2_tail_base")
        out["total_movement_all_bodyparts_both_mice"] = both[1] + both[2]
    return out


def rolled(track: Track, animals: int, sizes: Sequence[int] = ROLLING) -> dict[str, Column]:
    return {f"{c}_{how}_{n}": track.rolling(c, n, how) for c in ROLLED[animals] for n in sizes for how in ("median", "mean")}


def deviations(animals: int, sizes: Sequence[int] = ROLLING) -> dict[str, str]:
    """Features that are the session's mean minus a value, and the value's name."""
    out = {f"{c}_deviation": c for c in DEVIATIONS[animals]}
    out |= {f"{c}_mean_deviation_{n}": f"{c}_mean_{n}" for c in ROLLED_DEVIATIONS[animals] for n in sizes}
    out |= {f"{c}_mean_{n}_percentile_rank": f"{c}_mean_{n}" for c in RANK_NAMED[animals] for n in sizes}
    return out | {"sum_probabilities_deviation": "sum_probabilities"}


def ranks(animals: int) -> dict[str, str]:
    """Features that are a value's percentile rank in the session, and the value's name."""
    out = {}
    for i in range(1, animals + 1):
        out[f"movement_mouse_{i}_percentile_rank"] = f"movement_mouse_{i}_nose"
        out[f"movement_mouse_{i}_deviation_percentile_rank"] = f"movement_mouse_{i}_nose_deviation"
    if animals == 2:
        out["movement_percentile_rank"] = "total_movement_nose"
        out["distance_percentile_rank"] = "nose_to_nose_distance"
    return out | {"sum_probabilities_deviation_percentile_rank": "sum_probabilities_deviation"}


def probabilities(animals: int) -> dict[str, Column]:
    """Sum of a frame's probabilities, and how many are at most a bound (and at least 0)."""
    p = [f"`{bp}_{i}_p`" for i in range(animals, 0, -1) for bp in BODY_PARTS]
    out = {"sum_probabilities": F.expr(" + ".join(p))}
    for bound in LOW_P:
        out[f"low_prob_detections_{bound}"] = F.expr(" + ".join(f"if({c} BETWEEN 0 AND {float(bound)!r}D, 1, 0)" for c in p))
    return out


def _joined(rows: DataFrame, found: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with what was found for them; a null key is a key."""
    named = found.withColumnsRenamed({c: f"on__{c}" for c in on})
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`on__{c}`")) for c in on]
    return rows.join(named, reduce(lambda a, b: a & b, same, F.lit(True))).drop(*[f"on__{c}" for c in on])


def extract(df: DataFrame, keys: Sequence[str], animals: int, frame: str = "frame_idx", size: int = ROWS) -> DataFrame:
    """All features of every frame; missing values are 0, as in the input.

    Columns: keys, frame, the pose, then the features (299 with two animals,
    117 with one, the pose included). The numbered pose is written to the shared
    folder, since means, ranks and features read it; a task holds ranges of
    ``size`` frames.
    """
    pose = wide_columns(animals)
    df = df.select(*keys, frame, *[F.expr(f"coalesce(CAST(`{c}` AS DOUBLE), 0D)").alias(c) for c in pose])
    rows = stored(SplitTrack(tuple(keys), frame).numbered(df, "row__"), shared_folder(df.sparkSession), "pose")
    track = Track((*keys, "range__"), "row__")
    stages = [shapes(animals) | probabilities(animals), spreads(animals), movements(track, animals), totals(animals), rolled(track, animals)]
    # A rolling window reads steps, and a step the row before it.
    moved = lambda given: in_stages(dealt(given, max(ROLLING), 0, size), stages).where(own(size))
    apart, ranked = deviations(animals), ranks(animals)
    from_mean = {n: F.expr(f"`mean__{c}` - `{c}`") for n, c in apart.items()}
    means = moved(rows).groupBy(*keys).agg(*[F.expr(f"avg(`{c}`)").alias(f"mean__{c}") for c in dict.fromkeys(apart.values())])
    met = _joined(rows, means, keys)
    # Values to be ranked one below the other: a few numbers a row, and a task for each session and feature.
    used = {c: from_mean[c] for c in ranked.values() if c in from_mean}
    values = F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"`{c}`").alias("v")) for n, c in ranked.items()])
    long = moved(met).withColumns(used).select(*keys, "row__", F.explode(values).alias("_v")).select(*keys, "row__", F.col("_v.n").alias("name__"), F.col("_v.v").alias("value__"))
    placed = long.withColumn("rank__", Track((*keys, "name__")).percentile_rank("value__"))
    placed = placed.groupBy(*keys, "row__").agg(*[F.max(F.when(F.col("name__") == n, F.col("rank__"))).alias(n) for n in ranked])
    # A value's rank among ranks is its rank.
    last = {"sum_probabilities_percentile_rank": F.col("sum_probabilities_deviation_percentile_rank")}
    out = moved(_joined(met, placed.hint("merge"), [*keys, "row__"])).withColumns(from_mean).withColumns(last)
    made = [c for stage in [*stages, apart, ranked, last] for c in stage if not c.startswith("_")]
    return out.select(*keys, frame, *pose, *[F.expr(f"coalesce(`{c}`, 0)").alias(c) for c in made])


def narrowed(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Floats instead of doubles for storage."""
    return df.select(*keep, *[F.col(f"`{c}`").cast("float").alias(c) for c in df.columns if c not in keep])
