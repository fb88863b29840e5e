"""From long to wide poses and back, and which columns there are."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetrace.schema import BODY_PARTS


def track_number(track: Column) -> Column:
    """``track_3``, ``3`` or 3 as 3; null for what is no number."""
    return F.regexp_replace(track.cast("string"), "^track_", "").try_cast("double").cast("int")


def experiment_kind(identity: Column) -> Column:
    """``paired`` if the identity names two animals, else ``single``."""
    return F.when(F.contains(identity, F.lit("+")), "paired").otherwise("single")


def check_tracks(df: DataFrame, keys: Sequence[str], expected: str | None = None, track: str = "track") -> DataFrame:
    """Drops spurious tracks of single animals, and raises where tracks do not fit.

    ``single`` keeps track 0 and rows without a track where there are several;
    ``paired`` needs two. Without an expectation up to two tracks pass.
    """
    counts = df.groupBy(*keys).agg(F.countDistinct(track).alias("_tracks"))
    low, high = (2, 2) if expected == "paired" else (0, 2)
    if expected != "single":
        bad = counts.where(~F.col("_tracks").between(low, high)).limit(1).collect()
        if bad:
            raise ValueError(f"{bad[0]['_tracks']} tracks in {[bad[0][k] for k in keys]}")
        return df
    met = df.join(counts, list(keys))
    return met.where((F.col("_tracks") <= 1) | F.col(track).isNull() | (F.col(track) == 0)).drop("_tracks")


def widen(df: DataFrame, keys: Sequence[str], values: Sequence[str], slots: int, frame: str = "frame_idx", track: str = "track", row: str | None = None, name=lambda v, i: f"{v}_{i}") -> DataFrame:
    """One row for each frame with the values of each track, tracks numbered by order from 1.

    Of several rows for a frame and track the first by ``row`` holds (by all
    values where there is none). Tracks beyond ``slots`` are left out.
    """
    ranked = df.where(F.col(track).isNotNull()).withColumn("_slot", F.dense_rank().over(Window.partitionBy(*keys).orderBy(track)))
    record = F.struct(*([row] if row else []), *values)
    columns = []
    for i in range(1, slots + 1):
        columns.append(F.min(F.when(F.col("_slot") == i, record)).alias(f"_{i}"))
    grouped = ranked.groupBy(*keys, frame).agg(*columns)
    return grouped.select(*keys, frame, *[F.col(f"_{i}")[v].alias(name(v, i)) for i in range(1, slots + 1) for v in values])


def lengthen(df: DataFrame, keys: Sequence[str], values: Sequence[str], slots: int, frame: str = "frame_idx", name=lambda v, i: f"{v}_{i}") -> DataFrame:
    """One row for each frame and track again, tracks numbered from 0."""
    rows = F.array(*[F.struct(F.lit(i - 1).alias("track"), *[F.col(name(v, i)).alias(v) for v in values]) for i in range(1, slots + 1)])
    return df.select(*keys, frame, F.explode(rows).alias("_r")).select(*keys, frame, "_r.*")


def parts_of(columns: Sequence[str]) -> dict[int, list[str]]:
    """Animals and their known body parts, read off column names like ``nose_1_x``."""
    found: dict[int, list[str]] = {}
    for c in columns:
        m = re.fullmatch(r"(.+)_(\d+)_x", c)
        if m and m[1] in BODY_PARTS:
            found.setdefault(int(m[2]), []).append(m[1])
    return {i: sorted(found[i]) for i in sorted(found)}
