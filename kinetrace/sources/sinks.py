"""Writers of results; a folder's success mark says that it is whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrace.schema import DEFAULT_FPS, EVENTS, POSE


def event_rows(events: DataFrame) -> DataFrame:
    """Events as text: six decimals, blank for missing."""
    six = lambda c: F.when(F.col(c).isNotNull(), F.format_string("%.6f", F.col(c)))
    return events.select(*[six(f.name).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name).cast("string").alias(f.name) for f in EVENTS])


def write_events(events: DataFrame, path: str) -> None:
    event_rows(events).orderBy(F.col("time_start").cast("double")).write.option("header", "true").option("nullValue", "").option("emptyValue", "").csv(path)


def write_poses(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Poses by session, in order of frame and track."""
    df.repartition(*keys).sortWithinPartitions(*keys, "frame_idx", "track").write.partitionBy(*keys).parquet(path)


def write_pose_csv(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Poses as CSV with dotted names and ``track_N``, a folder for each session, rows in order of frame and track."""
    parts = [f.name for f in POSE if f.name not in ("track", "frame_idx", "instance_score")]
    dotted = lambda c: c[: c.rindex("_")] + "." + c[c.rindex("_") + 1 :]
    track = F.when(F.col("track").isNotNull(), F.concat(F.lit("track_"), F.col("track").cast("string")))
    out = df.select(*keys, track.alias("track"), "frame_idx", *[F.col(c).alias(dotted(c)) for c in parts if c in df.columns], F.col("track").alias("_order"))
    out.repartition(*keys).sortWithinPartitions(*keys, "frame_idx", "_order").drop("_order").write.partitionBy(*keys).option("header", "true").csv(path)


def write_frame_times(df: DataFrame, path: str, keys: Sequence[str], folders: int | None = None) -> None:
    """Frame numbers and seconds (six decimals) as CSV, a folder for each session.

    Many short sessions cost more by their files than by their rows: with ``folders``
    they lie in so many, whole and in order, and their keys are columns.
    """
    out = df.select(*keys, "frame_idx", F.format_string("%.6f", F.col("pts_seconds")).alias("pts_seconds"))
    dealt = list(keys)
    if folders is not None:
        out, dealt = out.withColumn("folder", F.pmod(F.hash(*keys), F.lit(folders))), ["folder"]
    out.repartition(*dealt).sortWithinPartitions(*dict.fromkeys([*dealt, *keys]), "frame_idx").write.partitionBy(*dealt).option("header", "true").csv(path)


def zone_record(floor: Column, nest: Column, center: Column, radius: Column) -> Column:
    """The text of a zone file: corners (arrays of pairs) of floor and nest, and the circle; a missing zone is left out."""
    text = lambda c: F.to_json(c)
    parts = [F.concat(F.lit('{"floor":'), text(floor), F.lit("}")), F.concat(F.lit('{"nest":'), text(nest), F.lit("}")), F.concat(F.lit('{"loom":['), text(center), F.lit(","), radius.cast("double").cast("string"), F.lit("]}"))]
    return F.concat(F.lit('{"regions":['), F.concat_ws(",", *parts), F.lit("]}"))


def write_features(df: DataFrame, path: str, keys: Sequence[str], csv: bool = False) -> None:
    """Features as floats, a folder for each session, rows in order of frame."""
    kept = [*keys, "frame_idx"]
    narrow = df.select(*kept, *[F.col(f"`{c}`").cast("float").alias(c) for c in df.columns if c not in kept])
    out = narrow.repartition(*keys).sortWithinPartitions(*keys, "frame_idx").write.partitionBy(*keys)
    out.option("header", "true").csv(path) if csv else out.parquet(path)


def with_sentinels(df: DataFrame, columns: Sequence[str], fps: float = DEFAULT_FPS) -> DataFrame:
    """Missing results as minus the frame rate, which older readers expect."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(-fps)) for c in columns})


def write_results(df: DataFrame, path: str, animal: str = "animal") -> None:
    """Event metrics, a folder for each animal."""
    df.write.partitionBy(animal).option("header", "true").csv(path)


def write_json(df: DataFrame, path: str, column: str = "report") -> None:
    """One line of JSON for each row."""
    df.select(F.col(column).alias("value")).write.text(path)


def as_json(df: DataFrame, keys: Sequence[str], into: str = "report") -> DataFrame:
    """All other columns of each row as a JSON text."""
    return df.select(*keys, F.to_json(F.struct(*[c for c in df.columns if c not in keys])).alias(into))


def ragged(lists: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Array columns as rows side by side: position and each array's value there, null beyond its end."""
    columns = [c for c in lists.columns if c not in keys]
    return lists.select(*keys, F.posexplode_outer(F.arrays_zip(*columns)).alias("position", "_v")).select(*keys, "position", *[F.col("_v")[c].alias(c) for c in columns])
