"""Streaming forms of the operators that do not look ahead.

Trailing row windows need state: the last positions of each track. Windows by
time are built in; the event time must be a timestamp with a time zone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kinetrace.workers import reachable


def tumbling(df: DataFrame, keys: Sequence[str], time: str, value: str, size: str = "1 day", late: str = "1 day") -> DataFrame:
    """Count, sum and mean of a value in tumbling windows, with late rows up to the watermark."""
    stamped = df.withColumn("_at", F.col(time).cast("timestamp_ltz")).withWatermark("_at", late)
    out = stamped.groupBy(F.window("_at", size), *keys).agg(F.count(F.lit(1)).alias("rows"), F.sum(value).alias("total"), F.avg(value).alias("mean"))
    return out.select(F.col("window.start").alias("start"), *keys, "rows", "total", "mean")


def sessions(df: DataFrame, keys: Sequence[str], time: str, gap: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Runs of rows with gaps below ``gap``: begin, end and rows."""
    stamped = df.withColumn("_at", F.col(time).cast("timestamp_ltz")).withWatermark("_at", late)
    out = stamped.groupBy(F.session_window("_at", gap), *keys).agg(F.count(F.lit(1)).alias("rows"))
    return out.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "rows")


def rolling_steps(df: DataFrame, key: str, frame: str, x: str, y: str, size: int) -> DataFrame:
    """Each frame's step and the mean of the last ``size`` steps, as frames arrive in order of a track.

    The state of a track is its last position and ``size`` - 1 steps. Frames
    that come after a later one of their track are counted from where it is.
    """
    reachable(df.sparkSession)

    def run(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        px, py, past = state.get if state.exists else (None, None, [])
        past = list(past)
        for pdf in batches:
            out = []
            for t, a, b in pdf.sort_values(frame)[[frame, x, y]].itertuples(index=False):
                step = 0.0 if px is None else ((a - px) ** 2 + (b - py) ** 2) ** 0.5
                past = [*past, step][-size:]
                px, py = a, b
                out.append((keys[0], t, step, sum(past) / len(past)))
            yield pd.DataFrame(out, columns=[key, frame, "step", "mean_step"])
        state.update((px, py, past))

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = f"{key} {kinds[key]}, {frame} {kinds[frame]}, step double, mean_step double"
    return df.groupBy(key).applyInPandasWithState(run, schema, "px double, py double, past array<double>", "append", GroupStateTimeout.NoTimeout)
