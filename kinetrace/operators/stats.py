"""Aggregations over tracks and values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetrace.functions.geometry import sum_of
from kinetrace.operators.track import Track


def intervals(frames: DataFrame, track: Track, pts: str = "pts_seconds", uneven: float = 0.01) -> DataFrame:
    """For each track: frames, rate, and mean, deviation (population), least and largest time between frames.

    ``is_vfr``: the deviation exceeds ``uneven`` of the mean. A track of one
    frame has no rate.
    """
    steps = frames.withColumn("_gap", F.col(pts) - F.lag(pts).over(track.window))
    out = steps.groupBy(*track.keys).agg(
        F.count(F.lit(1)).alias("frame_count"),
        F.try_divide(F.count(F.lit(1)) - 1, F.max(pts) - F.min(pts)).alias("fps"),
        F.avg("_gap").alias("ifi_mean_sec"),
        F.stddev_pop("_gap").alias("ifi_std_sec"),
        F.min("_gap").alias("ifi_min_sec"),
        F.max("_gap").alias("ifi_max_sec"),
    )
    return out.withColumn("is_vfr", F.col("ifi_std_sec") > F.col("ifi_mean_sec") * uneven)


def in_range(columns: Sequence[Column], low: float, high: float) -> Column:
    """How many values lie in [low, high]."""
    return sum_of([F.when(c.between(low, high), 1).otherwise(0) for c in columns])


def missing_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Missing values of each column, and rows where all are missing."""
    every = F.lit(True)
    for c in columns:
        every = every & F.col(c).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("frames"), *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns], F.count_if(every).alias("missing_all"))


def tracks(df: DataFrame, keys: Sequence[str], track: str = "track", frame: str = "frame_idx") -> DataFrame:
    """Rows, first and last frame of each track."""
    return df.groupBy(*keys, track).agg(F.count(F.lit(1)).alias("rows"), F.min(frame).alias("first"), F.max(frame).alias("last"))


def circular_histogram(df: DataFrame, keys: Sequence[str], angle: str, weight: str, bins: int = 72, period: float = 180.0) -> DataFrame:
    """Summed weights of ``bins`` equal bins of an angle, smoothed with their neighbours around the circle, and which are peaks.

    Smoothing weighs a bin 1/2 and its neighbours 1/4; a peak exceeds both.
    Bins without a value are there with weight 0.
    """
    width = period / bins
    slot = F.pmod(F.floor(F.pmod(F.col(angle), F.lit(period)) / width), F.lit(bins)).cast("int")
    sums = df.groupBy(*keys, slot.alias("bin")).agg(F.sum(weight).alias("weight"))
    every = df.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    full = every.join(sums, [*keys, "bin"], "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    order, whole = Window.partitionBy(*keys).orderBy("bin"), Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    around = lambda c: (F.coalesce(F.lag(c).over(order), F.last(c).over(whole)), F.coalesce(F.lead(c).over(order), F.first(c).over(whole)))
    left, right = around("weight")
    full = full.withColumn("smooth", F.col("weight") / 2 + (left + right) / 4)
    left, right = around("smooth")
    return full.withColumn("is_peak", (F.col("smooth") > left) & (F.col("smooth") > right))


def circular_mean(angle: str, weight: str, center: Column, period: float = 180.0) -> Column:
    """Aggregate: weighted mean of angles near ``center``, taken on the side of the circle where they are close to it."""
    a = F.col(angle)
    near = F.when(a - center > period / 2, a - period).when(center - a > period / 2, a + period).otherwise(a)
    return F.pmod(F.try_divide(F.sum(near * F.col(weight)), F.sum(weight)), F.lit(period))


def perpendicular_peaks(peaks: DataFrame, keys: Sequence[str], most: int = 8, angle: str = "bin", weight: str = "smooth", period: float = 180.0, best: float = 90.0) -> DataFrame:
    """The pair among the ``most`` strongest peaks with the best sum of weights, lowered by its distance from a right angle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(weight), angle))
    top = peaks.withColumn("_rank", rank).where(F.col("_rank") <= most)
    a = top.select(*keys, F.col(angle).alias("first"), F.col(weight).alias("_w1"))
    b = top.select(*keys, F.col(angle).alias("second"), F.col(weight).alias("_w2"))
    gap = F.abs(F.col("first") - F.col("second"))
    gap = F.least(gap, F.lit(period) - gap)
    pairs = a.join(b, list(keys)).where("first < second").withColumn("score", (F.col("_w1") + F.col("_w2")) * (1 - F.abs(gap - best) / best))
    return pairs.groupBy(*keys).agg(F.max_by(F.struct("first", "second", "score"), F.struct("score", -F.col("first"), -F.col("second"))).alias("_b")).select(*keys, "_b.*")


def best_candidate(df: DataFrame, keys: Sequence[str], score: str, ties: Sequence[str]) -> DataFrame:
    """The row with the highest score of each key; ties go by the given columns, ascending."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), *ties)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def extreme(df: DataFrame, keys: Sequence[str], position: str, score: str, share: float = 0.25, upper: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    """The best row by score among those in the outer ``share`` of positions of each key."""
    over = Window.partitionBy(*keys)
    low, high = F.min(position).over(over), F.max(position).over(over)
    edge = F.col(position) >= high - (high - low) * share if upper else F.col(position) <= low + (high - low) * share
    return best_candidate(df.withColumn("_edge", edge).where("_edge").drop("_edge"), keys, score, ties)
