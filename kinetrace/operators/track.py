"""Ordered operators: everything that depends on the order of a track's frames.

A :class:`Track` names the columns that make a track (the partition key of every
operator here) and the one that orders it. Operators that share a track share
one shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Track:
    """Keys of a track and the column that orders its frames."""

    keys: tuple[str, ...]
    order: str = "frame_idx"

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(self.order)

    @property
    def whole(self) -> WindowSpec:
        return Window.partitionBy(*self.keys)

    @property
    def before(self) -> WindowSpec:
        return self.window.rowsBetween(Window.unboundedPreceding, 0)

    @property
    def backward(self) -> WindowSpec:
        """The track from its end. What lies ahead is looked up here: a frame that ends at the partition's end
        would be gone through again for every row, one that begins there grows by a row at a time."""
        return Window.partitionBy(*self.keys).orderBy(F.col(self.order).desc())

    def ahead(self, c: Column | str, since: int = 0) -> Column:
        """The first known value from ``since`` rows back on."""
        return F.last(c, True).over(self.backward.rowsBetween(Window.unboundedPreceding, since))

    def over(self, frame: str = "", ordered: bool = True) -> str:
        """The track's window in SQL: operators that make hundreds of columns write each as one text, as every operation on a Column is a call into the JVM."""
        keys = ", ".join(f"`{k}`" for k in self.keys)
        return f"OVER (PARTITION BY {keys}{f' ORDER BY `{self.order}`' if ordered else ''} {frame})"

    # Neighbours

    def previous(self, c: str, by: int = 1, known: bool = False) -> Column:
        """The value ``by`` rows back; missing ones take the next known value, so the first row takes its own.

        ``known``: no value is missing, so only the first rows need another
        and the track is not sorted backward (for ``by`` = 1).
        """
        if known and by == 1:
            return F.coalesce(F.lag(c, 1).over(self.window), F.col(c))
        return self.ahead(c, by)

    def change(self, c: str, known: bool = False) -> Column:
        """Previous value minus this one; 0 in the first row."""
        if known:
            return F.expr(self._change(c))
        return self.previous(c, 1) - F.col(c)

    def _change(self, c: str) -> str:
        return f"(coalesce(lag(`{c}`, 1) {self.over()}, `{c}`) - `{c}`)"

    def step(self, x: str, y: str, known: bool = False) -> Column:
        """Distance from the previous position; 0 in the first row."""
        if known:
            dx, dy = self._change(x), self._change(y)
            return F.expr(f"sqrt({dx} * {dx} + {dy} * {dy})")
        dx, dy = self.change(x), self.change(y)
        return F.sqrt(dx * dx + dy * dy)

    def difference(self, c: str) -> Column:
        """This value minus the previous one; the first row repeats the second's."""
        d = F.col(c) - F.lag(c, 1).over(self.window)
        return F.coalesce(d, F.lead(c, 1).over(self.window) - F.col(c))

    def second_difference(self, c: str) -> Column:
        """x[t] - 2 x[t-1] + x[t-2]; null in the first two rows."""
        return F.col(c) - 2 * F.lag(c, 1).over(self.window) + F.lag(c, 2).over(self.window)

    # Trailing and leading windows

    def rolling(self, c: str, n: int, how: str = "mean") -> Column:
        """Mean, median, sum, min or max over this row and the n - 1 before it; nulls are passed over."""
        value = f"percentile(`{c}`, 0.5D)" if how == "median" else f"{ {'mean': 'avg', 'sum': 'sum', 'min': 'min', 'max': 'max'}[how]}(`{c}`)"
        return F.expr(f"{value} {self.over(f'ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW')}")

    def smoothed(self, c: str, n: int) -> Column:
        """Mean of this row and the n - 1 after it; null where fewer are left."""
        frame = self.window.rowsBetween(0, n - 1)
        return F.when(F.count(F.lit(1)).over(frame) == n, F.avg(c).over(frame))

    # Whole-track statistics

    def deviation(self, c: str) -> Column:
        """The track's mean minus the value."""
        return F.expr(f"avg(`{c}`) {self.over(ordered=False)} - `{c}`")

    def percentile_rank(self, c: str) -> Column:
        """Rank over count, ties sharing their mean rank; nulls have none."""
        ordered = Window.partitionBy(*self.keys).orderBy(F.col(c).asc_nulls_last())
        # Rows up to and with the ties, over the same order: no sort of its own.
        with_ties = F.count(F.lit(1)).over(ordered.rangeBetween(Window.unboundedPreceding, 0))
        return F.when(F.col(c).isNotNull(), (F.rank().over(ordered) + with_ties) / 2 / F.count(c).over(self.whole))

    # Running states

    def times(self, flag: Column) -> Column:
        """How often ``flag`` has held so far, this row included."""
        return F.sum(flag.cast("int")).over(self.before)

    def odd(self, flag: Column) -> Column:
        """Whether ``flag`` has held an odd number of times so far."""
        return F.coalesce(self.times(flag), F.lit(0)) % 2 == 1

    def rises(self, flag: Column) -> Column:
        """Whether ``flag`` holds here and did not in the previous row."""
        return flag & ~F.coalesce(F.lag(flag, 1).over(self.window), F.lit(False))

    def island(self, flag: Column) -> Column:
        """A number shared by neighbouring rows with the same ``flag``."""
        turn = F.coalesce((flag != F.lag(flag, 1).over(self.window)).cast("int"), F.lit(0))
        return F.sum(turn).over(self.before)

    # Filling

    def filled(self, c: str, limit: int | None = None, both: bool = False, known: Column | None = None) -> Column:
        """Linear interpolation over missing values by frame number.

        At most ``limit`` frames after a known value are filled; after the last
        known value it is repeated. Frames before the first stay missing, or
        take it if ``both``. ``known`` says which values count; by default
        those that are not null.
        """
        known = F.col(c).isNotNull() if known is None else F.coalesce(known & F.col(c).isNotNull(), F.lit(False))
        at = F.when(known, F.struct(F.col(self.order).alias("t"), F.col(c).alias("v")))
        left, right = F.last(at, True).over(self.before), self.ahead(at)
        here = F.col(self.order)
        line = left["v"] + (right["v"] - left["v"]) * (here - left["t"]) / (right["t"] - left["t"])
        value = F.when(right.isNull(), left["v"]).otherwise(line)
        if limit is not None:
            value = F.when(here - left["t"] <= limit, value)
        if both:
            value = F.when(left.isNull(), right["v"]).otherwise(value)
        return F.when(known, F.col(c)).otherwise(value)

    def bridged(self, c: str, x: str, y: str) -> Column:
        """A value of a point, where 0 in x or y means that it was not seen: a line over such frames, the nearest known value at both ends."""
        return self.filled(c, both=True, known=(F.col(x) != 0) & (F.col(y) != 0))


def in_stages(df: DataFrame, stages: Sequence[dict[str, Column]]) -> DataFrame:
    """Adds columns stage by stage: a stage may use what the ones before it made."""
    for stage in stages:
        df = df.withColumns(stage)
    return df


def densify(df: DataFrame, track: Track, start: int | None = None, whole: Sequence[str] | None = None) -> DataFrame:
    """A row for each frame from the track's first (or ``start``) to its last; new rows have nulls.

    ``whole`` names the keys over which the range of frames is taken, if it is
    shared by several tracks. Frames are numbers or dates.
    """
    over = tuple(whole) if whole is not None else track.keys
    low = F.min(track.order) if start is None else F.lit(start).cast(df.schema[track.order].dataType)
    ranges = df.groupBy(*over).agg(low.alias("_low"), F.max(track.order).alias("_high"))
    if over != track.keys:
        tracks = df.select(*track.keys).distinct()
        ranges = tracks.join(ranges, list(over)) if over else tracks.crossJoin(F.broadcast(ranges))  # a single row
    frames = ranges.select(*track.keys, F.explode(F.sequence("_low", "_high")).alias(track.order))
    return frames.join(df, [*track.keys, track.order], "left").select(*df.columns)


def runs(df: DataFrame, track: Track, flag: Column) -> DataFrame:
    """Runs of neighbouring rows where ``flag`` holds: keys, first and last frame, number of rows."""
    marked = df.withColumn("_flag", F.coalesce(flag, F.lit(False)))
    marked = marked.withColumn("_island", track.island(F.col("_flag")))
    found = marked.where("_flag").groupBy(*track.keys, "_island").agg(F.min(track.order).alias("first"), F.max(track.order).alias("last"), F.count(F.lit(1)).alias("length"))
    return found.drop("_island")


def consecutive(df: DataFrame, track: Track) -> DataFrame:
    """Rows grouped into runs of frame numbers without a hole: keys, first and last frame, number of rows."""
    numbered = df.withColumn("_run", F.col(track.order) - F.row_number().over(track.window))
    return numbered.groupBy(*track.keys, "_run").agg(F.min(track.order).alias("first"), F.max(track.order).alias("last"), F.count(F.lit(1)).alias("length")).drop("_run")


def filled_runs(df: DataFrame, track: Track, c: str, filled: str) -> DataFrame:
    """Runs of frames of ``c`` that were missing and that ``filled`` has a value for.

    A run is one gap, trimmed to its filled part.
    """
    gaps = df.withColumn("_gap", F.col(c).isNull()).withColumn("_island", track.island(F.col("_gap")))
    return gaps.where(F.col("_gap") & F.col(filled).isNotNull()).groupBy(*track.keys, "_island").agg(F.min(track.order).alias("first"), F.max(track.order).alias("last")).drop("_island")
