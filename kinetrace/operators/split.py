"""Ordered operators over sessions that are cut into ranges.

A session of many hours, or a key that holds a third of all rows, need not fit
into one task: its rows are cut into ranges of the ordering column, and a window
holds the rows of one range. What a row needs from other ranges is carried on
two levels. Every range is summed up in one row (the last known value, a count,
the state at its borders); the summaries of a session, one row a range, are
scanned in order; and each range is finished with what the scan hands to it.

The rows are shuffled once, by session and range; the summaries are aggregated
before their shuffle and are fewer by the size of a range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Numbers of the ordering column in a range, where nothing else is said.
RANGE = 1 << 16
#: Rows of a range that also gets rows around it: a window holds them without its spilling buffer.
ROWS = 4000
_PART = "_part"


@dataclass(frozen=True)
class Carry:
    """What ranges hand on: an aggregate of a range's rows, and how those of the ranges before (``last``, ``sum``) or after (``next``) are put together."""

    summary: Column
    how: str


@dataclass(frozen=True)
class SplitTrack:
    """Keys of a session, the column that orders its rows, how much of it a range spans, and what orders rows that tie.

    Rows with a null in the ordering column come first and are one range; null
    keys are a session like others. Rows that tie in all ordering columns have
    no defined order.
    """

    keys: tuple[str, ...]
    order: str = "frame_idx"
    size: float = RANGE
    ties: tuple[str, ...] = ()

    @property
    def part(self) -> Column:
        """Session and range as one struct: equal also where a key is null."""
        return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(self.keys)], F.floor(F.col(self.order) / self.size).alias("range"))

    @property
    def place(self) -> Column:
        """What orders rows, as one value."""
        return F.struct(*[F.col(c) for c in (self.order, *self.ties)])

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(_PART).orderBy(self.order, *self.ties)

    @property
    def so_far(self) -> WindowSpec:
        return self.window.rowsBetween(Window.unboundedPreceding, 0)

    @property
    def from_end(self) -> WindowSpec:
        return Window.partitionBy(_PART).orderBy(*[F.col(c).desc() for c in (self.order, *self.ties)]).rowsBetween(Window.unboundedPreceding, 0)

    def carried(self, df: DataFrame, carries: Mapping[str, Carry]) -> DataFrame:
        """Adds the range and what it gets from the others of its session; drop both with :meth:`done`."""
        cut = df.withColumn(_PART, self.part)
        one = cut.groupBy(_PART).agg(*[c.summary.alias(n) for n, c in carries.items()])
        whole = Window.partitionBy(*[F.col(_PART)[f"k{i}"] for i in range(len(self.keys))])
        others = (Window.unboundedPreceding, -1)
        before = whole.orderBy(F.col(_PART)["range"]).rowsBetween(*others)
        after = whole.orderBy(F.col(_PART)["range"].desc()).rowsBetween(*others)
        scan = {"last": lambda n: F.last(n, True).over(before), "next": lambda n: F.last(n, True).over(after), "sum": lambda n: F.coalesce(F.sum(n).over(before), F.lit(0))}
        return cut.join(one.select(_PART, *[scan[c.how](n).alias(n) for n, c in carries.items()]), _PART)

    @staticmethod
    def done(df: DataFrame) -> DataFrame:
        return df.drop(*[c for c in df.columns if c.startswith("_")])

    # Numbers and neighbours

    def numbered(self, df: DataFrame, into: str = "frame_idx") -> DataFrame:
        """Each row's place in its session, from 0."""
        met = self.carried(df, {"_n": Carry(F.count(F.lit(1)), "sum")})
        return met.withColumn(into, (F.row_number().over(self.window) - 1 + F.col("_n")).cast("long")).drop(_PART, "_n")

    def previous(self, df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
        """Values of the row before, by their new names; a missing one is the next known value, so the first row takes its own."""
        carries = {}
        for i, c in enumerate(columns.values()):
            carries[f"_l{i}"] = Carry(F.max_by(F.struct(F.col(c).alias("v")), self.place), "last")
            carries[f"_r{i}"] = Carry(F.min_by(F.col(c), F.when(F.col(c).isNotNull(), self.place)), "next")
        met = self.carried(df, carries)
        first = F.row_number().over(self.window) == 1
        made = {}
        for i, (into, c) in enumerate(columns.items()):
            back = F.when(first, F.col(f"_l{i}.v")).otherwise(F.lag(c, 1).over(self.window))
            made[into] = F.coalesce(back, F.last(c, True).over(self.from_end), F.col(f"_r{i}"))
        return self.done(met.withColumns(made))

    def change(self, df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
        """Previous value minus this one; 0 in the first row."""
        back = self.previous(df, {f"{into}__": c for into, c in columns.items()})
        return back.withColumns({into: F.col(f"{into}__") - F.col(c) for into, c in columns.items()}).drop(*[f"{into}__" for into in columns])

    def step(self, df: DataFrame, x: str, y: str, into: str = "step") -> DataFrame:
        """Distance from the previous position; 0 in the first row."""
        moved = self.change(df, {"dx__": x, "dy__": y})
        return moved.withColumn(into, F.sqrt(F.col("dx__") * F.col("dx__") + F.col("dy__") * F.col("dy__"))).drop("dx__", "dy__")

    # Filling

    def filled(self, df: DataFrame, columns: Mapping[str, str], limit: int | None = None, both: bool = False) -> DataFrame:
        """Linear interpolation over missing values by the ordering column, as :meth:`Track.filled` does it."""
        known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(self.order).alias("t"), F.col(c).alias("v"))) for c in columns.values()}
        carries = {}
        for i, c in enumerate(columns.values()):
            carries |= {f"_l{i}": Carry(F.max(known[c]), "last"), f"_r{i}": Carry(F.min(known[c]), "next")}
        met, made, here = self.carried(df, carries), {}, F.col(self.order)
        sides = {}
        for i, c in enumerate(columns.values()):
            sides |= {f"_a{i}": F.coalesce(F.last(known[c], True).over(self.so_far), F.col(f"_l{i}")), f"_b{i}": F.coalesce(F.last(known[c], True).over(self.from_end), F.col(f"_r{i}"))}
        for i, (into, c) in enumerate(columns.items()):
            at, av, bt, bv = (F.col(f"_{s}{i}.{f}") for s in "ab" for f in "tv")
            value = F.when(bt.isNull(), av).otherwise(av + (bv - av) * (here - at) / (bt - at))
            if limit is not None:
                value = F.when(here - at <= limit, value)
            if both:
                value = F.when(at.isNull(), bv).otherwise(value)
            made[into] = F.when(F.col(c).isNotNull(), F.col(c)).otherwise(value)
        return self.done(met.withColumns(sides).withColumns(made))

    # Running states

    def times(self, df: DataFrame, flag: Column, into: str) -> DataFrame:
        """How often ``flag`` has held so far, this row included."""
        held = F.coalesce(flag, F.lit(False)).cast("int")
        met = self.carried(df, {"_n": Carry(F.sum(held), "sum")})
        return self.done(met.withColumn(into, F.sum(held).over(self.so_far) + F.col("_n")))

    def odd(self, df: DataFrame, flag: Column, into: str) -> DataFrame:
        """Whether ``flag`` has held an odd number of times so far."""
        return self.times(df, flag, into).withColumn(into, F.col(into) % 2 == 1)

    def islands(self, df: DataFrame, state: Column, into: str) -> DataFrame:
        """A number shared by neighbouring rows with the same ``state``, from 0: how often it has turned in its session. Null is a state.

        A turn at a range's border shows when its summary meets that of the range before.
        """
        cut = df.withColumn("_state", state).withColumn(_PART, self.part)
        turned = (~F.col("_state").eqNullSafe(F.lag("_state", 1).over(self.window))).cast("int")
        inner = cut.withColumn("_turn", F.when(F.row_number().over(self.window) == 1, 0).otherwise(turned))
        one = inner.groupBy(_PART).agg(F.sum("_turn").alias("_n"), F.min_by(F.struct("_state"), self.place).alias("_first"), F.max_by(F.struct("_state"), self.place).alias("_last"))
        order = Window.partitionBy(*[F.col(_PART)[f"k{i}"] for i in range(len(self.keys))]).orderBy(F.col(_PART)["range"])
        back = F.lag("_last", 1).over(order)
        border = F.when(back.isNull(), 0).otherwise((~F.col("_first._state").eqNullSafe(back["_state"])).cast("int"))
        scanned = one.withColumn("_border", border).select(_PART, (F.sum(F.col("_n") + F.col("_border")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
        met = inner.join(scanned, _PART)
        return self.done(met.withColumn(into, F.sum("_turn").over(self.so_far) + F.col("_before")))

    def runs(self, df: DataFrame, flag: Column, more: Sequence[Column] = ()) -> DataFrame:
        """Runs of neighbouring rows where ``flag`` holds: keys, first and last place, number of rows and further aggregates.

        A run that spans ranges is put together from one row of each.
        """
        numbered = self.islands(df.withColumn("run__flag", F.coalesce(flag, F.lit(False))), F.col("run__flag"), "run__")
        found = numbered.where("run__flag").groupBy(*self.keys, "run__").agg(F.min(self.order).alias("first"), F.max(self.order).alias("last"), F.count(F.lit(1)).alias("length"), *more)
        return found.drop("run__")


def dealt(rows: DataFrame, before: int, after: int = 0, size: int = ROWS) -> DataFrame:
    """Numbered rows (``row__``, of :meth:`SplitTrack.numbered`) by ranges of ``size``, each with the rows around it that windows of its own rows reach: adds ``range__``.

    Windows are then partitioned by key and ``range__`` and ordered by ``row__``; rows where :func:`own` holds stay.
    """
    low, high = (F.floor((F.col("row__") + k) / size) for k in (-after, before))
    return rows.withColumn("range__", F.explode(F.sequence(F.greatest(low, F.lit(0)), high)))


def own(size: int = ROWS) -> Column:
    """Whether a row of :func:`dealt` lies in its range itself."""
    return F.col("range__") == F.floor(F.col("row__") / size)


def nearest(events: DataFrame, frames: DataFrame, keys: Sequence[str], time: str, pts: str, frame: str, into: str = "frame", error: str = "frame_error", size: float = 3600.0) -> DataFrame:
    """:func:`kinetrace.operators.align.nearest` over ranges of ``size`` seconds.

    A range hands its last frame to the ranges after it and its first to those
    before. Of two equally near frames the earlier holds; events of a key
    without frames, or with a null time, get nulls.
    """
    columns = events.columns
    whole = F.struct(*[F.col(c) for c in columns])
    e = events.select(*keys, F.col(time).cast("double").alias("t__"), F.lit(1).alias("kind__"), F.lit(None).cast(frames.schema[frame].dataType).alias("frame__"), whole.alias("event__"))
    f = frames.where(F.col(pts).isNotNull()).select(*keys, F.col(pts).cast("double").alias("t__"), F.lit(0).alias("kind__"), F.col(frame).alias("frame__"), F.lit(None).cast(e.schema["event__"].dataType).alias("event__"))
    track = SplitTrack(tuple(keys), "t__", size, ("kind__", "frame__"))
    known = F.when(F.col("kind__") == 0, F.struct("t__", "frame__"))
    met = track.carried(f.unionByName(e), {"_l": Carry(F.max(known), "last"), "_r": Carry(F.min(known), "next")})
    met = met.withColumns({"_before": F.coalesce(F.last(known, True).over(track.so_far), F.col("_l")), "_after": F.coalesce(F.last(known, True).over(track.from_end), F.col("_r"))})
    t = F.col("t__")
    earlier = F.col("_after").isNull() | (t - F.col("_before.t__") <= F.col("_after.t__") - t)
    best = F.when(t.isNotNull(), F.when(earlier, F.col("_before")).otherwise(F.col("_after")))
    met = met.where("kind__ = 1").withColumn("_best", best)
    return met.select(*[F.col("event__")[c].alias(c) for c in columns], F.col("_best.frame__").alias(into), (F.col("_best.t__") - t).alias(error))
