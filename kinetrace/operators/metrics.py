"""Event metrics: declared as specifications, computed in one pass over the frames.

First the time points of every event and animal (entry into the nest, exit,
freezing) are found; then all windows that the metrics need are laid out as
rows, joined with the frames once, and reduced by one aggregation whose
conditions pick each metric's window. No metric depends on another's side
effects.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetrace.operators import trajectory
from kinetrace.operators.align import in_windows
from kinetrace.operators.track import Track, in_stages
from kinetrace.schema import BODY_PARTS, DEFAULT_FPS, FREEZE_OFF, FREEZE_ON, NEST_FRAMES, STILL, STILL_RUN


@dataclass(frozen=True)
class Span:
    """A window [start + start_offset, end + end_offset) of frames.

    Points are ``loom`` or ``latency``; a missing point leaves the window
    empty. ``most`` bounds its length. ``both``: the part that all animals'
    windows share.
    """

    start: str = "loom"
    end: str = "loom"
    start_offset: int = 0
    end_offset: int = 0
    most: int | None = None
    both: bool = False


@dataclass(frozen=True)
class Metric:
    """A named reduction of a frame column over a span.

    ``kind``: mean, percent (of a flag), sum, or max_smoothed (largest mean of
    ``smooth`` neighbouring frames inside the window). ``column`` may hold
    ``{i}`` for the animal. ``post`` works on the result.
    """

    name: str
    kind: str
    column: str
    span: Span
    smooth: int = 1
    post: Callable[[Column], Column] | None = field(default=None, compare=False)


def to_seconds(fps: float) -> Callable[[Column], Column]:
    """Frames to seconds; negative values (missing) stay."""
    return lambda c: F.when(c >= 0, c / fps).otherwise(c)


def to_cm(px_per_cm: float) -> Callable[[Column], Column]:
    return lambda c: F.when(c >= 0, c / px_per_cm).otherwise(c)


def to_cm_per_second(fps: float, px_per_cm: float) -> Callable[[Column], Column]:
    return lambda c: F.when(c >= 0, c * fps / px_per_cm).otherwise(c)


def loom_events(events: DataFrame, keys: Sequence[str], kind: str = "loom") -> DataFrame:
    """Events of a kind in order of time: keys, number from 1, frame, and where the next begins."""
    order = Window.partitionBy(*keys).orderBy("time_start", "frame_start")
    return events.where(F.col("event_type") == kind).select(*keys, F.row_number().over(order).cast("int").alias("loom"), F.col("frame_start").alias("at"), F.lead("frame_start").over(order).alias("until"))


def time_points(frames: DataFrame, looms: DataFrame, keys: Sequence[str], frame: str = "frame_idx", inside: str = "inside", near: str = "near", slow: str = "slow", calm: str = "calm") -> DataFrame:
    """Latency, exit and freezing of each event and animal.

    ``frames``: keys, animal, frame and flags: all parts inside the nest, some
    part near it, speed below the low and below the high threshold. Returns
    for each: ``loom_frame``, ``latency`` (frames until the fifth frame inside,
    minus 4, before the next event), ``entry_frame``, ``stay`` (frames until no
    part is near), ``freeze_start`` (frames until the 35th slow frame, minus
    34, if the animal has not entered before) and ``freeze_length`` (frames
    until the fifth fast frame after it, minus 5, or the rest of the session).
    Counts never start anew. Null is missing.
    """
    each, who = [*keys, "animal"], [*keys, "animal", "loom"]
    end = frames.groupBy(*keys).agg((F.max(frame) + 1).alias("_end"))
    animals = frames.groupBy(*each).agg((F.max(frame) + 1).alias("_own"))
    base = animals.join(looms, list(keys)).join(end, list(keys)).withColumn("_next", F.least(F.coalesce("until", "_end"), F.col("_end")))
    flags = {"inside": F.col(inside), "slow": F.col(slow), "fast": ~F.coalesce(F.col(calm), F.lit(False)), "far": ~F.col(near)}
    seen = frames.where(F.col(frame).isNotNull()).select(*each, F.col(frame).alias("_frame"), *[F.coalesce(c.cast("int"), F.lit(0)).alias(n) for n, c in flags.items()])

    def nth(given: DataFrame, since: dict[str, tuple[Column, int]]) -> DataFrame:
        """Adds ``_{flag}``: the frame where the flag holds for the n-th time, counted from a place on.

        A place takes the count of the frames before it, and the frame that has n more is the one sought: no event meets all later frames.
        """
        held = seen.select(*each, "_frame", F.explode(F.array_compact(F.array(*[F.when(F.col(f) == 1, F.lit(f)) for f in since]))).alias("_flag"), F.lit(1).alias("_kind"), F.lit(0).alias("_more"), F.lit(None).cast("int").alias("loom"))
        places = F.array(*[F.struct(place.alias("at"), F.lit(f).alias("flag"), F.lit(n).alias("n")) for f, (place, n) in since.items()])
        asked = given.select(*each, "loom", F.explode(places).alias("_p")).where("_p.at IS NOT NULL")
        asked = asked.select(*each, F.col("_p.at").alias("_frame"), F.col("_p.flag").alias("_flag"), F.lit(0).alias("_kind"), F.col("_p.n").alias("_more"), "loom")
        so_far = Window.partitionBy(*each, "_flag").orderBy("_frame", "_kind").rowsBetween(Window.unboundedPreceding, 0)
        counted = held.unionByName(asked).withColumn("_count", F.sum("_kind").over(so_far) + F.col("_more"))
        met = counted.withColumn("_met", F.max(F.when(F.col("_kind") == 1, F.col("_frame"))).over(Window.partitionBy(*each, "_flag", "_count")))
        found = met.where("_kind = 0").groupBy(*who).agg(*[F.max(F.when(F.col("_flag") == f, F.col("_met"))).alias(f"_{f}") for f in since])
        return given.join(found, who, "left")

    at = F.col("at")
    first = nth(base, {"inside": (at, NEST_FRAMES), "slow": (at, FREEZE_ON)})
    first = first.withColumns({"latency": F.when(F.col("_inside") < F.col("_next"), F.col("_inside") - at - (NEST_FRAMES - 1)), "_frozen": F.col("_slow") - at})
    entered = F.col("latency").isNotNull() & (F.col("latency") > 0) & (F.col("_frozen") >= F.col("latency"))
    first = first.withColumn("freeze_start", F.when(~entered, F.col("_frozen") - (FREEZE_ON - 1)))
    later = nth(first, {"far": (at + F.greatest("latency", F.when(F.col("latency").isNotNull(), 0)), 1), "fast": (at + F.greatest("freeze_start", F.when(F.col("freeze_start").isNotNull(), 0)), FREEZE_OFF)})
    start = F.col("freeze_start")
    length = F.when(start.isNotNull(), F.coalesce(F.col("_fast") - at - start - FREEZE_OFF, F.col("_own") - at - start))
    return later.select(*who, at.alias("loom_frame"), "until", "latency", (at + F.col("latency")).alias("entry_frame"), (F.col("_far") - at - F.col("latency")).alias("stay"), "freeze_start", length.alias("freeze_length"))


def windows_of(points: DataFrame, keys: Sequence[str], spans: Sequence[Span], end_of: DataFrame) -> DataFrame:
    """One row for each event, animal and span: ``span`` (its place), ``start`` and ``end``, null where a point is missing."""
    who = [*keys, "animal", "loom"]
    at = {"loom": F.col("loom_frame"), "latency": F.col("entry_frame")}
    rows = []
    for k, s in enumerate(spans):
        start = at[s.start] + s.start_offset
        end = at[s.end] + s.end_offset
        if s.most is not None:
            end = F.least(end, start + s.most)
        known = at[s.start].isNotNull() & at[s.end].isNotNull()
        rows.append(F.struct(F.lit(k).alias("span"), F.lit(s.both).alias("both"), F.when(known, start).alias("start"), F.when(known, F.least(end, F.col("_end"))).alias("end")))
    out = points.join(end_of, list(keys)).select(*who, F.explode(F.array(*rows)).alias("_w")).select(*who, "_w.*")
    each = Window.partitionBy(*keys, "loom", "span")
    whole = F.count("start").over(each) == F.count(F.lit(1)).over(each)
    low, high = F.max("start").over(each), F.min("end").over(each)
    good = ~F.col("both") | (whole & (low < high))
    return out.withColumns({"_low": F.when(F.col("both"), low).otherwise(F.col("start")), "_high": F.when(F.col("both"), high).otherwise(F.col("end")), "_good": good}).select(
        *who, "span", F.when(F.col("_good"), F.col("_low")).alias("start"), F.when(F.col("_good"), F.col("_high")).alias("end")
    )


def measure(frames: DataFrame, points: DataFrame, keys: Sequence[str], metrics: Sequence[Metric], frame: str = "frame_idx") -> DataFrame:
    """All metrics of every event and animal: one range join and one aggregation.

    ``frames`` has a row for each animal and frame and every column that the
    metrics name. A metric whose window is empty is null.
    """
    who = [*keys, "animal", "loom"]
    spans = list(dict.fromkeys(m.span for m in metrics))
    smooth = sorted({(m.column, m.smooth) for m in metrics if m.kind == "max_smoothed"})
    track = Track((*keys, "animal"), frame)
    frames = frames.withColumns({f"_s{n}_{c}": track.smoothed(c, n) for c, n in smooth}) if smooth else frames
    end_of = frames.groupBy(*keys).agg((F.max(frame) + 1).alias("_end"))
    met = in_windows(frames, windows_of(points, keys, spans, end_of), [*keys, "animal"], frame)
    reduced = []
    for m in metrics:
        here = F.col("span") == spans.index(m.span)
        if m.kind == "max_smoothed":
            inside = here & (F.col(frame) + m.smooth <= F.col("end"))
            value = F.max(F.when(inside, F.col(f"_s{m.smooth}_{m.column}")))
        else:
            c = F.when(here, F.col(m.column).cast("double"))
            value = {"mean": F.avg, "percent": lambda x: 100 * F.avg(x), "sum": F.sum}[m.kind](c)
        reduced.append((m.post(value) if m.post else value).alias(m.name))
    out = met.groupBy(*who).agg(*reduced)
    return points.select(*who).join(out, who, "left")


def still_stages(track: Track, columns: dict[str, str], tolerance: float = STILL, least: int = STILL_RUN) -> list[dict[str, Column]]:
    """Stages that add, by new names, 1 in runs of ``least`` frames or more of nearly constant speed along a column.

    A frame lies in such a run where one of the ``least`` rows from it on ends as many flat ones, so windows stay short.
    """
    ends, begins = track.window.rowsBetween(1 - least, 0), track.window.rowsBetween(0, least - 1)
    return [
        {f"_flat_{n}": F.coalesce(F.abs(track.second_difference(c)) < tolerance, F.lit(False)).cast("int") for n, c in columns.items()},
        {f"_full_{n}": (F.sum(f"_flat_{n}").over(ends) == least).cast("int") for n in columns},
        {n: F.max(f"_full_{n}").over(begins) for n in columns},
    ]


def still_runs(df: DataFrame, track: Track, part: str, tolerance: float = STILL, least: int = STILL_RUN) -> DataFrame:
    """Adds ``still_{part}``: 1 in runs of ``least`` frames or more of nearly constant speed along x, which interpolation leaves."""
    name = f"still_{part}"
    return in_stages(df, still_stages(track, {name: f"{part}_x"}, tolerance, least)).drop(f"_flat_{name}", f"_full_{name}")


def still_everywhere(parts: Sequence[str] = BODY_PARTS) -> Column:
    """1 where all parts are in such a run."""
    return F.least(*[F.col(f"still_{p}") for p in parts])


def path_distances(frames: DataFrame, points: DataFrame, keys: Sequence[str], span: Span, part: str, frame: str = "frame_idx", aligned: bool = False, long: bool = True) -> DataFrame:
    """Frechet distance between the two animals' paths of a part over the window they share.

    ``frames``: one row for each animal and frame with ``{part}_x``,
    ``{part}_y``. Windows of fewer than two frames have none.
    """
    end_of = frames.groupBy(*keys).agg((F.max(frame) + 1).alias("_end"))
    shared = Span(span.start, span.end, span.start_offset, span.end_offset, span.most, True)
    met = in_windows(frames, windows_of(points, keys, [shared], end_of), [*keys, "animal"], frame)
    x, y = F.col(f"{part}_x"), F.col(f"{part}_y")
    paths = met.groupBy(*keys, "loom").agg(*[trajectory.path(frame, F.when(F.col("animal") == i, x), F.when(F.col("animal") == i, y)).alias(f"_all{i}") for i in (1, 2)])
    known = {f"_p{i}": F.filter(f"_all{i}", lambda p: p["x"].isNotNull()) for i in (1, 2)}
    paths = paths.withColumns(known).where("size(_p1) > 1 and size(_p2) > 1")
    if aligned:
        paths = paths.withColumns({f"_p{i}": trajectory.from_origin(F.col(f"_p{i}")) for i in (1, 2)})
    out = trajectory.frechet_groups(paths, "_p1", "_p2") if long else paths.withColumn("frechet", trajectory.frechet(F.col("_p1"), F.col("_p2")))
    return out.select(*keys, "loom", "frechet")


def catalogue(fps: float = DEFAULT_FPS, px_per_cm: float = 1.0, paired: bool = True) -> list[Metric]:
    """The declared metrics over standard columns of an animal's frames; their names are fixed values.

    Columns: ``calm`` (below the high speed threshold), ``angle_to_loom``, ``facing_loom``, ``speed``
    (mean step of nose, tail base and ears), ``nest_speed`` (mean change of the parts' distance to the nest),
    ``still_{part}``, ``still_all``; with two animals also the distances and the angle between them.
    """
    f = lambda seconds: int(seconds * fps)
    during, blink, before = Span(end_offset=f(7.5)), Span(end_offset=f(0.2)), Span(start_offset=-f(10), end_offset=0)
    around = Span(start_offset=-f(10), end_offset=f(17.5))
    entry = Span(start_offset=-4, end="latency", end_offset=4, most=f(10))
    lead_up = Span(start_offset=-f(10) - 4, end_offset=4, most=f(10))
    speed, cm = to_cm_per_second(fps, px_per_cm), to_cm(px_per_cm)
    out = [
        Metric("Freeze Percent (2s window starting at loom)", "percent", "calm", Span(end_offset=f(2))),
        Metric("Freeze Percent (window over whole loom)", "percent", "calm", during),
        Metric("Angle to loom(during loom)", "mean", "angle_to_loom", during),
        Metric("Angle to loom(0.2 seconds after loom)", "mean", "angle_to_loom", blink),
        Metric("Angle to loom(10s before loom)", "mean", "angle_to_loom", before),
        Metric("Facing loom percent", "percent", "facing_loom", during),
        Metric("Max velocity(start loom - nest entry)", "max_smoothed", "speed", entry, 5, speed),
        Metric("Max velocity(10s before loom)", "max_smoothed", "speed", lead_up, 5, speed),
        Metric("Max velocity to nest(start loom - nest entry)", "max_smoothed", "nest_speed", entry, 3, speed),
        Metric("Max velocity to nest(10s before loom)", "max_smoothed", "nest_speed", lead_up, 3, speed),
    ]
    if paired:
        both = lambda s: Span(s.start, s.end, s.start_offset, s.end_offset, s.most, True)
        to_nest, after = Span(end="latency"), Span("latency", "latency", 0, f(10))
        four = (("during loom", both(during)), ("start loom - nest entry", both(to_nest)), ("10s before loom", before), ("10s after nest entry", after))
        for title, column, post in (
            ("Midline angle average", "relative_midline_angle", None),
            ("Nose to nose average", "nose_to_nose_distance", cm),
            ("Nose1 to tail2 average", "nose_1_to_tail_2_distance", cm),
            ("Nose2 to tail1 average", "nose_2_to_tail_1_distance", cm),
        ):
            out += [Metric(f"{title} ({where})", "mean", column, span, 1, post) for where, span in four]
        out.append(Metric("Midline angle average (0.2 seconds after loom)", "mean", "relative_midline_angle", both(blink)))
    titles = {"nose": "Nose", "ear_left": "Left Ear", "ear_right": "Right Ear", "head": "Head", "body_center": "Body Center", "tail_base": "Tail Base"}
    out += [Metric(f"Missing {titles[p]} Frames", "sum", f"still_{p}", around) for p in sorted(BODY_PARTS)]
    return [*out, Metric("Missing Identity Frames", "sum", "still_all", around)]


def stacked(df: DataFrame, keys: Sequence[str], per_animal: dict[str, Callable[[int], Column]], animals: int, shared: Sequence[str] = (), frame: str = "frame_idx") -> DataFrame:
    """One row for each animal and frame from wide rows, with chosen columns of each."""
    rows = [df.select(*keys, frame, F.lit(i).alias("animal"), *shared, *[make(i).alias(n) for n, make in per_animal.items()]) for i in range(1, animals + 1)]
    return reduce(DataFrame.unionByName, rows)
