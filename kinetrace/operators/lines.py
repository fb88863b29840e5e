"""Lines of an image by key: their two dominant directions, outermost lines and the box they make; merging of regions.

Lines are rows of keys, ``angle`` in [0, 180), ``length`` and end points ``x1``,
``y1``, ``x2``, ``y2``. Sums by bin are combined before they are shuffled, so a
key may have any number of lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import exp

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetrace.functions import regions as R
from kinetrace.functions.geometry import shoelace

#: Bins of half a turn, deviation and reach of the smoothing in bins, least peak, peaks that are paired, degrees off a right angle that a pair may be.
BINS, SIGMA, REACH, LEAST_PEAK, PEAKS, OFF = 72, 2.0, 8, 0.01, 8, 15.0
#: Degrees off a direction that a line may be, least lines of a direction, share of the longest line, outer share of positions.
NEAR, LEAST_LINES, LEAST_LENGTH, OUTER = 20.0, 3, 0.3, 0.1
#: Lines that a box needs in all and by direction, angles between directions, regions that are paired.
ALL_LINES, SIDE_LINES, RIGHT, LARGEST = 8, 2, (65.0, 115.0), 5


def apart(a: Column, b: Column) -> Column:
    """Degrees between two directions."""
    d = F.abs(a - b)
    return F.least(d, 180 - d)


def smoothing() -> list[float]:
    weights = [exp(-0.5 * (k / SIGMA) ** 2) for k in range(-REACH, REACH + 1)]
    return [w / sum(weights) for w in weights]


def directions(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The two directions nearly at right angles with the strongest peaks, the stronger first: keys, angle_1, angle_2.

    Lines count by their squared length. A key with fewer than four lines, or
    without such a pair of peaks, has none.
    """
    weight = F.col("length") * F.col("length")
    slot = F.least(F.floor(F.col("angle") / (180.0 / BINS)), F.lit(BINS - 1)).cast("int")
    sums = lines.where(F.col("angle").between(0, 180)).groupBy(*keys, slot.alias("_bin")).agg(F.sum(weight).alias("_w"), F.count(F.lit(1)).alias("_n"))
    found = sums.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_bin", "_w"))).alias("_h"), F.sum("_w").alias("_all"), F.sum("_n").alias("_n")).where("_n >= 4")
    share = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.coalesce(F.try_element_at(F.col("_h"), b), F.lit(0.0)) / F.col("_all"))
    bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    at = lambda c, b: F.get(c, F.pmod(b, F.lit(BINS)))

    def smooth(shares: Column) -> Column:
        return F.transform(bins, lambda b: F.round(sum((at(shares, b + k) * w for k, w in zip(range(-REACH, REACH + 1), smoothing(), strict=True)), F.lit(0.0)), 9))

    def peaks(s: Column) -> Column:
        rows = F.transform(s, lambda v, b: F.struct((-v).alias("v"), (-(b + 0.5) * (180.0 / BINS)).alias("a"), ((v > at(s, b - 1)) & (v > at(s, b + 1)) & (v > LEAST_PEAK)).alias("peak")))
        return F.slice(F.array_sort(F.filter(rows, lambda p: p["peak"])), 1, PEAKS)

    def best(ps: Column) -> Column:
        def paired(p: Column, i: Column) -> Column:
            def pair(q: Column, j: Column) -> Column:
                gap = apart(-p["a"], -q["a"])
                score = F.when((i < j) & (gap >= 90 - OFF), (-p["v"] - q["v"]) * (1 - (90 - gap) / OFF))
                return F.struct((-score).alias("score"), i.alias("i"), j.alias("j"), (-p["a"]).alias("a"), (-q["a"]).alias("b"))

            return F.transform(ps, pair)

        return F.array_min(F.filter(F.flatten(F.transform(ps, paired)), lambda p: p["score"] < 0))

    chosen = R.bound(R.bound(R.bound(share, smooth), peaks), best)
    return found.select(*keys, chosen.alias("_best")).where("_best is not null").select(*keys, F.col("_best.a").alias("angle_1"), F.col("_best.b").alias("angle_2"))


def clustered(lines: DataFrame, keys: Sequence[str], near: float = NEAR, least: int = LEAST_LINES) -> DataFrame:
    """Lines of keys that have directions, with ``cluster`` 1 or 2, the direction they are near to; null for others.

    If one has fewer than ``least`` lines, half as much again counts as near for both.
    """
    met = lines.join(directions(lines, keys), list(keys))

    def of(most: float) -> Column:
        a, b = apart(F.col("angle"), F.col("angle_1")), apart(F.col("angle"), F.col("angle_2"))
        return F.when((a < b) & (a < most), 1).when((b <= a) & (b < most), 2)

    met = met.withColumns({"_near": of(near), "_wide": of(1.5 * near)})
    few = met.groupBy(*keys).agg((F.least(F.count_if(F.col("_near") == 1), F.count_if(F.col("_near") == 2)) < least).alias("_few"))
    return met.join(few, list(keys)).withColumn("cluster", F.when(F.col("_few"), F.col("_wide")).otherwise(F.col("_near"))).drop("_near", "_wide", "_few")


def _mean(weight: Column) -> Column:
    """Aggregate: weighted mean direction; where directions span more than a right angle, those beyond it count backward."""
    a = F.col("angle")
    over = F.max(a) - F.min(a) > 90
    return F.when(over, F.sum(F.when(a > 90, a - 180).otherwise(a) * weight) / F.sum(weight)).otherwise(F.sum(a * weight) / F.sum(weight))


def cluster_angles(met: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines of each direction and the degrees between their mean directions, 90 where one has none: keys, n_1, n_2, angle_between."""
    means = met.where("cluster is not null").groupBy(*keys, "cluster").agg(F.count(F.lit(1)).alias("n"), _mean(F.col("length")).alias("mean"))
    of = lambda k, c: F.max(F.when(F.col("cluster") == k, F.col(c)))
    both = met.select(*keys).distinct().join(means, list(keys), "left").groupBy(*keys).agg(*[of(k, c).alias(f"_{c}{k}") for k in (1, 2) for c in ("n", "mean")])
    turned = lambda c: F.when(c < 0, c + 180).otherwise(c)
    return both.select(*keys, F.coalesce("_n1", F.lit(0)).alias("n_1"), F.coalesce("_n2", F.lit(0)).alias("n_2"), F.coalesce(apart(turned(F.col("_mean1")), turned(F.col("_mean2"))), F.lit(90.0)).alias("angle_between"))


def outermost(met: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The outermost lines of each direction: keys, cluster, low and high (structs of end points); two lines at least are needed.

    Short lines are left out while two others remain. Among the lines in the
    outer tenth of positions the longest holds, and of equally long ones rather
    the outer one.
    """
    who = [*keys, "cluster"]
    over = Window.partitionBy(*who)
    a = F.col("angle")
    spans = F.max(a).over(over) - F.min(a).over(over) > 90
    met = met.where("cluster is not null").withColumn("_turned", F.when(spans & (a > 90), a - 180).otherwise(a))
    mean = F.avg("_turned").over(over)
    mean = F.when(mean < 0, mean + 180).otherwise(mean)
    met = met.withColumns({"_flat": (mean < 45) | (mean > 135), "_long": F.col("length") >= F.max("length").over(over) * LEAST_LENGTH, "_n": F.count(F.lit(1)).over(over)}).where("_n >= 2")
    met = met.withColumn("_pos", F.when(F.col("_flat"), F.col("y1") + F.col("y2")).otherwise(F.col("x1") + F.col("x2")) / 2)
    met = met.withColumn("_used", F.col("_long") | (F.count_if(F.col("_long")).over(over) < 2)).where("_used")
    met = met.withColumns({"_low": F.min("_pos").over(over), "_high": F.max("_pos").over(over)}).withColumn("_range", F.col("_high") - F.col("_low"))
    line = F.struct("x1", "y1", "x2", "y2")

    def best(edge: Column, share: Column, first: Column) -> Column:
        score = F.col("length") * (0.7 + 0.3 * share / (F.col("_range") + 1))
        return F.max_by(F.when(edge, line), F.when(edge, F.struct(score, first)))

    low, high = F.col("_low") + F.col("_range") * OUTER, F.col("_low") + F.col("_range") * (1 - OUTER)
    return met.groupBy(*who).agg(best(F.col("_pos") <= low, F.col("_high") - F.col("_pos"), -F.col("_pos")).alias("low"), best(F.col("_pos") >= high, F.col("_pos") - F.col("_low"), -F.col("_pos")).alias("high"))


def box_of_lines(lines: DataFrame, keys: Sequence[str], width: float, height: float, ratio: float | None = None) -> DataFrame:
    """The box that an image's lines make: keys, corners and checked; keys whose lines make none are left out."""
    enough = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("_lines")).where(F.col("_lines") >= ALL_LINES).drop("_lines")
    met = clustered(lines.join(enough, list(keys)), keys)
    square = cluster_angles(met, keys).where((F.col("n_1") >= SIDE_LINES) & (F.col("n_2") >= SIDE_LINES) & F.col("angle_between").between(*RIGHT)).select(*keys)
    of = lambda k, c: F.max(F.when(F.col("cluster") == k, F.col(c))).alias(f"_{c}{k}")
    sides = outermost(met, keys).groupBy(*keys).agg(*[of(k, c) for k in (1, 2) for c in ("low", "high")]).join(square, list(keys))
    ends = lambda c: ((F.col(c)["x1"], F.col(c)["y1"]), (F.col(c)["x2"], F.col(c)["y2"]))
    made = R.box_from_lines([ends("_low1"), ends("_high1")], [ends("_low2"), ends("_high2")], width, height)
    judged = R.bound(made, lambda c: F.when(c.isNotNull(), F.struct(c.alias("corners"), R.checked(R.points_of(c), width, height, ratio).alias("checked"))))
    return sides.select(*keys, judged.alias("_box")).where("_box.checked.valid").select(*keys, "_box.corners", "_box.checked")


def merged_regions(boxes: DataFrame, keys: Sequence[str], width: float, height: float, ratio: float, gap: float = R.GAP, most: int = LARGEST) -> DataFrame:
    """The best box around two adjacent regions among the ``most`` largest of each key: keys, corners, confidence.

    ``boxes``: keys, ``region`` (a number that tells them apart) and ``corners``
    (array of four points). Keys without a fit pair are left out.
    """
    area = shoelace(R.points_of(F.col("corners")))
    order = Window.partitionBy(*keys).orderBy(F.desc(area), "region")
    top = boxes.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= most)
    a, b = [top.select(*keys, F.col("_k").alias(f"_k{n}"), F.col("corners").alias(f"_c{n}")) for n in "ab"]
    pairs = a.join(b, list(keys)).where("_ka < _kb")
    p, q = R.points_of(F.col("_ca")), R.points_of(F.col("_cb"))
    judged = R.bound(R.enclosing([*p, *q]), lambda b: F.struct(b["corners"].alias("corners"), R.checked(R.points_of(b["corners"]), width, height, ratio).alias("checked")))
    pairs = pairs.where(R.adjacent(p, q, gap) != "").select(*keys, "_ka", "_kb", judged.alias("_box")).where("_box.checked.valid and _box.checked.confidence > 0")
    return pairs.groupBy(*keys).agg(F.max_by(F.struct(F.col("_box.corners").alias("corners"), F.col("_box.checked.confidence").alias("confidence")), F.struct("_box.checked.confidence", -F.col("_ka"), -F.col("_kb"))).alias("_b")).select(*keys, "_b.*")


def pixel_background(frames: DataFrame, keys: Sequence[str], pixels: str = "pixels", median: bool = True) -> DataFrame:
    """The median or mean of each pixel over the frames of a key, cut to whole numbers: keys, position, value.

    ``pixels`` is an array of numbers, the same length in all frames of a key.
    """
    rows = frames.select(*keys, F.posexplode(pixels).alias("position", "_v"))
    value = F.median("_v") if median else F.avg("_v")
    return rows.groupBy(*keys, "position").agg(F.floor(value).cast("int").alias("value"))
