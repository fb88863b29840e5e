"""Straight lines among edge pixels, by voting.

Each pixel votes, for every angle, for the line through it: an angle of the
line's normal and a whole-numbered offset. Votes are counted before the shuffle.
Lines are cells with enough votes that no cell beside them exceeds; a line's
pixels, in order along it, are cut at gaps into segments.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Angles over half a turn; binary places of the sines, which are whole numbers so that offsets are exact.
ANGLES, PLACES = 180, 14


def turns(angles: int = ANGLES) -> list[tuple[int, int]]:
    """Cosine and sine of each angle, times 2**14."""
    return [(round(math.cos(math.pi * k / angles) * (1 << PLACES)), round(math.sin(math.pi * k / angles) * (1 << PLACES))) for k in range(angles)]


def votes(cells: DataFrame, angles: int = ANGLES) -> DataFrame:
    """For each edge pixel (image, y, x) and angle: the offset of its line and its place along it, in 2**-14 pixels."""
    table = F.array(*[F.struct(F.lit(c).cast("long").alias("c"), F.lit(s).cast("long").alias("s")) for c, s in turns(angles)])
    every = cells.select("image", "y", "x", F.posexplode(table).alias("angle", "t"))
    x, y = F.col("x"), F.col("y")
    return every.select("image", "y", "x", "angle", F.shiftright(x * F.col("t.c") + y * F.col("t.s") + (1 << (PLACES - 1)), PLACES).alias("offset"), (y * F.col("t.c") - x * F.col("t.s")).alias("along"))


def _beside(angles: int) -> Column:
    """The nine cells around a cell, itself included; beyond the last angle the offset's sign turns."""
    found = []
    for da in (-1, 0, 1):
        for db in (-1, 0, 1):
            a, b = F.col("angle") + da, F.col("offset") + db
            found.append(F.struct(F.pmod(a, F.lit(angles)).cast("int").alias("angle"), F.when((a < 0) | (a >= angles), -b).otherwise(b).alias("offset")))
    return F.array(*found)


def lines(cells: DataFrame, least: int, angles: int = ANGLES) -> DataFrame:
    """Lines with ``least`` votes or more that no line beside them exceeds; of equal ones the smaller angle, then offset, holds.

    Columns image, angle, offset, votes.
    """
    counted = votes(cells, angles).groupBy("image", "angle", "offset").agg(F.count(F.lit(1)).alias("votes")).where(F.col("votes") >= least)
    # Only a line with as many votes can exceed one, so those that have too few are not compared.
    own = F.struct("votes", (-F.col("angle")).alias("a"), (-F.col("offset")).alias("o"))
    around = counted.select("image", own.alias("from"), F.explode(_beside(angles)).alias("to"))
    most = around.groupBy("image", "to").agg(F.max("from").alias("m"))
    best = most.where((-F.col("m.a") == F.col("to.angle")) & (-F.col("m.o") == F.col("to.offset")))
    return best.select("image", F.col("to.angle").alias("angle"), F.col("to.offset").alias("offset"), F.col("m.votes").alias("votes"))


def segments(cells: DataFrame, least: int, length: float, gap: float, angles: int = ANGLES) -> DataFrame:
    """Segments of the lines: pixels along a line with gaps of at most ``gap``, over ``length`` or more.

    Columns image, angle, offset, votes, x1, y1, x2, y2 (first and last pixel) and pixels.
    """
    unit = 1 << PLACES
    found = lines(cells, least, angles).select(F.col("image").alias("i"), F.col("angle").alias("a"), F.col("offset").alias("o"), "votes")
    held = F.col("image").eqNullSafe(F.col("i")) & (F.col("angle") == F.col("a")) & (F.col("offset") == F.col("o"))
    # Each pixel becomes a row for every angle, which Spark's estimate of a size leaves out: votes must not be taken for a small side.
    own = votes(cells, angles).join(found.hint("merge"), held).drop("i", "a", "o")
    order = Window.partitionBy("image", "angle", "offset").orderBy("along", "y", "x")
    cut = F.coalesce((F.col("along") - F.lag("along").over(order) > gap * unit).cast("int"), F.lit(0))
    numbered = own.withColumn("_cut", cut).withColumn("_part", F.sum("_cut").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    at = F.struct("along", "y", "x")
    out = numbered.groupBy("image", "angle", "offset", "votes", "_part").agg(F.min(at).alias("p"), F.max(at).alias("q"), F.count(F.lit(1)).alias("pixels"))
    out = out.where(F.col("q.along") - F.col("p.along") >= length * unit)
    return out.select("image", "angle", "offset", "votes", F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.col("q.x").alias("x2"), F.col("q.y").alias("y2"), "pixels")
