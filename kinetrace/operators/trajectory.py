"""Similarity of trajectories: the discrete Frechet distance."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrace.workers import reachable


def frechet(p: Column, q: Column) -> Column:
    """Discrete Frechet distance of two arrays of (x, y) structs, in the JVM.

    A fold over ``p`` keeps one row of the table of coupled distances. Null if
    one of the arrays is null or empty. Its cost is length times length squared,
    which suits short windows; :func:`frechet_groups` suits long ones.
    """
    none = F.array().cast("array<double>")

    def row(above: Column, a: Column) -> Column:
        gaps = F.transform(q, lambda b: F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"])))
        indexed = F.transform(gaps, lambda d, j: F.struct(d.alias("d"), j.alias("j")))

        def cell(made: Column, c: Column) -> Column:
            j = c["j"]
            # Least of the neighbours that exist; nulls are passed over, and with none the distance stands alone.
            past = F.least(F.get(above, j), F.get(above, j - 1), F.get(made, j - 1))
            return F.concat(made, F.array(F.greatest(past, c["d"])))

        return F.aggregate(indexed, none, cell)

    return F.when((F.size(p) > 0) & (F.size(q) > 0), F.element_at(F.aggregate(p, none, row), -1))


def coupled(px, py, qx, qy, above: float = float("inf")) -> float:
    """Discrete Frechet distance by antidiagonals of the table of coupled distances, of which three are held.

    Every coupling passes one of two neighbouring antidiagonals, so once both
    exceed ``above`` the distance does too, and infinity is returned.
    """
    import numpy as np

    px, py, qx, qy = (np.asarray(v, float) for v in (px, py, qx, qy))
    n, m = len(px), len(qx)
    # Cell (i, s - i) of an antidiagonal stands at i + 1; all else is infinite.
    two, one, made = (np.full(n + 1, np.inf) for _ in range(3))
    for s in range(n + m - 1):
        low, high = max(0, s - m + 1), min(n, s + 1)
        j = slice(s - high + 1, s - low + 1)
        gap = np.hypot(px[low:high] - qx[j][::-1], py[low:high] - qy[j][::-1])
        made.fill(np.inf)
        if s == 0:
            made[1] = gap[0]
        else:
            past = np.minimum(np.minimum(one[low:high], one[low + 1 : high + 1]), two[low:high])
            np.maximum(past, gap, out=made[low + 1 : high + 1])
        two, one, made = one, made, two
        if above < np.inf and one.min() > above and (two.min() > above or s == 0):
            return float("inf")
    return float(one[n])


def frechet_groups(df: DataFrame, p: str, q: str, into: str = "frechet", above: float = float("inf")) -> DataFrame:
    """Adds the distance of two array columns by an Arrow batch function, for long windows; infinity where it exceeds ``above``.

    A pair's memory follows the length of its paths, not of their product.
    """
    reachable(df.sparkSession)

    @F.pandas_udf("double")
    def measure(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            out = []
            for u, v in zip(a, b, strict=True):
                if u is None or v is None or not len(u) or not len(v):
                    out.append(None)
                else:
                    out.append(coupled([w["x"] for w in u], [w["y"] for w in u], [w["x"] for w in v], [w["y"] for w in v], above))
            yield pd.Series(out, dtype="float64")

    return df.withColumn(into, measure(p, q))


def path(keys_frame: str, x: Column, y: Column) -> Column:
    """Aggregate: the (x, y) points of a group in order of frame."""
    points = F.array_sort(F.collect_list(F.struct(F.col(keys_frame).alias("t"), x.cast("double").alias("x"), y.cast("double").alias("y"))))
    return F.transform(points, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))


def from_origin(points: Column) -> Column:
    """The path moved so that it starts at (0, 0)."""
    first = F.get(points, F.lit(0))
    return F.transform(points, lambda p: F.struct((p["x"] - first["x"]).alias("x"), (p["y"] - first["y"]).alias("y")))
