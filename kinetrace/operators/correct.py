"""Reconciling two animals' results with manual scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrace.functions.geometry import sum_of
from kinetrace.operators.track import Track

VALUES = ("latency", "time_in_nest")


def missing(c: Column) -> Column:
    """Null, NaN or -1."""
    return c.isNull() | F.isnan(c) | (c == -1)


def should_swap(manual: Sequence[tuple[Column, Column]], found: Sequence[tuple[Column, Column]]) -> Column:
    """Whether the found (latency, time) of two animals fit the manual ones better exchanged.

    If each side has data for one animal only, the two decide. Otherwise the
    summed absolute errors of known pairs do, and equal sums mean no swap. A
    manual time of 0 without a latency counts as missing for that.
    """
    has_manual = [~missing(lat) | ~(missing(time) | (missing(lat) & (time == 0))) for lat, time in manual]
    has_found = [~missing(lat) | ~missing(time) for lat, time in found]
    one_manual = has_manual[0] != has_manual[1]
    one_found = has_found[0] != has_found[1]

    def errors(pairs: Sequence[tuple[int, int]]) -> Column:
        return sum_of([F.when(missing(manual[i][k]) | missing(found[j][k]), F.lit(0.0)).otherwise(F.abs(manual[i][k] - found[j][k])) for i, j in pairs for k in (0, 1)])

    # Without any comparable pair both sums are 0, which means no swap.
    by_error = errors(((0, 1), (1, 0))) < errors(((0, 0), (1, 1)))
    return F.coalesce(F.when(one_manual & one_found, has_manual[0] != has_found[0]).otherwise(by_error), F.lit(False))


def correct(a: DataFrame, b: DataFrame, manual: DataFrame, keys: Sequence[str], values: Sequence[str], order: str = "loom") -> DataFrame:
    """Joins both animals' rows and manual scores by key and event, and exchanges values where that fits better.

    ``manual``: keys, ``order``, and ``latency_a``, ``time_in_nest_a``,
    ``latency_b``, ``time_in_nest_b``; events without scores keep nulls.
    Returns ``{value}_a``, ``{value}_b``, ``swapped``, ``swap_before`` (the
    first of a run of exchanged events), and errors (0 where unknown).
    """
    on = [*keys, order]
    met = a.select(*on, *[F.col(v).alias(f"_{v}_a") for v in values]).join(b.select(*on, *[F.col(v).alias(f"_{v}_b") for v in values]), on).join(manual, on, "left")
    scores = [tuple(F.col(f"{v}_{s}") for v in VALUES) for s in "ab"]
    found = [tuple(F.col(f"_{v}_{s}") for v in VALUES) for s in "ab"]
    met = met.withColumn("swapped", should_swap(scores, found))
    track = Track(tuple(keys), order)
    out = {f"{v}_{s}": F.when(F.col("swapped"), F.col(f"_{v}_{o}")).otherwise(F.col(f"_{v}_{s}")) for v in values for s, o in ("ab", "ba")}
    errors = {}
    for k, v in enumerate(VALUES):
        for i, s in enumerate("ab"):
            errors[f"error_{v}_{s}"] = F.when(missing(scores[i][k]) | missing(out[f"{v}_{s}"]), F.lit(0.0)).otherwise(F.abs(scores[i][k] - out[f"{v}_{s}"]))
    return met.select(*on, *[c.alias(n) for n, c in out.items()], F.col("swapped"), track.rises(F.col("swapped")).cast("int").alias("swap_before"), *[c.alias(n) for n, c in errors.items()])


def report(corrected: DataFrame, keys: Sequence[str], order: str = "loom") -> DataFrame:
    """A JSON text for each session: events, exchanged ones, and how often a run of these begins."""
    event = F.struct(F.col(order), F.col("swapped"), (F.col("swap_before") == 1).alias("begins"))
    body = F.struct(F.count(F.lit(1)).alias("total"), F.count_if("swapped").alias("swapped"), F.sum("swap_before").alias("changes"), F.array_sort(F.collect_list(event)).alias("events"))
    return corrected.groupBy(*keys).agg(F.to_json(body).alias("report"))
