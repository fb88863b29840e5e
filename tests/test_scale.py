"""Long sessions: time has to grow with the rows, not with their square."""

import re
import time

import pytest
from pyspark.sql import functions as F

from kinetrace.operators import align
from kinetrace.operators.track import Track
from kinetrace.plans.queries import QUERIES
from tests.compare import DATA

T = Track(("session",))
LOOKS_AHEAD = re.compile(r"specifiedwindowframe\(RowFrame, (?!unboundedpreceding\$\(\))[^,]*, unboundedfollowing\$\(\)\)")


def session(spark, rows: int):
    v = F.when(F.col("id") % 9 > 3, F.sin("id") * 100)
    return spark.range(0, rows, 1, 1).select(F.lit(1).alias("session"), F.col("id").alias("frame_idx"), (F.col("id") / 30).alias("pts"), v.alias("x"), (v + 1).alias("y"))


def nearest(df):
    events = df.select("session", (F.col("pts") + 0.01).alias("t"))
    return align.nearest(events, df, ["session"], "t", "pts", "frame_idx")


FORMS = {
    "previous": lambda df: df.select(T.previous("x"), T.previous("y")),
    "step": lambda df: df.select(T.step("x", "y")),
    "filled": lambda df: df.select(T.filled("x", 5), T.filled("y", both=True)),
    "rolling": lambda df: df.select(T.rolling("x", 15), T.rolling("x", 15, "median")),
    "nearest": nearest,
}


def seconds(df) -> float:
    began = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


@pytest.mark.parametrize("name", sorted(FORMS))
def test_twice_the_rows_take_twice_the_time(spark, name):
    make = FORMS[name]
    seconds(make(session(spark, 1000)))
    once, twice = (min(seconds(make(session(spark, n))) for _ in range(2)) for n in (16_000, 32_000))
    assert twice < max(2.6 * once, 2.0)


@pytest.mark.parametrize("name", ["movement_lag", "fill_limited", "fill_both_ways", "filled_gaps", "nearest_frame", "clean_paired", "clean_single", "features_paired", "features_single", "nest_approach", "loom_time_points"])
def test_no_frame_runs_to_the_end_of_a_partition(spark, name):
    plan = QUERIES[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "specifiedwindowframe" in plan and not LOOKS_AHEAD.search(plan)


def test_the_pattern_finds_such_a_frame(spark):
    from pyspark.sql import Window

    ahead = Window.partitionBy("session").orderBy("frame_idx").rowsBetween(0, Window.unboundedFollowing)
    assert LOOKS_AHEAD.search(session(spark, 3).select(F.first("x").over(ahead))._jdf.queryExecution().optimizedPlan().toString())


@pytest.mark.parametrize("name", ["features_paired", "features_single", "hull", "pairwise_stats"])
def test_wide_plans_are_compiled(spark, name):
    """No stage falls back from generated code: with the fallback off, one that does not compile fails."""
    key = "spark.sql.codegen.fallback"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        assert QUERIES[name](spark, f"{DATA}/sf0.001").count() > 0
        QUERIES[name](spark, f"{DATA}/sf0.001").write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.set(key, before)
