"""Operators over ranges of a session against the same over whole sessions, and their plans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from kinetrace.operators import align, split
from kinetrace.operators.split import SplitTrack
from kinetrace.operators.track import Track, runs
from kinetrace.plans.queries import QUERIES
from tests.compare import DATA, rows_of

KIND = "who string, frame_idx long, x double, y double, flag boolean"


def sessions(seed=1):
    """A long session, one of which whole ranges are missing or null, one row, one without values, and a null key."""
    rng = random.Random(seed)
    rows = []
    for who, n in (("a", 300), ("b", 40), (None, 60), ("lone", 1)):
        for f in range(n):
            if who == "b" and 9 < f < 30:
                continue
            gone = rng.random() < 0.5 or 100 < f < 190
            rows.append((who, f, None if gone else float(round(rng.random() * 100)), None if rng.random() < 0.3 else 1.0 * f, rng.choice([True, False, None]) if f % 50 > 20 else True))
    rows += [("empty", f, None, None, None) for f in range(0, 90, 7)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(sessions(), KIND)


def rows(df):
    return rows_of(df.columns, df.collect())


WHOLE = Track(("who",))


@pytest.mark.parametrize("size", [1, 7, 16, 1000])
def test_ranges_give_what_whole_sessions_give(df, size):
    part = SplitTrack(("who",), "frame_idx", size)
    for limit, both in ((None, False), (3, False), (None, True), (5, True)):
        want = df.withColumns({"u": WHOLE.filled("x", limit, both), "v": WHOLE.filled("y", limit, both)})
        assert rows(part.filled(df, {"u": "x", "v": "y"}, limit, both)) == rows(want)
    assert rows(part.previous(df, {"u": "x", "v": "y"})) == rows(df.withColumns({"u": WHOLE.previous("x"), "v": WHOLE.previous("y")}))
    assert rows(part.step(df, "x", "y")) == rows(df.withColumn("step", WHOLE.step("x", "y")))
    assert rows(part.odd(df, F.col("flag"), "u")) == rows(df.withColumn("u", WHOLE.odd(F.coalesce("flag", F.lit(False)))))
    assert rows(part.runs(df, F.col("flag"))) == rows(runs(df, WHOLE, F.col("flag")))
    assert rows(part.runs(df, F.col("x").isNull())) == rows(runs(df, WHOLE, F.col("x").isNull()))
    numbered = part.numbered(df, "n").groupBy("who").agg(F.collect_list(F.struct("n", "frame_idx")).alias("l")).collect()
    for r in numbered:
        assert [p.n for p in sorted(r.l, key=lambda p: p.frame_idx)] == list(range(len(r.l)))


@pytest.mark.parametrize("size", [1.0, 10.0, 1e6])
def test_nearest_over_ranges(spark, size):
    rng = random.Random(2)
    frames = spark.createDataFrame([(w, k, t) for w in "abc" for k, t in enumerate(sorted(rng.randrange(200) / 2 for _ in range(60)))], "who string, frame long, pts double")
    frames = frames.dropDuplicates(["who", "pts"])
    events = spark.createDataFrame([(w, k, None if k == 3 else rng.randrange(-50, 300) / 4) for w in "abd" for k in range(40)], "who string, id long, t double")
    got, want = split.nearest(events, frames, ["who"], "t", "pts", "frame", size=size), align.nearest(events, frames, ["who"], "t", "pts", "frame")
    assert got.columns == want.columns and rows(got) == rows(want)


def test_empty_tables_give_no_rows(spark, df):
    none, part = df.where("false"), SplitTrack(("who",), "frame_idx", 5)
    for out in (part.filled(none, {"u": "x"}), part.runs(none, F.col("flag")), part.numbered(none, "n"), part.previous(none, {"u": "x"})):
        assert out.collect() == []


def test_columns_with_the_names_used_inside_stay_apart(spark, df):
    part = SplitTrack(("who",), "frame_idx", 5)
    named = df.withColumnRenamed("y", "a").withColumn("range", F.lit(1))
    assert rows(part.filled(named, {"u": "x"}).select("who", "frame_idx", "u")) == rows(df.select("who", "frame_idx", WHOLE.filled("x").alias("u")))


@pytest.mark.parametrize("name", ["split_fill_limited", "split_parity_swap", "split_gap_runs", "split_nearest_frame", "split_numbers", "split_lag"])
def test_rows_are_dealt_by_session_and_range(spark, name):
    """Every window over rows has the range in its key; only summaries, one row a range, are dealt by session alone."""
    plan = QUERIES[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]
    own = 0
    for line in windows:
        keys = re.search(r"\], \[([^\[\]]*)\], \[[^\[\]]*\]$", line)[1]
        own += "_part#" in keys
        assert "_part#" in keys or re.fullmatch(r"_w\d+#\d+L?", keys), line  # the latter: a field of the range, over summaries
    assert own


def test_one_long_session_is_many_tasks(spark):
    """A single session's rows lie in as many partitions as there are ranges, and none holds more than a range."""
    long = spark.range(0, 40_000, 1, 4).select(F.lit("a").alias("who"), F.col("id").alias("frame_idx"), F.when(F.col("id") % 1000 == 0, F.col("id").cast("double")).alias("x"))
    part = SplitTrack(("who",), "frame_idx", 1000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = part.filled(long, {"u": "x"})
        most = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count"), F.count("*")).first()
        assert most[0] < 40_000 and most[1] > 1
        assert out.where((F.col("u") != F.col("frame_idx")) & (F.col("frame_idx") < 39_000)).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
