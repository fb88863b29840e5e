"""Queries of ordered operators, alignment and aggregation, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinetrace.operators import align, reshape, stats
from kinetrace.operators.metrics import still_runs
from kinetrace.operators.track import Track, consecutive, densify, filled_runs, runs
from kinetrace.plans.base import FRAMES, TRACK, frames, query, rounded, table

_W = "PARTITION BY track ORDER BY frame_idx"
WITH = f"WITH {FRAMES}"


@query(
    f"""{WITH}, s AS (SELECT track, frame_idx, abs(coalesce(lag(value) OVER ({_W}), value) - value) AS step FROM fr),
m AS (SELECT track, step, avg(step) OVER ({_W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS mean6 FROM s)
SELECT track, count(*) AS frames, round(sum(step), 3) AS total_step, round(max(mean6), 4) AS most_mean6, round(avg(mean6), 4) AS mean_mean6 FROM m GROUP BY track"""
)
def movement_summary(spark, sf_dir):
    df = frames(spark, sf_dir).withColumn("step", F.abs(TRACK.change("value")))
    df = df.withColumn("mean6", TRACK.rolling("step", 6))
    out = df.groupBy("track").agg(F.count(F.lit(1)).alias("frames"), F.round(F.sum("step"), 3).alias("total_step"), F.max("mean6").alias("most_mean6"), F.avg("mean6").alias("mean_mean6"))
    return rounded(out)


@query(
    f"""{WITH} SELECT track, frame_idx, round(coalesce(lag(gappy) OVER ({_W}), first_value(gappy IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 4) AS previous,
round(coalesce(lag(value) OVER ({_W}), value) - value, 4) AS change, round(coalesce(value - lag(value) OVER ({_W}), lead(value) OVER ({_W}) - value), 4) AS difference,
round(value - 2 * lag(value, 1) OVER ({_W}) + lag(value, 2) OVER ({_W}), 4) AS second_difference FROM fr"""
)
def movement_lag(spark, sf_dir):
    return rounded(frames(spark, sf_dir).select("track", "frame_idx", TRACK.previous("gappy").alias("previous"), TRACK.change("value").alias("change"), TRACK.difference("value").alias("difference"), TRACK.second_difference("value").alias("second_difference")))


@query(f"{WITH} SELECT track, frame_idx, " + ", ".join(f"round(avg(gappy) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 4) AS mean_{n}" for n in (3, 6, 9, 15)) + " FROM fr")
def rolling_mean(spark, sf_dir):
    return rounded(frames(spark, sf_dir).select("track", "frame_idx", *[TRACK.rolling("gappy", n).alias(f"mean_{n}") for n in (3, 6, 9, 15)]))


@query(f"{WITH} SELECT track, frame_idx, " + ", ".join(f"round(median(gappy) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 4) AS median_{n}" for n in (3, 6, 9, 15)) + " FROM fr")
def rolling_median(spark, sf_dir):
    return rounded(frames(spark, sf_dir).select("track", "frame_idx", *[TRACK.rolling("gappy", n, "median").alias(f"median_{n}") for n in (3, 6, 9, 15)]))


@query(
    f"""{WITH}, q AS (SELECT *, round(gappy) AS v FROM fr) SELECT track, frame_idx, round(CASE WHEN v IS NOT NULL THEN
(rank() OVER (PARTITION BY track ORDER BY v NULLS LAST) + (count(*) OVER (PARTITION BY track, v) - 1) / 2.0) / count(v) OVER (PARTITION BY track) END, 6) AS pct FROM q"""
)
def percentile_rank(spark, sf_dir):
    df = frames(spark, sf_dir).withColumn("v", F.round("gappy"))
    return rounded(df.select("track", "frame_idx", TRACK.percentile_rank("v").alias("pct")), 6)


@query(f"{WITH} SELECT track, frame_idx, round(avg(value) OVER (PARTITION BY track) - value, 6) AS deviation FROM fr")
def deviation_from_mean(spark, sf_dir):
    return rounded(frames(spark, sf_dir).select("track", "frame_idx", TRACK.deviation("value").alias("deviation")), 6)


@query(
    f"""{WITH}, kept AS (SELECT * FROM fr WHERE gappy IS NOT NULL), g AS (SELECT track, unnest(generate_series(min(frame_idx), max(frame_idx))) AS frame_idx FROM kept GROUP BY track)
SELECT g.track, g.frame_idx, kept.value FROM g LEFT JOIN kept ON kept.track = g.track AND kept.frame_idx = g.frame_idx"""
)
def densify_frames(spark, sf_dir):
    return densify(frames(spark, sf_dir).where("gappy is not null").select("track", "frame_idx", "value"), TRACK)


@query(
    """WITH days AS (SELECT event_type AS kind, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL),
b AS (SELECT min(day) AS lo, max(day) AS hi FROM days), g AS (SELECT kind, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT kind FROM days), b)
SELECT g.kind, CAST(g.day AS VARCHAR) AS day, coalesce(n, 0) AS n FROM g LEFT JOIN days USING (kind, day)"""
)
def densify_days(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    days = e.groupBy(F.col("event_type").alias("kind"), F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return densify(days, Track(("kind",), "day"), whole=()).na.fill(0).withColumn("day", F.col("day").cast("string"))


def _fill_sql(limit: int | None, both: bool) -> str:
    left = f"last_value(CASE WHEN gappy IS NOT NULL THEN {{c}} END IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    right = f"first_value(CASE WHEN gappy IS NOT NULL THEN {{c}} END IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    neighbours = ", ".join(f"{side.format(c=c)} AS {n}{c[0]}" for side, n in ((left, "l"), (right, "r")) for c in ("frame_idx", "gappy"))
    value = "CASE WHEN rg IS NULL THEN lg ELSE lg + (rg - lg) * (frame_idx - lf) / nullif(rf - lf, 0) END"
    if limit is not None:
        value = f"CASE WHEN frame_idx - lf <= {limit} THEN {value} END"
    if both:
        value = f"CASE WHEN lg IS NULL THEN rg ELSE {value} END"
    return f"{WITH}, n AS (SELECT track, frame_idx, gappy, {neighbours} FROM fr) SELECT track, frame_idx, round(coalesce(gappy, {value}), 4) AS filled FROM n"


@query(_fill_sql(2, False))
def fill_limited(spark, sf_dir):
    return rounded(frames(spark, sf_dir).select("track", "frame_idx", TRACK.filled("gappy", 2).alias("filled")))


@query(_fill_sql(None, True))
def fill_both_ways(spark, sf_dir):
    return rounded(frames(spark, sf_dir).select("track", "frame_idx", TRACK.filled("gappy", both=True).alias("filled")))


_RUNS = f"""i AS (SELECT *, frame_idx - row_number() OVER (PARTITION BY track, gappy IS NULL ORDER BY frame_idx) AS k FROM fr)"""


@query(f"{WITH}, {_RUNS} SELECT track, min(frame_idx) AS first, max(frame_idx) AS last, count(*) AS length FROM i WHERE gappy IS NULL GROUP BY track, k")
def gap_runs(spark, sf_dir):
    return runs(frames(spark, sf_dir), TRACK, F.col("gappy").isNull())


@query(f"{WITH}, {_RUNS} SELECT track, min(frame_idx) AS first, max(frame_idx) AS last, count(*) AS length FROM i WHERE gappy IS NOT NULL GROUP BY track, k")
def consecutive_runs(spark, sf_dir):
    return consecutive(frames(spark, sf_dir).where("gappy is not null"), TRACK)


@query(
    f"""{WITH}, {_RUNS}, b AS (SELECT track, min(frame_idx) AS first, max(frame_idx) AS last FROM i WHERE gappy IS NULL GROUP BY track, k)
SELECT track, first, least(last, first + 1) AS last FROM b WHERE first > 0 AND EXISTS (SELECT 1 FROM fr WHERE fr.track = b.track AND fr.frame_idx < b.first AND fr.gappy IS NOT NULL)"""
)
def filled_gaps(spark, sf_dir):
    df = frames(spark, sf_dir).withColumn("filled", TRACK.filled("gappy", 2))
    return filled_runs(df, TRACK, "gappy", "filled")


@query(
    f"""{WITH}, f AS (SELECT track, frame_idx, value, pts, sum(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) OVER ({_W}) % 2 = 1 AS flip FROM fr)
SELECT track, frame_idx, flip AS flipped, CASE WHEN flip THEN pts ELSE value END AS a, CASE WHEN flip THEN value ELSE pts END AS b FROM f"""
)
def parity_swap(spark, sf_dir):
    df = frames(spark, sf_dir).withColumn("flipped", TRACK.odd(F.col("kind") == "error"))
    return df.select("track", "frame_idx", "flipped", F.when(F.col("flipped"), F.col("pts")).otherwise(F.col("value")).alias("a"), F.when(F.col("flipped"), F.col("value")).otherwise(F.col("pts")).alias("b"))


@query(f"{WITH} SELECT track, frame_idx FROM (SELECT *, coalesce(lag(kind) OVER ({_W}), '') = 'purchase' AS was FROM fr) WHERE kind = 'purchase' AND NOT was")
def swap_edges(spark, sf_dir):
    df = frames(spark, sf_dir)
    return df.withColumn("rise", TRACK.rises(F.col("kind") == "purchase")).where("rise").select("track", "frame_idx")


@query(
    f"""{WITH}, d AS (SELECT track, frame_idx, coalesce(abs(round(value / 4000) - 2 * lag(round(value / 4000), 1) OVER ({_W}) + lag(round(value / 4000), 2) OVER ({_W})) < 0.5, false) AS flat FROM fr),
i AS (SELECT *, frame_idx - row_number() OVER (PARTITION BY track, flat ORDER BY frame_idx) AS k FROM d)
SELECT track, frame_idx, CASE WHEN flat AND count(*) OVER (PARTITION BY track, flat, k) >= 2 THEN 1 ELSE 0 END AS still FROM i"""
)
def second_difference_runs(spark, sf_dir):
    df = frames(spark, sf_dir).withColumn("v_x", F.round(F.col("value") / 4000))
    return still_runs(df, TRACK, "v", 0.5, 2).select("track", "frame_idx", F.col("still_v").alias("still"))


@query(
    f"""{WITH}, s AS (SELECT track, avg(value) OVER ({_W} ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS m, count(*) OVER ({_W} ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS n FROM fr)
SELECT track, round(max(m) FILTER (n = 5), 4) AS most FROM s GROUP BY track"""
)
def smoothed_maximum(spark, sf_dir):
    df = frames(spark, sf_dir).withColumn("m", TRACK.smoothed("value", 5))
    return rounded(df.groupBy("track").agg(F.max("m").alias("most")))


@query(
    f"""{WITH} SELECT track, count(*) AS frame_count, round((count(*) - 1) / nullif(max(pts) - min(pts), 0), 9) AS fps, round(avg(gap), 3) AS ifi_mean_sec, round(stddev_pop(gap), 3) AS ifi_std_sec,
round(min(gap), 3) AS ifi_min_sec, round(max(gap), 3) AS ifi_max_sec, stddev_pop(gap) > avg(gap) * 0.01 AS is_vfr
FROM (SELECT *, pts - lag(pts) OVER ({_W}) AS gap FROM fr) GROUP BY track"""
)
def interval_stats(spark, sf_dir):
    out = stats.intervals(frames(spark, sf_dir), TRACK, "pts")
    return out.withColumns({c: F.round(c, 9 if c == "fps" else 3) for c in ("fps", "ifi_mean_sec", "ifi_std_sec", "ifi_min_sec", "ifi_max_sec")})


@query(f"{WITH} SELECT kind, track, count(*) AS rows, min(frame_idx) AS first, max(frame_idx) AS last FROM fr GROUP BY ALL")
def track_summary(spark, sf_dir):
    return stats.tracks(frames(spark, sf_dir), ["kind"])


@query(
    f"""{WITH} SELECT track, count(*) AS frames, count(*) FILTER (gappy IS NULL) AS missing_gappy, count(*) FILTER (kind = 'view') AS missing_seen,
count(*) FILTER (gappy IS NULL AND kind = 'view') AS missing_all FROM fr GROUP BY track"""
)
def missing_counts(spark, sf_dir):
    df = frames(spark, sf_dir).withColumn("seen", F.when(F.col("kind") != "view", F.col("value")))
    return stats.missing_counts(df, ["track"], ["gappy", "seen"])


# Alignment

_STIMULI = "st AS (SELECT track, event_id, pts + 10 * (event_id % 5 - 2) AS t FROM fr WHERE kind = 'error')"


@query(
    f"""{WITH}, {_STIMULI}, a AS (SELECT st.*, fr.frame_idx AS f0, fr.pts AS p0 FROM st ASOF LEFT JOIN fr ON st.track = fr.track AND st.t >= fr.pts),
b AS (SELECT a.*, fr.frame_idx AS f1, fr.pts AS p1 FROM a ASOF LEFT JOIN fr ON a.track = fr.track AND a.t <= fr.pts)
SELECT track, event_id, CASE WHEN p1 IS NULL OR t - p0 <= p1 - t THEN f0 ELSE f1 END AS frame, round(CASE WHEN p1 IS NULL OR t - p0 <= p1 - t THEN p0 ELSE p1 END - t, 3) AS frame_error FROM b"""
)
def nearest_frame(spark, sf_dir):
    f = frames(spark, sf_dir)
    stimuli = f.where("kind = 'error'").select("track", "event_id", (F.col("pts") + 10 * (F.col("event_id") % 5 - 2)).alias("t"))
    return align.nearest(stimuli, f, ["track"], "t", "pts", "frame_idx").select("track", "event_id", "frame", F.round("frame_error", 3).alias("frame_error"))


_ERRORS = "ev AS (SELECT track, frame_idx AS fa, row_number() OVER (PARTITION BY track ORDER BY frame_idx) AS event, lead(frame_idx) OVER (PARTITION BY track ORDER BY frame_idx) AS until FROM fr WHERE kind = 'error')"


def _errors(f):
    e = f.where("kind = 'error'").select("track", F.col("frame_idx").alias("at"))
    return align.until_next(e.withColumn("event", F.row_number().over(Track(("track",), "at").window)), ["track"], "at")


@query(
    f"""{WITH}, {_ERRORS} SELECT ev.track, event, count(*) AS frames, round(avg(value), 4) AS mean, round(100 * avg(CASE WHEN kind = 'click' THEN 1 ELSE 0 END), 4) AS percent,
sum(CASE WHEN kind = 'view' THEN 1 ELSE 0 END)::BIGINT AS views FROM ev JOIN fr ON fr.track = ev.track AND frame_idx >= fa - 3 AND frame_idx < fa + 8 GROUP BY ev.track, event"""
)
def event_window_mean(spark, sf_dir):
    f = frames(spark, sf_dir)
    met = align.in_windows(f, align.event_windows(_errors(f), ["track"], "at", -3, 8), ["track"], bucket=16)
    flag = lambda k: F.when(F.col("kind") == k, 1).otherwise(0)
    return rounded(met.groupBy("track", "event").agg(F.count(F.lit(1)).alias("frames"), F.avg("value").alias("mean"), (100 * F.avg(flag("click"))).alias("percent"), F.sum(flag("view")).alias("views")))


@query(
    f"""{WITH}, {_ERRORS}, w AS (SELECT track // 2 AS pair, event, fa AS s, least(fa + 12, coalesce(until, fa + 12)) AS e FROM ev)
SELECT pair, event, CASE WHEN count(*) >= 2 AND max(s) < min(e) THEN max(s) END AS start, CASE WHEN count(*) >= 2 AND max(s) < min(e) THEN min(e) END AS "end" FROM w GROUP BY pair, event"""
)
def shared_windows(spark, sf_dir):
    w = _errors(frames(spark, sf_dir))
    w = w.select(F.floor(F.col("track") / 2).cast("long").alias("pair"), "event", F.col("at").alias("start"), F.least(F.col("at") + 12, F.coalesce("until", F.col("at") + 12)).alias("end"))
    return align.shared_window(w, ["pair", "event"], 2)


_MET = f"""{WITH}, {_ERRORS}, m AS (SELECT ev.track, event, fa, frame_idx, kind, value FROM ev JOIN fr ON fr.track = ev.track AND frame_idx >= fa AND frame_idx < coalesce(until, fa + 1000))"""


def _met(spark, sf_dir):
    f = frames(spark, sf_dir)
    w = _errors(f).select("track", "event", "at", F.col("at").alias("start"), F.coalesce("until", F.col("at") + 1000).alias("end"))
    return align.in_windows(f, w, ["track"], bucket=64)


@query(
    f"""{_MET}, c AS (SELECT *, sum(CASE WHEN kind = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY track, event ORDER BY frame_idx) AS n FROM m)
SELECT track, event, min(frame_idx) - 2 AS nth_frame FROM c WHERE n >= 3 GROUP BY track, event"""
)
def nth_after_event(spark, sf_dir):
    return align.nth_in_window(_met(spark, sf_dir), ["track", "event"], F.col("kind") == "view", 3)


@query(f"{_MET} SELECT track, event, min(frame_idx) AS first_frame FROM m WHERE kind = 'purchase' GROUP BY track, event")
def first_after_event(spark, sf_dir):
    return align.first_in_window(_met(spark, sf_dir), ["track", "event"], F.col("kind") == "purchase")


@query(f"{WITH}, {_ERRORS} SELECT a.track, l.loom FROM (SELECT DISTINCT track FROM fr) a CROSS JOIN (SELECT unnest([1, 2, 3]) AS loom) l")
def animals_by_looms(spark, sf_dir):
    looms = spark.range(1, 4).select(F.col("id").cast("int").alias("loom"))  # a fixed handful of event numbers
    return frames(spark, sf_dir).select("track").distinct().crossJoin(F.broadcast(looms))


@query(
    f"""{WITH}, k AS (SELECT track // 2 AS session, dense_rank() OVER (PARTITION BY track // 2 ORDER BY track) AS slot, frame_idx, value FROM fr)
SELECT session, frame_idx, max(value) FILTER (slot = 1) AS value_1, max(value) FILTER (slot = 2) AS value_2 FROM k GROUP BY ALL"""
)
def widen_tracks(spark, sf_dir):
    f = frames(spark, sf_dir).withColumn("session", F.floor(F.col("track") / 2).cast("long"))
    return reshape.widen(f, ["session"], ["value"], 2, row="event_id")


@query(f"{WITH} SELECT track // 2 AS session, frame_idx FROM fr GROUP BY ALL HAVING count(gappy) = 0")
def missing_in_both(spark, sf_dir):
    f = frames(spark, sf_dir).withColumn("session", F.floor(F.col("track") / 2).cast("long"))
    valid = f.where("gappy is not null").select("session", "frame_idx")
    return f.select("session", "frame_idx").distinct().join(valid, ["session", "frame_idx"], "left_anti")


@query(
    f"""{WITH}, {_RUNS}, b AS (SELECT track, min(frame_idx) AS first, max(frame_idx) AS last FROM i WHERE gappy IS NULL GROUP BY track, k)
SELECT b.track, first, last, p.value AS before, n.value AS after FROM b LEFT JOIN fr p ON p.track = b.track AND p.frame_idx = first - 1 LEFT JOIN fr n ON n.track = b.track AND n.frame_idx = last + 1"""
)
def gap_neighbours(spark, sf_dir):
    df = frames(spark, sf_dir).withColumns({"before": F.lag("value").over(TRACK.window), "after": F.lead("value").over(TRACK.window), "hole": F.col("gappy").isNull()})
    df = df.withColumn("island", TRACK.island(F.col("hole"))).where("hole")
    out = df.groupBy("track", "island").agg(F.min("frame_idx").alias("first"), F.max("frame_idx").alias("last"), F.min_by("before", "frame_idx").alias("before"), F.max_by("after", "frame_idx").alias("after"))
    return out.drop("island")


# Sets and order


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, 'log' AS source FROM events WHERE event_type = 'error' UNION ALL SELECT 'o' || o_orderkey, o_orderstatus, 'orders' FROM orders WHERE o_totalprice > 300000")
def union_sources(spark, sf_dir):
    log = table(spark, sf_dir, "events").where("event_type = 'error'").select(F.col("event_id").cast("string").alias("event_id"), "event_type", F.lit("log").alias("source"))
    orders = table(spark, sf_dir, "orders").where("o_totalprice > 300000")
    return log.unionByName(orders.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("event_id"), F.col("o_orderstatus").alias("event_type"), F.lit("orders").alias("source")))


@query(f"{WITH} SELECT track, array_to_string(list_sort(list_distinct(list(CAST(frame_idx AS INT)))), ',') AS swaps FROM fr WHERE kind IN ('error', 'purchase') GROUP BY track")
def distinct_swaps(spark, sf_dir):
    f = frames(spark, sf_dir)
    of = lambda k: F.collect_set(F.when(F.col("kind") == k, F.col("frame_idx").cast("int")))
    both = f.where("kind in ('error', 'purchase')").groupBy("track").agg(of("error").alias("a"), of("purchase").alias("b"))
    return both.select("track", F.array_join(F.array_sort(F.array_union("a", "b")), ",").alias("swaps"))


@query("SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'O' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def set_difference(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderstatus")
    return o.where("o_orderstatus = 'O'").select("custkey").subtract(o.where("o_orderstatus = 'F'").select("custkey"))


@query("SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'O' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def set_intersection(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderstatus")
    return o.where("o_orderstatus = 'O'").select("custkey").intersect(o.where("o_orderstatus = 'F'").select("custkey"))


@query(f"{WITH} SELECT track, frame_idx, value, kind FROM (SELECT *, row_number() OVER (PARTITION BY track ORDER BY value DESC, frame_idx) AS k FROM fr) WHERE k = 1")
def best_candidate(spark, sf_dir):
    return stats.best_candidate(frames(spark, sf_dir).select("track", "frame_idx", "value", "kind"), ["track"], "value", ["frame_idx"])


@query(
    f"""{WITH}, e AS (SELECT *, min(frame_idx) OVER (PARTITION BY track) AS lo, max(frame_idx) OVER (PARTITION BY track) AS hi FROM fr)
SELECT track, frame_idx, value FROM (SELECT *, row_number() OVER (PARTITION BY track ORDER BY value DESC, frame_idx) AS k FROM e WHERE frame_idx >= hi - (hi - lo) * 0.25) WHERE k = 1"""
)
def extreme_candidate(spark, sf_dir):
    return stats.extreme(frames(spark, sf_dir).select("track", "frame_idx", "value"), ["track"], "frame_idx", "value", 0.25, True, ["frame_idx"])


@query(f"{WITH} SELECT track, min(frame_idx) FILTER (kind = 'purchase') AS first_match, arg_min(frame_idx, (value, frame_idx)) AS at_least, arg_max(frame_idx, (value, frame_idx)) AS at_most FROM fr GROUP BY track")
def first_and_extreme_rows(spark, sf_dir):
    key = F.struct("value", "frame_idx")
    return frames(spark, sf_dir).groupBy("track").agg(F.min(F.when(F.col("kind") == "purchase", F.col("frame_idx"))).alias("first_match"), F.min_by("frame_idx", key).alias("at_least"), F.max_by("frame_idx", key).alias("at_most"))


@query(
    f"""{WITH}, b AS (SELECT kind, CAST(floor((value % 180) / 2.5) AS INT) AS bin, sum(1e0 + event_id % 3) AS w FROM fr GROUP BY ALL),
g AS (SELECT kind, CAST(unnest(range(72)) AS INT) AS bin FROM (SELECT DISTINCT kind FROM fr)), h AS (SELECT g.kind, g.bin, coalesce(w, 0e0) AS weight FROM g LEFT JOIN b USING (kind, bin)),
s AS (SELECT h.kind, h.bin, h.weight, h.weight / 2 + (l.weight + r.weight) / 4 AS smooth FROM h JOIN h l ON l.kind = h.kind AND l.bin = (h.bin + 71) % 72 JOIN h r ON r.kind = h.kind AND r.bin = (h.bin + 1) % 72)
SELECT s.kind, s.bin, round(s.weight, 4) AS weight, round(s.smooth, 4) AS smooth, s.smooth > l.smooth AND s.smooth > r.smooth AS is_peak
FROM s JOIN s l ON l.kind = s.kind AND l.bin = (s.bin + 71) % 72 JOIN s r ON r.kind = s.kind AND r.bin = (s.bin + 1) % 72"""
)
def circular_peaks(spark, sf_dir):
    f = frames(spark, sf_dir).withColumn("w", 1.0 + F.col("event_id") % 3)
    return rounded(stats.circular_histogram(f, ["kind"], "value", "w"))


@query(
    f"""{WITH}, p AS (SELECT kind, CAST(floor((value % 180) / 2.5) AS INT) AS bin, round(sum(1e0 + event_id % 3), 4) AS w FROM fr GROUP BY ALL),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY w DESC, bin) AS k FROM p) WHERE k <= 8),
j AS (SELECT a.kind, a.bin AS first, b.bin AS second, (a.w + b.w) * (1 - abs(least(abs(a.bin - b.bin), 72 - abs(a.bin - b.bin)) - 36.0) / 36.0) AS score FROM t a JOIN t b ON a.kind = b.kind AND a.bin < b.bin)
SELECT kind, first, second, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY score DESC, first, second) AS k FROM j) WHERE k = 1"""
)
def perpendicular_pair(spark, sf_dir):
    f = frames(spark, sf_dir)
    p = f.groupBy("kind", F.floor((F.col("value") % 180) / 2.5).cast("int").alias("bin")).agg(F.round(F.sum(1.0 + F.col("event_id") % 3), 4).alias("w"))
    return rounded(stats.perpendicular_peaks(p, ["kind"], 8, "bin", "w", 72.0, 36.0))


@query(
    f"""{WITH} SELECT kind, round(((sum((CASE WHEN v - 170 > 90 THEN v - 180 WHEN 170 - v > 90 THEN v + 180 ELSE v END) * w) / sum(w)) % 180 + 180) % 180, 4) AS angle
FROM (SELECT kind, value % 180 AS v, 1e0 + event_id % 3 AS w FROM fr) GROUP BY kind"""
)
def weighted_angle(spark, sf_dir):
    f = frames(spark, sf_dir).select("kind", (F.col("value") % 180).alias("v"), (1.0 + F.col("event_id") % 3).alias("w"))
    return rounded(f.groupBy("kind").agg(stats.circular_mean("v", "w", F.lit(170.0)).alias("angle")))


# Conventional relational operators


@query(
    """SELECT r_name, n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY CUBE (r_name, n_name)"""
)
def star_cube(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    j = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.cube("r_name", "n_name").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS lines, round(sum(l_quantity), 2) AS quantity, CAST(sum(round(l_discount * 100)) AS BIGINT) AS discount FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def line_rollup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").where("l_shipdate >= timestamp_ntz'1995-01-01 00:00:00'")
    return li.rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.sum(F.round(F.col("l_discount") * 100)).cast("long").alias("discount"))


@query("SELECT c_mktsegment, count(*) AS customers FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000) GROUP BY c_mktsegment")
def semi_join(spark, sf_dir):
    big = table(spark, sf_dir, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(big, "c_custkey", "left_semi").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
