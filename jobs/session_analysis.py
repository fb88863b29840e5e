"""Job 2: from recorded vectors to features and event metrics, for the sessions that have changed.

A session's input is summed up in a digest of its rows, whatever their order,
and of the parameters. Sessions whose digest is not the one that their results
were made from are analysed: their features and metrics are written, a folder
for each session, in place of older ones, and then their digests are added to
``marks``. A run that breaks off leaves no mark for what it had not finished, so
the next one does it again; a run over the same input writes nothing.

Results carry the digest that they were made from. :func:`result` returns those
whose digest is the session's latest, so results of sessions that are gone, or
that have no event any more, do not show.
"""

from __future__ import annotations

import hashlib
import json
import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import main, read_or_empty
from kinetrace.operators import features, zones
from kinetrace.plans import session_queries
from kinetrace.plans.base import ORACLES, pose_of
from kinetrace.plans.session import measured
from kinetrace.schema import DEFAULT_FPS
from kinetrace.sources.stage import shared_folder, stored

log = logging.getLogger("jobs.session_analysis")

MARKS = "session int, digest string, run bigint"
NEST = [list(p) for p in session_queries.WIDE]
CIRCLE = [list(session_queries.LOOM), session_queries.RADIUS]


def _both(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def digests(vectors: DataFrame, parameters: dict) -> DataFrame:
    """A digest of each session's rows, in any order, and of the parameters."""
    row = F.concat_ws(";", F.coalesce(F.col("vec_id").cast("string"), F.lit("null")), F.coalesce(F.col("embedding").cast("string"), F.lit("null")))
    parts = [F.sum(F.xxhash64(F.lit(seed), row).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    given = hashlib.sha256(json.dumps(parameters, sort_keys=True).encode()).hexdigest()
    return vectors.groupBy(F.col("label").alias("session")).agg(F.sha2(F.concat_ws(",", F.count(F.lit(1)).cast("string"), *parts, F.lit(given)), 256).alias("digest"))


def latest(spark: SparkSession, output: str) -> DataFrame:
    """The digest that each session's results were made from; a session that is gone has none."""
    marks = read_or_empty(spark, f"{output}/marks", MARKS)
    return marks.groupBy("session").agg(F.max_by("digest", "run").alias("digest")).where("digest is not null")


def run(
    spark: SparkSession, input: str, output: str, fps: float = DEFAULT_FPS, px_per_cm: float = session_queries._CM, event_first: int = 5, event_every: int = 25, nest: list = NEST, circle: list = CIRCLE
) -> dict:
    """Analyses the sessions whose rows or parameters have changed since their results were made."""
    vectors = spark.read.parquet(input).select("label", "vec_id", "embedding")
    parameters = {"fps": fps, "px_per_cm": px_per_cm, "event_first": event_first, "event_every": event_every, "nest": nest, "circle": circle}
    folder = shared_folder(spark)
    now = digests(vectors, parameters)
    before = latest(spark, output).select(F.col("session").alias("s"), F.col("digest").alias("d"))
    met = stored(now.join(before, _both("session", "s"), "full_outer"), folder, "compared")
    # A row of a session that is there has a digest, one that is gone only the older one.
    changed = met.where("digest is not null and not digest <=> d").select("session", "digest")
    gone = met.where("digest is null").select(F.col("s").alias("session"), F.lit(None).cast("string").alias("digest"))
    counts = met.agg(F.count("digest").alias("sessions"), F.count_if(F.col("digest").isNotNull() & ~F.col("digest").eqNullSafe(F.col("d"))).alias("changed"), F.count_if(F.col("digest").isNull()).alias("gone")).first().asDict()
    log.info("read %s: %d sessions, %d of them new or changed, %d gone", input, counts["sessions"], counts["changed"], counts["gone"])
    if counts["changed"]:
        own = vectors.join(changed.select("session"), _both("label", "session"), "left_semi")
        table = features.extract(pose_of(own), ["session"], 2)
        _written(table, changed, f"{output}/features")
        done = spark.read.parquet(f"{output}/features").join(changed.select(F.col("session").alias("s"), F.col("digest").alias("d")), _both("session", "s") & _both("digest", "d"), "left_semi").drop("digest")
        # Frames are read back once more by the steps of the analysis, which writes what several of them read.
        events = done.where((F.col("frame_idx") >= event_first) & ((F.col("frame_idx") - event_first) % event_every == 0))
        events = events.select("session", F.lit("loom").alias("event_type"), F.col("frame_idx").cast("double").alias("time_start"), F.col("frame_idx").alias("frame_start"))
        area = zones.Zones(tuple(map(tuple, nest)), tuple(circle[0]), circle[1])
        _written(measured(done, events, area, ["session"], 2, fps, px_per_cm, paths=False), changed, f"{output}/metrics")
    if counts["changed"] or counts["gone"]:
        number = read_or_empty(spark, f"{output}/marks", MARKS).agg(F.coalesce(F.max("run"), F.lit(0))).first()[0] + 1
        changed.unionByName(gone).withColumn("run", F.lit(number).cast("long")).write.mode("append").parquet(f"{output}/marks")
    log.info("wrote features, metrics and marks of %d sessions below %s", counts["changed"], output)
    return counts


def _written(df: DataFrame, changed: DataFrame, path: str) -> None:
    """Writes a folder for each session, with the digest that the rows were made from."""
    named = df.join(changed.select(F.col("session").alias("s"), "digest"), _both("session", "s")).drop("s")
    named.hint("rebalance", "session").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("session").parquet(path)


def result(spark: SparkSession, output: str) -> DataFrame:
    """The metrics of every animal and event, of the sessions as they last were."""
    metrics = spark.read.parquet(f"{output}/metrics")
    now = latest(spark, output).select(F.col("session").alias("s"), F.col("digest").alias("d"))
    return metrics.join(now, _both("session", "s") & _both("digest", "d"), "left_semi").drop("digest")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of all sessions after two runs into one folder; doubles are rounded, as in the SQL."""
    output = f"{shared_folder(spark)}/analysis"
    for _ in range(2):
        run(spark, f"{sf_dir}/embeddings.parquet", output)
    out = result(spark, output)
    return out.select(*[F.round(F.col(f"`{c}`"), 7).alias(c) if kind == "double" else F.col(f"`{c}`") for c, kind in out.dtypes])


ORACLE = ORACLES["session_metrics"]

if __name__ == "__main__":
    main(run, ("input", "output"), ("fps", "px_per_cm", "event_first", "event_every"))
