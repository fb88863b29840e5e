"""Queries whose rows arrive as a stream of files, compared with the SQL of the batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinetrace.plans.base import ORACLES, query
from kinetrace.plans.session_queries import _looms, _pairs
from kinetrace.sources.stage import shared_folder, stored
from kinetrace.streaming import points

#: Sets of files that arrive one after another, and how many frames late a row may be.
SETS, LATE = 6, 20
#: Files of a set: one micro-batch takes them, so batches do not grow with the rows, and a batch touches each animal once.
FILES = 8
#: Seconds without a row that end a session.
GAP = 600


def arriving(spark, sf_dir: str):
    """Frames and events of all pairs, one frame a second."""
    p = _pairs(spark, sf_dir)
    flags = ["inside", "near", "slow", "calm"]
    seen = p.select("session", "animal", "frame_idx", F.lit(False).alias("event"), *flags)
    none = [F.lit(None).cast("boolean").alias(c) for c in flags]
    told = _looms(p).select("session", F.explode(F.array(F.lit(1), F.lit(2))).alias("animal"), F.col("at").alias("frame_idx"), F.lit(True).alias("event"), *none)
    return seen.unionByName(told).withColumn("time", F.timestamp_seconds("frame_idx"))


@query(ORACLES["loom_time_points"])
def loom_time_points_streamed(spark, sf_dir):
    """Time points from files that arrive one after another, rows out of order within them and some late."""
    folder = shared_folder(spark)
    rows = stored(arriving(spark, sf_dir), folder, "rows")
    frames = (rows.agg(F.max("frame_idx")).first()[0] or 0) + LATE + 1
    size, into = -(-frames // SETS), f"{folder}/arrived"
    behind = F.pmod(F.hash("session", "animal", "frame_idx"), F.lit(LATE))
    for part in range(SETS):
        rows.where(F.floor((F.col("frame_idx") + behind) / size) == part).repartition(FILES).write.mode("append").parquet(into)
    # A row of no session, much later, moves the watermark past the end of all sessions.
    after = {"session": F.lit(-1).cast("bigint"), "time": F.timestamp_seconds(F.lit(4 * frames + 2 * GAP))}
    rows.limit(1).withColumns(after).write.mode("append").parquet(into)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(into)
    found = points.time_points(stream, ["session"], f"{size + LATE} seconds", GAP)
    done = found.writeStream.format("parquet").option("checkpointLocation", f"{folder}/marks").option("path", f"{folder}/points").trigger(availableNow=True).start()
    done.awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{folder}/points")
