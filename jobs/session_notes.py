"""Job 1: bouts of two-party sessions from written notes, as files of notes arrive.

A session's notes are numbered turns, each by one party. Files of them arrive
over time; a session may go on in later files, and a file may arrive twice. The
job streams what is new (a file stream with ``availableNow`` and a checkpoint),
measures each turn's text, and keeps for each session its bouts: neighbouring
turns of one party, with the turns missing between them and the words written.

Two folders are written below ``output``. ``turns`` gets the measures of each
micro-batch in partitions named by the batch, so a batch that is run again after
a failure replaces what it wrote before. ``bouts`` is partitioned by blocks of
session numbers; a batch works out anew, from ``turns``, the blocks that it
touches and replaces these partitions alone.

Turns without a session or a number cannot be placed: they are left out and
counted in the log. Turns that repeat with the same party and text count once.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import main, read_or_empty
from kinetrace.operators.split import SplitTrack
from kinetrace.sources.stage import shared_folder

log = logging.getLogger("jobs.session_notes")

NOTES = "conv_id bigint, turn bigint, role string, text string"
TURNS = "session bigint, turn bigint, role string, text_id string, n_chars bigint, n_words bigint, batch bigint, block bigint"
BOUTS = "session bigint, bout bigint, role string, first_turn bigint, last_turn bigint, turns bigint, missing bigint, n_chars bigint, n_words bigint, most_words bigint, gap_before bigint, block bigint"
#: Turns of a session in one range of the ordered operators.
TURNS_A_RANGE = 1 << 16


def measured(notes: DataFrame, sessions_per_block: int) -> DataFrame:
    """Each turn's party, a digest of its text, and its characters and words; a null text has none."""
    text = F.coalesce("text", F.lit(""))
    words = F.size(F.filter(F.split(text, r"[\t\n\r ]+"), lambda w: w != ""))
    block = F.floor(F.col("conv_id") / sessions_per_block)
    return notes.select(F.col("conv_id").alias("session"), "turn", "role", F.sha2("text", 256).alias("text_id"), F.length(text).cast("long").alias("n_chars"), words.cast("long").alias("n_words"), block.alias("block"))


def bouts(turns: DataFrame) -> DataFrame:
    """Bouts of all sessions in ``turns``, over ranges of turns, so that a long session is many tasks."""
    once = turns.select("block", "session", "turn", "role", "text_id", "n_chars", "n_words").distinct()
    numbered = SplitTrack(("block", "session"), "turn", TURNS_A_RANGE, ("role", "text_id")).islands(once, F.col("role"), "bout")
    found = numbered.groupBy("block", "session", "bout").agg(
        F.first("role").alias("role"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.count(F.lit(1)).alias("turns"),
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("missing"), F.sum("n_chars").alias("n_chars"), F.sum("n_words").alias("n_words"), F.max("n_words").alias("most_words"),
    )
    back = SplitTrack(("block", "session"), "first_turn", TURNS_A_RANGE, ("bout",)).previous(found, {"before": "last_turn"})
    return back.withColumn("gap_before", F.when(F.col("bout") > 0, F.col("first_turn") - F.col("before") - 1)).drop("before")


def _pattern(path: str) -> str:
    """A path as a pattern that only it fits: file streams take a single file by a pattern alone."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def run(spark: SparkSession, input: str, output: str, checkpoint: str, sessions_per_block: int = 1000, files_per_batch: int = 1000) -> dict:
    """Takes the note files that are new since the last run and brings the bouts of their sessions up to date."""
    totals = {"batches": 0, "read": 0, "unplaced": 0, "blocks": 0, "bouts": 0}
    columns = lambda schema: [c.split()[0] for c in schema.split(", ")]

    def take(batch: DataFrame, number: int) -> None:
        session, placed = batch.sparkSession, F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
        here = {"batches": 1, "blocks": 0, "bouts": 0} | batch.agg(F.count(F.lit(1)).alias("read"), F.count_if(~placed).alias("unplaced")).first().asDict()
        if here["read"] > here["unplaced"]:
            new = measured(batch.where(placed), sessions_per_block).withColumn("batch", F.lit(number).cast("long"))
            new.select(*columns(TURNS)).hint("rebalance", "block").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "block").parquet(f"{output}/turns")
            turns = session.read.schema(TURNS).parquet(f"{output}/turns")
            touched = turns.where(F.col("batch") == number).select("block").distinct()
            made = bouts(turns.join(touched, "block", "left_semi")).select(*columns(BOUTS))
            made.hint("rebalance", "block").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("block").parquet(f"{output}/bouts")
            here |= {"blocks": touched.count(), "bouts": result(session, output).join(touched, "block", "left_semi").count()}
        for k, v in here.items():
            totals[k] += v
        log.info("batch %d: read %d turns of %s, %d without a place; wrote %d bouts of %d blocks below %s", number, here["read"], input, here["unplaced"], here["bouts"], here["blocks"], output)

    stream = spark.readStream.schema(NOTES).option("maxFilesPerTrigger", files_per_batch).parquet(_pattern(input))
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("done: %s", totals)
    return totals


def result(spark: SparkSession, output: str) -> DataFrame:
    """The bouts of all sessions so far."""
    return read_or_empty(spark, f"{output}/bouts", BOUTS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bouts of all conversations after two runs into one folder."""
    folder = shared_folder(spark)
    for _ in range(2):
        run(spark, f"{sf_dir}/conversations.parquet", f"{folder}/notes", f"{folder}/checkpoint")
    return result(spark, f"{folder}/notes")


ORACLE = r"""
WITH n AS (SELECT DISTINCT conv_id AS session, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
t AS (SELECT session, turn, role, length(coalesce(text, '')) AS c, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\t\n\r ]+'), lambda w: w <> '')) AS w, row_number() OVER o AS k,
  CASE WHEN row_number() OVER o > 1 AND role IS DISTINCT FROM lag(role) OVER o THEN 1 ELSE 0 END AS turned FROM n
  WINDOW o AS (PARTITION BY session ORDER BY turn, role NULLS FIRST, sha256(text) NULLS FIRST)),
b AS (SELECT *, sum(turned) OVER (PARTITION BY session ORDER BY k) AS bout FROM t),
g AS (SELECT session, CAST(bout AS BIGINT) AS bout, any_value(role) AS role, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS turns, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS missing,
  CAST(sum(c) AS BIGINT) AS n_chars, CAST(sum(w) AS BIGINT) AS n_words, CAST(max(w) AS BIGINT) AS most_words FROM b GROUP BY session, b.bout)
SELECT *, first_turn - lag(last_turn) OVER (PARTITION BY session ORDER BY bout) - 1 AS gap_before, CAST(floor(session / 1000) AS BIGINT) AS block FROM g
"""

if __name__ == "__main__":
    main(run, ("input", "output", "checkpoint"), ("sessions_per_block", "files_per_batch"))
