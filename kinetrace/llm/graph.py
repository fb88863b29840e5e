"""Connected components by contraction, in DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetrace.sources.stage import drop, stored


def components(edges: DataFrame, folder: str) -> DataFrame:
    """The smallest reachable id for each id in ``edges`` (columns u and v): columns id and root.

    In a round every id turns into the smallest of itself and its neighbours,
    and edges whose ends become equal go; the rounds' number grows with the
    logarithm of the longest path. Each step is a combinable minimum or a join
    with a table of unique keys, so an id with very many edges may be split.
    """
    spark = edges.sparkSession
    labels, step = None, 0
    edges = stored(edges.where("u <> v").select("u", "v").distinct(), folder, "edges0")
    while not edges.isEmpty():
        step += 1
        both = edges.union(edges.select("v", "u"))
        turn = stored(both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.col("u")).alias("root")), folder, f"turn{step}")
        if labels is None:
            labels = turn
        else:
            labels = stored(labels.alias("l").join(turn.alias("t"), F.col("l.root") == F.col("t.id"), "left").select("l.id", F.coalesce("t.root", "l.root").alias("root")), folder, f"labels{step}")
        moved = edges.join(turn.select(F.col("id").alias("u"), F.col("root").alias("a")), "u").join(turn.select(F.col("id").alias("v"), F.col("root").alias("b")), "v")
        edges = stored(moved.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), folder, f"edges{step}")
        drop(spark, f"{folder}/edges{step - 1}")
    return labels if labels is not None else edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
