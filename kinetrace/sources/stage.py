"""Tables written between stages, in the folder all machines share.

A stage that several later steps read is written once instead of being planned
into each of them; the files also end the lineage, so a lost executor costs no
earlier stage.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``.

    Where that is unset, a local master uses a temporary folder, as tests do; a
    cluster's machines do not share one, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/kinetrace-stages"
    _made.append(f"{base.rstrip('/')}/{uuid.uuid4().hex}")
    return _made[-1]


def mark() -> int:
    """Where the list of stage folders stands, for :func:`release`."""
    return len(_made)


def release(spark: SparkSession, since: int = 0) -> None:
    """Deletes the stage folders made by this process, or those made after :func:`mark` gave ``since``.

    Results that read them have to be written before.
    """
    while len(_made) > since:
        drop(spark, _made.pop())


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Writes ``df`` below ``folder`` and reads it back."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _at(spark, path)
    return system.exists(at)


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a folder through Spark's own file systems."""
    system, at = _at(spark, path)
    system.delete(at, True)
