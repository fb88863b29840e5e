"""Python workers."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def reachable(spark: SparkSession) -> None:
    """Lets workers on a shared file system import this package from where the driver has it.

    Elsewhere it has to be installed, or sent with ``--py-files``.
    """
    root, environment = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    now = environment.get("PYTHONPATH", "")
    if root not in now.split(os.pathsep):
        environment["PYTHONPATH"] = root + (os.pathsep + now if now else "")
