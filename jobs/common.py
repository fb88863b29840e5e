"""What the jobs share: configuration, logging, and reading what may not be there yet."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def configured(path: str | None, given: dict) -> dict:
    """The config file's values; those given on the command line win."""
    found = {}
    if path:
        with open(path) as f:
            found = json.load(f)
    return found | {k: v for k, v in given.items() if v is not None}


def main(run: Callable[..., dict], paths: Sequence[str], numbers: Sequence[str], argv: Sequence[str] | None = None) -> None:
    """Reads the command line and the config file, makes a session, runs the job in it and stops it."""
    parser = argparse.ArgumentParser(description=run.__doc__)
    parser.add_argument("--config", help="a JSON file of the options below")
    for name in paths:
        parser.add_argument(f"--{name.replace('_', '-')}", dest=name)
    for name in numbers:
        parser.add_argument(f"--{name.replace('_', '-')}", dest=name, type=float if name in ("fps", "px_per_cm") else int)
    given = vars(parser.parse_args(argv))
    options = configured(given.pop("config"), given)
    missing = [name for name in paths if not options.get(name)]
    if missing:
        parser.error(f"no value for {', '.join(missing)}")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName(run.__module__).getOrCreate()
    try:
        run(spark, **options)
    finally:
        spark.stop()


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder, or no rows where it was not written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
