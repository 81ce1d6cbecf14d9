"""What the jobs' command lines share."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

from pyspark.sql import SparkSession


def configuration(spark: SparkSession, path: str, known: dict) -> dict:
    """The JSON object in a file that Spark can read, over the defaults; names that are not known are refused."""
    given = json.loads(spark.read.text(path, wholetext=True).first()[0])
    if unknown := sorted(set(given) - set(known)):
        raise ValueError(f"unknown settings in {path}: {', '.join(unknown)}")
    return known | given


def main(name: str, work: Callable[[SparkSession], None]) -> None:
    """Run work in a session of its own, which is stopped at the end."""
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        work(spark)
    finally:
        spark.stop()
