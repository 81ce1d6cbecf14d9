"""Digests of run logs, kept up to date as log files arrive.

    python -m jobs.log_digest SOURCE OUTPUT CHECKPOINT [--config jobs/log_digest.json]

Those who watch long searches want each run's state at a glance: how many lines, errors and data gaps it has logged, who wrote last and what. SOURCE is a
folder of Parquet files (conv_id: the run, turn: the line's number, role: what wrote it, text), followed as a file stream whose CHECKPOINT knows
the files that were taken. Each call takes what is new and ends. It writes

    OUTPUT/lines/batch=.../bucket=...   the lines of a batch, classified
    OUTPUT/digests/bucket=...           one row for each run

Runs are numbered in the order of time, so `runs_per_bucket` neighbours share a bucket, new lines meet few buckets, and only these are digested again, from their
own lines. A batch that is repeated after a failure overwrites the partitions that it wrote before, and a digest is a function of the lines
alone, so neither depends on how often a batch ran or how the files were dealt to batches.

Lines without a run form a run of their own (null) in bucket -1. The last line is the one of the largest number (null numbers
come first), of several the one whose text has the largest MD5, then by role; null texts are empty. A line is repeated if its run has an equal text in another line. Lines are never dropped, and no step holds a whole
run: counts are summed from partial ones, by run and text first.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import configuration, main
from tallybeam.functions import scalars as S
from tallybeam.streaming import loop

log = logging.getLogger("log_digest")
DEFAULTS = {"runs_per_bucket": 1000, "files_per_batch": 100, "tail_chars": 4000}
#: Words of lines that report a failure.
FAILURES = ("error", "failed", "exception", "traceback")


def kind(text: Column) -> Column:
    """gap or error for lines that report one, else info."""
    failed = F.lit(False)
    for word in FAILURES:
        failed = failed | F.lower(text).contains(word)
    gap = S.error_kind(text) == "gap"
    return F.when(gap, "gap").when(failed, "error").otherwise("info")


def lines(rows: DataFrame, batch: int, runs_per_bucket: int) -> DataFrame:
    """Log lines as they are kept: run_id, line, origin, kind, text, n_chars, text_md5, batch, bucket."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.select(
        F.col("conv_id").cast("long").alias("run_id"), F.col("turn").cast("long").alias("line"), F.col("role").alias("origin"), kind(text).alias("kind"), text.alias("text"),
        F.length(text).cast("long").alias("n_chars"), F.md5(text).alias("text_md5"), F.lit(batch).cast("long").alias("batch"),
        F.coalesce(F.floor(F.col("conv_id") / runs_per_bucket), F.lit(-1)).cast("long").alias("bucket"),
    )


def digests(kept: DataFrame, tail_chars: int) -> DataFrame:
    """One row for each run: run_id, n_lines, n_errors, n_gaps, n_repeated, n_chars, last_line, last_origin, last_kind, tail (of the last line, escaped), bucket.

    Lines are counted by run and text first, so a run of very many lines is spread over tasks; of texts only tails are shuffled.
    """
    last = F.max(F.struct(F.col("line").isNotNull().alias("numbered"), "line", "text_md5", "origin", "kind", F.right("text", F.lit(tail_chars)).alias("tail"))).alias("last")
    by_text = kept.groupBy("bucket", "run_id", "text_md5").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == "error").alias("errors"), F.count_if(F.col("kind") == "gap").alias("gaps"), F.sum("n_chars").alias("chars"), last,
    )
    runs = by_text.groupBy("bucket", "run_id").agg(
        F.sum("n").alias("n_lines"), F.sum("errors").alias("n_errors"), F.sum("gaps").alias("n_gaps"), (F.sum("n") - F.count(F.lit(1))).alias("n_repeated"), F.sum("chars").alias("n_chars"), F.max("last").alias("last"),
    )
    return runs.select(
        "run_id", "n_lines", "n_errors", "n_gaps", "n_repeated", "n_chars", F.col("last.line").alias("last_line"), F.col("last.origin").alias("last_origin"), F.col("last.kind").alias("last_kind"),
        S.escape_html(F.col("last.tail")).alias("tail"), "bucket",
    )


def take(batch: DataFrame, number: int, output: str, settings: dict) -> None:
    """One micro-batch: keep its lines, then digest the buckets that they meet. Taking it again changes nothing."""
    spark = batch.sparkSession

    def write(rows: DataFrame, name: str, *by: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{output}/{name}")

    found = lines(batch, number, settings["runs_per_bucket"])
    write(found, "lines", "batch", "bucket")
    kept = spark.read.schema(found.schema).parquet(f"{output}/lines")
    mine = kept.filter(F.col("batch") == number).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()  # one number a partition just written
    buckets = sorted(r.bucket for r in mine)
    if buckets:
        write(digests(kept.filter(F.col("bucket").isin(buckets)), settings["tail_chars"]).repartition("bucket"), "digests", "bucket")
    log.info("batch %d: read %d new lines, wrote them to %s/lines and digested %d of its buckets", number, sum(r.n for r in mine), output, len(buckets))


def run(spark: SparkSession, source: str, output: str, checkpoint: str, settings: dict | None = None) -> DataFrame:
    """Take the log files in `source` that the checkpoint doesn't know, and return all digests as they stand then."""
    settings = DEFAULTS | (settings or {})
    schema = spark.read.parquet(source).select("conv_id", "turn", "role", "text").schema
    new = loop.source(spark, source, schema, settings["files_per_batch"])
    loop.run(new, lambda batch, number: take(batch, number, output, settings), checkpoint).awaitTermination()
    return read(spark, output, schema, settings)


def read(spark: SparkSession, output: str, schema, settings: dict) -> DataFrame:
    """All digests; none where nothing has been written yet."""
    nothing = digests(lines(spark.createDataFrame([], schema), 0, settings["runs_per_bucket"]), settings["tail_chars"])
    try:
        return spark.read.schema(nothing.schema).parquet(f"{output}/digests")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return nothing


if __name__ == "__main__":
    given = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    for name in ("source", "output", "checkpoint"):
        given.add_argument(name)
    given.add_argument("--config", default="jobs/log_digest.json")
    args = given.parse_args()

    def work(spark: SparkSession) -> None:
        found = run(spark, args.source, args.output, args.checkpoint, configuration(spark, args.config, DEFAULTS))
        log.info("%s/digests holds %d runs", args.output, found.count())

    main("log_digest", work)
