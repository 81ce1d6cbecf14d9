"""Continuous operation with Structured Streaming over a folder of event files."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def source(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """Event files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def blocks(events: DataFrame, time: str, duration: str, late: str) -> DataFrame:
    """Tumbling blocks of time with counts by kind; rows later than the watermark go."""
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, duration), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        .select(F.col("window.start").alias("block_start"), F.col("window.end").alias("block_end"), "event_type", "n", "total")
    )


def stream_pairs(left: DataFrame, right: DataFrame, left_time: str, right_time: str, window: str, late: str, on: list[tuple[str, str]]) -> DataFrame:
    """Interval join of two streams; both watermarks bound its state."""
    a, b = left.withWatermark(left_time, late), right.withWatermark(right_time, late)
    condition = F.col(left_time).between(F.col(right_time) - F.expr(f"interval {window}"), F.col(right_time) + F.expr(f"interval {window}"))
    for x, y in on:
        condition &= F.col(x) == F.col(y)
    return a.join(b, condition)


def run(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, poll: str | None = None, record_error: Callable[[int, Exception], None] | None = None) -> StreamingQuery:
    """Call `each` with every micro-batch: once over what is there, or for ever if `poll` names an interval.

    An error is recorded before it is raised; the checkpoint resumes after the last whole batch.
    """

    def work(batch: DataFrame, number: int) -> None:
        try:
            each(batch, number)
        except Exception as e:
            if record_error:
                record_error(number, e)
            raise

    writer = df.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=poll) if poll else writer.trigger(availableNow=True)).start()


def stop_requested(spark: SparkSession, stop_file: str) -> bool:
    """Whether the file exists, in any store that Spark reaches."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stop_file)
    return bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where))


def run_until(query: StreamingQuery, stop: Callable[[], bool], poll_s: float = 1.0) -> bool:
    """Wait for a query, and stop it between batches once it is asked to. Returns whether it was; raises the query's error."""
    while not query.awaitTermination(poll_s):
        if stop():
            while query.isActive and query.status["isTriggerActive"]:
                time.sleep(min(poll_s, 0.05))
            query.stop()
            return True
    return False


def block_times(spark: SparkSession, start_us: int, end_us: int, duration_us: int, backward: bool = False) -> DataFrame:
    """block_start_us, block_end_us: forward from start while the start lies before the end, or backward from the end while the start does not pass `start_us`."""
    n = max(0, -(-(end_us - start_us) // duration_us)) if not backward else max(0, (end_us - start_us) // duration_us)
    first = F.lit(start_us) + F.col("id") * duration_us if not backward else F.lit(end_us) - (F.col("id") + 1) * duration_us
    return spark.range(n).select(first.alias("block_start_us"), (first + duration_us).alias("block_end_us"))
