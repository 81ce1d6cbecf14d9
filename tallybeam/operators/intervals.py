"""Interval, range and nearest joins.

A range condition alone makes Spark compare all pairs. Here both sides get a time bin as wide as the window, one side is
repeated into its two neighbour bins, and an equality join on (keys, bin) leaves the exact condition as a residual. Rows a bin apart meet
exactly once, so nothing is lost or doubled, the join sorts and shuffles by key, and adaptive execution can split hot bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_bin(t: Column, width: int) -> Column:
    """Bin number of an integer time; works below zero."""
    return F.floor(t / F.lit(max(1, int(width)))).cast("long")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """rows shuffled by keys into the session's number of partitions. Adaptive execution leaves that as it is; it would go by the bytes read, and few tasks would make all the rows that a join makes of them."""
    if rows.isStreaming:
        return rows
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def range_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, window: int, on: list[tuple[str, str]] = (), strict: bool = False, how: str = "inner", both_grow: bool = False, bins: tuple[str, int] | None = None) -> DataFrame:
    """Rows with |left - right| <= window (< if strict) and equal `on` columns; names of both sides must differ.

    how: inner, left, left_semi or left_anti. Null times or keys never match. both_grow: the right side is as large as the left one, so both are shuffled
    at every size and by spread(): many rows come of few here, and a broadcast would leave them to as few tasks as the left side's scan has. bins: a column of the left side that has
    its time_bin() already, and that bin's width (the window at least). The column stays, and a left side that was spread by it and the `on` columns is neither shuffled nor (once joined by them) sorted again.
    """
    width = max(1, int(window)) if bins is None else bins[1]
    if width < window:
        raise ValueError(f"bins of {width} are narrower than the window, {window}")
    a, own = (left.withColumn("_bin_a", time_bin(F.col(left_time), width)), "_bin_a") if bins is None else (left, bins[0])
    if both_grow and bins is None:
        a = spread(a, own, *(x for x, _ in on))
    b = right.withColumn("_bin_b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: time_bin(F.col(right_time), width) + d)))
    gap = F.abs(F.col(left_time) - F.col(right_time))
    condition = (F.col(own) == F.col("_bin_b")) & ((gap < window) if strict else (gap <= window))
    for x, y in on:
        condition &= F.col(x) == F.col(y)
    return a.join(b.hint("merge") if both_grow else b, condition, how).drop("_bin_a", "_bin_b")


def nearest(left: DataFrame, right: DataFrame, left_time: str, right_time: str, name: str, tolerance: int) -> DataFrame:
    """Each left row with `name` of the right row nearest in time within the tolerance and match_gap (ties: earlier, then smaller name), else null in both.

    Both sides are laid on one line of time, in bins some tolerances wide; right rows near an edge are repeated into the bin beyond.
    Windows over a bin, one forward and one backward, carry the last right row before and the first one after each left row, so left rows are evaluated once, none is
    repeated or merged whatever its keys, and a burst on either side costs its sorting only. Left rows without a time have no match.
    """
    width = 16 * max(1, int(tolerance))
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    a = left.select(row.alias("_row"), F.col(left_time).cast("long").alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast("string").alias("_name"))
    a = a.withColumn("_bin", F.coalesce(time_bin(F.col("_t"), width), F.spark_partition_id().cast("long")))
    b = right.select(F.col(right_time).cast("long").alias("_t"), F.col(name).cast("string").alias("_name")).filter("_t is not null").groupBy("_t").agg(F.min("_name").alias("_name"))
    bins = F.array_distinct(F.array(*(time_bin(F.col("_t") + d, width) for d in (-tolerance, 0, tolerance))))
    line = a.unionByName(b.select("_t", F.lit(0).alias("_side"), "_name", F.explode(bins).alias("_bin")), allowMissingColumns=True)
    upto = lambda *order: Window.partitionBy("_bin").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    hit = F.when(F.col("_side") == 0, F.struct(F.col("_t").alias("t"), F.col("_name").alias("name")))
    before = F.last(hit, ignorenulls=True).over(upto("_t", "_side"))
    after = F.last(hit, ignorenulls=True).over(upto(F.desc("_t"), F.desc("_side")))  # a frame that ends at the bin's end would pass it again for each row
    met = line.withColumn("_before", before).withColumn("_after", after).filter("_side = 1")
    near = lambda x: F.when(F.abs(F.col("_t") - F.col(x)["t"]) <= tolerance, F.struct(F.abs(F.col("_t") - F.col(x)["t"]).alias("gap"), F.col(x)["t"].alias("t"), F.col(x)["name"].alias("name")))
    found = met.withColumn("_best", F.least(near("_before"), near("_after")))  # skips nulls
    return found.select("_row.*", F.col("_best.name").alias(name), F.col("_best.gap").alias("match_gap"))


def within_segments(points: DataFrame, segments: DataFrame, time: str, start: str, end: str, width: int, how: str = "left_semi") -> DataFrame:
    """Points inside any segment, both ends included; segments are repeated into the bins that they touch."""
    a = points.withColumn("_bin_a", time_bin(F.col(time), width))
    b = segments.select(start, end).withColumn("_bin_b", F.explode(F.sequence(time_bin(F.col(start), width), time_bin(F.col(end), width))))
    return a.join(b, (F.col("_bin_a") == F.col("_bin_b")) & F.col(time).between(F.col(start), F.col(end)), how).drop("_bin_a", "_bin_b")


def clip(segments: DataFrame, start: str, end: str, lo: Column, hi: Column) -> DataFrame:
    """Segments cut to [lo, hi); empty ones go."""
    return segments.withColumn(start, F.greatest(F.col(start), lo)).withColumn(end, F.least(F.col(end), hi)).filter(F.col(start) < F.col(end))


def islands(rows: DataFrame, time: str, gap: int, span: int = 86_400_000_000) -> DataFrame:
    """rows with `island`: numbered runs of rows in which neighbours are less than `gap` apart (integer times).

    Breaks are counted inside spans of time first, each span a group of its own; only one row per span passes the window over all,
    which decides whether a span's first row continues the run of the span before.
    """
    inside = Window.partitionBy("_span").orderBy(time)
    step = F.col(time) - F.lag(time).over(inside)
    marked = rows.withColumn("_span", time_bin(F.col(time), span)).withColumn("_break", F.when(step >= gap, 1).otherwise(0))
    spans = marked.groupBy("_span").agg(F.min(time).alias("first"), F.max(time).alias("last"), F.sum("_break").alias("breaks"))
    order = Window.orderBy("_span")
    opens = F.when(F.col("first") - F.lag("last").over(order) < gap, 0).otherwise(1)
    spans = spans.withColumn("opens", opens)
    before = F.coalesce(F.sum(F.col("opens") + F.col("breaks")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select("_span", (before + F.col("opens")).alias("_base"))
    counted = marked.withColumn("_breaks", F.sum("_break").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    return counted.join(spans, "_span").withColumn("island", F.col("_base") + F.col("_breaks")).drop("_span", "_break", "_breaks", "_base")
