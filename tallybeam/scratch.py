"""Intermediate tables in the cluster's shared folder, and sums over an order that need them."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_scratch: set[tuple[SparkSession, str]] = set()
#: What the scope() at work has written.
_inside: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("inside", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a folder of this machine does for a local master; any other needs the setting."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tallybeam-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; it is deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_delete_all)
    _scratch.add((spark, path))
    if (own := _inside.get()) is not None:
        own.append((spark, path))
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path of new_path()."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _scratch.discard((spark, path))


@contextmanager
def scope() -> Iterator[None]:
    """Delete at the end what this thread wrote to new paths inside; nothing that is read later may depend on it."""
    token = _inside.set([])
    try:
        yield
    finally:
        own = _inside.get()
        _inside.reset(token)
        for spark, path in own:
            if (spark, path) in _scratch:
                delete(spark, path)


def _delete_all() -> None:
    for spark, path in list(_scratch):
        try:
            delete(spark, path)
        except Exception:  # the JVM may have ended already
            return


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tallybeam_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete what materialise() wrote for this very DataFrame, once nothing reads it any more."""
    delete(df.sparkSession, df._tallybeam_path)


def running(rows: DataFrame, order: list[Column], sums: dict[str, str], by: list[str] = (), totals: dict[str, str] | None = None) -> DataFrame:
    """rows with, for each name: column of `sums`, the column's sum over all rows before in a total order, for each group of `by` columns (not null) apart; and for each of `totals`, the sum over all of the group's rows.

    Ranges of the order are summed by themselves and moved by the sums of the ranges before, so a range is all that a task holds, and a large
    group is as many ranges as its rows need. Only one row a range and group passes a window over all ranges.
    """
    totals = totals or {}
    dealt = materialise(rows.repartitionByRange(*map(F.col, by), *order).withColumn("_part", F.spark_partition_id()), "ranges")
    parts = dealt.groupBy("_part", *by).agg(*(F.sum(c).alias(f"_{name}") for name, c in (sums | totals).items()))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nothing = F.lit(0)
    parts = parts.select("_part", *by, *(F.coalesce(F.sum(f"_{n}").over(before), nothing).alias(f"_{n}") for n in sums), *(F.coalesce(F.sum(f"_{n}").over(every), nothing).alias(n) for n in totals))
    inside = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = dealt.select("*", *(F.coalesce(F.sum(c).over(inside), nothing).alias(f"_in_{name}") for name, c in sums.items()))
    return counted.join(parts, ["_part", *by]).select(*[F.col(f"`{c}`") for c in rows.columns], *((F.col(f"_in_{name}") + F.col(f"_{name}")).alias(name) for name in sums), *totals)
