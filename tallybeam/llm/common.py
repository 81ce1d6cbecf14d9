"""Shared helpers: table access, Arrow batches, and removal of marked rows. Scratch tables are those of tallybeam.scratch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybeam.scratch import delete, materialise, new_path, release, running, shared_dir  # noqa: F401

#: A-Z to a-z on bytes; all other bytes stay.
LOWER_ASCII = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Text bytes that Python code holds as separate objects at once.
SLICE_BYTES = 4 << 20
#: Bits of a broadcast map of hashes at most: 4 MB.
MOST_BITS = 1 << 25

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table of that name; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split(docs: DataFrame, hashes: DataFrame, key: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """docs whose key (text_hash() if not given) is surely not among `hashes` (one long column), and the others: few more than there are such, as long as their number is well below MOST_BITS.

    A map of bits, sixteen for each hash but MOST_BITS at most, is built by an aggregation and broadcast, so only the second part needs a shuffle
    for what follows, whatever the table's size. Beyond MOST_BITS hashes nearly all rows are in the second part; nothing is lost.
    """
    n = hashes.count()
    bits = min(MOST_BITS, max(1 << 12, 1 << (16 * n).bit_length()))
    place = F.col(hashes.columns[0]).bitwiseAND(F.lit(bits - 1))
    words = hashes.select(F.shiftright(place, 6).alias("_tb_word"), place.bitwiseAND(F.lit(63)).cast("int").alias("_tb_at"))
    words = words.groupBy("_tb_word").agg(F.bit_or(F.expr("shiftleft(1L, _tb_at)")).alias("_tb_bits"))
    words = F.broadcast(materialise(words, "bits"))  # MOST_BITS / 64 rows at most
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_tb_row"), (text_hash() if key is None else key).bitwiseAND(F.lit(bits - 1)).alias("_tb_place"))
    rows = rows.join(words, F.shiftright("_tb_place", 6) == F.col("_tb_word"), "left")
    maybe = F.coalesce(F.expr("shiftright(_tb_bits, cast(_tb_place & 63 as int)) & 1") == 1, F.lit(False))
    own = [F.col(f"_tb_row.`{c}`") for c in docs.columns]
    return rows.filter(~maybe).select(*own), rows.filter(maybe).select(*own)


def text_hash() -> Column:
    """A number of the text as it is; null is not empty here."""
    return F.xxhash64("text")


def drop_marked(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """docs without the rows that `marks` (doc_id, text_hash()) names, all columns kept. Texts of marked rows and a few others alone are shuffled."""
    stay, maybe = split(docs, marks.select(F.col(marks.columns[1]).alias("h")))
    marks = marks.toDF("_tb_id", "_tb_hash").hint("merge")  # the same plan at every size
    same = (F.xxhash64(maybe["text"]) == F.col("_tb_hash")) & maybe["doc_id"].cast("long").eqNullSafe(F.col("_tb_id"))
    return stay.unionByName(maybe.join(marks, same, "left_anti"))


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about SLICE_BYTES of the column's bytes at most (one row at least)."""
    for batch in batches:
        start, size = 0, 0
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        for i, n in enumerate(lengths):
            if i > start and size + n > SLICE_BYTES:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < len(lengths):
            yield batch.slice(start)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, column: str, done: Callable[[], None] | None = None) -> DataFrame:
    """work on small batches of df by mapInArrow, cut by the bytes of a text column; done() ends each task, as processes outlive tasks."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in slices(batches, column):
                yield work(batch)
        finally:
            if done:
                done()

    return df.mapInArrow(run, schema)


def bound_batches(spark: SparkSession) -> None:
    """Bound what Spark sends to Python at once to twice SLICE_BYTES, if the session still has Spark's default of 64 MB."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in ("67108864b", "67108864", "64MB"):
        spark.conf.set(name, str(2 * SLICE_BYTES))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]
