"""Exact deduplication with a heavy-hitter split.

1. One pass writes a small table (doc_id, row number, digest) with the SHA-256 of each normalised text.
2. Misra-Gries summaries of that table, one per task, are added up by digest. With k counters the sum errs by
   at most N/(k+1), and at most k+1 digests can reach N/(k+1), so the candidates have a fixed bound at any N;
   every digest with 2N/(k+1) rows or more is among them.
3. Candidates are verified: their exact row count and winner come from a map-side combined aggregation.
4. Verified winners (at most k+1 rows) are broadcast, so heavy groups are settled map-side without a shuffle.
   All other digests use an ordinary shuffle.

Defined results: null text counts as empty; texts are equal when identical after lower-casing A-Z. Of equal
texts the row with the largest doc_id stays (null doc_ids lose to any other); if rows repeat a doc_id, exactly
one of them stays: that with the largest hash of the text as it is, then the one with the least other columns, so reruns agree.
Extra columns are ignored by decisions() and kept by drop_copies().
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybeam.llm.common import LOWER_ASCII, bound_batches, map_batches, materialise, slices, split, text_hash, texts

#: Counters of a Misra-Gries summary: digests with two parts in K + 1 of all rows or more are found for certain.
K = 1024


def digest(text: bytes) -> bytes:
    """SHA-256 of the text after lower-casing A-Z only."""
    return hashlib.sha256(text.translate(LOWER_ASCII)).digest()


def with_digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest binary, raw long (of the text as it is), row long: a number of the row that is fixed once this has been written."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([digest(x) for x in texts(batch.column(1))], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), found, batch.column(2)], ["doc_id", "digest", "raw"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text", text_hash().alias("raw")), work, "doc_id long, digest binary, raw long", "text").withColumn("row", F.monotonically_increasing_id())


class MisraGries:
    """Frequent items of a stream with k counters; an item's count is short by n/(k+1) at most."""

    def __init__(self, k: int):
        self.k, self.counts = k, {}

    def add_all(self, items: list[bytes]) -> None:
        """Add items of one batch: counted exactly first, then the counters beyond k are cut off together."""
        counts = self.counts
        for item in items:
            counts[item] = counts.get(item, 0) + 1
        if len(counts) > self.k:
            cut = sorted(counts.values(), reverse=True)[self.k]
            self.counts = {x: c - cut for x, c in counts.items() if c > cut}


def frequent(digests: DataFrame, k: int = K) -> DataFrame:
    """The rows' frequent digests, k + 1 at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, n = MisraGries(k), 0
        for batch in batches:
            n += batch.num_rows
            summary.add_all(batch.column(0).to_pylist())
        found = [*summary.counts.items(), (b"", n)]  # the empty key carries the number of rows
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([c for _, c in found], pa.int64())], ["digest", "n"])

    summed = digests.select("digest").mapInArrow(run, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    summed = materialise(summed, "frequent")
    total = summed.filter(F.length("digest") == 0).agg(F.sum("n")).first()[0] or 0
    return summed.filter((F.length("digest") > 0) & (F.col("n") * (k + 1) >= total) & (F.col("n") > 1)).select("digest")


def verified(digests: DataFrame, k: int = K) -> DataFrame:
    """digest, group_size, keep_id, keep_raw, keep_row of the heavy groups: k + 1 rows at most, so it may be broadcast."""
    heavy = F.broadcast(frequent(digests, k))
    return materialise(_groups(digests.join(heavy, "digest", "left_semi")), "winners")


def _groups(digests: DataFrame) -> DataFrame:
    best = F.max(F.struct("doc_id", "raw", "row"))
    return digests.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")).select("digest", "group_size", *(F.col(f"best.{c}").alias(f"keep_{n}") for c, n in (("doc_id", "id"), ("raw", "raw"), ("row", "row"))))


def _with_groups(digests: DataFrame, k: int) -> DataFrame:
    """The rows of with_digests() with those of their group: heavy groups map-side, the others by a shuffle of digests."""
    winners = verified(digests, k)
    settled = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    return settled.unionByName(rest.join(_groups(rest), "digest"))


def decisions(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document, dropped ones too."""
    out = _with_groups(materialise(with_digests(docs), "digests"), k)
    return out.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, k: int = K) -> DataFrame:
    """docs without the copies, all columns kept.

    Decisions are made on digests alone. Texts that may belong to a group of two or more are told by a broadcast map of their hashes; all
    others stay without a shuffle. Of the first, losers of heavy groups go map-side by the broadcast winners, the others by an anti join with marks (doc_id,
    digest, raw). Rows equal to their group's winner in doc_id and text can't be told apart by marks: a map-side combined aggregation leaves one of them.
    """
    digests = materialise(with_digests(docs), "digests")
    winners = verified(digests, k)
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    wins = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("raw") == F.col("keep_raw"))
    copied = materialise(rest.join(_groups(rest).filter("group_size > 1"), "digest").select("doc_id", "digest", "raw", wins.alias("wins")), "copied")
    lost = copied.filter("not wins").select("doc_id", "digest", "raw").distinct()
    twins = digests.groupBy("doc_id", "digest", "raw").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id", "digest", "raw")
    twins = materialise(twins, "twins")
    stay, maybe = split(docs, copied.select("raw").unionByName(digests.join(F.broadcast(winners.select("digest")), "digest", "left_semi").select("raw")).distinct())

    schema = T.StructType([*maybe.schema.fields, T.StructField("_tb_digest", T.BinaryType())])
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = pa.array([digest(x) for x in texts(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "_tb_digest"])

    own = [F.col(f"`{c}`") for c in docs.columns]
    row = maybe.mapInArrow(run, schema).select(F.struct(*own).alias("_tb_row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("_tb_digest").alias("digest"), text_hash().alias("raw"))
    heavy = winners.select(F.col("digest").alias("_tb_heavy"), "keep_id", "keep_raw")
    row = row.join(F.broadcast(heavy), F.col("digest") == F.col("_tb_heavy"), "left").filter(F.col("_tb_heavy").isNull() | wins)
    same = (F.col("digest") == F.col("_tb_digest")) & (F.col("raw") == F.col("_tb_raw")) & F.col("doc_id").eqNullSafe(F.col("_tb_id"))
    marked = lambda rows, marks, how: rows.join(marks.toDF("_tb_id", "_tb_digest", "_tb_raw").hint("merge"), same, how)  # noqa: E731  the same plan at every size
    row = marked(row, lost, "left_anti")
    if not twins.isEmpty():
        order = F.struct(*[F.col(f"_tb_row.`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, T.MapType | T.VariantType)])
        one = marked(row, twins, "left_semi").groupBy("doc_id", "digest", "raw").agg(F.min_by("_tb_row", order).alias("_tb_row"))
        row = marked(row, twins, "left_anti").select("_tb_row").unionByName(one.select("_tb_row"))
    return stay.unionByName(row.select(*[F.col(f"_tb_row.`{c}`") for c in docs.columns]))
