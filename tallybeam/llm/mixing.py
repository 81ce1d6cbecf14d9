"""Mixing sources to target weights by capped water-filling.

Sources share all words by weight, but no target may exceed EPOCHS times its source: sources above are clamped there,
and the excess is shared out among the others by weight until none is above. Clamping in order of cap over
weight reaches that fixed point in one pass, as a source is clamped if and only if it would be after all
with a smaller ratio are. Sources are numbered and their caps summed by running(), so no task holds all sources.

Sampling: a source of target/size = whole + fraction epochs takes each document `whole` times, and once more those that come
first in a seeded order until the fraction's words are reached (to half a document). The order is a hash of doc_id and text, so
repeated and null doc_ids spread out too. Its cut-off is found by a histogram of the hash's leading bits and then inside the one
crossing bin, so nothing is sorted as a whole and documents are decided map-side by one cut-off per source. Rows that are equal
in doc_id and text share a place; where the cut falls among them, the same steps over a hash of row numbers choose how many are taken.

Defined results: null texts and texts of white space have size 0 and are taken 0 words. Null is a source of its own, last in order.
A table of no words has targets 0. Reruns agree: only which of rows equal in doc_id and text are taken once more is free.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybeam.llm.common import map_batches, materialise, running, texts

WEIGHTS, EPOCHS, SEED = (5, 2, 1), 3, "mix-1"
#: Hexadecimal digits of the seeded hash, and those of its leading bin.
DIGITS, BIN_DIGITS = 13, 3


def place(seed: str, doc_id: str = "doc_id", text: str = "text") -> Column:
    """The document's place in the seeded order, 0 to 16^DIGITS - 1, from its doc_id and text."""
    known = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(known), 1, DIGITS), 16, 10).cast("long")


def with_sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size (words at ASCII white space), place, row (a number of the row that is fixed once this has been written)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = pa.array([len(x.split()) for x in texts(batch.column(2))], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, batch.column(3)], ["doc_id", "source", "size", "place"])

    rows = docs.select(F.col("doc_id").cast("long"), "source", "text", place(seed).alias("place"))
    return map_batches(rows, work, "doc_id long, source string, size long, place long", "text").withColumn("row", F.monotonically_increasing_id())


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, target, whole, fraction_size (words wanted beyond the whole epochs): one row per source."""
    sources = sizes.groupBy("source").agg(F.sum("size").cast("decimal(38,0)").alias("source_size")).withColumn("one", F.lit(1))
    ranked = running(sources, [F.col("source").asc_nulls_last()], {"i": "one"}).drop("one")
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("i") % len(weights) + 1).cast("int")).cast("decimal(38,0)"))
    ranked = ranked.withColumn("cap", (F.col("source_size") * epochs).cast("decimal(38,0)"))
    ratio = F.col("cap").cast("double") / F.col("weight").cast("double")
    filled = materialise(running(ranked, [ratio, F.col("source").asc_nulls_last()], {"cap_before": "cap", "weight_before": "weight"}), "mix-sources")
    number = lambda x: F.lit(int(x or 0)).cast("decimal(38,0)")
    words, total_weight = map(number, filled.agg(F.sum("source_size"), F.sum("weight")).first())
    left, weight_left = (words - F.col("cap_before")).cast("double"), (total_weight - F.col("weight_before")).cast("double")
    filled = filled.withColumn("clamped", left * F.col("weight").cast("double") >= F.col("cap").cast("double") * weight_left)
    caps, free_weight = map(number, filled.agg(F.sum(F.when(F.col("clamped"), F.col("cap"))), F.sum(F.when(~F.col("clamped"), F.col("weight")))).first())
    level = F.try_divide(words.cast("double") - caps.cast("double"), free_weight.cast("double"))
    target = F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(F.least(F.col("weight").cast("double") * level, F.col("cap").cast("double")))
    size = F.col("source_size").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("long")
    out = filled.withColumn("target", target).withColumn("whole", whole)
    return out.select("source", size.alias("source_size"), "target", "whole", (F.col("target") - (F.col("whole") * size).cast("double")).alias("fraction_size"))


def cuts(rows: DataFrame, wanted: DataFrame, at: str = "place") -> DataFrame:
    """c_source, cut, cut_words, next, next_words, next_rows: per source, the last place up to which all rows are wanted (to half a row's words), the words up to it, and the first place beyond.

    rows has source, size (above 0) and `at` (0 to 16^DIGITS - 1); wanted has c_source and c_words. A source whose words all fit has no row.
    """
    bin_ = F.floor(F.col(at) / 16 ** (DIGITS - BIN_DIGITS)).cast("int")
    bins = rows.groupBy("source", bin_.alias("bin")).agg(F.sum("size").alias("n"))
    bins = bins.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
    crossing = bins.join(wanted, F.col("source").eqNullSafe(F.col("c_source"))).filter("upto >= c_words and upto - n < c_words")
    crossing = materialise(crossing.select("c_source", "c_words", F.col("bin").alias("c_bin"), (F.col("upto") - F.col("n")).alias("below")), "mix-crossing")  # a row per source at most
    inside = rows.withColumn("bin", bin_).join(crossing, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("bin") == F.col("c_bin")))
    places = inside.groupBy("c_source", F.col(at).alias("at")).agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows"), F.first("below").alias("below"), F.first("c_words").alias("c_words"), F.first("c_bin").alias("c_bin"))
    places = places.withColumn("upto", F.col("below") + F.sum("n").over(Window.partitionBy("c_source").orderBy("at")))
    fits = F.col("upto") - F.col("n") / F.col("rows") / F.lit(2.0) <= F.col("c_words")
    first = F.min(F.when(~fits, F.struct("at", "n", "rows"))).alias("first")
    # All places of earlier bins lie below the cut even where no place of the crossing bin fits.
    cut = F.coalesce(F.max(F.when(fits, F.col("at"))), F.first("c_bin") * F.lit(16 ** (DIGITS - BIN_DIGITS)) - 1)
    words = F.coalesce(F.max(F.when(fits, F.col("upto"))), F.first("below"))
    found = places.groupBy("c_source").agg(cut.cast("long").alias("cut"), words.cast("long").alias("cut_words"), first)
    return found.select("c_source", "cut", "cut_words", F.col("first.at").alias("next"), F.col("first.n").alias("next_words"), F.col("first.rows").alias("next_rows"))


def plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """p_source, source_size, target, whole, cut_off, tie, tie_rows: rows up to place cut_off are taken once more, and tie_rows of the rows at place `tie` (null: none)."""
    wanted = materialise(targets(sizes, weights, epochs), "mix-targets")
    found = cuts(sizes.filter("size > 0"), wanted.filter("fraction_size > 0").select(F.col("source").alias("c_source"), F.col("fraction_size").alias("c_words")))
    out = wanted.join(found, F.col("source").eqNullSafe(F.col("c_source")), "left")
    rest = (F.col("fraction_size") - F.col("cut_words")) / (F.col("next_words") / F.col("next_rows"))
    tied = (F.col("next_rows") > 1) & (rest >= 0.5)
    return materialise(out.select(F.col("source").alias("p_source"), "source_size", "target", "whole", F.col("cut").alias("cut_off"), F.when(tied, F.col("next")).alias("tie"), F.when(tied, rest).alias("tie_rows")), "mix-plan")


def tie_cuts(rows: DataFrame, p: DataFrame) -> DataFrame:
    """b_source, tie_cut: the last place of a row number up to which rows at their source's tie are taken once more. rows has source and row of those rows."""
    ties = rows.select("source", F.lit(1).cast("long").alias("size"), row_place().alias("place"))
    found = cuts(ties, p.filter("tie is not null").select(F.col("p_source").alias("c_source"), F.col("tie_rows").alias("c_words")))
    return materialise(found.select(F.col("c_source").alias("b_source"), F.col("cut").alias("tie_cut")), "mix-ties")


def row_place() -> Column:
    return F.shiftrightunsigned(F.xxhash64("row"), 64 - 4 * DIGITS)


def at_tie() -> Column:
    return (F.col("size") > 0) & F.coalesce(F.col("place") == F.col("tie"), F.lit(False))


def times(with_ties: bool) -> Column:
    more = F.coalesce(F.col("place") <= F.col("cut_off"), F.lit(False))
    if with_ties:
        more |= at_tie() & F.coalesce(row_place() <= F.col("tie_cut"), F.lit(False))
    return F.col("whole") + more.cast("long")


def has_ties(p: DataFrame) -> bool:
    return not p.filter("tie is not null").isEmpty()


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per document."""
    sizes = materialise(with_sizes(docs, seed), "mix-sizes")
    p = plan(sizes, weights, epochs)
    rows = sizes.join(p, F.col("source").eqNullSafe(F.col("p_source")))
    if with_ties := has_ties(p):
        rows = rows.join(tie_cuts(rows.filter(at_tie()), p), F.col("source").eqNullSafe(F.col("b_source")), "left")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * times(with_ties)).alias("taken"))


def repeat_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """docs as mixed: each row as often as it is taken, all columns kept. Documents of size 0 go.

    Only doc_id, source and sizes pass a shuffle; texts are repeated map-side. Rows at a tie, if there are any, are written with row numbers first.
    """
    p = plan(materialise(with_sizes(docs, seed), "mix-sizes"), weights, epochs)
    whole_row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_tb_doc")
    rows = docs.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(whole_row, F.col("source").cast("string").alias("source"), place(seed).alias("place"), F.lit(1).cast("long").alias("size"))
    rows = rows.join(p, F.col("source").eqNullSafe(F.col("p_source")))
    parts = [rows.withColumn("_tb_times", times(False))]
    if has_ties(p):
        tied = materialise(rows.filter(at_tie()).withColumn("row", F.monotonically_increasing_id()), "mix-tied-rows")
        tied = tied.join(tie_cuts(tied, p), F.col("source").eqNullSafe(F.col("b_source")), "left")
        parts = [rows.filter(~at_tie()).withColumn("_tb_times", times(False)), tied.withColumn("_tb_times", times(True))]
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_tb_times")))
    return reduce(DataFrame.unionByName, [r.filter("_tb_times > 0").withColumn("_tb_copy", copies).select(*[F.col(f"_tb_doc.`{c}`") for c in docs.columns]) for r in parts])
