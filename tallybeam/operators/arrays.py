"""Operators on a series held as an array column: higher-order functions, so they stay in the JVM; only products of many arrays with many are matrices in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from tallybeam.functions.scalars import finite


def let(value: Column, use) -> Column:
    """use(value) with the value computed once, not once for each element of a lambda that needs it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sanitise(a: Column) -> Column:
    """Broken samples become 0."""
    return F.transform(a, lambda x: F.when(finite(x), x).otherwise(0.0))


def total(a: Column, f=lambda x: x) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + f(x))


def rms(a: Column) -> Column:
    return F.sqrt(F.try_divide(total(a, lambda x: x * x), F.size(a)))


def fraction(a: Column, test) -> Column:
    return F.try_divide(F.size(F.filter(a, test)), F.size(a))


def std_pop(a: Column) -> Column:
    mean = F.try_divide(total(a), F.size(a))
    return F.sqrt(F.try_divide(let(mean, lambda m: total(a, lambda x: (x - m) * (x - m))), F.size(a)))


def median(a: Column) -> Column:
    n = F.size(a)
    middle = lambda s: (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2
    return F.when(n > 0, let(F.sort_array(a), middle))


def floor_spectrum(a: Column, least: float = 1e-40, share: float = 1e-6) -> Column:
    """Broken bins become `least`; then bins under `share` of the median of the positive ones are raised to it."""
    clean = F.transform(a, lambda x: F.when(finite(x), F.greatest(x, F.lit(least))).otherwise(least))
    lowest = lambda c: share * median(F.filter(c, lambda y: y > 0))
    return let(clean, lambda c: let(lowest(c), lambda low: F.transform(c, lambda x: F.greatest(x, low))))


def inner(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def unit(a: Column, psd: Column | None = None, kmin: int = 0) -> Column:
    """The array from bin kmin on, weighted by 1 / sqrt(psd) and of norm 1; zeros for a zero norm."""
    cut = lambda x: F.slice(x, kmin + 1, F.greatest(F.lit(0), F.size(x) - kmin)) if kmin else x
    a = cut(a) if psd is None else F.zip_with(cut(a), cut(psd), lambda v, p: v / F.sqrt(p))
    over = lambda x: let(F.sqrt(inner(x, x)), lambda n: F.transform(x, lambda v: F.when(n == 0, 0.0).otherwise(v / n)))
    return let(a, over)


def match(a: Column, b: Column, psd: Column | None = None, kmin: int = 0) -> Column:
    """Absolute normalised inner product, weighted by 1 / psd and from bin kmin on: 0 to 1; 0 for a zero norm."""
    return F.least(F.lit(1.0), F.abs(inner(unit(a, psd, kmin), unit(b, psd, kmin))))


#: Rows of a chunk that meet as one matrix, and of the pairs that leave a task at once, about.
CHUNK, BLOCK = 1024, 1 << 18


def _chunked(fields: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (row, arr) as chunks (rows, lengths, values); an array that is null has length -1, a null element is NaN."""
        for batch in batches:
            for s in range(0, batch.num_rows, CHUNK):
                part = batch.slice(s, CHUNK)
                arr = part.column(1)
                lengths = pc.fill_null(pc.list_value_length(arr), -1).to_numpy(zero_copy_only=False).astype(np.int32)
                values = pc.fill_null(arr.flatten().cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
                rows = pa.ListArray.from_arrays([0, part.num_rows], part.column(0)).cast(fields.field(0).type)
                yield pa.RecordBatch.from_arrays([rows, pa.array([lengths.tobytes()]), pa.array([values.tobytes()])], schema=fields)

    return run


def _chunks_of(rows: DataFrame, arr: Column) -> DataFrame:
    kept = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != "arr"]).alias("row"), arr.alias("arr"))
    out = kept.select(F.array("row").alias("rows"), F.lit(b"").alias("lengths"), F.lit(b"").alias("values")).schema
    return kept.mapInArrow(_chunked(to_arrow_schema(out)), out)


def _by_length(lengths: np.ndarray, values: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Which rows have each length, and their matrix."""
    ends = np.cumsum(np.maximum(lengths, 0))
    found = {}
    for n in np.unique(lengths[lengths >= 0]).tolist():
        mine = np.flatnonzero(lengths == n)
        found[n] = mine, values[(ends[mine] - n)[:, None] + np.arange(n)]
    return found


def _met(fields: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                (rows_a, n_a, v_a), (rows_b, n_b, v_b) = ((batch.column(i)[r].values, *(np.frombuffer(batch.column(i + k)[r].as_buffer(), t) for k, t in ((1, np.int32), (2, np.float64)))) for i in (0, 3))
                # As least() has it, what has no number (other lengths, null arrays or elements) is 1.
                found, other = np.ones((len(n_a), len(n_b))), _by_length(n_b, v_b)
                for n, (i, a) in _by_length(n_a, v_a).items():
                    if n in other:
                        j, b = other[n]
                        found[np.ix_(i, j)] = np.fmin(1.0, np.abs(a @ b.T))
                step = max(1, BLOCK // max(1, len(n_b)))
                for s in range(0, len(n_a), step):
                    e = min(s + step, len(n_a))
                    i, j = pa.array(np.repeat(np.arange(s, e), len(n_b))), pa.array(np.tile(np.arange(len(n_b)), e - s))
                    columns = [f.take(at) for rows, at in ((rows_a, i), (rows_b, j)) for f in rows.flatten()]
                    columns.append(pa.array(found[s:e].ravel()))
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

    return run


def matches(series: DataFrame, bank: DataFrame, psd: Column | None = None, kmin: int = 0, blocks: int = 8) -> DataFrame:
    """series columns but arr, bank columns but arr, match: each series row against each row of the bank (names but arr must differ).

    Both are weighted and normalised once and packed into chunks of rows, which meet as matrices. The bank's chunks are dealt to `blocks` keys and repeated for as many shares of the series, the series'
    chunks are repeated to each key, and an equality join on both meets them, so a task holds a chunk of each and the bank is broadcast only if Spark finds it small.
    """
    shares = 4 * series.sparkSession.sparkContext.defaultParallelism
    a = _chunks_of(series.repartition(shares), unit(F.col("arr"), psd, kmin)).withColumn("_share", F.pmod(F.xxhash64("values"), F.lit(shares)))
    a = a.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    b = _chunks_of(bank, unit(F.col("arr"), psd, kmin)).select(F.col("rows").alias("rows_b"), F.col("lengths").alias("lengths_b"), F.col("values").alias("values_b"))
    b = b.withColumn("_block", F.pmod(F.xxhash64("values_b"), F.lit(blocks)).cast("int")).withColumn("_share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))
    met = a.join(b, ["_block", "_share"]).select("rows", "lengths", "values", "rows_b", "lengths_b", "values_b")
    fields = [f for df in (series, bank) for f in df.schema.fields if f.name != "arr"]
    out = StructType([*fields, StructField("match", DoubleType())])
    return met.mapInArrow(_met(to_arrow_schema(out)), out)


def crop(a: Column, rate: float, seconds: float = 4.0) -> Column:
    """The array without min(seconds * rate, an eighth) samples at each end."""
    n = F.size(a)
    c = F.least(F.lit(int(seconds * rate)), F.floor(n / 8).cast("int"))
    return F.slice(a, c + 1, n - 2 * c)


def chunks(a: Column, size: int) -> Column:
    return F.when(F.size(a) == 0, F.array(F.slice(a, 1, 0))).otherwise(F.transform(F.sequence(F.lit(0), F.size(a) - 1, F.lit(size)), lambda i: F.slice(a, i + 1, F.lit(size))))


def gates(series: DataFrame, key: str, a: str, factor: float, pad: int, longest: int) -> DataFrame:
    """key, s, e: runs of samples beyond `factor` population deviations (runs `pad` apart or less join), widened by pad and cut to `longest`.

    Only samples beyond the threshold leave the arrays, and a window numbers the runs of each series.
    """
    beyond = lambda limit: F.filter(F.transform(F.col(a), lambda x, i: F.when(F.abs(x) > limit, i)), lambda i: i.isNotNull())
    loud = series.select(key, F.size(a).alias("n"), F.explode(let(factor * std_pop(F.col(a)), beyond)).alias("i"))
    w = Window.partitionBy(key).orderBy("i")
    step = F.when(F.col("i") - F.lag("i").over(w) <= pad, 0).otherwise(1)
    runs = loud.withColumn("step", step).withColumn("run", F.sum("step").over(w))
    found = runs.groupBy(key, "run", "n").agg(F.min("i").alias("a"), F.max("i").alias("b"))
    s, e = F.greatest(F.col("a") - pad, F.lit(0)), F.least(F.col("b") + pad, F.col("n") - 1)
    return found.select(key, s.cast("int").alias("s"), F.least(s + longest, e).cast("int").alias("e"))


def apply_gates(a: Column, gates: Column) -> Column:
    """Samples in each gate times a ramp from 1 at its start to 0 at its end."""
    ramp = lambda i, g: F.when((i >= g["s"]) & (i <= g["e"]), F.when(g["e"] > g["s"], 1.0 - (i - g["s"]) / (g["e"] - g["s"])).otherwise(1.0)).otherwise(1.0)
    return F.transform(a, lambda x, i: F.aggregate(gates, x, lambda acc, g: acc * ramp(i, g)))


def gated(series: DataFrame, found: DataFrame, key: str, a: str, least_share: float = 0.01) -> DataFrame:
    """series with its gates applied, n_gates and rolled_back: where less than least_share of the RMS is left, the array stays and has no gates."""
    listed = found.groupBy(F.col(key).alias("_key")).agg(F.collect_list(F.struct("s", "e")).alias("_gates"))
    joined = series.join(listed, F.col(key) == F.col("_key"), "left")
    none = F.slice(F.array(F.struct(F.lit(0).alias("s"), F.lit(0).alias("e"))), 1, 0)
    done = joined.withColumn("_gates", F.coalesce("_gates", none)).withColumn("_gated", apply_gates(F.col(a), F.col("_gates")))
    back = F.coalesce(rms(F.col("_gated")) < least_share * rms(F.col(a)), F.lit(False))
    done = done.withColumn("rolled_back", back).withColumn("n_gates", F.when(F.col("rolled_back"), 0).otherwise(F.size("_gates")))
    return done.withColumn(a, F.when(F.col("rolled_back"), F.col(a)).otherwise(F.col("_gated"))).drop("_key", "_gates", "_gated")


def gap_kind(a: Column, least_rms: float = 1e-21, least_finite: float = 0.8, most_zero: float = 0.99) -> Column:
    """Why a series is no data: quiet, broken or zero; null where it is usable. An empty or null series is quiet."""
    level = rms(sanitise(a))
    return (
        F.when(F.coalesce(fraction(a, finite), F.lit(1.0)) < least_finite, "broken")
        .when(fraction(a, lambda x: x == 0) > most_zero, "zero")
        .when(level.isNull() | (level < least_rms), "quiet")
    )


def diagnostics(a: Column) -> dict[str, Column]:
    """Largest, mean, median and population deviation of the absolute values."""
    size = F.transform(a, lambda x: F.abs(x))
    return {"largest": F.array_max(size), "mean": F.try_divide(total(size), F.size(size)), "median": median(size), "deviation": std_pop(size)}


def cluster(peaks: DataFrame, keys: list[str], index: str, value: str, window: int) -> DataFrame:
    """Rows that are the largest within +-window of their index (earliest wins ties); filter by the threshold before."""
    w = Window.partitionBy(*keys).orderBy(index).rangeBetween(-window, window)
    best = F.max(F.struct(F.col(value).alias("v"), (-F.col(index)).alias("i"))).over(w)
    return peaks.withColumn("_best", best).filter((F.col("_best.v") == F.col(value)) & (F.col("_best.i") == -F.col(index))).drop("_best")
