"""Matched filtering of series of any length, in pieces.

A series is rows of pieces of `hop` samples (series_id, ifo, piece, arr). The filter of a template is cut to `reach` samples on either side in time (inverse spectrum truncation,
Allen et al. 2012), so an output sample needs its own neighbourhood only: each piece gets the ends of its two neighbours by one shuffle, is filtered by itself, and gives what the
whole series would give (overlap-save). A task holds some arrays of hop + 2 * (reach + window) samples, rounded up to a power of two, however long the series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybeam.operators import signal
from tallybeam.operators.signal import TASKS_PER_CORE, TRIGGERS, WAVE_BYTES, Template, Waves
from tallybeam.scratch import materialise

#: Neighbouring pieces that share one copy of their series' spectrum in the join, so a series of many pieces isn't one key.
SHARED = 64


def cut(series: DataFrame, hop: int) -> DataFrame:
    """Pieces of series whose samples are one array (series_id, ifo, arr); the last one may be shorter."""
    starts = F.sequence(F.lit(0), F.floor((F.size("arr") - 1) / hop).cast("int"))
    parts = F.transform(starts, lambda k: F.slice("arr", k * hop + 1, F.lit(hop)))
    return series.filter(F.size("arr") > 0).select("series_id", "ifo", F.posexplode(parts).alias("piece", "arr")).withColumn("piece", F.col("piece").cast("long"))


def gathered(samples: DataFrame, hop: int) -> DataFrame:
    """Pieces of samples as rows (series_id, ifo, i, v), i from 0: values of one sample add up, samples without a row are 0, pieces without any row are left out."""
    summed = samples.groupBy("series_id", "ifo", "i").agg(F.sum("v").alias("v")).withColumn("piece", F.floor(F.col("i") / hop).cast("long"))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros(hop)
        x[(rows["i"] % hop).to_numpy()] = rows["v"].fillna(0.0).to_numpy()
        first = rows.iloc[0]
        return pd.DataFrame({"series_id": [first["series_id"]], "ifo": [first["ifo"]], "piece": [first["piece"]], "arr": [x.tolist()]})

    return summed.groupBy("series_id", "ifo", "piece").applyInPandas(fill, "series_id long, ifo string, piece long, arr array<double>")


def spectra(pieces: DataFrame, rate: float, segment: int) -> DataFrame:
    """series_id, psd: the mean over a series' pieces of their median spectra of `segment` samples; pieces that are gaps or shorter than a segment don't count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for series_id, arr in zip(batch.column(0), batch.column(1), strict=True):
                x = signal.sanitise(np.asarray(arr.values.to_numpy(zero_copy_only=False), float)) if arr.is_valid else np.zeros(0)
                if len(x) >= segment and not signal.is_gap(x):
                    ids.append(series_id.as_py())
                    found.append(signal.welch(x, rate, segment)[0])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.float64()))], ["series_id", "psd"])

    each = pieces.select("series_id", "arr").mapInArrow(run, "series_id long, psd array<double>").select("series_id", F.posexplode("psd").alias("k", "p"))
    means = each.groupBy("series_id", "k").agg(F.avg("p").alias("p"))
    return means.groupBy("series_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "p"))), lambda x: x["p"]).alias("psd"))  # segment / 2 + 1 values


def with_neighbours(pieces: DataFrame, hop: int, pad: int, tasks: int) -> DataFrame:
    """pieces with `before` and `after`: `pad` samples of the two neighbours, null where there is none. Other columns stay."""
    others = [c for c in pieces.columns if c not in ("series_id", "ifo", "piece", "arr")]
    piece = F.col("piece")
    role = lambda at, number, part: F.struct(at.alias("piece"), F.lit(number).alias("role"), part.alias("part"))
    parts = F.array(role(piece, 0, F.col("arr")), role(piece + 1, 1, F.slice("arr", hop - pad + 1, pad)), role(piece - 1, 2, F.slice("arr", 1, pad)))
    dealt = pieces.select("series_id", "ifo", F.explode(parts).alias("x"), *others).select("series_id", "ifo", "x.*", *others)
    of = lambda number, column: F.first(F.when(F.col("role") == number, F.col(column)), ignorenulls=True)
    dealt = dealt.select("series_id", "ifo", "piece", "role", "part", *(F.when(F.col("role") == 0, F.col(c)).alias(c) for c in others)).repartition(tasks, "series_id", "piece")
    met = dealt.groupBy("series_id", "ifo", "piece").agg(of(0, "part").alias("arr"), of(1, "part").alias("before"), of(2, "part").alias("after"), *(of(0, c).alias(c) for c in others))
    return met.filter("arr is not null")


def kernel(h: np.ndarray, psd: np.ndarray, n: int, rate: float, f_lower: float, reach: int) -> np.ndarray | None:
    """The filter of a template in time, as n lags (negative ones at the end), zero beyond `reach`; None for a template without power in the band. Data convolved with it are signal-to-noise."""
    f, df = np.fft.rfftfreq(n, 1 / rate), rate / n
    band = (f >= f_lower) & (f > 0)
    if (sigma := signal.norm(h, psd, df, band)) == 0:
        return None
    full = np.zeros(n, complex)
    full[: len(f)][band] = (np.conj(h) / psd)[band]
    lags = np.fft.ifft(full) * (4 / sigma)
    lags[reach + 1 : n - reach] = 0
    return lags


def triggers(pieces: DataFrame, bank: list[Template], rate: float, threshold: float, chisq_from: float, hop: int, reach: int, window_s: float = 0.1, crop_s: float = 0.05, bins: int = 16, segment: int = 32, loudest: float = 1e6) -> DataFrame:
    """Triggers of every series against every template of the bank, as signal.triggers() has them, i being the sample of the whole series.

    All pieces but a series' last have hop samples, and reach and window together are at most hop. Spectra are a series' own. Peaks are the largest within the window across the seams too;
    chi-square is of the piece with its neighbours' ends. Missing neighbours count as zeros, pieces that are gaps or go beyond `loudest` give nothing.
    """
    window = max(1, int(window_s * rate))
    pad, segment, dof = reach + window, min(segment, hop), 2 * bins - 2
    if pad > hop:
        raise ValueError("reach and window together must not be longer than a piece")
    n = 1 << (hop + 2 * pad - 1).bit_length()
    spark = pieces.sparkSession
    held = materialise(pieces.select("series_id", "ifo", F.col("piece").cast("long").alias("piece"), F.col("arr").cast("array<double>").alias("arr")), "pieces")
    lengths = held.groupBy("series_id").agg(F.max(F.col("piece") * hop + F.size("arr")).alias("length"))
    known = lengths.join(spectra(held, rate, segment), "series_id")
    group = lambda p: F.floor(p / SHARED)
    known = known.withColumn("_group", F.explode(F.sequence(F.lit(0).cast("long"), group((F.col("length") - 1) / hop))))
    ready = held.withColumn("_group", group(F.col("piece"))).join(known, ["series_id", "_group"]).drop("_group")
    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = with_neighbours(ready, hop, pad, tasks).select("series_id", "ifo", "piece", "arr", "before", "after", "length", "psd")
    values = lambda arr: signal.sanitise(np.asarray(arr.values.to_numpy(zero_copy_only=False), float)) if arr.is_valid else np.zeros(0)

    def of_piece(waves: Waves, start: int, own: np.ndarray, before: np.ndarray, after: np.ndarray, length: int, psd: np.ndarray) -> list[tuple]:
        x = np.zeros(n)
        x[: len(before)], x[pad : pad + len(own)], x[pad + hop : pad + hop + len(after)] = before, own, after
        fitted = signal.fit_spectrum(psd, rate / segment, n, rate)
        transformed, found = np.fft.fft(x), []
        crop = min(int(crop_s * rate), length // 8)
        first, last = max(crop, start - window), min(length - crop, start + hop + window)
        for t in bank:
            h = waves.get(t, n, rate)
            if first >= last or (lags := kernel(h, fitted, n, rate, t.f_lower, reach)) is None:
                continue
            snr = np.abs(np.fft.ifft(transformed * np.fft.fft(lags)))[first - start + pad : last - start + pad]
            if not np.isfinite(snr).all() or snr.max() > loudest:
                continue
            at = signal.peaks(snr, threshold, window)
            at = at[(at + first >= start) & (at + first < start + hop)]
            chisq = np.full(len(at), float(dof))
            if (loud := snr[at] >= chisq_from).any():
                chisq[loud] = np.maximum(0.0, signal.power_chisq(x, h, fitted, rate, t.f_lower, at[loud] + first - start + pad, bins))
            r = chisq / dof
            ranked = snr[at] / ((1 + np.minimum(r, 1000.0) ** 3) / 2) ** (1 / 6)
            found += [(t.template_id, int(i + first), float(s), float(c), float(q), float(k)) for i, s, c, q, k in zip(at, snr[at], chisq, r, ranked, strict=True)]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waves = Waves(WAVE_BYTES)
        for batch in batches:
            for row in range(batch.num_rows):
                series_id, ifo, piece, own, before, after, length, psd = (batch.column(i)[row] for i in range(8))
                x = values(own)
                if signal.is_gap(x):
                    continue
                found = of_piece(waves, piece.as_py() * hop, x, values(before), values(after), length.as_py(), values(psd))
                if found:
                    kinds = (pa.int32(), pa.int64(), *[pa.float64()] * 4)
                    fixed = [pa.array([series_id.as_py()] * len(found), pa.int64()), pa.array([ifo.as_py()] * len(found), pa.string())]
                    columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*fixed, *columns], [c.split(" ")[0] for c in TRIGGERS.split(", ")])

    return rows.mapInArrow(run, TRIGGERS.replace("i int", "i long"))
