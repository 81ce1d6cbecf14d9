"""Signal kernels in numpy, run over batches of series: each row is one series, or one series with one chunk of a template bank, so rows are independent.

Definitions are the published ones: Welch (1967) spectra with the median bias of Allen et al. (2012), stationary-phase TaylorF2 waveforms to
3.5 post-Newtonian order (Buonanno et al. 2009) with the leading terms of aligned spins, matched filtering by the PSD-weighted inner product, and the power chi-square of Allen (2005).

Memory of a task, for series of n samples: some arrays of n complex numbers, and WAVE_BYTES of waveforms, whatever the bank, the peaks and the number of series.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Solar mass in seconds.
MSUN_S = 4.925491025543576e-06
LEAST_PSD = 1e-40
#: Series quieter than this after the high-pass hold no data.
LEAST_HIGHPASSED = 1e-22
#: Templates that a task filters with at a time, tasks for each core where there are several chunks of them, and bytes of waveforms that a task holds.
PER_TASK, TASKS_PER_CORE, WAVE_BYTES = 16, 4, 256 << 20


def sanitise(x: np.ndarray) -> np.ndarray:
    return np.where(np.isfinite(x), x, 0.0)


def resample(x: np.ndarray, rate: float, target: float) -> np.ndarray:
    """Band-limited: the spectrum is cut or padded with zeros."""
    n = int(round(len(x) * target / rate))
    if n == len(x) or not n:
        return x
    spectrum = np.fft.rfft(x)
    out = np.zeros(n // 2 + 1, complex)
    m = min(len(spectrum), len(out))
    out[:m] = spectrum[:m]
    return np.fft.irfft(out, n) * n / len(x)


def highpass(x: np.ndarray, rate: float, frequency: float, edge: float = 0.25) -> np.ndarray:
    """Zero below (1 - edge) * frequency, a cosine edge up to it; the frequency is at most 0.9 of Nyquist."""
    f, cut = np.fft.rfftfreq(len(x), 1 / rate), min(frequency, 0.9 * rate / 2)
    low = cut * (1 - edge)
    gain = np.clip((f - low) / max(cut - low, 1e-12), 0, 1)
    return np.fft.irfft(np.fft.rfft(x) * (0.5 - 0.5 * np.cos(np.pi * gain)), len(x))


def notch(x: np.ndarray, rate: float, lines: list[tuple[float, float]]) -> np.ndarray:
    """Zero-phase second-order notches at (frequency, width)."""
    f, spectrum = np.fft.rfftfreq(len(x), 1 / rate), np.fft.rfft(x)
    for f0, width in lines:
        w = max(width, 1e-3) * f
        d = f0 * f0 - f * f
        spectrum = spectrum * (d * d / np.maximum(d * d + w * w, 1e-300))
    return np.fft.irfft(spectrum, len(x))


def median_bias(n: int) -> float:
    return float(sum((-1) ** (k + 1) / k for k in range(1, (n if n % 2 else n - 1) + 1)))


def welch(x: np.ndarray, rate: float, segment: int, average: str = "median", skip_s: float = 0.0) -> tuple[np.ndarray, float]:
    """One-sided spectrum and its step from Hann segments that overlap by half; the tail that fills no segment is left out."""
    x = x[int(skip_s * rate) :]
    segment = max(4, min(segment, len(x)))
    step = max(1, segment // 2)
    starts = range(0, len(x) - segment + 1, step)
    window = np.hanning(segment)
    power = np.array([np.abs(np.fft.rfft(x[s : s + segment] * window)) ** 2 for s in starts])
    power = 2 * power / (rate * (window**2).sum())
    if average == "median":
        return np.median(power, axis=0) / median_bias(len(power)), rate / segment
    return power.mean(axis=0), rate / segment


def spectrum(x: np.ndarray, rate: float, segment: int, skip_s: float = 0.0) -> tuple[np.ndarray, float]:
    """The first of four segment lengths that gives a finite positive spectrum; else a flat one."""
    for size in (segment, segment // 2, segment // 4, segment // 8):
        if size >= 4 and len(x) >= size:
            psd, step = welch(x, rate, size, skip_s=skip_s)
            if np.isfinite(psd).all() and (psd > 0).any():
                return psd, step
    return np.full(segment // 2 + 1, 1e-46), rate / segment


def fit_spectrum(psd: np.ndarray, step: float, n: int, rate: float) -> np.ndarray:
    """The spectrum at the frequencies of a series of n samples, cleaned and floored at a millionth of its positive median."""
    fitted = np.interp(np.fft.rfftfreq(n, 1 / rate), np.arange(len(psd)) * step, psd)
    fitted = np.maximum(np.nan_to_num(fitted, nan=LEAST_PSD, posinf=LEAST_PSD, neginf=LEAST_PSD), LEAST_PSD)
    return np.maximum(fitted, 1e-6 * np.median(fitted[fitted > 0]))


def whiten(x: np.ndarray, psd: np.ndarray, rate: float, cutoff: float) -> np.ndarray:
    f = np.fft.rfftfreq(len(x), 1 / rate)
    good = np.isfinite(psd) & (psd > 0)
    middle = np.median(psd[good]) if good.any() else 1.0
    safe = np.where(good & (psd >= 0.01 * middle), psd, middle)
    return np.fft.irfft(np.where(f < cutoff, 0, np.fft.rfft(x) / np.sqrt(safe)), len(x))


def is_gap(x: np.ndarray, least_rms: float = 1e-21) -> bool:
    """No usable data: too quiet, too few finite or too many zero samples."""
    ok = np.isfinite(x)
    value = float(np.sqrt(np.mean(sanitise(x) ** 2))) if len(x) else 0.0
    return not len(x) or value < least_rms or ok.mean() < 0.8 or (x == 0).mean() > 0.99


def gated(x: np.ndarray, factor: float, pad: int, longest: int, least_share: float = 0.01) -> tuple[np.ndarray, int, bool]:
    """The series with its gates applied, their number, and whether they were taken back, as arrays.gates() and arrays.gated() define them."""
    loud = np.flatnonzero(np.abs(x) > factor * x.std()) if len(x) else np.zeros(0, int)
    if not len(loud):
        return x, 0, False
    y = x.copy()
    runs = np.split(loud, np.flatnonzero(np.diff(loud) > pad) + 1)
    for run in runs:
        start, end = max(int(run[0]) - pad, 0), min(int(run[-1]) + pad, len(x) - 1)
        end = min(start + longest, end)
        if end > start:
            y[start : end + 1] *= 1.0 - np.arange(end - start + 1) / (end - start)
    if np.sqrt(np.mean(y * y)) < least_share * np.sqrt(np.mean(x * x)):
        return x, 0, True
    return y, len(runs), False


def phase_terms(mass1: float, mass2: float, spin1: float = 0.0, spin2: float = 0.0) -> tuple[list[float], float, float]:
    """Coefficients of v^0 to v^7 in the TaylorF2 phase, and those of ln(v) in v^5 and v^6."""
    total, eta = mass1 + mass2, mass1 * mass2 / (mass1 + mass2) ** 2
    pi, euler = np.pi, 0.5772156649015329
    spin_orbit = sum((113 / 12 * (m / total) ** 2 + 25 / 4 * eta) * s for m, s in ((mass1, spin1), (mass2, spin2)))
    spin_spin = 79 / 8 * eta * spin1 * spin2
    fifth = pi * (38645 / 756 - 65 * eta / 9)
    return [
        1.0, 0.0, 3715 / 756 + 55 * eta / 9, -16 * pi + 4 * spin_orbit, 15293365 / 508032 + 27145 * eta / 504 + 3085 * eta**2 / 72 - 10 * spin_spin, fifth,
        11583231236531 / 4694215680 - 640 * pi**2 / 3 - 6848 * euler / 21 - 6848 / 21 * np.log(4) + eta * (-15737765635 / 3048192 + 2255 * pi**2 / 12) + 76055 * eta**2 / 1728 - 127825 * eta**3 / 1296,
        pi * (77096675 / 254016 + 378515 * eta / 1512 - 74045 * eta**2 / 756),
    ], 3 * fifth, -6848 / 21


def taylor_f2(mass1: float, mass2: float, n: int, rate: float, f_lower: float, spin1: float = 0.0, spin2: float = 0.0) -> np.ndarray:
    """Frequency-domain inspiral, zero below f_lower and above the last stable orbit (or Nyquist)."""
    total, eta = mass1 + mass2, mass1 * mass2 / (mass1 + mass2) ** 2
    f = np.fft.rfftfreq(n, 1 / rate)
    last = min(1 / (6**1.5 * np.pi * total * MSUN_S), rate / 2)
    inside = (f >= f_lower) & (f <= last) & (f > 0)
    v = np.cbrt(np.pi * total * MSUN_S * f[inside])
    terms, log_fifth, log_sixth = phase_terms(mass1, mass2, spin1, spin2)
    phase = 3 / (128 * eta) * v**-5 * (np.polynomial.polynomial.polyval(v, terms) + (log_fifth * v**5 + log_sixth * v**6) * np.log(v))
    out = np.zeros(len(f), complex)
    out[inside] = f[inside] ** (-7 / 6) * np.exp(-1j * (phase + np.pi / 4))
    return out


class Waves:
    """Waveforms by template and length; the ones not used for longest go once they take more than `most` bytes."""

    def __init__(self, most: int):
        self.most, self.size, self.held = most, 0, OrderedDict()

    def get(self, t: Template, n: int, rate: float) -> np.ndarray:
        key = (t, n, rate)
        if key in self.held:
            self.held.move_to_end(key)
            return self.held[key]
        h = taylor_f2(t.mass1, t.mass2, n, rate, t.f_lower, t.spin1, t.spin2)
        self.held[key] = h
        self.size += h.nbytes
        while self.size > self.most and len(self.held) > 1:
            self.size -= self.held.popitem(last=False)[1].nbytes
        return h


def norm(h: np.ndarray, psd: np.ndarray, df: float, band: np.ndarray) -> float:
    return float(np.sqrt(4 * df * (np.abs(h[band]) ** 2 / psd[band]).sum()))


def filtered(x: np.ndarray, h: np.ndarray, psd: np.ndarray, rate: float, f_lower: float, transformed: np.ndarray | None = None) -> np.ndarray:
    """Complex signal-to-noise series: 4 * inverse transform of data * conj(h) / psd over positive frequencies, over the norm."""
    n = len(x)
    f, df = np.fft.rfftfreq(n, 1 / rate), rate / n
    band = (f >= f_lower) & (f > 0)
    if (sigma := norm(h, psd, df, band)) == 0:
        return np.zeros(n, complex)
    full = np.zeros(n, complex)
    transformed = np.fft.rfft(x) if transformed is None else transformed
    full[: len(f)][band] = (transformed / rate * np.conj(h) / psd)[band]
    return 4 * np.fft.ifft(full) * n * df / sigma


def power_chisq(x: np.ndarray, h: np.ndarray, psd: np.ndarray, rate: float, f_lower: float, at: np.ndarray, bins: int = 16, transformed: np.ndarray | None = None) -> np.ndarray:
    """Chi-square of `bins` bands of about equal template power at the given samples; 2 * bins - 2 degrees of freedom.

    Bands end at frequency samples, so each band's own share of the power is used.
    """
    f, df = np.fft.rfftfreq(len(x), 1 / rate), rate / len(x)
    band = (f >= f_lower) & (f > 0)
    power = np.where(band, np.abs(h) ** 2 / psd, 0)
    if power.sum() == 0:
        return np.full(len(at), float(2 * bins - 2))
    share = np.minimum((np.cumsum(power) / power.sum() * bins - 1e-12).astype(int), bins - 1)
    whole = norm(h, psd, df, band)
    transformed = np.fft.rfft(x) if transformed is None else transformed
    integrand = np.where(band, transformed / rate * np.conj(h) / psd, 0)
    own = np.bincount(share, power, bins) / power.sum()
    parts = np.stack([4 * df * band_sums(integrand, np.flatnonzero((share == b) & (power > 0)), len(x), at) / whole for b in range(bins)])
    own = own[:, None]
    return (np.abs(parts - own * parts.sum(axis=0)) ** 2 / np.maximum(own, 1e-12)).sum(axis=0, where=own > 0)


def band_sums(integrand: np.ndarray, inside: np.ndarray, n: int, at: np.ndarray) -> np.ndarray:
    """Sum over the frequencies `inside` of integrand * exp(2 pi i k at / n) for each sample: directly for few samples, a piece of frequencies at a time, else by an inverse transform."""
    if len(at) * len(inside) > 8 * n * np.log2(n):
        full = np.zeros(n, complex)
        full[inside] = integrand[inside]
        return np.fft.ifft(full)[at] * n
    out = np.zeros(len(at), complex)
    step = max(1, (1 << 20) // max(1, len(at)))
    for i in range(0, len(inside), step):
        k = inside[i : i + step]
        out += np.exp(2j * np.pi * (np.outer(at, k) % n) / n) @ integrand[k]
    return out


def sliding_max(a: np.ndarray, width: int) -> np.ndarray:
    """The largest of each `width` neighbouring values: the end of one block of that width and the start of the next, so the work doesn't depend on the width (van Herk 1992)."""
    blocks = np.full((-(-len(a) // width), width), -np.inf)
    blocks.ravel()[: len(a)] = a
    rising = np.maximum.accumulate(blocks, axis=1).ravel()
    falling = np.maximum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(a) - width + 1
    return np.maximum(falling[:n], rising[width - 1 : width - 1 + n])


def peaks(a: np.ndarray, threshold: float, window: int) -> np.ndarray:
    """Samples of `threshold` or more that are the largest within +-window (the earliest of equals); window is 1 or more."""
    none = np.full(window, -np.inf)
    near = sliding_max(np.concatenate([none, a, none]), window)
    return np.flatnonzero((a >= threshold) & (a > near[: len(a)]) & (a >= near[window + 1 : window + 1 + len(a)]))


@dataclass(frozen=True)
class Template:
    template_id: int
    mass1: float
    mass2: float
    f_lower: float
    spin1: float = 0.0
    spin2: float = 0.0


def demo_bank() -> list[Template]:
    """Heavy systems whose inspiral falls into the band of slow sampled series."""
    return [Template(i, m, 0.8 * m, 2.0) for i, m in enumerate((300.0, 400.0, 500.0, 650.0))]


TRIGGERS = "series_id long, ifo string, template_id int, i int, snr double, chisq double, rchisq double, new_snr double"


def template_triggers(x: np.ndarray, spectrum_of_x: np.ndarray, psd: np.ndarray, h: np.ndarray, t: Template, rate: float, threshold: float, chisq_from: float, window_s: float, crop_s: float, bins: int, loudest: float) -> list[tuple]:
    """(i, snr, chisq, rchisq, new_snr) of the peaks of one series under one template; none where the filter's output is broken or beyond `loudest`."""
    dof = 2 * bins - 2
    crop = min(int(crop_s * rate), len(x) // 8)
    snr = np.abs(filtered(x, h, psd, rate, t.f_lower, spectrum_of_x))[crop : len(x) - crop]
    if not len(snr) or not np.isfinite(snr).all() or snr.max() > loudest:
        return []
    at = peaks(snr, threshold, max(1, int(window_s * rate)))
    chisq = np.full(len(at), float(dof))
    loud = snr[at] >= chisq_from
    if loud.any():
        chisq[loud] = np.maximum(0.0, power_chisq(x, h, psd, rate, t.f_lower, at[loud] + crop, bins, spectrum_of_x))
    r = chisq / dof
    ranked = snr[at] / ((1 + np.minimum(r, 1000.0) ** 3) / 2) ** (1 / 6)
    return [(int(i + crop), float(s), float(c), float(q), float(k)) for i, s, c, q, k in zip(at, snr[at], chisq, r, ranked, strict=True)]


def triggers(series: DataFrame, bank: list[Template], rate: float, threshold: float, chisq_from: float, window_s: float = 0.1, crop_s: float = 0.05, bins: int = 16, segment: int = 32, loudest: float = 1e6, per_task: int = PER_TASK) -> DataFrame:
    """Triggers of every series against every template of the bank.

    The bank is a parameter and travels with the function, cut into chunks of per_task templates. A bank of several chunks multiplies the work, not only the rows:
    each series is dealt once for each chunk, and chunks of one series go to different tasks, so one series fills as many cores as it has chunks. Chi-square is
    computed for peaks of chisq_from or more only; others get its expected value. Gaps, non-finite series and series beyond `loudest` give nothing. A column psd
    (as of condition()) is used where there is one; else the spectrum is estimated here.
    """
    chunks = [bank[i : i + per_task] for i in range(0, len(bank), per_task)] or [[]]
    known = "psd" in series.columns
    rows = series.select("series_id", "ifo", "arr", *(["psd"] if known else []))
    spark = series.sparkSession
    if len(chunks) > 1:
        rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(len(chunks) - 1))))
        tasks = max(len(chunks), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
        rows = rows.repartitionById(tasks, F.pmod(F.xxhash64("series_id") + F.col("chunk"), F.lit(tasks)).cast("int"))
    else:
        rows = rows.withColumn("chunk", F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waves = Waves(WAVE_BYTES)
        for batch in batches:
            for row in range(batch.num_rows):
                series_id, ifo, arr, *psd, chunk = (batch.column(i)[row] for i in range(batch.num_columns))
                x = sanitise(np.asarray(arr.values.to_numpy(zero_copy_only=False), float)) if arr.is_valid else np.zeros(0)
                if len(x) < 8 or is_gap(x):
                    continue
                if known and psd[0].is_valid:
                    fitted = np.asarray(psd[0].values.to_numpy(zero_copy_only=False), float)
                else:
                    fitted = fit_spectrum(*spectrum(x, rate, segment), len(x), rate)
                transformed, found = np.fft.rfft(x), []
                for t in chunks[chunk.as_py()]:
                    peaks_of_t = template_triggers(x, transformed, fitted, waves.get(t, len(x), rate), t, rate, threshold, chisq_from, window_s, crop_s, bins, loudest)
                    found += [(t.template_id, *p) for p in peaks_of_t]
                if found:
                    columns = [*zip(*found, strict=True)]
                    fixed = [pa.array([series_id.as_py()] * len(found), pa.int64()), pa.array([ifo.as_py()] * len(found), pa.string())]
                    kinds = (pa.int32(), pa.int32(), *[pa.float64()] * 4)
                    yield pa.RecordBatch.from_arrays([*fixed, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [c.split(" ")[0] for c in TRIGGERS.split(", ")])

    return rows.mapInArrow(run, TRIGGERS)


def condition(series: DataFrame, rate: float, cut: float, segment: int, notches: list[tuple[float, float]] = (), target: float | None = None, skip_s: float = 0.0, gate: tuple[float, float, float] | None = None) -> DataFrame:
    """series_id, ifo, arr, psd, df, is_gap, n_gates, rolled_back: gates (factor, pad and longest in seconds; None for none), gap checks, high-pass, notches, resampling and spectrum, without whitening."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for series_id, ifo, arr in zip(batch["series_id"], batch["ifo"], batch["arr"], strict=True):
                x = np.asarray(arr, float) if arr is not None else np.zeros(0)
                n_gates, back = 0, False
                gap = len(x) < 8 or is_gap(x)
                if not gap:
                    y = sanitise(x)
                    if gate:
                        y, n_gates, back = gated(y, gate[0], int(gate[1] * rate), int(gate[2] * rate))
                    y = highpass(y, rate, cut)
                    gap = np.sqrt(np.mean(y**2)) < LEAST_HIGHPASSED
                if gap:
                    out.append((series_id, ifo, None, None, None, True, n_gates, back))
                    continue
                y = notch(y, rate, list(notches)) if notches else y
                y = resample(y, rate, target) if target else y
                final = target or rate
                psd = fit_spectrum(*spectrum(y, final, segment, skip_s), len(y), final)
                out.append((series_id, ifo, y.tolist(), psd.tolist(), final / len(y), False, n_gates, back))
            yield pd.DataFrame(out, columns=["series_id", "ifo", "arr", "psd", "df", "is_gap", "n_gates", "rolled_back"])

    return series.select("series_id", "ifo", "arr").mapInPandas(run, "series_id long, ifo string, arr array<double>, psd array<double>, df double, is_gap boolean, n_gates int, rolled_back boolean")


def whitened(conditioned: DataFrame, cutoff: float) -> DataFrame:
    """series_id, ifo, arr, power, psd_fits: the series of condition() over their own spectra, the mean power of the middle half, and whether twice that, the mean square of a filter's output, lies within 2 of 2.

    power is near 1 where the spectrum fits the series. Gaps have none of the three.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for series_id, ifo, arr, psd, df in zip(*(batch[c] for c in ("series_id", "ifo", "arr", "psd", "df")), strict=True):
                if arr is None:
                    out.append((series_id, ifo, None, None, None))
                    continue
                x, rate = np.asarray(arr, float), df * len(arr)
                y = whiten(x, np.asarray(psd, float), rate, cutoff) * np.sqrt(2 / rate)
                power = float(np.mean(y[len(y) // 4 : len(y) - len(y) // 4] ** 2))
                out.append((series_id, ifo, y.tolist(), power, abs(2 * power - 2) <= 2))
            yield pd.DataFrame(out, columns=["series_id", "ifo", "arr", "power", "psd_fits"])

    return conditioned.select("series_id", "ifo", "arr", "psd", "df").mapInPandas(run, "series_id long, ifo string, arr array<double>, power double, psd_fits boolean")
