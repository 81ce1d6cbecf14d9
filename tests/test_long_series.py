"""Filtering in pieces against one filter over the whole series, and the sliding maximum against a plain one."""

import numpy as np
import pytest

from tallybeam.operators import long_series, signal
from tallybeam.plans import registry
from tallybeam.plans import views as V

RATE, HOP, REACH, WINDOW, SEGMENT = 64.0, 1024, 300, 6, 64


def plain_peaks(a, threshold, window):
    out = []
    for i in np.flatnonzero(a >= threshold):
        lo = max(0, i - window)
        near = a[lo : i + window + 1]
        if near.max() == a[i] and lo + int(near.argmax()) == i:
            out.append(int(i))
    return out


@pytest.mark.parametrize("window", [1, 2, 7, 64, 5000])
def test_peaks_are_those_of_a_plain_search(window):
    rng = np.random.default_rng(window)
    for n in (0, 1, 2, 63, 64, 65, 1000):
        for a in (rng.normal(size=n), rng.integers(0, 4, n).astype(float), np.ones(n), np.arange(float(n))):
            for threshold in (-10.0, 0.5, 3.0):
                assert signal.peaks(a, threshold, window).tolist() == plain_peaks(a, threshold, window)


def whole(x, psd, t, threshold, chisq_from):
    """i, snr, chisq by one convolution of the whole series; chi-square of the zero-padded stretch around the sample's piece."""
    pad = REACH + WINDOW
    n = 1 << (HOP + 2 * pad - 1).bit_length()
    fitted = signal.fit_spectrum(psd, RATE / SEGMENT, n, RATE)
    h = signal.taylor_f2(t.mass1, t.mass2, n, RATE, t.f_lower)
    lags = long_series.kernel(h, fitted, n, RATE, t.f_lower, REACH)
    z = np.convolve(x, np.concatenate([lags[-REACH:], lags[: REACH + 1]]))[REACH : REACH + len(x)]
    crop = min(3, len(x) // 8)
    snr = np.abs(z)[crop : len(x) - crop]
    around = np.concatenate([np.zeros(pad), x, np.zeros(2 * n)])
    out = []
    for i in plain_peaks(snr, threshold, WINDOW):
        start, chisq = (i + crop) // HOP * HOP, 30.0
        if snr[i] >= chisq_from:
            stretch = np.zeros(n)
            stretch[: HOP + 2 * pad] = around[start : start + HOP + 2 * pad]
            chisq = signal.power_chisq(stretch, h, fitted, RATE, t.f_lower, np.array([i + crop - start + pad]))[0]
        out.append((i + crop, snr[i], chisq))
    return out


def test_pieces_give_the_triggers_of_the_whole_series(spark):
    rng = np.random.default_rng(11)
    bank = signal.demo_bank()
    series = {1: rng.normal(size=7 * HOP), 2: rng.normal(size=3 * HOP + 17), 3: rng.normal(size=200), 4: np.zeros(2 * HOP)}
    wave = np.fft.irfft(signal.taylor_f2(bank[1].mass1, bank[1].mass2, 1024, RATE, 2.0), 1024)
    wave = np.roll(wave, 512) * 6 / wave.std()
    for seam in (HOP, 3 * HOP - 2, 5 * HOP + 500):  # signals across seams and inside a piece
        series[1][seam - 512 : seam + 512] += wave
    frame = spark.createDataFrame([(k, "H1", x.tolist()) for k, x in series.items()] + [(5, "L1", None), (6, "L1", [])], "series_id long, ifo string, arr array<double>")
    pieces = long_series.cut(frame, HOP)
    assert pieces.filter("series_id = 2").selectExpr("max(piece)", "min(size(arr))").first()[:] == (3, 17)
    spectra = {r.series_id: np.array(r.psd) for r in long_series.spectra(pieces, RATE, SEGMENT).collect()}
    assert set(spectra) == {1, 2, 3}
    means = np.mean([signal.welch(series[2][k * HOP : (k + 1) * HOP], RATE, SEGMENT)[0] for k in range(3)], axis=0)
    assert spectra[2] == pytest.approx(means)
    got = {}
    for r in long_series.triggers(pieces, bank, RATE, 2.5, 4.0, HOP, REACH, segment=SEGMENT).collect():
        got.setdefault((r.series_id, r.template_id), []).append((r.i, r.snr, r.chisq))
    for k in spectra:
        for t in bank:
            want = whole(series[k], spectra[k], t, 2.5, 4.0)
            found = sorted(got.pop((k, t.template_id), []))
            assert [f[0] for f in found] == [w[0] for w in want]
            for f, w in zip(found, want, strict=True):
                assert f[1:] == pytest.approx(w[1:], rel=1e-7)
    assert not got
    loud = max(whole(series[1], spectra[1], bank[1], 2.5, 1e9), key=lambda w: w[1])
    assert loud[1] > 8 and min(abs(loud[0] - s) for s in (HOP, 3 * HOP - 2, 5 * HOP + 500)) <= 4


def test_pieces_of_samples_and_missing_pieces(spark):
    rng = np.random.default_rng(12)
    rows = [(1, "H1", i, float(v)) for i, v in enumerate(rng.normal(size=4 * HOP)) if not HOP <= i < 2 * HOP]
    pieces = long_series.gathered(spark.createDataFrame(rows + [(1, "H1", 0, 2.0)], "series_id long, ifo string, i long, v double"), HOP)
    held = {r.piece: r.arr for r in pieces.collect()}
    assert sorted(held) == [0, 2, 3] and held[0][0] == pytest.approx(rows[0][3] + 2.0) and held[2][5] == rows[HOP + 5][3]
    found = long_series.triggers(pieces, signal.demo_bank()[:1], RATE, 1.0, 9.0, HOP, REACH, segment=SEGMENT)
    places = [r.i for r in found.collect()]
    assert places and not any(HOP <= i < 2 * HOP for i in places)
    with pytest.raises(ValueError):
        long_series.triggers(pieces, [], RATE, 1.0, 9.0, 100, 100)


def test_query_of_long_series_by_one_convolution(spark, sf):
    name = "v17_g17_filter_in_pieces"
    assert name in registry.queries()
    samples = registry.samples(V.triggers(spark, sf)).groupBy("series_id", "i").sum("v").collect()
    rows = registry.queries()[name](spark, sf).collect()
    assert rows
    pieces = long_series.gathered(registry.samples(V.triggers(spark, sf)), registry.HOP)
    spectra = {r.series_id: np.array(r.psd) for r in long_series.spectra(pieces, RATE, 32).collect()}
    pad = registry.REACH + WINDOW
    n = 1 << (registry.HOP + 2 * pad - 1).bit_length()
    for series_id, psd in spectra.items():
        length = (max(s.i for s in samples if s.series_id == series_id) // registry.HOP + 1) * registry.HOP
        x = np.zeros(length)
        for s in samples:
            if s.series_id == series_id:
                x[s.i] = s[2]
        fitted = signal.fit_spectrum(psd, RATE / 32, n, RATE)
        for t in signal.demo_bank():
            lags = long_series.kernel(signal.taylor_f2(t.mass1, t.mass2, n, RATE, t.f_lower), fitted, n, RATE, t.f_lower, registry.REACH)
            snr = np.abs(np.convolve(x, np.concatenate([lags[-registry.REACH :], lags[: registry.REACH + 1]]))[registry.REACH : registry.REACH + length])[3 : length - 3]
            want = [i + 3 for i in plain_peaks(snr, 2.0, WINDOW) if not signal.is_gap(x[(i + 3) // registry.HOP * registry.HOP :][: registry.HOP])]
            got = sorted((r.i, r.snr) for r in rows if (r.series_id, r.template_id) == (series_id, t.template_id))
            assert [g[0] for g in got] == want
            assert [g[1] for g in got] == pytest.approx([snr[i - 3] for i in want], rel=1e-7)
