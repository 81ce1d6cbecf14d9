"""Queries and operators without SQL against direct formulas, plain loops and numpy."""

import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybeam.functions import scalars
from tallybeam.operators import arrays, background, bank, candidates, ranking, signal
from tallybeam.operators.intervals import nearest
from tallybeam.plans import registry
from tallybeam.plans import views as V
from tallybeam.search import blocks_to_search
from tallybeam.sources import frames


def series_of(spark, sf):
    return {r.series_id: np.array(r.arr, float) for r in V.series(spark, sf).collect()}


def direct_highpass(x, rate, cut, edge=0.25):
    """By a matrix of the discrete transform."""
    n = len(x)
    k = np.arange(n)
    f = np.minimum(k, n - k) * rate / n
    low = cut * (1 - edge)
    gain = 0.5 - 0.5 * np.cos(np.pi * np.clip((f - low) / (cut - low), 0, 1))
    transform = np.exp(-2j * np.pi * np.outer(k, k) / n)
    return (np.conj(transform) @ (gain * (transform @ x))).real / n


def direct_psd(x, rate, segment):
    """Median of Hann periodograms by direct sums, interpolated and floored."""
    window = [0.5 - 0.5 * math.cos(2 * math.pi * i / (segment - 1)) for i in range(segment)]
    rows = []
    for s in range(0, len(x) - segment + 1, segment // 2):
        part = [v * w for v, w in zip(x[s : s + segment], window, strict=True)]
        rows.append([2 * abs(sum(v * np.exp(-2j * np.pi * k * i / segment) for i, v in enumerate(part))) ** 2 / (rate * sum(w * w for w in window)) for k in range(segment // 2 + 1)])
    n = len(rows)
    bias = sum((-1) ** (k + 1) / k for k in range(1, (n if n % 2 else n - 1) + 1))
    psd = np.median(np.array(rows), axis=0) / bias
    fitted = np.interp(np.arange(len(x) // 2 + 1) * rate / len(x), np.arange(segment // 2 + 1) * rate / segment, psd)
    return np.maximum(fitted, 1e-6 * np.median(fitted))


def test_conditioned_and_whitened_series(spark, sf):
    known = series_of(spark, sf)
    rows = registry.queries()["v05_v07_conditioned_series"](spark, sf).collect()
    white = {r.series_id: r for r in registry.queries()["v13_v12_whitened_series"](spark, sf).collect()}
    assert len(rows) == len(white) == len(known)
    for r in rows[:12]:
        y = direct_highpass(known[r.series_id], 64.0, 2.0)
        assert r.arr == pytest.approx(y, abs=1e-9)
        psd = direct_psd(y, 64.0, 32)
        assert r.psd == pytest.approx(psd, rel=1e-6)
        n = len(y)
        f, transform = np.arange(n // 2 + 1) * 64.0 / n, np.exp(-2j * np.pi * np.outer(np.arange(n // 2 + 1), np.arange(n)) / n)
        safe = np.where(psd >= 0.01 * np.median(psd), psd, np.median(psd))
        half = np.where(f < 2.0, 0, (transform @ y) / np.sqrt(safe))
        full = np.concatenate([half, np.conj(half[1:-1][::-1])])
        want = (np.exp(2j * np.pi * np.outer(np.arange(n), np.arange(n)) / n) @ full).real / n * np.sqrt(2 / 64.0)
        assert white[r.series_id].arr == pytest.approx(want, abs=1e-6)
        power = np.mean(want[n // 4 : n - n // 4] ** 2)
        assert white[r.series_id].power == pytest.approx(power, rel=1e-6) and white[r.series_id].psd_fits == (abs(2 * power - 2) <= 2)


def test_gated_and_conditioned_series(spark, sf):
    s = V.series(spark, sf)
    gated = {r.series_id: r for r in arrays.gated(s, arrays.gates(s, "series_id", "arr", 1.5, 3, 12), "series_id", "arr").collect()}
    rows = registry.queries()["v15_gated_and_conditioned_series"](spark, sf).collect()
    assert len(rows) == len(gated) and sum(r.n_gates for r in rows) > 0
    for r in rows[:40]:
        g = gated[r.series_id]
        assert (r.n_gates, r.rolled_back) == (g.n_gates, g.rolled_back)
        assert r.arr == pytest.approx(direct_highpass(np.array(g.arr), 64.0, 2.0), abs=1e-9)


def direct_triggers(x, t, rate, threshold, chisq_from, window, crop, bins=16):
    """Signal-to-noise and chi-square at every sample by sums over frequencies."""
    n = len(x)
    psd = direct_psd(x, rate, 32)
    h = signal.taylor_f2(t.mass1, t.mass2, n, rate, t.f_lower)
    f, df = np.arange(n // 2 + 1) * rate / n, rate / n
    band = (f >= t.f_lower) & (f > 0)
    data = np.array([sum(v * np.exp(-2j * np.pi * k * i / n) for i, v in enumerate(x)) for k in range(n // 2 + 1)]) / rate
    power = np.where(band, np.abs(h) ** 2 / psd, 0)
    if power.sum() == 0:
        return []
    sigma = math.sqrt(4 * df * power.sum())
    terms = np.where(band, data * np.conj(h) / psd, 0)
    z = lambda ks, i: 4 * df * sum(terms[k] * np.exp(2j * np.pi * k * i / n) for k in ks) / sigma
    snr = [abs(z(range(n // 2 + 1), i)) for i in range(n)][crop : n - crop]
    bin_of = np.minimum((np.cumsum(power) / power.sum() * bins - 1e-12).astype(int), bins - 1)
    out = []
    for i, v in enumerate(snr):
        near = snr[max(0, i - window) : i + window + 1]
        if v < threshold or v < max(near) or (max(0, i - window) + near.index(max(near))) != i:
            continue
        chisq = 30.0
        if v >= chisq_from:
            parts = [(z([k for k in range(n // 2 + 1) if bin_of[k] == b], i + crop), power[bin_of == b].sum() / power.sum()) for b in range(bins)]
            whole = sum(p for p, _ in parts)
            chisq = sum(abs(p - q * whole) ** 2 / q for p, q in parts if q > 0)
        out.append((i + crop, v, chisq))
    return out


def test_matched_filter_by_direct_sums(spark, sf):
    known = series_of(spark, sf)
    found = {}
    for r in registry.queries()["v17_w01_v18_matched_filter"](spark, sf).collect():
        found.setdefault((r.series_id, r.template_id), []).append((r.i, r.snr, r.chisq))
        assert r.rchisq == pytest.approx(r.chisq / 30) and r.new_snr == pytest.approx(r.snr / ((1 + min(r.chisq / 30, 1000) ** 3) / 2) ** (1 / 6))
    assert found
    for series_id in [*known][:6]:
        for t in signal.demo_bank():
            want = direct_triggers(known[series_id], t, 64.0, 1.5, 2.0, 6, 3)
            got = sorted(found.get((series_id, t.template_id), []))
            assert [g[0] for g in got] == [w[0] for w in want]
            for g, w in zip(got, want, strict=True):
                assert g[1:] == pytest.approx(w[1:], rel=1e-6)


def test_chunks_of_a_bank_give_the_same_triggers(spark, sf):
    s = V.series(spark, sf).select("series_id", "ifo", "arr")
    waves = [signal.Template(i, 300.0 + 20 * i, 200.0 + 10 * i, 2.0, 0.1 * (i % 3)) for i in range(11)]
    key = lambda df: sorted(map(tuple, df.collect()))
    whole = key(signal.triggers(s, waves, 64.0, 1.5, 2.0, per_task=100))
    assert whole and whole == key(signal.triggers(s, waves, 64.0, 1.5, 2.0, per_task=2))
    one = s.limit(1)
    spread = signal.triggers(one, waves * 20, 64.0, 0.0, 9.0, per_task=10)
    assert spread.rdd.getNumPartitions() >= 22  # one series fills as many tasks as the bank has chunks
    assert signal.triggers(s, [], 64.0, 1.5, 2.0).count() == 0


def test_waveforms_stay_within_their_bytes():
    held = signal.Waves(40_000)
    made = [held.get(signal.Template(i, 30.0, 20.0 + i, 20.0), 1024, 256.0) for i in range(9)]
    assert held.size <= 40_000 and len(held.held) < 9
    assert np.array_equal(held.get(signal.Template(0, 30.0, 20.0, 20.0), 1024, 256.0), made[0])


def test_band_sums_by_both_ways():
    rng = np.random.default_rng(3)
    n = 256
    x, inside = rng.normal(size=n // 2 + 1) + 1j * rng.normal(size=n // 2 + 1), np.arange(10, 90)
    few, many = np.array([3, 77]), np.arange(n)
    want = np.array([sum(x[k] * np.exp(2j * np.pi * k * i / n) for k in inside) for i in range(n)])
    assert signal.band_sums(x, inside, n, few) == pytest.approx(want[few])
    assert signal.band_sums(x, inside, n, many) == pytest.approx(want)


def test_waveform_phase_terms():
    """Amplitude f^(-7/6), and the phase as the sum of its orders, written out for equal masses (eta = 1/4)."""
    n, rate = 4096, 512.0
    h = signal.taylor_f2(20.0, 20.0, n, rate, 20.0)
    f = np.arange(n // 2 + 1) * rate / n
    k = np.flatnonzero(np.abs(h) > 0)
    assert f[k[0]] >= 20 and f[k[-1]] <= 1 / (6**1.5 * math.pi * 40 * signal.MSUN_S)
    assert np.abs(h[k]) == pytest.approx(f[k] ** (-7 / 6))
    for i in k[:: len(k) // 5]:
        v = (math.pi * 40 * signal.MSUN_S * f[i]) ** (1 / 3)
        sixth = 11583231236531 / 4694215680 - 640 * math.pi**2 / 3 - 6848 / 21 * (np.euler_gamma + math.log(4 * v)) + 0.25 * (2255 * math.pi**2 / 12 - 15737765635 / 3048192) + 76055 / 1728 / 16 - 127825 / 1296 / 64
        orders = [1, 0, 3715 / 756 + 55 / 36, -16 * math.pi, 15293365 / 508032 + 27145 / 2016 + 3085 / 1152, math.pi * (38645 / 756 - 65 / 36) * (1 + 3 * math.log(v)), sixth, math.pi * (77096675 / 254016 + 378515 / 6048 - 74045 / 12096)]
        phase = 3 / 32 * sum(c * v ** (p - 5) for p, c in enumerate(orders))
        assert np.exp(-1j * (phase + math.pi / 4)) == pytest.approx(h[i] / abs(h[i]), abs=1e-6)
    assert not np.allclose(h, signal.taylor_f2(20.0, 20.0, n, rate, 20.0, 0.5, 0.0))


def test_significance_of_the_query(spark, sf):
    rows = registry.queries()["f17_significance"](spark, sf).collect()
    assert rows and all(r.sigma == pytest.approx(0.0 if r.p_value >= 1 else abs(NormalDist().inv_cdf(1 - min(max(r.p_value, 1e-15), 1 - 1e-15)))) for r in rows)


def test_stochastic_bank_by_a_plain_placement(spark, sf):
    draw = np.random.RandomState(42).uniform
    kept, refused = [(45.0, 45.0)], 0
    point = lambda a, b: ((a + b) * (a * b / (a + b) ** 2) ** 0.6, a * b / (a + b) ** 2)
    for _ in range(100_000):
        x, y = draw(10, 80), draw(10, 80)
        a, b = max(x, y), min(x, y)
        (m, e) = point(a, b)
        if not 2 <= a + b <= 100 or b / a < 0.05 or any(math.sqrt(((m - p) / p) ** 2 + (10 * (e - q)) ** 2) < 0.1 * 5 * math.sqrt(1 - 0.97) for p, q in map(lambda k: point(*k), kept)):
            refused += 1
            continue
        kept.append((a, b))
        if refused > 1000 and len(kept) - 1 < 5:
            break
    rows = [(r.mass1, r.mass2) for r in registry.queries()["g07_stochastic_bank"](spark, sf).orderBy("template_id").collect()]
    assert len(rows) == 122 and np.array(rows) == pytest.approx(np.array(kept))


def test_subset_of_slides_is_the_seeded_draw(spark, sf):
    listed = sorted(s * k * 7_200_000_000 for k in range(1, 11) for s in (1, -1))
    pairs = [(a, b) for a in listed for b in listed]
    want = [pairs[i] for i in np.random.RandomState(42).choice(400, size=120, replace=False)]
    rows = registry.queries()["g13_subset_of_slides"](spark, sf).collect()
    got = [(r.offset_1, r.offset_2) for r in rows]
    assert sorted(got) == sorted(want) and len(set(got)) == 120
    n = {r.offset_us: r.n for r in registry.queries()["g11_slide_offsets"](spark, sf).collect()}
    assert all((r.n_1, r.n_2) == (n[r.offset_1], n[r.offset_2]) for r in rows)
    assert background.offset_pairs(background.offsets(spark, 10, 1), "subset", 0.01).count() == 100


def test_backward_blocks_by_a_plain_loop(spark, sf):
    from tallybeam.plans import discovery

    files = [tuple(r) for r in discovery._files(spark, sf)[0].select("ifo", "file_start", "file_end").collect()]
    held = {ifo: [(s, e) for x, s, e in files if x == ifo] for ifo in ("H1", "L1")}
    both = [s for s, _ in held["H1"] if any(abs(s - o) < 4096 for o, _ in held["L1"])]
    now, want = float(max(e for _, e in held["H1"])), []
    while now - 512 >= 512:
        a, b = now - 512, now
        if all(any(s <= a and b <= e for s, e in held[x]) for x in held):
            want.append((a, b, "data"))
            now = a
            continue
        want.append((a, b, "gap"))
        ends = [s + 4096.0 for s in both if s < a]
        now = max(ends) if ends and max(ends) < a - 512 else (math.ceil(a / 8192) - 1) * 8192.0
    assert [tuple(r) for r in registry.queries()["r03_backward_blocks"](spark, sf).collect()] == want and {s for *_, s in want} == {"data", "gap"}


def test_ranges_answer_like_plain_searches():
    rng = random.Random(4)
    for n in (0, 1, 7, 40):
        held = [(a, a + rng.randrange(1, 30)) for a in (rng.randrange(200) for _ in range(n))]
        ranges = frames.Ranges(held)
        for _ in range(200):
            a = rng.randrange(-10, 220)
            b = a + rng.randrange(1, 25)
            assert ranges.holds(a, b) == any(s <= a and b <= e for s, e in held)
            assert ranges.meets(a, b) == any(s < b and a < e for s, e in held)
            assert ranges.latest_end(a) == max((e for s, e in held if s < a), default=None)


def test_forward_blocks_wait_and_stop():
    seen = []
    blocks = blocks_to_search(0.0, 10.0, lambda a, b: b <= 30 + 10 * len(seen), follow=True, wait=lambda: seen.append(1), stop=lambda: len(seen) >= 3)
    assert [*blocks] == [(0.0, 10.0, "data"), (10.0, 20.0, "data"), (20.0, 30.0, "data"), (30.0, 40.0, "data"), (40.0, 50.0, "data")]
    assert [s for *_, s in blocks_to_search(0.0, 10.0, lambda a, b: a != 10, end_s=30.0)] == ["data", "gap", "data"]
    assert [*blocks_to_search(40.0, 10.0, lambda a, b: a >= 30 or a < 5, "backward", lambda t: None, lambda t: 15.0 if t > 15 else None, stop_s=None, stop=lambda: False)][:3] == [(30.0, 40.0, "data"), (20.0, 30.0, "gap"), (5.0, 15.0, "gap")]


# --- candidates, background, nearest, files ---

CANDIDATE = "far_hz double, network_stat double, gps_us long, template_id string, event_id_a long, event_id_b long"


def naive_greedy(rows, window):
    kept = []
    for r in sorted(rows, key=lambda r: (1e9 if r[0] is None else r[0], -r[1], r[2] is not None, r[2] or 0, r[3], r[4], r[5])):
        if r[2] is None or all(k[2] is None or abs(r[2] - k[2]) >= window for k in kept):
            kept.append(r)
    return sorted(r[4] for r in kept)


@pytest.mark.parametrize("kind", ["dense", "rising", "equal", "sparse"])
def test_deduplication_at_any_density(spark, kind):
    rng = random.Random(5)
    n = 600
    stat = {"dense": lambda i: float(rng.randrange(50)), "rising": lambda i: float(i), "equal": lambda i: 1.0, "sparse": lambda i: rng.random()}[kind]
    span = 200_000 if kind == "sparse" else 6_000
    rows = [(None if i % 7 == 0 else 1.0 if kind != "dense" else rng.choice([0.5, 1.0]), stat(i), i * 10 if kind in ("rising", "equal") else rng.randrange(-span, span), "t", i, i) for i in range(n)] + [(1.0, 3.0, None, "t", 9_000, 1), (1.0, 3.0, None, "t", 9_001, 1)]
    frame = spark.createDataFrame(rows, CANDIDATE)
    for chunk_rows in (5, 10**6):  # many chunks of time, and one
        assert sorted(r.event_id_a for r in candidates.deduplicate(frame, 45, chunk_rows).collect()) == naive_greedy(rows, 45)
    assert candidates.deduplicate(frame.limit(0), 45).count() == 0


def test_tasks_of_deduplication_stay_bounded_at_ten_times_the_density(spark, monkeypatch):
    """Islands of rows nearer than the window would be one; chunks hold what they were asked to."""
    rng = random.Random(6)
    rows = [(1.0, rng.random(), rng.randrange(0, 40_000), "t", i, i) for i in range(8_000)]
    whole = candidates.greedy

    def counted(time, place, state, own, window):
        assert len(time) < 4 * 1_000
        return whole(time, place, state, own, window)

    monkeypatch.setattr(candidates, "greedy", counted)
    kept = sorted(r.event_id_a for r in candidates.deduplicate(spark.createDataFrame(rows, CANDIDATE), 10, 1_000).collect())
    assert kept == naive_greedy(rows, 10)


def test_tasks_of_deduplication_stay_bounded_in_a_burst(spark, monkeypatch):
    """Half of all rows lie in a burst, many at one time, and half are spread: the burst is cut by count, so no chunk holds more than some times what was asked for."""
    rng = random.Random(8)
    burst = [rng.randrange(500_000, 540_000) for _ in range(4_000)] + [520_000] * 1_000
    rows = [(1.0, rng.random(), t, "t", i, i) for i, t in enumerate(burst + [rng.randrange(0, 500_000_000) for _ in range(5_000)])]
    whole = candidates.greedy

    def counted(time, place, state, own, window):
        assert len(time) < 4 * 1_000
        return whole(time, place, state, own, window)

    monkeypatch.setattr(candidates, "greedy", counted)
    frame = spark.createDataFrame(rows, CANDIDATE)
    for window in (10, 3_000):  # the second is longer than a chunk of the burst
        kept = sorted(r.event_id_a for r in candidates.deduplicate(frame, window, 800 if window == 10 else 300).collect())
        assert kept == naive_greedy(rows, window)
    assert candidates.deduplicate(frame, 0, 800).count() == len(rows)


def test_nearest_in_a_burst(spark):
    """A bin of many rows on both sides is sorted, not passed again for each row."""
    left = spark.range(200_000).selectExpr("id", "id * 7 % 100003 as t")
    right = spark.range(100_000).selectExpr("id * 3 as u", "cast(id as string) as name")
    rows = nearest(left, right, "t", "u", "name", 50_000)
    assert rows.filter("match_gap = (case when t % 3 = 2 then 1 else t % 3 end) and cast(name as long) = (case when t % 3 = 2 then t div 3 + 1 else t div 3 end)").count() == 200_000


def test_places_number_all_rows(spark):
    rows = [(random.Random(i).choice([None, 1.0]), float(i % 5), i, "t", i, i) for i in range(300)]
    got = {r.event_id_a: r.place for r in candidates.placed(spark.createDataFrame(rows, CANDIDATE)).collect()}
    want = sorted(rows, key=lambda r: (1e9 if r[0] is None else r[0], -r[1], r[2]))
    assert [got[r[4]] for r in want] == [*range(1, 301)]


def test_nearest_keeps_rows_of_null_and_equal_keys(spark):
    rng = random.Random(7)
    left = [(None, 5), (None, 5), (1, 5), (1, 5), (2, None), (3, -40), (4, 10_000)] + [(i, rng.randrange(-3_000, 3_000)) for i in range(10, 200)]
    right = [(rng.randrange(-3_000, 3_000), f"e{i}") for i in range(80)] + [(5, "b"), (5, "a"), (None, "null"), (-60, "x"), (-20, "y")]
    rows = nearest(spark.createDataFrame(left, "id int, t long"), spark.createDataFrame(right, "u long, name string"), "t", "u", "name", 20).collect()
    want = []
    for i, t in left:
        near = sorted((abs(t - u), u, n) for u, n in right if u is not None and abs(t - u) <= 20) if t is not None else []
        want.append((i, t, near[0][2] if near else None, near[0][0] if near else None))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))


def test_louder_of_broken_values(spark):
    fg, bg = [1.0, float("nan"), None, float("inf"), 2.0], [1.0, 2.0, 2.0, float("nan"), None, 3.0]
    f, b = (spark.createDataFrame([(x,) for x in v], "network_stat double") for v in (fg, bg))
    got = sorted((str(r.network_stat), r.n_louder, r.n_background) for r in background.count_louder(f, b).collect())
    assert got == sorted([("1.0", 4, 6), ("nan", 0, 6), ("None", 0, 6), ("inf", 0, 6), ("2.0", 3, 6)])
    assert sorted(r.network_stat for r in ranking.ranked(f, b, 10.0).collect()) == [1.0, 2.0]
    hot = spark.range(5_000).select((F.col("id") % 3).cast("double").alias("network_stat"))
    assert {(r.network_stat, r.n_louder) for r in background.count_louder(hot, hot).collect()} == {(0.0, 5000), (1.0, 3333), (2.0, 1666)}


def test_long_files_are_found(spark):
    files = spark.createDataFrame([("long", 0, 100_000), ("short", 8_192, 12_288), ("none", 500, 500)], "file string, file_start long, file_end long")
    blocks = spark.createDataFrame([(9_000, 9_100), (50_000, 54_000), (99_990, 100_010)], "block_start long, block_end long")
    assert sorted((r.block_start, r.file) for r in frames.containing(blocks, files).collect()) == [(9_000, "long"), (50_000, "long")]
    cached = spark.createDataFrame([("H-x-0-100000.gwf", 5_000)], "file string, size long")
    assert frames.cached(blocks, cached).count() == 2


def test_bank_methods(spark, tmp_path):
    spark.createDataFrame([(30.0, 20.0)], "mass1 double, mass2 double").write.parquet(f"{tmp_path}/bank")
    counts = {m: bank.build(spark, m, (10, 80), (10, 80), path=f"{tmp_path}/bank").count() for m in ("stochastic", "targeted", "moderate", "multi_event", "stored")}
    assert counts == {"stochastic": 122, "targeted": 87, "moderate": 496, "multi_event": 427, "stored": 1}
    assert bank.stored(spark, f"{tmp_path}/bank").first().spin1z == 0.0
    row = bank.described(bank.targeted_bank(spark), "targeted", points=10).first()
    assert row.n_templates == 87 and row.least_mass1 < row.largest_mass1 and len(row.hash) == 64
    with pytest.raises(ValueError):
        bank.build(spark, "lattice", (1, 2), (1, 2))


def test_sensors_beyond_three_are_refused(spark, sf):
    from tallybeam.operators import coincidence

    t = V.triggers(spark, sf)
    with pytest.raises(ValueError, match="4 sensors"):
        coincidence.find(t, ["H1", "L1", "V1", "K1"], {("H1", "L1"): 10})
    assert coincidence.find(t, ["H1"], {("H1", "L1"): 10}).count() == 0


def test_fixed_digits_round_as_printf_does(spark):
    rng = random.Random(9)
    xs = [k * 0.31371 for k in range(1, 3000, 7)] + [k / 8 for k in range(1, 400)] + [0.25, 0.125, 1.005, 0.995, 0.001, 2.675, 1e14, 0.0, 99.95, 999.995, 35183.25] + [rng.random() * 10 ** rng.randrange(-3, 7) for _ in range(500)] + [k / 200 for k in range(1, 2000)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", scalars.fixed(F.col("x"), 1).alias("one"), scalars.fixed(F.col("x"), 2).alias("two")).collect()
    assert [(r.x, r.one, r.two) for r in rows] == [(x, f"{x:.1f}", f"{x:.2f}") for x in xs]


@pytest.mark.parametrize("size", [512, 1000, 6000])
def test_tiles_in_files_are_those_of_the_join_and_only_files_are_shuffled(spark, size):
    rng = random.Random(size)
    rows = [(f"f{i}", s := rng.randrange(-40_000, 40_000), s + rng.choice([0, 500, 4096, 4097, 20_000])) for i in range(150)] + [(None, 0, 9_000), ("none", None, 9_000)]
    files = spark.createDataFrame(rows, "file string, file_start long, file_end long")
    blocks = spark.range(-100, 150).select((F.col("id") * size).alias("block_start"), (F.col("id") * size + size).alias("block_end"))
    want = sorted(map(tuple, frames.containing(blocks, files).collect()), key=repr)
    found = frames.containing_tiles(files, size)
    assert sorted(map(tuple, found.collect()), key=repr) == want and len(want) > 10
    plan = found._jdf.queryExecution().toString()
    assert "Join" not in plan and "min(file" not in plan


def test_matches_are_matrix_products_of_chunks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, "ab"[i % 2], rng.normal(size=12).tolist()) for i in range(90)] + [(900, "z", [0.0] * 12), (901, None, [1.0, 2.0, 3.0]), (902, "n", None), (903, "n", [1.0, None, *[2.0] * 10]), (904, "n", []), (905, "n", [float("nan")] * 12)]
    s = spark.createDataFrame(rows, "series_id long, ifo string, arr array<double>")
    b = s.filter("series_id % 10 = 0 or series_id > 899").select(F.col("series_id").alias("template_id"), "arr")
    psd = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: 1 + k / 16.0)
    for p, k in ((None, 0), (psd, 4)):
        a, t = s.withColumn("u", arrays.unit(F.col("arr"), p, k)), b.withColumn("v", arrays.unit(F.col("arr"), p, k)).drop("arr")
        whole = a.crossJoin(t).select("series_id", "ifo", "template_id", F.least(F.lit(1.0), F.abs(arrays.inner(F.col("u"), F.col("v")))).alias("match"))
        found = arrays.matches(s, b, p, k)
        assert found.columns == whole.columns
        got, want = (sorted(((r.series_id, str(r.ifo), r.template_id, round(r.match, 9)) for r in df.collect())) for df in (found, whole))
        assert got == want and len(got) == 96 * 15
        assert "MapInArrow" in found._jdf.queryExecution().toString()
