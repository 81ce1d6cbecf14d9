"""Behaviour of the operators on small frames: windows, broken values, invariants, signals, state and streams."""

import json
import math
import random
from statistics import NormalDist, median

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybeam.functions import scalars as S
from tallybeam.operators import arrays, background, bank, candidates, coincidence, ranking, ranks, signal
from tallybeam.operators.intervals import clip, islands, nearest, range_join, within_segments
from tallybeam.plans import views as V
from tallybeam.sources import frames, state
from tallybeam.streaming import loop

TRIGGER = "ifo string, gps_us long, new_snr double, rchisq double, template_id string, event_id long"


def trigger_frame(spark, rows):
    return spark.createDataFrame([(ifo, int(t * 1e6), float(s), 1.0, tmpl, i) for i, (ifo, t, s, tmpl) in enumerate(rows)], TRIGGER)


def test_window_includes_its_end_unless_strict(spark):
    t = trigger_frame(spark, [("H1", 100.0, 8, "A"), ("L1", 100.015, 6, "A"), ("L1", 100.0151, 6, "A")])
    assert coincidence.pairs(t, "H1", "L1", 15_000).count() == 1
    assert coincidence.pairs(t, "H1", "L1", 15_000, strict=True).count() == 0


def test_templates_must_match_if_asked(spark):
    t = trigger_frame(spark, [("H1", 1, 8, "A"), ("L1", 1.001, 6, "B")])
    assert coincidence.pairs(t, "H1", "L1", 15_000).count() == 0
    assert coincidence.pairs(t, "H1", "L1", 15_000, same_template=False).count() == 1


@pytest.mark.parametrize("broken", [math.nan, math.inf, -math.inf])
def test_broken_ratio_counts_as_zero_or_drops_the_row(spark, broken):
    t = trigger_frame(spark, [("H1", 1, broken, "A"), ("L1", 1.001, 6, "A")])
    assert coincidence.pairs(t, "H1", "L1", 15_000).first().network_stat == 6.0
    assert coincidence.pairs(t, "H1", "L1", 15_000, drop_broken=True).count() == 0


def test_one_sensor_or_none_gives_no_pairs(spark):
    t = trigger_frame(spark, [("H1", 1, 5, "A")])
    assert coincidence.all_pairs(t, ["H1"], {("H1", "L1"): 1}).count() == 0
    assert coincidence.pairs(t.limit(0), "H1", "L1", 15_000).count() == 0


def test_range_join_equals_nested_loops(spark):
    rng = random.Random(1)
    a = [(i, rng.randrange(-5_000, 5_000), rng.randrange(3)) for i in range(200)] + [(900, None, 1)]
    b = [(i, rng.randrange(-5_000, 5_000), rng.randrange(3)) for i in range(200)]
    fa, fb = spark.createDataFrame(a, "i int, t long, k int"), spark.createDataFrame(b, "j int, u long, l int")
    for strict in (False, True):
        got = {(r.i, r.j) for r in range_join(fa, fb, "t", "u", 70, [("k", "l")], strict).collect()}
        want = {(i, j) for i, t, k in a for j, u, m in b if t is not None and k == m and (abs(t - u) < 70 if strict else abs(t - u) <= 70)}
        assert got == want
        assert {r.i for r in range_join(fa, fb, "t", "u", 70, strict=strict, how="left_anti").collect()} == {i for i, t, _ in a if t is None or not any((abs(t - u) < 70 if strict else abs(t - u) <= 70) for _, u, _ in b)}
    plan = range_join(fa.hint("merge"), fb, "t", "u", 70)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_joins_that_make_many_rows_keep_their_number_of_tasks(spark):
    """Few bytes make many rows, so the joins' tasks are as many as the session asks for, however few bytes each of them reads."""
    t = spark.range(3000).select(F.when(F.col("id") % 2 == 0, "H1").otherwise("L1").alias("ifo"), (F.col("id") * 1000).alias("gps_us"), F.lit(5.0).alias("new_snr"), F.lit(1.0).alias("rchisq"), (F.col("id") % 3).cast("string").alias("template_id"), F.col("id").alias("event_id"))
    slides = spark.createDataFrame([(1, 7000), (-1, -7000)], "slide long, offset_us long")
    for found in (coincidence.pairs(t, "H1", "L1", 4000), background.slid_pairs(t, "H1", "L1", slides, 4000)):
        assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
        assert found.groupBy(F.spark_partition_id()).count().count() > 4  # of 8; adaptive execution made one or two of them


def test_nearest_ties_and_misses(spark):
    left = spark.createDataFrame([(1, 100), (2, 500)], "id int, t long")
    right = spark.createDataFrame([(90, "b"), (110, "a"), (400, "c")], "u long, name string")
    rows = {r.id: (r.name, r.match_gap) for r in nearest(left, right, "t", "u", "name", 20).collect()}
    assert rows == {1: ("b", 10), 2: (None, None)}


def test_islands_over_many_spans(spark):
    rng = random.Random(2)
    times = sorted(rng.sample(range(-4_000, 4_000), 300))
    got = [r.island for r in islands(spark.createDataFrame([(t,) for t in times], "t long"), "t", 30, span=100).orderBy("t").collect()]
    want, n = [], 0
    for i, t in enumerate(times):
        n += i == 0 or t - times[i - 1] >= 30
        want.append(n)
    assert got == want


def test_segments(spark):
    s = spark.createDataFrame([(0, 10), (15, 25), (30, 40)], "s long, e long")
    assert sorted(map(tuple, clip(s, "s", "e", F.lit(5), F.lit(20)).collect())) == [(5, 10), (15, 20)]
    p = spark.createDataFrame([(10,), (12,), (15,), (41,)], "t long")
    assert sorted(r.t for r in within_segments(p, s, "t", "s", "e", 4).collect()) == [10, 15]


def test_new_snr(spark):
    rows = [(10.0, 20.0), (8.0, 30.0), (math.nan, 1.0), (math.inf, 1.0), (-1.0, 1.0), (5.0, math.nan), (5.0, -2.0), (5.0, math.inf), (1e6, 0.0), (5.0, 1e9)]
    got = [r[0] for r in spark.createDataFrame(rows, "s double, c double").select(S.new_snr(F.col("s"), F.col("c"))).collect()]
    for (s, c), g in zip(rows, got, strict=True):
        want = 0.0 if not math.isfinite(s) or s <= 0 else s if not math.isfinite(c) or c < 0 else s / ((1 + min(c / 30, 1000) ** 3) / 2) ** (1 / 6)
        assert g == pytest.approx(want)


def test_rounding_of_pairs_equals_the_sql(spark):
    """Halves away from zero by doubles, broken values left alone; in the plan no decimal rounding is left where pairs are made."""
    import duckdb

    rng = random.Random(4)
    values = [0.5e-6, 1.5e-6, 2.5e-6, -2.5e-6, -1.5e-6, 0.0, 1.0, 131.0000005, 131.0000015, math.inf, 2.0**53, *(rng.random() * 200 for _ in range(3000)), *((k + 0.5) * 1e-6 for k in range(0, 2_000_000, 999))]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(S.rounded(F.col("x"), 6)).collect()]
    db = duckdb.connect()
    assert got == [db.execute("select round(?::double, 6)", [v]).fetchone()[0] for v in values]
    assert spark.createDataFrame([(math.nan,), (None,)], "x double").select(S.rounded(F.col("x"), 6)).collect()[1][0] is None
    from tallybeam.plans import registry

    for name in ("j01_pairs_same_template", "j02_pairs_any_template", "j03_pairs_of_all_sensors", "j04_triples", "j08_slides_same_template"):
        assert " round(" not in registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()


def test_sigma_and_texts(spark):
    ps = [0.5, 0.1, 0.9, 1e-6, 1e-20]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in ps], "p double").select(S.sigma(F.col("p"))).collect()]
    assert got == pytest.approx([abs(NormalDist().inv_cdf(1 - min(max(p, 1e-15), 1 - 1e-15))) for p in ps])
    row = spark.range(1).select(S.ifar_text(F.lit(None).cast("double")), S.ifar_text(F.lit(0.5)), S.assessment(F.lit(40_000.0)), S.template_number(F.lit("x")), S.gps_to_utc(F.lit(1_126_259_462))).first()
    assert tuple(row) == ("-", "12.00 hr", "confident", 0, "2015-09-14 09:50:44 UTC")


def test_background_slides(spark):
    rows = [("H1", i, 8, "A") for i in range(50)] + [("L1", i + 0.01, 7, "A") for i in range(50)]
    t = trigger_frame(spark, rows)
    few, more = (background.slid_pairs(t, "H1", "L1", background.offsets(spark, n, 1_000_000), 500_000).count() for n in (3, 10))
    assert 0 < few <= more
    assert background.slid_pairs(trigger_frame(spark, [("H1", 0, 8, "A"), ("L1", 1000, 7, "A")]), "H1", "L1", background.offsets(spark, 2, 1_000_000), 500_000).count() == 0
    r = ranking.rate(background.slid_pairs(t, "H1", "L1", background.offsets(spark, 3, 1_000_000), 500_000), 3, 50.0).first()
    assert r.far_hz == pytest.approx(few / 300) and ranking.rate(spark.createDataFrame([], "network_stat double"), 3, 50.0).first().far_hz is None
    assert background.slide_estimate(100, 10, "full_grid") == 400
    with pytest.raises(ValueError):
        background.offset_pairs(background.offsets(spark, 1, 1), "spiral")


def test_count_louder_and_ranks(spark):
    rng = random.Random(3)
    fg, bg = [round(rng.uniform(0, 9), 1) for _ in range(80)], [round(rng.uniform(0, 9), 1) for _ in range(300)]
    f, b = (spark.createDataFrame([(x,) for x in v], "network_stat double") for v in (fg, bg))
    assert sorted((r.network_stat, r.n_louder) for r in background.count_louder(f, b).collect()) == sorted((x, sum(y >= x for y in bg)) for x in fg)
    none = background.count_louder(f, b.limit(0)).collect()
    assert len(none) == 80 and all(r.n_louder == 0 and r.n_background == 0 for r in none)
    empty = ranking.ranked(f, b.limit(0), 100.0, 5, "poisson").first()
    assert (empty.far_hz, empty.ifar_years, empty.p_value, empty.sigma) == (math.inf, 0.0, 1.0, 0.0)
    assert ranking.threshold_for(b, 1.0, 5.0).first().threshold == sorted(bg)[-5]
    assert ranking.threshold_for(b.limit(0), 1.0, 5.0).first().threshold == 0.0


def test_deduplication_is_greedy(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1.0, 2.0]), float(rng.randrange(20)), rng.randrange(0, 4_000), "A", i, i) for i in range(250)]
    frame = spark.createDataFrame(rows, "far_hz double, network_stat double, gps_us long, template_id string, event_id_a long, event_id_b long")
    kept = []
    for r in sorted(rows, key=lambda r: (1e9 if r[0] is None else r[0], -r[1], r[2], r[3], r[4], r[5])):
        if all(abs(r[2] - k[2]) >= 15 for k in kept):
            kept.append(r)
    assert sorted(r.event_id_a for r in candidates.deduplicate(frame, 15).collect()) == sorted(k[4] for k in kept)


def test_banks(spark, tmp_path):
    grid = bank.grid_bank(spark, 2, 20, 2, 20)
    assert grid.count() == 441 and grid.select("mass1", "mass2").distinct().count() == 231
    assert bank.grid_bank(spark, 2, 20, 2, 20, spins=[-0.5, 0.0, 0.5]).count() == 3969
    assert bank.grid_bank(spark, 2, 20, 2, 20, quick=True, cap=50).count() <= 50
    assert grid.filter("mass1 < mass2 or mass1 + mass2 < 4").count() == 0
    assert (bank.targeted_bank(spark, 15).count(), bank.targeted_bank(spark).count(), bank.moderate_bank(spark, 5, 80).count(), bank.multi_event_bank(spark).count()) == (198, 87, 496, 427)
    calls = []
    build = lambda: calls.append(1) or bank.targeted_bank(spark)
    for _ in range(2):
        assert bank.cached(spark, f"file://{tmp_path}", {"n": 10}, build).count() == 87
    assert len(calls) == 1
    assert bank.content_hash({"a": 1, "b": 2}) == bank.content_hash({"b": 2, "a": 1})


def test_gates(spark):
    x = np.zeros(100)
    x[[10, 12, 40]] = 50.0
    s = spark.createDataFrame([(1, x.tolist())], "k int, arr array<double>")
    found = sorted((r.s, r.e) for r in arrays.gates(s, "k", "arr", 3.0, 3, 50).collect())
    assert found == [(7, 15), (37, 43)]
    gated = s.select(arrays.apply_gates(F.col("arr"), F.array(F.struct(F.lit(7).alias("s"), F.lit(15).alias("e")))).alias("a")).first().a
    want = x.copy()
    want[7:16] *= np.linspace(1, 0, 9)
    assert gated == pytest.approx(want.tolist())


def injected(n=2048, rate=256.0, at=1200, scale=60.0):
    rng = np.random.default_rng(7)
    h = signal.taylor_f2(120.0, 100.0, n, rate, 10.0)
    wave = np.fft.irfft(h * np.exp(-2j * np.pi * np.fft.rfftfreq(n, 1 / rate) * at / rate), n)
    return rng.normal(size=n) + scale * wave / np.abs(wave).max(), h, rate, at


def test_matched_filter_finds_an_injection(spark):
    x, h, rate, at = injected()
    psd = np.full(len(x) // 2 + 1, 2 / rate)
    snr = np.abs(signal.filtered(x, h, psd, rate, 10.0))
    assert abs(int(snr.argmax()) - at) <= 2 and snr.max() > 8
    noise = np.abs(signal.filtered(np.random.default_rng(8).normal(size=len(x)), h, psd, rate, 10.0))
    assert 1.6 < (noise**2).mean() < 2.4
    chisq = signal.power_chisq(x, h, psd, rate, 10.0, np.array([snr.argmax()]))
    assert chisq[0] / 30 < 2
    frame = spark.createDataFrame([(1, "H1", x.tolist()), (2, "L1", [0.0] * 64), (3, "L1", None)], "series_id long, ifo string, arr array<double>")
    rows = signal.triggers(frame, [signal.Template(0, 120.0, 100.0, 10.0)], rate, 7.0, 8.0, segment=256).collect()
    assert rows and {r.series_id for r in rows} == {1} and abs(max(rows, key=lambda r: r.snr).i - at) <= 2


def test_spectra_and_filters():
    rng = np.random.default_rng(9)
    x, rate = rng.normal(size=1 << 14), 256.0
    for average in ("median", "mean"):
        psd, step = signal.welch(x, rate, 512, average)
        assert step == 0.5 and psd[5:-5].mean() == pytest.approx(2 / rate, rel=0.08)
    t = np.arange(4096) / rate
    low, high = np.sin(2 * np.pi * 2 * t), np.sin(2 * np.pi * 40 * t)
    assert np.abs(signal.highpass(low + high, rate, 10.0) - high).max() < 0.05
    assert np.abs(signal.notch(low + high, rate, [(40.0, 0.5)])[200:-200] - low[200:-200]).max() < 0.1
    assert len(signal.resample(x, rate, 128.0)) == len(x) // 2
    white = signal.whiten(x, signal.fit_spectrum(psd, step, len(x), rate), rate, 5.0)
    assert white.std() == pytest.approx(math.sqrt(rate / 2), rel=0.1)
    flat, _ = signal.spectrum(np.zeros(256), rate, 64)
    assert (flat == 1e-46).all()
    assert signal.is_gap(np.zeros(10)) and signal.is_gap(np.array([])) and not signal.is_gap(x)


def test_state(spark, tmp_path):
    s = state.State(spark, f"file://{tmp_path}")
    assert state.last_block_end(s.read("blocks")).first().last_end is None
    for i, status in enumerate(("processing", "done")):
        s.append("blocks", spark.createDataFrame([(i, 1, "H1,L1", 0.0, 10.0, status, None, float(i))], state.TABLES["blocks"]))
    assert state.last_block_end(s.read("blocks"), 1).first().last_end == 10.0
    assert state.current_blocks(s.read("blocks")).first().status == "done"
    assert state.first_finished_start(s.read("blocks")).first().first_start == 0.0
    s.set_value("progress", "a")
    s.set_value("progress", "b")
    assert s.get_value("progress") == "b" and s.get_value("other") is None
    rows = spark.createDataFrame([(1, {"H1": 2.0}, "x")], "id long, per_ifo map<string,double>, name string")
    state.write_candidates(rows, f"file://{tmp_path}/out", "{}")
    assert json.loads(spark.read.csv(f"file://{tmp_path}/out/candidates.csv", header=True).first().per_ifo) == {"H1": 2.0}


def test_files(spark):
    names = spark.createDataFrame([("H-H1_X-100-50.hdf5",), ("bad.txt",)], "n string")
    a, b = frames.coverage(F.col("n"))
    assert [tuple(r) for r in names.select(a, b).collect()] == [(100, 150), (None, None)]


def test_stream_blocks_equal_the_batch(spark, sf, tmp_path):
    events = V.read(spark, sf, "events").withColumn("t", F.col("ts").cast("timestamp"))
    events.repartition(3).write.parquet(f"{tmp_path}/in")
    out = []
    stream = loop.blocks(loop.source(spark, f"{tmp_path}/in", events.schema), "t", "6 hours", "40 days")
    q = loop.run(stream.select("block_start", "event_type", "n"), lambda df, n: out.extend(df.collect()), f"{tmp_path}/cp")
    q.awaitTermination()
    raw = events.groupBy(F.window("t", "6 hours").start.alias("block_start"), "event_type").agg(F.count(F.lit(1)).alias("n")).collect()
    late = {(r.block_start, r.event_type): r.n for r in out}
    assert all(late[k] == n for k, n in {(r.block_start, r.event_type): r.n for r in raw}.items() if k in late)


def test_stream_join_equals_the_batch(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:{i % 60:02d}:00", str(i % 3)) for i in range(120)]
    frame = spark.createDataFrame(rows, "id long, t string, k string").withColumn("t", F.to_timestamp("t"))
    frame.repartition(2).write.parquet(f"{tmp_path}/in")
    a, b = (loop.source(spark, f"{tmp_path}/in", frame.schema, 2).select(*(F.col(c).alias(f"{c}_{s}") for c in frame.columns)) for s in "ab")
    out = []
    q = loop.run(loop.stream_pairs(a, b, "t_a", "t_b", "2 minutes", "2 hours", [("k_a", "k_b")]), lambda df, n: out.extend((r.id_a, r.id_b) for r in df.collect()), f"{tmp_path}/cp")
    q.awaitTermination()
    want = [(i, j) for i, t, k in rows for j, u, m in rows if k == m and abs(i % 60 - j % 60) <= 2]
    assert sorted(out) == sorted(want)


def test_failed_batches_are_recorded(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/in")
    seen = []

    def fail(df, n):
        raise ValueError("broken")

    q = loop.run(loop.source(spark, f"{tmp_path}/in", spark.range(1).schema), fail, f"{tmp_path}/cp", record_error=lambda n, e: seen.append((n, str(e))))
    with pytest.raises(Exception, match="broken"):
        q.awaitTermination()
    assert seen == [(0, "broken")]


def test_blocks_forward_and_backward(spark):
    assert [tuple(r) for r in loop.block_times(spark, 0, 25, 10).collect()] == [(0, 10), (10, 20), (20, 30)]
    assert [tuple(r) for r in loop.block_times(spark, 0, 25, 10, backward=True).collect()] == [(15, 25), (5, 15)]


def test_gates_that_take_nearly_all_are_rolled_back(spark):
    s = spark.createDataFrame([(1, [0.0] * 20 + [100.0, 100.0] + [0.0] * 20), (2, [1.0, -1.0] * 20 + [50.0]), (3, [])], "series_id long, arr array<double>")
    found = spark.createDataFrame([(1, 19, 22), (2, 38, 40)], "series_id long, s int, e int")
    rows = {r.series_id: r for r in arrays.gated(s, found, "series_id", "arr", least_share=0.6).collect()}
    assert rows[1].rolled_back and rows[1].n_gates == 0 and max(rows[1].arr) == 100.0
    assert rows[2].rolled_back and rows[3].n_gates == 0 and rows[3].arr == [] and not rows[3].rolled_back
    kept = {r.series_id: r for r in arrays.gated(s, found, "series_id", "arr").collect()}
    assert kept[2].n_gates == 1 and kept[2].arr[-1] == 0.0 and kept[2].arr[38] == 1.0


def test_whitened_noise_has_unit_power(spark):
    rng = np.random.default_rng(1)
    colour = np.convolve(rng.normal(size=4_200), np.ones(5) / 5, "valid")[:4_096] * 1e-3
    s = spark.createDataFrame([(1, "H1", colour.tolist()), (2, "L1", [0.0] * 64), (3, "L1", None)], "series_id long, ifo string, arr array<double>")
    rows = {r.series_id: r for r in signal.whitened(signal.condition(s, rate=256.0, cut=2.0, segment=256), 4.0).collect()}
    assert 0.7 < rows[1].power < 1.3 and rows[2].power is None and rows[3].arr is None


def test_cached_files(spark):
    blocks = spark.createDataFrame([(1_000, 1_100), (5_000, 5_100)], "block_start long, block_end long")
    files = spark.createDataFrame([("H-a-900-4096.gwf", 10), ("H-b-900-4096.gwf", 5_000), ("H-c-904-4096.hdf5", 5_000), ("notes.txt", 9_000)], "file string, size long")
    assert [r.file for r in frames.cached(blocks, files).collect()] == ["H-b-900-4096.gwf"]


def test_stochastic_bank_takes_all_proposals(spark):
    from tallybeam.operators import bank

    assert bank.stochastic_bank(spark, 10, 80, 10, 80, iterations=20_000).count() == 116
    assert bank.stochastic_bank(spark, 10, 80, 10, 80).count() == 122


@pytest.mark.parametrize("range_rows", [3, 50, 10_000])
def test_ranks_by_ranges(spark, monkeypatch, range_rows):
    """Counts and order statistics with ties, infinities, broken values and few or many ranges, against sorted lists."""
    monkeypatch.setattr(ranks, "RANGE_ROWS", range_rows)
    rng = random.Random(range_rows)
    values = [rng.choice([1.5, 1.5, rng.uniform(0, 9), float(rng.randrange(9)), -0.0, 0.0]) for _ in range(700)] + [float("inf"), float("-inf"), float("nan"), None]
    asked = [*rng.sample(values[:700], 60), 1.5, 100.0, -100.0, float("inf"), float("nan"), None, 1.5]
    bg = spark.createDataFrame([(v,) for v in values], "network_stat double").repartition(5)
    fg = spark.createDataFrame(list(enumerate(asked)), "v long, network_stat double")
    good = [v for v in values if v is not None and not math.isnan(v)]
    for most in (0, 1 << 20):  # by ranges, and by one array
        monkeypatch.setattr(ranks, "MOST_ASKED", most)
        got = {r.v: (r.n_louder, r.n_background) for r in background.count_louder(fg, bg).collect()}
        assert got == {i: (0 if v is None or math.isnan(v) else sum(x >= v for x in good), len(values)) for i, v in enumerate(asked)}
    row = ranking.summary(bg).first()
    assert (row.n, row.loudest, row.median) == (len(good), float("inf"), median(good))
    falling = sorted(good, reverse=True)
    for n in (1, 2, 350, len(good), 10**6):
        assert ranking.threshold_for(bg, n, 1.0).first().threshold == falling[min(n, len(good)) - 1]
    counts = ranks.counted(bg, F.col("network_stat"))
    inner = ranks.bounds(counts)
    sizes = [r["count"] for r in counts.groupBy(ranks.range_of(F.col("v"), inner).alias("r")).count().collect()]
    assert max(sizes) <= 2 * range_rows + 1 and (len(inner) > 0) == (range_rows < 600)
    nothing = bg.limit(0)
    assert ranking.summary(nothing).first().asDict() == {"n": 0, "loudest": 0.0, "median": None} and ranking.threshold_for(nothing, 3, 1.0).first().threshold == 0.0
    assert {r.n_louder for r in background.count_louder(fg, nothing).collect()} == {0}
