"""Counts over coincidences that are not listed, against the listed ones."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybeam.operators import background, candidates, coincidence, ranking, tallies
from tallybeam.plans import registry
from tallybeam.plans import views as V


@pytest.fixture(scope="module")
def both(spark, sf):
    t, slides = V.triggers(spark, sf), background.offsets(spark, 3, 2 * V.HOUR)
    listed = background.slid_pairs(t, "H1", "L1", slides, 6 * V.HOUR).localCheckpoint()
    return coincidence.pairs(t, "H1", "L1", 6 * V.HOUR).select("event_id_a", "event_id_b", "network_stat").localCheckpoint(), listed, tallies.slid(t, "H1", "L1", slides, 6 * V.HOUR)


@pytest.mark.parametrize("most, least", [(8_000_000, 100_000), (20, 5), (3, 1)])
def test_louder_counts_equal_those_of_the_listed_background(both, monkeypatch, most, least):
    found, listed, unlisted = both
    monkeypatch.setattr(tallies, "MOST_RANKED", most)
    monkeypatch.setattr(tallies, "LEAST_RANKED", least)
    rows = lambda b: sorted((r.event_id_a, r.event_id_b, r.n_louder, r.n_background) for r in background.count_louder(found, b).collect())
    assert rows(unlisted) == rows(listed)
    assert len(rows(unlisted)) == found.count() > 0


def test_ranks_write_neither_pairs_nor_background(spark, both, monkeypatch):
    found, _, unlisted = both
    written = []
    keep = tallies.materialise
    monkeypatch.setattr(tallies, "materialise", lambda df, name: written.append(name) or keep(df, name))
    monkeypatch.setattr(background, "materialise", lambda df, name: written.append(name) or keep(df, name))
    ranking.with_far(found, unlisted, 1e6).collect()
    assert written == ["units"]


def test_statistics_between_bounds_equal_the_filtered_ones():
    rng = np.random.default_rng(3)
    ta, tb = np.sort(rng.integers(0, 1000, 300)), np.sort(rng.integers(0, 1000, 1200))
    unit, b = [ta, rng.random(300), tb, rng.random(1200)], tallies.Slid(None, "a", "b", ((1, 50), (-1, -70)), 90)
    every = np.sort(np.concatenate([*tallies.statistics(unit, b)]))
    want = sorted(np.sqrt(x + y) for s, x in zip(ta, unit[1], strict=True) for t, y in zip(tb, unit[3], strict=True) for o in (50, -70) if abs(s - t - o) < 90)
    assert every.tolist() == want
    for lo, hi in ((-np.inf, np.inf), (0.4, 0.7), (-np.inf, 0.5), (0.9, np.inf)):
        found = np.sort(np.concatenate([*tallies.statistics_between(unit, b, lo, hi)]))
        assert found.tolist() == every[(every > lo) & (every <= hi)].tolist()


def test_summary_and_thresholds_equal_those_of_the_listed_background(both):
    _, listed, unlisted = both
    assert ranking.summary(unlisted).collect() == ranking.summary(listed).collect()
    for place in (1, 7, 10**9):
        assert ranking.threshold_for(unlisted, float(place), 1.0).collect() == ranking.threshold_for(listed, float(place), 1.0).collect()
    none = dataclasses.replace(unlisted, ifo_b="none")
    assert ranking.summary(none).first().asDict() == {"n": 0, "loudest": 0.0, "median": None}
    assert ranking.threshold_for(none, 1.0, 1.0).first()[0] == 0.0


def test_counts_and_loudest_by_offset(both):
    _, listed, unlisted = both
    want = listed.groupBy("slide", "offset_us").agg(F.count(F.lit(1)).alias("n"), F.max("network_stat").alias("loudest"))
    assert sorted(tallies.by_offset(unlisted).collect()) == sorted(want.collect())
    plan = tallies.by_offset(unlisted)._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("looks", [1, 4])
def test_loudest_first_deduplication_equals_the_general_one(spark, looks):
    rng = np.random.default_rng(looks)
    times = np.concatenate([rng.integers(-5_000, 5_000, 300), rng.integers(100, 160, 200)]).tolist()
    rows = [(float(s), t, "1", i, -i) for i, (s, t) in enumerate(zip(rng.integers(0, 40, 500).tolist(), times, strict=True))] + [(1.0, None, "1", 900, 1), (2.0, None, "1", 901, 1), (float("nan"), 3, "1", 902, 1)]
    given = spark.createDataFrame(rows, "network_stat double, gps_us long, template_id string, event_id_a long, event_id_b long")
    ids = lambda df: sorted(r.event_id_a for r in df.collect())
    want = ids(candidates.deduplicate(given.filter("not isnan(network_stat)").withColumn("far_hz", F.lit(None).cast("double")), 50))
    assert ids(candidates.deduplicate_loudest(given, 50, looks)) == want


def test_places_of_candidates_are_made_without_a_background(spark, sf, monkeypatch):
    want = sorted(tuple(r) for r in candidates.placed(registry._candidates(spark, sf)).select("event_id_a", "event_id_b", "place").collect())
    monkeypatch.setattr(registry, "_slid", None)
    monkeypatch.setattr(registry, "_unlisted", None)
    assert sorted(tuple(r) for r in registry.a21_ordered_candidates(spark, sf).collect()) == want


def test_batches_of_a_background_are_appended_without_its_pairs(spark, sf, monkeypatch):
    from tallybeam.plans import run_state

    monkeypatch.setattr(background, "slid_pairs", None)
    assert sum(r.n for r in run_state.r11_background_in_batches(spark, sf).collect()) > 0


@pytest.mark.parametrize("scale", [1.0, 1e153])
def test_known_and_new_pairs_are_counted_without_listing_them(spark, scale, monkeypatch):
    """Against the listed pairs: windows that cross stretches, negative and equal times, ends of tolerances, and squares that overflow."""
    rng = np.random.default_rng(4)
    rows = [("HL"[i % 2], int(t), "xy"[i % 3 % 2], scale * float(s), i) for i, (t, s) in enumerate(zip(rng.integers(-3_000, 3_000, 900), rng.integers(3, 15, 900), strict=True))]
    t = spark.createDataFrame([*rows, ("H", None, "x", 1.0, -1), ("L", 5, "x", None, -2)], "ifo string, gps_us long, template_id string, new_snr double, event_id long").withColumn("rchisq", F.lit(0.0))
    times = [*rng.integers(-4_000, 4_000, 60).tolist(), 100, 100, 107, None]
    catalogue = spark.createDataFrame([("e", x) for x in times], "name string, cat_us long")
    listed = coincidence.pairs(t, "H", "L", 70)
    near = F.lit(False)
    for x in times:
        near = near | (F.abs(F.col("gps_us") - x) <= 9) if x is not None else near
    kept = listed.filter(F.col("network_stat") < float("inf")).withColumn("known", near)
    want = kept.groupBy("known").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("network_stat") > 14 * scale).alias("n_loud"), F.max("network_stat").alias("loudest")).collect()
    monkeypatch.setattr(coincidence, "pairs", None)
    got = tallies.known_and_new(tallies.coincident(t, "H", "L", 70), catalogue, "cat_us", 9, 14 * scale).collect()
    assert sorted(got) == sorted(want) and len(want) == 2
    assert scale > 1 or min(r.n_loud for r in want) > 0


def test_p07_makes_no_pairs(spark, sf, monkeypatch):
    monkeypatch.setattr(registry, "_coincidences", None)
    assert sum(r.n for r in registry.p07_p09_p12_known_and_new(spark, sf).collect()) > 0


@pytest.mark.parametrize("block", [1 << 20, 50])
def test_distribution_is_numbered_without_writing_the_pairs(spark, monkeypatch, block):
    rng = np.random.default_rng(5)
    rows = [("HL"[i % 2], int(t), "x", float(s), i) for i, (t, s) in enumerate(zip(rng.integers(0, 3_000, 300), [*rng.integers(1, 5, 200), *rng.random(99), 1e200], strict=True))]
    t = spark.createDataFrame(rows, "ifo string, gps_us long, template_id string, new_snr double, event_id long")
    slides = spark.createDataFrame([(1, 500), (-1, -500)], "slide long, offset_us long")
    want = [(r.place, r.network_stat) for r in ranking.distribution(background.slid_pairs(t, "H", "L", slides, 100)).orderBy("place").collect()]
    monkeypatch.setattr(tallies, "BLOCK", block)
    monkeypatch.setattr(ranking, "materialise", None)
    monkeypatch.setattr(ranking, "running", None)
    got = [(r.place, r.network_stat) for r in ranking.distribution(tallies.slid(t, "H", "L", slides, 100)).orderBy("place").collect()]
    assert got == want and len(want) > 1_000
