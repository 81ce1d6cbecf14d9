"""Ranks, rates and observing times of candidates against a background."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybeam.functions import scalars as S
from tallybeam.operators import ranks, remade, tallies, triples
from tallybeam.operators.background import count_louder
from tallybeam.scratch import materialise, release, running


def summary(background: DataFrame | tallies.Slid, stat: str = "network_stat") -> DataFrame:
    """One row: n of the statistics that are numbers, loudest (0 if none), median; exact, by the ranges of the two middle places. A background that is not listed is counted by operators.tallies."""
    if isinstance(background, tallies.Slid):
        n, found = tallies.order_statistics(tallies.units(background), background, lambda n: sorted({0, (n - 1) // 2, n // 2}) if n else [])
        median = (found[(n - 1) // 2] + found[n // 2]) / 2 if n else None
        return background.triggers.sparkSession.range(1).select(F.lit(n).cast("long").alias("n"), F.lit(found.get(0, 0.0)).alias("loudest"), F.lit(median).cast("double").alias("median"))
    values = materialise(ranks.counted(background, F.col(stat)), "statistics")
    n, loudest = values.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("v"), F.lit(0.0))).first()
    middle = ranks.at_places(values, [(n - 1) // 2, n // 2] if n else [], ranks.bounds(values))
    median = (middle[(n - 1) // 2] + middle[n // 2]) / 2 if n else None
    release(values)
    return background.sparkSession.range(1).select(F.lit(n).cast("long").alias("n"), F.lit(loudest).alias("loudest"), F.lit(median).cast("double").alias("median"))


def distribution(background: DataFrame | tallies.Slid, stat: str = "network_stat") -> DataFrame:
    """stat, place: all finite statistics, loudest first, numbered from 0. A background that is not listed is numbered by operators.remade."""
    if isinstance(background, tallies.Slid):
        return remade.distribution(background, stat)
    values = background.filter(S.finite(F.col(stat))).select(F.col(stat), F.lit(1).alias("_one"), F.monotonically_increasing_id().alias("_row"))
    return running(materialise(values, "statistics"), [F.col(stat).desc(), F.col("_row")], {"place": "_one"}).select(stat, F.col("place").cast("long").alias("place"))


def rate(background: DataFrame, slides: int, duration_s: float) -> DataFrame:
    """One row: n, trials_s, far_hz = n / trials (null without samples), ifar_days."""
    trials = float(2 * slides * duration_s)
    n = F.count(F.lit(1))
    far = F.when(n > 0, n / F.lit(trials))
    return background.agg(n.alias("n"), F.lit(trials).alias("trials_s"), far.alias("far_hz")).withColumn("ifar_days", S.ifar_days(F.col("far_hz")))


def with_far(candidates: DataFrame, background: DataFrame | tallies.Slid, trials_s: float) -> DataFrame:
    """candidates with n_louder, far_hz, ifar_days."""
    return with_rates(count_louder(candidates.filter(S.finite(F.col("network_stat"))), background), trials_s)


def with_rates(counted: DataFrame, trials_s: float) -> DataFrame:
    """Rows with n_louder, and far_hz and ifar_days by it."""
    counted = counted.withColumn("far_hz", S.far_hz(F.col("n_louder"), F.lit(trials_s)))
    return counted.withColumn("ifar_days", S.ifar_days(F.col("far_hz")))


def ranked(candidates: DataFrame | tallies.Slid, background: DataFrame | tallies.Slid, trials_s: float, slides: int = 1, p_value: str = "empirical") -> DataFrame:
    """Candidates of a finite statistic with n_louder, far_hz, ifar_years, p_value, sigma.

    Candidates that are not listed come with their event ids and statistics.
    p_value: empirical, (louder + 1) / (n + 1); poisson, 1 - exp(-rate * trials / slides); or search, with trials / n for the time.
    Without trials (or, but for empirical, without samples) the rate is infinite, its inverse 0 and the p-value 1.
    """
    valid = candidates if isinstance(candidates, tallies.Slid) else candidates.filter(S.finite(F.col("network_stat")))
    return _rated(count_louder(valid, background), trials_s, slides, p_value)


def ranked_triples(candidates: triples.Three, background: triples.Three, trials_s: float, slides: int = 1, p_value: str = "empirical") -> DataFrame:
    """What ranked() gives for triples of three sensors, of which neither side is listed before."""
    return _rated(triples.count_louder(candidates, background), trials_s, slides, p_value)


def _rated(c: DataFrame, trials_s: float, slides: int, p_value: str) -> DataFrame:
    """Counted candidates with their rates, p-values and significances."""
    n = F.col("n_background")
    none = (F.lit(trials_s) == 0) if p_value == "empirical" else (F.lit(trials_s) == 0) | (n == 0)
    c = c.withColumn("far_hz", F.when(none, float("inf")).otherwise(S.far_hz(F.col("n_louder"), F.lit(float(trials_s)))))
    c = c.withColumn("ifar_years", F.when(none, 0.0).otherwise(1.0 / (F.col("far_hz") * S.YEAR_S)))
    observed = F.lit(float(trials_s)) / max(1, slides) if p_value == "poisson" else F.try_divide(F.lit(float(trials_s)), n)
    p = S.empirical_p(F.col("n_louder"), n) if p_value == "empirical" else S.poisson_p(F.col("far_hz"), observed)
    c = c.withColumn("p_value", F.when(none & (n == 0), 1.0).otherwise(p))
    return c.withColumn("sigma", F.when(F.col("p_value") >= 1, 0.0).otherwise(S.sigma(F.col("p_value"))))


def observing_time(triggers: DataFrame, per_sensor: bool) -> DataFrame:
    """One row, seconds: the span of all triggers, or the least span of sensors with two or more; 0 otherwise."""
    if not per_sensor:
        n = F.count(F.lit(1))
        return triggers.agg(F.when(n < 2, 0.0).otherwise((F.max("gps_us") - F.min("gps_us")) / 1e6).alias("seconds"))
    spans = triggers.groupBy("ifo").agg(F.count(F.lit(1)).alias("n"), ((F.max("gps_us") - F.min("gps_us")) / 1e6).alias("span")).filter("n >= 2")
    return spans.agg(F.coalesce(F.min("span"), F.lit(0.0)).alias("seconds"))


def threshold_for(background: DataFrame | tallies.Slid, far_per_year: float, years: float, stat: str = "network_stat") -> DataFrame:
    """One row: the n-th loudest statistic that is a number, n = max(1, int(far * years)); the least one if there are fewer, 0 if none.

    Exact for any n: only the range of values that holds the place is sorted. A background that is not listed is counted by operators.tallies.
    """
    if isinstance(background, tallies.Slid):
        _, found = tallies.order_statistics(tallies.units(background), background, lambda n: [min(max(1, int(far_per_year * years)), n) - 1] if n else [])
        return background.triggers.sparkSession.range(1).select(F.lit(next(iter(found.values()), 0.0)).cast("double").alias("threshold"))
    values = materialise(ranks.counted(background, F.col(stat)), "statistics")
    total = values.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    place = min(max(1, int(far_per_year * years)), total) - 1
    found = ranks.at_places(values, [place] if total else [], ranks.bounds(values))
    release(values)
    return background.sparkSession.range(1).select(F.lit(found.get(place, 0.0)).cast("double").alias("threshold"))
