"""Template banks: relations generated from parameters."""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Component masses of the events that the multi-event bank covers.
EVENT_MASSES = [(36.2, 29.1), (14.2, 7.5), (31.2, 19.4), (50.6, 34.3), (35.5, 23.9), (30.5, 25.3), (1.46, 1.27)]


def stepped(spark: SparkSession, name: str, lo: float, hi: float, step: float) -> DataFrame:
    """i, name: lo, lo + step ... up to hi (with slack), rounded to three places."""
    n = max(-1, math.floor((hi - lo) / step + 1e-9))
    return spark.range(n + 1).select(F.col("id").alias(f"i_{name}"), F.round(F.lit(lo) + F.col("id") * F.lit(step), 3).alias(name))


def grid_step(lo: float, hi: float, mismatch: float, quick: bool, cap: int) -> float:
    return max(1.0, (hi - lo) / max(cap**0.5, 2)) if quick else max(0.3, math.sqrt(mismatch) * 5.0)


def grid_bank(spark: SparkSession, lo1: float, hi1: float, lo2: float, hi2: float, mismatch: float = 0.03, approximant: str = "SEOBNRv4", f_lower: float = 30.0, spins: list[float] | None = None, quick: bool = False, cap: int = 50, least_total: float = 4.0) -> DataFrame:
    """template_id, mass1 >= mass2, spins: the product of two mass grids and two spin grids in order of generation.

    Swapping keeps duplicates, as template ids are positions. The product is of parameter lists.
    """
    step = grid_step(lo1, hi1, mismatch, quick, cap)
    spins = spins or [0.0]
    n = len(spins)
    a, b = stepped(spark, "m1", lo1, hi1, step), stepped(spark, "m2", lo2, hi2, step)
    rows = a.crossJoin(F.broadcast(b)).select("i_m1", "i_m2", F.greatest("m1", "m2").alias("mass1"), F.least("m1", "m2").alias("mass2")).filter(F.col("mass1") + F.col("mass2") >= least_total)
    pairs = F.array(*[F.struct(F.lit(i * n + j).alias("i"), F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for i, x in enumerate(spins) for j, y in enumerate(spins)])
    rows = rows.select("*", F.explode(pairs).alias("s"))
    order = (F.col("i_m1") * 1_000_000 + F.col("i_m2")) * n * n + F.col("s.i")
    out = rows.select(order.alias("gen"), "mass1", "mass2", F.col("s.x").alias("spin1z"), F.col("s.y").alias("spin2z"), F.lit(approximant).alias("approximant"), F.lit(f_lower).alias("f_lower"))
    return out.orderBy("gen").limit(cap) if quick else out


def linspace(lo, hi, n: int, i):
    return lo + i * ((hi - lo) / (n - 1)) if n > 1 else lo + i * 0


def square_bank(spark: SparkSession, centres: list[tuple[float, float]], margin: float, n: int) -> DataFrame:
    """For each centre an n x n grid of +-margin with mass1 >= mass2."""
    c = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(centres)], "centre int, c1 double, c2 double")
    steps = F.sequence(F.lit(0), F.lit(n - 1))
    g = c.select("*", F.explode(steps).alias("i")).select("*", F.explode(steps).alias("j"))
    m1 = linspace(F.col("c1") * (1 - margin), F.col("c1") * (1 + margin), n, F.col("i"))
    m2 = linspace(F.col("c2") * (1 - margin), F.col("c2") * (1 + margin), n, F.col("j"))
    return g.select("centre", "i", "j", m1.alias("mass1"), m2.alias("mass2")).filter("mass1 >= mass2")


def targeted_bank(spark: SparkSession, n: int = 10) -> DataFrame:
    return square_bank(spark, [(36.2, 29.1)], 0.2, n).select("mass1", "mass2", F.lit(0.0).alias("spin1z"), F.lit(0.0).alias("spin2z"), F.lit("IMRPhenomD").alias("approximant"), F.lit(15.0).alias("f_lower"))


def moderate_bank(spark: SparkSession, lo: float, hi: float, templates: int = 500) -> DataFrame:
    """int(sqrt(2 N)) masses per dimension, mass1 >= mass2."""
    n = int(math.sqrt(2 * templates))
    steps = spark.range(n).select(linspace(F.lit(lo), F.lit(hi), n, F.col("id")).alias("m"))
    a, b = steps.select(F.col("m").alias("mass1")), steps.select(F.col("m").alias("mass2"))
    return a.crossJoin(F.broadcast(b)).filter("mass1 >= mass2")


def multi_event_bank(spark: SparkSession, events: list[tuple[float, float]] | None = None, margin: float = 0.15, points: int = 64) -> DataFrame:
    total = F.col("mass1") + F.col("mass2")
    grid = square_bank(spark, events or EVENT_MASSES, margin, int(math.sqrt(points)))
    return grid.select("centre", "mass1", "mass2", F.when(total < 3.0, "TaylorF2").otherwise("IMRPhenomD").alias("approximant"), F.when(total > 3.0, 15.0).otherwise(20.0).alias("f_lower"))


def stochastic_bank(spark: SparkSession, lo1: float, hi1: float, lo2: float, hi2: float, min_match: float = 0.97, iterations: int = 100_000, least_total: float = 2.0, most_total: float = 100.0, least_ratio: float = 0.05, seed: int = 42) -> DataFrame:
    """Sequential placement: a proposal is accepted if it is far enough from all that were accepted.

    The choice depends on the proposals before, so a bank (a parameter list of some hundred rows) is placed on the driver.
    """
    import numpy as np

    draw = np.random.RandomState(seed).uniform
    def point(a: float, b: float) -> tuple[float, float]:
        eta = a * b / (a + b) ** 2
        return (a + b) * eta**0.6, eta

    limit = math.sqrt(1 - min_match) * 0.5
    kept = [((lo1 + hi1) / 2, (lo2 + hi2) / 2)]
    mc, eta = (np.array([v]) for v in point(*kept[0]))
    refused = 0
    for _ in range(iterations):
        x, y = draw(lo1, hi1), draw(lo2, hi2)
        a, b = max(x, y), min(x, y)
        inside = lo1 <= a <= hi1 and lo2 <= b <= hi2 and least_total <= a + b <= most_total and b / a >= least_ratio
        m, e = point(a, b)
        if not inside or np.hypot((m - mc) / mc, 10 * (e - eta)).min() < limit:
            refused += 1
            continue
        kept.append((a, b))
        mc, eta = np.append(mc, m), np.append(eta, e)
        if refused > 1000 and len(kept) < 6:  # looked at after an acceptance only
            break
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(kept)], "template_id int, mass1 double, mass2 double")


def stored(spark: SparkSession, path: str, approximant: str = "IMRPhenomD", f_lower: float = 20.0, keep: list[str] = ()) -> DataFrame:
    """mass1, mass2, spin1z, spin2z, approximant, f_lower and the columns to keep of a bank in a Parquet table; spins that the table or a row does not have are 0."""
    rows = spark.read.parquet(path)
    spin = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in rows.columns else F.lit(0.0).alias(c)
    return rows.select(F.col("mass1").cast("double").alias("mass1"), F.col("mass2").cast("double").alias("mass2"), spin("spin1z"), spin("spin2z"), F.lit(approximant).alias("approximant"), F.lit(float(f_lower)).alias("f_lower"), *keep)


def described(bank: DataFrame, kind: str, **parameters) -> DataFrame:
    """One row about a bank: kind, n_templates, the least and largest masses, the parameters as JSON and their hash."""
    bounds = [f(c).alias(f"{name}_{c}") for c in ("mass1", "mass2") for f, name in ((F.min, "least"), (F.max, "largest"))]
    known = F.lit(json.dumps(parameters, sort_keys=True))
    return bank.agg(F.count(F.lit(1)).alias("n_templates"), *bounds).select(F.lit(kind).alias("kind"), "*", known.alias("parameters"), F.lit(content_hash({"kind": kind, **parameters})).alias("hash"))


def build(spark: SparkSession, method: str, mass1: tuple[float, float], mass2: tuple[float, float], min_match: float = 0.97, mismatch: float = 0.03, f_lower: float = 20.0, quick: bool = False, cap: int = 256, spins: list[float] | None = None, path: str | None = None) -> DataFrame:
    """The bank of a method: stochastic, grid, targeted, moderate, multi_event or stored."""
    if method == "stochastic":
        return stochastic_bank(spark, *mass1, *mass2, min_match)
    if method == "grid":
        return grid_bank(spark, *mass1, *mass2, mismatch, f_lower=f_lower, spins=spins or None, quick=quick, cap=cap)
    if method == "targeted":
        return targeted_bank(spark)
    if method == "moderate":
        return moderate_bank(spark, min(mass1[0], mass2[0]), max(mass1[1], mass2[1]))
    if method == "multi_event":
        return multi_event_bank(spark)
    if method == "stored" and path:
        return stored(spark, path, f_lower=f_lower)
    raise ValueError(f"unknown bank method: {method}")


def content_hash(parameters: dict) -> str:
    """SHA-256 of the parameters as sorted compact JSON: the key of a cached bank or a configuration."""
    return hashlib.sha256(json.dumps(parameters, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def physical(bank: DataFrame, lo1: float, hi1: float, lo2: float, hi2: float, least_total: float = 2.0, most_total: float = 100.0, least_ratio: float = 0.05) -> DataFrame:
    """Templates that satisfy order, mass, total mass and mass ratio bounds."""
    a, b = F.col("mass1"), F.col("mass2")
    return bank.filter((a >= b) & a.between(lo1, hi1) & b.between(lo2, hi2) & (a + b).between(least_total, most_total) & (b / a >= least_ratio))


def cached(spark: SparkSession, folder: str, parameters: dict, build) -> DataFrame:
    """The bank of these parameters from its table under the folder, built and written if it is missing."""
    path = f"{folder}/bank-{content_hash(parameters)}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
