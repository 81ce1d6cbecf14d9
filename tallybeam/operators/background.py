"""Background by time slides, and ranking against it.

All slides are one join: the shifted side is repeated per offset (a literal relation of bounded size) and the slide becomes a join key,
so there is no loop over slides and every slide is spread over the cluster.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybeam.functions.scalars import network_stat
from tallybeam.operators import ranks, remade, tallies
from tallybeam.operators.coincidence import side
from tallybeam.operators.intervals import range_join, spread, time_bin
from tallybeam.scratch import materialise


#: Pairs of a subset at least.
LEAST_PAIRS = 100


def offsets(spark: SparkSession, slides: int, spacing_us: int) -> DataFrame:
    """slide, offset_us: +-k * spacing for k = 1..slides, never 0."""
    k = spark.range(1, slides + 1).select(F.explode(F.array(F.col("id"), -F.col("id"))).alias("slide"))
    return k.select("slide", (F.col("slide") * spacing_us).alias("offset_us"))


def offsets_subset(spark: SparkSession, step_us: int, most_us: int, slides: int) -> DataFrame:
    """slide, offset_us: the alternating list +1, -1, +2, -2 ... steps up to most_us, thinned to `slides` by evenly spaced index, then sorted."""
    n = 2 * (most_us // step_us)
    index = F.col("id") if n <= slides else F.floor(F.col("id") * (n - 1) / (slides - 1)) if slides > 1 else F.lit(0)
    picked = spark.range(min(n, slides)).select(index.cast("long").alias("i"))
    value = (F.floor(F.col("i") / 2) + 1) * F.when(F.col("i") % 2 == 0, 1).otherwise(-1) * step_us
    found = picked.select(value.cast("long").alias("offset_us"))
    return found.select((F.row_number().over(Window.orderBy("offset_us")) - 1).cast("long").alias("slide"), "offset_us")


def offset_pairs(single: DataFrame, strategy: str, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """offset_1, offset_2 of a list of offsets: full_grid, diagonal, or subset (a seeded draw of a fraction of the grid without repeats, 100 at least)."""
    a = single.select(F.col("offset_us").alias("offset_1"))
    if strategy == "diagonal":
        return a.withColumn("offset_2", F.col("offset_1"))
    if strategy == "full_grid":
        listed = single.agg(F.sort_array(F.collect_list("offset_us")).alias("all"))  # a parameter list, not data
        return listed.select(F.explode("all").alias("offset_1"), "all").select("offset_1", F.explode("all").alias("offset_2"))
    if strategy == "subset":
        listed = sorted(r[0] for r in single.select("offset_us").collect())  # a parameter list, not data
        total = len(listed) ** 2
        drawn = np.random.RandomState(seed).choice(total, size=min(total, max(LEAST_PAIRS, int(total * fraction))), replace=False)
        return single.sparkSession.createDataFrame([(listed[i // len(listed)], listed[i % len(listed)]) for i in drawn.tolist()], "offset_1 long, offset_2 long")
    raise ValueError(f"unknown strategy: {strategy}")


def slide_estimate(most: float, step: float, strategy: str, fraction: float = 1.0) -> int:
    n = int(2 * most / step)
    return {"full_grid": n * n, "subset": int(n * n * fraction)}.get(strategy, n)


def slid_pairs(triggers: DataFrame, ifo_a: str, ifo_b: str, slides: DataFrame, window_us: int, same_template: bool = True, strict: bool = True) -> DataFrame:
    """slide, offset_us, template_id, event ids and network_stat of coincidences with ifo_b shifted by each offset."""
    a = side(triggers, ifo_a, "a", ("gps_us", "new_snr", "template_id", "event_id"))
    b = side(triggers, ifo_b, "b", ("gps_us", "new_snr", "template_id", "event_id")).crossJoin(F.broadcast(slides))  # the offsets are parameters
    b = b.withColumn("gps_us_b", F.col("gps_us_b") + F.col("offset_us"))
    on = [("template_id_a", "template_id_b")] if same_template else []
    joined = range_join(a, b, "gps_us_a", "gps_us_b", window_us, on, strict, both_grow=True)
    return joined.select("slide", "offset_us", F.col("template_id_a").alias("template_id"), "event_id_a", "event_id_b", network_stat(F.col("new_snr_a"), F.col("new_snr_b")).alias("network_stat"))


def slid_triples(triggers: DataFrame, ifos: tuple[str, str, str], pairs: DataFrame, windows_us: tuple[int, int, int]) -> DataFrame:
    """offset_1, offset_2, event ids and network_stat of three-sensor coincidences with the second and third sensor shifted independently.

    The first sensor's triggers are repeated by offset too, so both joins go by the same keys and bin, and no pair is shuffled.
    """
    keep = ("gps_us", "new_snr", "template_id", "event_id")
    a, b, c = (side(triggers, ifo, s, keep) for ifo, s in zip(ifos, "abc", strict=True))
    bins = ("_bin", max(1, *windows_us[:2]))
    first = pairs.select("offset_1").distinct()
    a = spread(a.crossJoin(F.broadcast(first)).withColumn("_bin", time_bin(F.col("gps_us_a"), bins[1])), "_bin", "template_id_a", "offset_1")
    b = b.crossJoin(F.broadcast(first.withColumnRenamed("offset_1", "o_b"))).withColumn("gps_us_b", F.col("gps_us_b") + F.col("o_b"))
    c = c.crossJoin(F.broadcast(pairs.select(F.col("offset_1").alias("o1"), "offset_2"))).withColumn("gps_us_c", F.col("gps_us_c") + F.col("offset_2"))
    two = range_join(a, b, "gps_us_a", "gps_us_b", windows_us[0], [("template_id_a", "template_id_b"), ("offset_1", "o_b")], both_grow=True, bins=bins)
    three = range_join(two, c, "gps_us_a", "gps_us_c", windows_us[1], [("template_id_a", "template_id_c"), ("offset_1", "o1")], both_grow=True, bins=bins)
    three = three.filter(F.abs(F.col("gps_us_b") - F.col("gps_us_c")) <= windows_us[2])
    return three.select("offset_1", "offset_2", "event_id_a", "event_id_b", "event_id_c", network_stat(F.col("new_snr_a"), F.col("new_snr_b"), F.col("new_snr_c")).alias("network_stat"))


def append(slid: DataFrame, path: str, batch: str) -> None:
    """Add a batch's background to the table at path; a batch that is written again replaces what it wrote before."""
    slid.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def appended(spark: SparkSession, path: str) -> DataFrame:
    """The backgrounds of all batches, with batch."""
    return spark.read.parquet(path)


def excise(triggers: DataFrame, loud: DataFrame, half_width_us: int) -> DataFrame:
    """Triggers that are half_width_us or more from all loud times (column loud_us)."""
    return range_join(triggers, loud.select("loud_us").distinct(), "gps_us", "loud_us", half_width_us, strict=True, how="left_anti")


def count_louder(foreground: DataFrame | tallies.Slid, background: DataFrame | tallies.Slid, stat: str = "network_stat") -> DataFrame:
    """foreground with n_louder (background rows of a statistic >= its own) and n_background.

    If neither side is listed, operators.remade makes the foreground's pairs as it counts: event_id_a, event_id_b, network_stat and both counts of those of a finite statistic.
    A background that is not listed yet is counted by operators.tallies, which writes neither side. Otherwise:
    The foreground's rows are written once. If they have few different values (ranks.MOST_ASKED at most), the background passes by a sorted array of them and leaves
    counts only; otherwise its values are counted and written, and both meet range by range (operators.ranks). Either way rows get their ranks by an
    equality join, and equal values need no order. Null and NaN background values are louder than nothing but belong to n_background; a null or NaN foreground value has n_louder 0.
    """
    if isinstance(foreground, tallies.Slid):
        return remade.count_louder(foreground, background)
    if isinstance(background, tallies.Slid):
        return tallies.count_louder(foreground, background, stat)
    value = F.when(F.isnan(stat), None).otherwise(F.col(stat)).cast("double")
    rows = materialise(foreground.select(F.struct(*[F.col(f"`{c}`") for c in foreground.columns]).alias("_row"), value.alias("_v")), "foreground")
    asked = rows.select(F.col("_v").alias("v")).filter("v is not null").distinct()
    heard = background.select(value.alias("v"))
    known = np.sort(asked.limit(ranks.MOST_ASKED + 1).toArrow().column(0).to_numpy())
    if len(known) <= ranks.MOST_ASKED:
        n_background, louder = ranks.at_least_of_few(heard, known)
        found = background.sparkSession.createDataFrame(louder, "v double, louder long")
    else:
        counts = materialise(heard.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "louder")
        n_background = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        numbers = counts.filter("v is not null")
        found = ranks.at_least(numbers, asked, ranks.bounds(numbers))
    out = rows.join(found, F.col("_v") == F.col("v"), "left")
    return out.select("_row.*", F.coalesce("louder", F.lit(0)).cast("long").alias("n_louder"), F.lit(n_background).cast("long").alias("n_background"))
