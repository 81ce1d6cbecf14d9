"""Coincidences: interval joins of triggers across two or three sensors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybeam.functions.scalars import finite, network_stat
from tallybeam.operators.intervals import range_join, spread, time_bin

SIDE = ("gps_us", "new_snr", "rchisq", "template_id", "event_id")


def side(triggers: DataFrame, ifo: str, suffix: str, keep: tuple[str, ...] = SIDE) -> DataFrame:
    """One sensor's triggers with suffixed column names."""
    return triggers.filter(F.col("ifo") == ifo).select(*(F.col(c).alias(f"{c}_{suffix}") for c in keep))


def pairs(triggers: DataFrame, ifo_a: str, ifo_b: str, window_us: int, same_template: bool = True, drop_broken: bool = False, strict: bool = False) -> DataFrame:
    """gps_us (mean, floored), dt_us, template_id of a, both sides' values and network_stat.

    The window includes its end unless strict. Broken ratios count as 0, or drop the row if drop_broken.
    """
    a, b = side(triggers, ifo_a, "a"), side(triggers, ifo_b, "b")
    if drop_broken:
        a, b = a.filter(finite(F.col("new_snr_a"))), b.filter(finite(F.col("new_snr_b")))
    on = [("template_id_a", "template_id_b")] if same_template else []
    joined = range_join(a, b, "gps_us_a", "gps_us_b", window_us, on, strict, both_grow=True)
    return joined.select(
        F.concat(F.lit(ifo_a), F.lit(","), F.lit(ifo_b)).alias("ifos"),
        F.floor((F.col("gps_us_a") + F.col("gps_us_b")) / 2).cast("long").alias("gps_us"),
        (F.col("gps_us_a") - F.col("gps_us_b")).alias("dt_us"),
        F.col("template_id_a").alias("template_id"),
        "event_id_a",
        "event_id_b",
        "new_snr_a",
        "new_snr_b",
        "rchisq_a",
        "rchisq_b",
        network_stat(F.col("new_snr_a"), F.col("new_snr_b")).alias("network_stat"),
    )


def all_pairs(triggers: DataFrame, ifos: list[str], windows_us: dict[tuple[str, str], int], **options) -> DataFrame:
    """Every unordered pair of sensors; a pair without a window of its own gets the widest."""
    widest = max(windows_us.values())
    out = None
    for i, a in enumerate(ifos):
        for b in ifos[i + 1 :]:
            found = pairs(triggers, a, b, windows_us.get((a, b), windows_us.get((b, a), widest)), **options)
            out = found if out is None else out.unionByName(found)
    if out is None:  # fewer than two sensors
        return pairs(triggers.limit(0), "", "", widest, **options)
    return out


def triples(triggers: DataFrame, ifos: tuple[str, str, str], windows_us: tuple[int, int, int]) -> DataFrame:
    """Same template in three sensors, all three pairs within their own windows (0-1, 0-2, 1-2); broken ratios drop the row.

    Both joins go by one bin of the first sensor's time, so triggers are shuffled and pairs are not.
    """
    keep = ("gps_us", "new_snr", "template_id", "event_id")
    a, b, c = (side(triggers, ifo, s, keep).filter(finite(F.col(f"new_snr_{s}"))) for ifo, s in zip(ifos, "abc", strict=True))
    bins = ("_bin", max(1, *windows_us[:2]))
    a = spread(a.withColumn("_bin", time_bin(F.col("gps_us_a"), bins[1])), "_bin", "template_id_a")
    two = range_join(a, b, "gps_us_a", "gps_us_b", windows_us[0], [("template_id_a", "template_id_b")], both_grow=True, bins=bins)
    three = range_join(two, c, "gps_us_a", "gps_us_c", windows_us[1], [("template_id_a", "template_id_c")], both_grow=True, bins=bins)
    three = three.filter(F.abs(F.col("gps_us_b") - F.col("gps_us_c")) <= windows_us[2])
    return three.select(
        F.floor((F.col("gps_us_a") + F.col("gps_us_b") + F.col("gps_us_c")) / 3).cast("long").alias("gps_us"),
        (F.col("gps_us_a") - F.col("gps_us_b")).alias("dt_01"),
        (F.col("gps_us_a") - F.col("gps_us_c")).alias("dt_02"),
        (F.col("gps_us_b") - F.col("gps_us_c")).alias("dt_12"),
        F.col("template_id_a").alias("template_id"),
        "event_id_a",
        "event_id_b",
        "event_id_c",
        network_stat(F.col("new_snr_a"), F.col("new_snr_b"), F.col("new_snr_c")).alias("network_stat"),
    )


def find(triggers: DataFrame, ifos: list[str], windows_us: dict[tuple[str, str], int], same_template: bool = True) -> DataFrame:
    """Coincidences of all given sensors, by their number: none for fewer than two, pairs for two, triples (of one template) for three."""
    ifos = sorted(ifos)
    widest = max(windows_us.values())
    window = lambda a, b: windows_us.get((a, b), windows_us.get((b, a), widest))
    if len(ifos) < 2:
        return pairs(triggers.limit(0), "", "", widest)
    if len(ifos) == 2:
        return pairs(triggers, *ifos, window(*ifos), same_template, drop_broken=True)
    if len(ifos) == 3:
        return triples(triggers, tuple(ifos), (window(ifos[0], ifos[1]), window(ifos[0], ifos[2]), window(ifos[1], ifos[2])))
    raise ValueError(f"{len(ifos)} sensors: two or three can be searched together")
