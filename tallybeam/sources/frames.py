"""Series files: names carry their time range, and requests are cut to what a file has."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybeam.operators.intervals import range_join, time_bin
from tallybeam.scratch import materialise

PAD_S, LEAST_S, MOST_S, FILE_S = 32, 64, 6000, 4096
#: Seconds that a discovered end stays fresh, and the time that stands in where nothing is known.
CACHE_S, KNOWN_S = 1800.0, 1126259462.4
NAME = r"-([0-9]+)-([0-9]+)\.(gwf|hdf5)$"
#: Observing runs (name, start, end) in GPS seconds.
RUNS = [
    ("O1", 1126051217.0, 1137254417.0), ("O2", 1164556817.0, 1187733618.0), ("O3a", 1238166018.0, 1253977218.0), ("O3b", 1256655618.0, 1269363618.0),
    ("O4a", 1368195220.0, 1389456018.0), ("O4b1Disc", 1412722688.0, 1412726784.0), ("O4b2Disc", 1415274496.0, 1415278592.0), ("O4b3Disc", 1420877824.0, 1420881920.0),
]
#: Name, latitude, longitude (degrees), elevation (m) of the detectors.
DETECTORS = [("H1", 46.45515, -119.40835, 142.554), ("L1", 30.56290, -90.77420, -6.574), ("V1", 43.63124, 10.50494, 51.884)]


class Ranges:
    """Time ranges of a listing for a control loop, which asks by binary search: the starts in order, and the latest end of all ranges up to each."""

    def __init__(self, ranges: Iterable[tuple[float, float]]):
        ordered = sorted(ranges)
        self.starts = [a for a, _ in ordered]
        self.ends = [*accumulate((b for _, b in ordered), max)]

    def holds(self, start: float, end: float) -> bool:
        """One range has all of start to end."""
        i = bisect_right(self.starts, start)
        return i > 0 and self.ends[i - 1] >= end

    def meets(self, start: float, end: float) -> bool:
        """One range overlaps [start, end)."""
        i = bisect_left(self.starts, end)
        return i > 0 and self.ends[i - 1] > start

    def latest_end(self, before: float) -> float | None:
        """The latest end of the ranges that start before a time; None if none does."""
        i = bisect_left(self.starts, before)
        return self.ends[i - 1] if i else None


def coverage(name: Column) -> tuple[Column, Column]:
    """Start and end from a file name; null if it does not fit."""
    start = F.nullif(F.regexp_extract(name, NAME, 1), F.lit("")).cast("long")
    return start, start + F.nullif(F.regexp_extract(name, NAME, 2), F.lit("")).cast("long")


def requests(rows: DataFrame) -> DataFrame:
    """rows (file_start, file_end, block_start, block_end) with read_start, read_end: the padded block cut to the file; too short or too long reads go."""
    start = F.greatest(F.greatest(F.col("block_start") - PAD_S, F.lit(0)), F.col("file_start"))
    end = F.least(F.col("block_end") + PAD_S, F.col("file_end"))
    cut = rows.withColumn("read_start", start).withColumn("read_end", end)
    return cut.filter((F.col("read_end") - F.col("read_start")).between(LEAST_S, MOST_S))


def containing(blocks: DataFrame, files: DataFrame) -> DataFrame:
    """For each block (block_start, block_end) the first file (by name) that holds it whole.

    A file lies in every bin that it touches, so a block meets all files that hold its start, however long they are.
    """
    a = blocks.withColumn("_bin", F.floor(F.col("block_start") / FILE_S))
    b = files.filter("file_end > file_start").withColumn("_bin", F.explode(F.sequence(F.floor(F.col("file_start") / FILE_S), F.floor((F.col("file_end") - 1) / FILE_S))))
    hit = a.join(b, "_bin").filter("file_start <= block_start and block_end <= file_end")
    return hit.groupBy("block_start", "block_end").agg(F.min("file").alias("file"))


def containing_tiles(files: DataFrame, size: int) -> DataFrame:
    """containing() for all blocks of a grid, [k * size, (k + 1) * size) for whole k: block_start, block_end, file of those that a file holds.

    Files alone are shuffled, by bin; a bin's blocks are made beside its files, so they are neither joined nor sorted nor grouped. A task holds the files of one bin at once.
    """
    bins = F.sequence(F.floor(F.col("file_start") / FILE_S), F.floor((F.col("file_end") - 1) / FILE_S))
    held = files.filter(F.col("file_end") - F.col("file_start") >= size).withColumn("_bin", F.explode(bins))
    held = held.groupBy("_bin").agg(F.collect_list(F.struct("file", "file_start", "file_end")).alias("_files"))
    first, last = F.ceil(F.col("_bin") * FILE_S / size), F.ceil((F.col("_bin") + 1) * FILE_S / size) - 1
    tiles = held.withColumn("_first", first).withColumn("_last", last).filter("_first <= _last").select("_files", F.explode(F.sequence("_first", "_last")).alias("_k"))
    start, end = (F.col("_k") * size).cast("long"), (F.col("_k") * size + size).cast("long")
    hit = F.filter("_files", lambda f: (f["file_start"] <= start) & (end <= f["file_end"]))
    found = tiles.select(start.alias("block_start"), end.alias("block_end"), F.transform(hit, lambda f: f["file"]).alias("_names")).filter(F.size("_names") > 0)
    return found.select("block_start", "block_end", F.array_min("_names").alias("file"))


def cached(blocks: DataFrame, files: DataFrame, least_bytes: int = 1024) -> DataFrame:
    """containing() over whole cached files (file, size, with the range in the name); stubs of least_bytes or less don't count."""
    start, end = coverage(F.col("file"))
    ranged = files.filter(F.col("size") > least_bytes).select("file", start.alias("file_start"), end.alias("file_end"))
    return containing(blocks, ranged.filter("file_end is not null"))


def overlapping_runs(blocks: DataFrame, runs: DataFrame) -> DataFrame:
    """block_start with the names of runs that it overlaps; `runs` is a literal relation."""
    return blocks.join(F.broadcast(runs), (F.col("run_start") < F.col("block_end")) & (F.col("run_end") > F.col("block_start")))


def resolved(blocks: DataFrame, files: DataFrame, runs: DataFrame) -> DataFrame:
    """block_start, block_end, run, file: the first file (by name) that holds the block whole, from the first run (by start) that has one.

    `files` has (run, file, file_start, file_end). A block looks in the runs that hold its start or end, or in all runs if none does; runs are a literal relation.
    """
    listed = runs.select(F.col("run").alias("_run"), "run_start", "run_end")
    inside = ((F.col("block_start") >= F.col("run_start")) & (F.col("block_start") < F.col("run_end"))) | ((F.col("block_end") > F.col("run_start")) & (F.col("block_end") <= F.col("run_end")))
    tried = blocks.join(F.broadcast(listed), inside, "left").select("block_start", "block_end", "_run")
    a = tried.withColumn("_bin", F.floor(F.col("block_start") / FILE_S))
    b = files.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("file_start") / FILE_S), F.floor((F.col("file_end") - 1) / FILE_S))))
    hit = a.join(b, "_bin").filter("file_start <= block_start and block_end <= file_end and (_run is null or _run = run)")
    hit = hit.join(F.broadcast(listed.select(F.col("_run").alias("run"), "run_start")), "run")
    best = F.min(F.struct("run_start", "run", "file")).alias("best")
    return hit.groupBy("block_start", "block_end").agg(best).select("block_start", "block_end", "best.run", "best.file")


def first_of(blocks: DataFrame, sources: list[DataFrame]) -> DataFrame:
    """block_start, block_end, source (its number), file: containing() from the first source that has a file; null where none has."""
    every = None
    for i, files in enumerate(sources):
        found = containing(blocks, files).withColumn("source", F.lit(i))
        every = found if every is None else every.unionByName(found)
    best = every.groupBy("block_start", "block_end").agg(F.min(F.struct("source", "file")).alias("best"))
    return blocks.select("block_start", "block_end").distinct().join(best, ["block_start", "block_end"], "left").select("block_start", "block_end", "best.source", "best.file")


def fetched(blocks: DataFrame, cache: DataFrame, listed: DataFrame, ifos: list[str]) -> DataFrame:
    """block_start, block_end, ifo, file, is_cached, error: for each block and sensor a cached file that holds it, else a listed one, else an error text.

    cache and listed have (ifo, file, file_start, file_end). The sensor is a key of the join, so all are resolved at once.
    """
    asked = blocks.select("block_start", "block_end").distinct().withColumn("ifo", F.explode(F.array(*map(F.lit, ifos))))
    both = cache.withColumn("_listed", F.lit(0)).unionByName(listed.withColumn("_listed", F.lit(1)))
    b = both.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("file_start") / FILE_S), F.floor((F.col("file_end") - 1) / FILE_S))))
    hit = asked.withColumn("_bin", F.floor(F.col("block_start") / FILE_S)).join(b, ["ifo", "_bin"]).filter("file_start <= block_start and block_end <= file_end")
    best = hit.groupBy("block_start", "block_end", "ifo").agg(F.min(F.struct("_listed", "file")).alias("best"))
    out = asked.join(best, ["block_start", "block_end", "ifo"], "left")
    none = F.concat(F.lit("no files found for "), F.col("ifo"), F.lit(" "), F.col("block_start").cast("string"), F.lit("-"), F.col("block_end").cast("string"))
    return out.select("block_start", "block_end", "ifo", "best.file", (F.col("best._listed") == 0).alias("is_cached"), F.when(F.col("best").isNull(), none).alias("error"))


def listed_end(files: DataFrame, name: str = "file") -> DataFrame:
    """One row, latest: the largest end of a listing's file names; null if none fits."""
    return files.agg(F.max(coverage(F.col(name))[1]).alias("latest"))


def latest_end(cached: Column, cached_at: Column, listed: Column, of_runs: Column, now: Column, lookback_s: float) -> Column:
    """Where data end: a cached value that is fresh and not too far ahead, else the listing's end, the runs' or a known time, none later than now and the look-back."""
    fresh = (now - cached_at < CACHE_S) & (cached <= now + 1.5 * lookback_s)
    return F.coalesce(F.when(fresh, cached.cast("double")), F.least(F.coalesce(listed.cast("double"), of_runs.cast("double"), F.lit(KNOWN_S)), now + lookback_s))


def has_new_data(latest: Column, current: Column) -> Column:
    return latest > current + 1.0


def run_segments(runs: DataFrame, overrides: DataFrame) -> DataFrame:
    """run, run_start, run_end of `runs`, each from `overrides` (same columns) where that has the run with both times."""
    known = overrides.filter("run_start is not null and run_end is not null").groupBy("run").agg(F.max(F.struct("run_start", "run_end")).alias("_own"))
    own = lambda c: F.coalesce(F.col(f"_own.{c}"), F.col(c)).alias(c)
    return runs.join(known, "run", "left").select("run", own("run_start"), own("run_end"))


def previous_run_end(runs: DataFrame, before: float) -> DataFrame:
    """One row, previous: the greatest end of a run strictly before a time; null if there is none."""
    return runs.agg(F.max(F.when(F.col("run_end") < before, F.col("run_end"))).alias("previous"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """page, detector, gps_start, url of a listing kept as one JSON document a page and line ({"page", "num_pages", "results": [...]}); pages beyond the first page's number of pages and broken ones don't count."""
    kind = "page int, num_pages int, results array<struct<detector: string, gps_start: double, hdf5_url: string>>"
    pages = spark.read.schema(kind).option("mode", "PERMISSIVE").json(path).filter("page is not null")
    most = pages.filter("page = 1").agg(F.max("num_pages").alias("most"))
    kept = pages.join(F.broadcast(most), F.col("page") <= F.coalesce(F.col("most"), F.lit(1)))
    return kept.select("page", F.explode("results").alias("r")).select("page", "r.detector", "r.gps_start", F.col("r.hdf5_url").alias("url")).filter("gps_start is not null")


def listed_starts(listed: DataFrame, detector: str, start: float, end: float) -> DataFrame:
    """gps_start of a listing's files of a sensor in [start, end), in order."""
    return listed.filter((F.col("detector") == detector) & (F.col("gps_start") >= start) & (F.col("gps_start") < end)).select("gps_start").orderBy("gps_start")


def science_segments(spark: SparkSession, path: str, ifo: str, start: float, end: float) -> DataFrame:
    """seg_start, seg_end of a sensor's segments that overlap [start, end), cut to it; a table that can't be read has none."""
    try:
        rows = spark.read.parquet(path).select("ifo", "seg_start", "seg_end")
    except Exception:  # no science segments is a defined state of a search
        return spark.createDataFrame([], "seg_start double, seg_end double")
    inside = rows.filter((F.col("ifo") == ifo) & (F.col("seg_start") < end) & (F.col("seg_end") > start))
    return inside.select(F.greatest("seg_start", F.lit(start)).cast("double").alias("seg_start"), F.least("seg_end", F.lit(end)).cast("double").alias("seg_end"))


def resolve_pages(pages: DataFrame) -> DataFrame:
    """name, gps of a paged listing (page, name, gps): of repeated names the last page wins."""
    return pages.groupBy("name").agg(F.max_by("gps", F.struct("page", "gps")).alias("gps"))


def _neighbours(files: DataFrame, others: DataFrame, file_us: int) -> DataFrame:
    """s, near of files (s) with any of `others` (o) less than file_us away: the last such one up to s and the first one from s on. Both sides pass days once forward and once backward."""
    width = max(86_400_000_000, file_us)
    bins = F.array_distinct(F.array(*(time_bin(F.col("o") + d, width) for d in (-file_us, 0, file_us))))
    line = files.select(time_bin(F.col("s"), width).alias("_bin"), F.col("s").alias("t"), F.lit(None).cast("long").alias("o")).unionByName(others.select(F.explode(bins).alias("_bin"), F.col("o").alias("t"), "o"))
    upto = lambda *order: Window.partitionBy("_bin").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = F.last("o", ignorenulls=True).over(upto("t", F.col("o").desc()))  # nulls last: others of a file's own time come before it
    after = F.last("o", ignorenulls=True).over(upto(F.desc("t"), F.col("o").desc()))
    met = line.withColumn("before", before).withColumn("after", after).filter("o is null")
    near = F.filter(F.array("before", "after"), lambda o: F.abs(o - F.col("t")) < file_us)
    return met.select(F.col("t").alias("s"), near.alias("near")).filter(F.size("near") > 0)


def previous_available_end(asked: DataFrame, starts: DataFrame, runs: DataFrame, ifos: list[str], file_us: int = FILE_S * 1_000_000, days: tuple[int, ...] = (1, 7, 30, 90), years: int = 5) -> DataFrame:
    """before_us, run, days, end_us of `asked` (before_us): the end of the latest file before that time whose like exists for all sensors.

    Runs (run, run_start, run_end; a handful, known to the driver) are searched newest first, each in windows that widen; the first window that finds one decides. `starts` has (ifo, start_us); a file
    of the first sensor counts if one of every other sensor in the same run and window starts less than a file's length away. Only the nearest neighbours before and after a file can decide that,
    as they lie in every window that holds the file and any other neighbour of that side; they are found once for each file.
    A window's ends alone can part a file from its neighbours, so only files in the days of its ends are compared with it; of all days before, the latest file with neighbours is
    looked up by day. Each asked time thus meets the files of some days, however long the windows.
    """
    day = 86_400_000_000
    width = max(day, file_us)
    listed = runs.select("run", "run_start", "run_end").orderBy(F.desc("run_start")).collect()  # a literal relation
    every = F.array(*(F.struct(F.lit(i + 1).alias("turn"), F.lit(r.run).alias("run"), F.lit(r.run_start).cast("long").alias("run_start"), F.lit(r.run_end).cast("long").alias("run_end")) for i, r in enumerate(listed)))
    if not listed:
        return asked.select("before_us", F.lit(None).cast("string").alias("run"), F.lit(None).cast("int").alias("days"), F.lit(None).cast("long").alias("end_us")).limit(0)
    tries = asked.select("before_us", F.explode(every).alias("r")).select("before_us", "r.*").filter(F.col("run_end") >= F.col("before_us") - years * 365 * day)
    tries = tries.withColumn("days", F.explode(F.array(*map(F.lit, days)))).withColumn("lo", F.greatest("run_start", F.col("before_us") - F.col("days") * day)).withColumn("hi", F.least("run_end", "before_us"))
    ranges = tries.filter("lo < hi").select("before_us", "turn", "run", "days", "lo", "hi")
    of = lambda ifo, name: starts.filter(F.col("ifo") == ifo).select(F.col("start_us").alias(name)).distinct()
    joint = of(ifos[0], "s")
    for k, other in enumerate(ifos[1:]):
        joint = joint.join(_neighbours(of(ifos[0], "s"), of(other, "o"), file_us).withColumnRenamed("near", f"near_{k}"), "s")
    joint = materialise(joint.withColumn("_day", time_bin(F.col("s"), width)), "joint-files")
    inner = F.col("hi") - file_us  # files up to here have their neighbours before hi, and those from lo + file_us - 1 on have them after lo
    ends = F.array_distinct(F.array(*(time_bin(t, width) for t in (F.col("lo"), F.col("lo") + file_us, inner, F.col("hi")))))
    inside = lambda t: (t >= F.col("lo")) & (t < F.col("hi"))
    found = ranges.withColumn("_day", F.explode(ends)).join(joint, "_day").filter(inside(F.col("s")))
    for k in range(len(ifos) - 1):
        found = found.filter(F.exists(f"near_{k}", inside))
    asked_days = ranges.withColumn("_day", time_bin(inner, width))
    calendar = joint.select("_day", "s").unionByName(asked_days.select("_day", F.lit(None).cast("long").alias("s"))).groupBy("_day").agg(F.max("s").alias("s"))
    calendar = calendar.select("_day", F.last("s", ignorenulls=True).over(Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)).alias("s"))  # one row a day
    earlier = asked_days.join(calendar, "_day").filter(F.col("s") >= F.col("lo") + file_us - 1)
    key = ["before_us", "turn", "run", "days"]
    best = found.select(*key, "s").unionByName(earlier.select(*key, "s")).groupBy(*key).agg((F.max("s") + file_us).alias("end_us"))
    first = F.min(F.struct("turn", "days", "run", "end_us")).alias("first")
    return best.groupBy("before_us").agg(first).select("before_us", "first.run", "first.days", "first.end_us")
