"""The whole search as one call: series in, ranked candidates and run state out.

Blocks are rows, so all blocks of a call are conditioned, matched, joined and ranked together; only the kernels leave the JVM. search_blocks()
calls it block by block, forward or backward over gaps, until it is asked to stop.
"""

from __future__ import annotations

import dataclasses
import json
import math
import time
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybeam.config import Config
from tallybeam.functions import scalars as S
from tallybeam.operators import background, bank, candidates, coincidence, ranking, signal, tallies
from tallybeam.operators.intervals import nearest
from tallybeam.scratch import materialise, scope
from tallybeam.sources import series as series_files
from tallybeam.sources.frames import RUNS, Ranges
from tallybeam.sources.state import TABLES, State, write_candidates
from tallybeam.streaming import loop
from tallybeam.streaming.loop import stop_requested


def micros(s: float) -> int:
    return int(round(s * 1e6))


def templates(spark: SparkSession, cfg: Config) -> list[signal.Template]:
    """The configured bank: a parameter list."""
    b = cfg.bank
    build = lambda: bank.build(spark, b.method, b.mass1, b.mass2, b.min_match, b.mismatch, b.f_lower, b.quick, b.cap, b.spins, b.path)
    rows = bank.cached(spark, b.cache, {k: v for k, v in dataclasses.asdict(b).items() if k != "cache"}, build) if b.cache else build()
    rows = rows.orderBy(*(c for c in ("template_id", "gen", "centre", "mass1", "mass2") if c in rows.columns))
    spins = [c for c in ("spin1z", "spin2z") if c in rows.columns]
    return [signal.Template(i, r.mass1, r.mass2, b.f_lower, *(r[c] for c in spins)) for i, r in enumerate(rows.collect())]


def conditioned(series: DataFrame, cfg: Config) -> DataFrame:
    """Gated and conditioned series rows, as signal.condition() returns them, with the other columns of `series`."""
    c, g = cfg.conditioning, cfg.gating
    clean = signal.condition(series, c.rate, c.highpass, int(c.segment_s * c.rate), c.notches, skip_s=c.skip_s, gate=(g.threshold, g.pad_s, g.longest_s))
    return clean.join(series.drop("ifo", "arr"), "series_id")


def find_triggers(clean: DataFrame, cfg: Config, waves: list[signal.Template]) -> DataFrame:
    """Triggers of conditioned series with their times."""
    c, r = cfg.conditioning, cfg.runtime
    usable = clean.filter("not is_gap")
    found = signal.triggers(usable, waves, c.rate, r.threshold, r.chisq_from, r.cluster_s, segment=int(c.segment_s * c.rate), per_task=r.templates_per_task)
    timed = found.join(usable.select("series_id", "t0_us", "n_gates"), "series_id").withColumn("gps_us", F.col("t0_us") + F.round(F.col("i") * (1e6 / c.rate)).cast("long"))
    number = F.xxhash64("series_id", "template_id", "i")
    lasts = S.template_duration_s(F.lit(cfg.bank.f_lower))
    return timed.select("ifo", "gps_us", "snr", "chisq", "new_snr", "rchisq", F.col("template_id").cast("string").alias("template_id"), lasts.alias("duration_s"), "n_gates", number.alias("event_id"))


def windows(cfg: Config) -> dict[tuple[str, str], int]:
    """The window of each pair of sensors."""
    ifos, b = cfg.runtime.ifos, cfg.background
    own = {frozenset(k.split(",")): v for k, v in b.pair_windows_s.items()}
    found = {(x, y): micros(own.get(frozenset((x, y)), b.window_s)) for i, x in enumerate(ifos) for y in ifos[i + 1 :]}
    return found or {("", ""): micros(b.window_s)}


def block_states(clean: DataFrame, ifos: list[str]) -> DataFrame:
    """block_us, status, error: gap where a sensor has no series at all, skipped where all are gaps, else done."""
    seen = clean.groupBy("block_us").agg(F.collect_set("ifo").alias("seen"), F.bool_and("is_gap").alias("all_gaps"))
    missing = F.array_except(F.array(*map(F.lit, ifos)), "seen")
    status = F.when(F.size(missing) > 0, "gap").when(F.col("all_gaps"), "skipped").otherwise("done")
    error = F.when(F.size(missing) > 0, F.concat(F.lit("no data: "), F.array_join(F.array_sort(missing), ","))).when(F.col("all_gaps"), "data gap")
    return seen.select("block_us", status.alias("status"), error.alias("error"))


class Run:
    """A search of any number of parts (blocks, or batches of a stream): one run in the state, one bank, one place to write to.

    Each part's outputs and states have paths of their own, so a part that is searched again, after a failure, replaces what it wrote before. number: the run that goes on, else a new one.
    """

    def __init__(self, spark: SparkSession, cfg: Config, root: str, number: int | None = None):
        self.spark, self.cfg, self.root, self.state, now = spark, cfg, root, State(spark, f"{root}/state"), time.time()
        self.number = number or int(now * 1000)
        if number is None:
            self.state.append("runs", spark.createDataFrame([(self.number, now, cfg.hash(), None)], TABLES["runs"]))

    @cached_property
    def waves(self) -> list[signal.Template]:
        return templates(self.spark, self.cfg)

    def kept(self, df: DataFrame, name: str, part: str) -> DataFrame:
        path = f"{self.root}/{name}/run={self.number}/part={part}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def log(self, blocks: DataFrame, part: str, status: Column, error: Column) -> None:
        """Rows of block_us as blocks of the part with a status; the kind of status is a path of its own, so that a later one doesn't replace it."""
        start, number = F.col("block_us") / 1e6, self.state.number("block_us")
        rows = blocks.select(
            number.alias("id"), F.lit(self.number).alias("run_id"), F.lit(",".join(self.cfg.runtime.ifos)).alias("ifos"), start.alias("gps_start"), (start + self.cfg.runtime.block_s).alias("gps_end"),
            status.alias("status"), error.cast("string").alias("error"), F.lit(time.time()).alias("created_at"),
        )
        self.state.put("blocks", rows, f"run={self.number}/{part}")

    def gap(self, start_s: float, error: str = "no data") -> None:
        rows = self.spark.range(1).select(F.lit(micros(start_s)).alias("block_us"))
        self.log(rows, f"part={micros(start_s)}/end", F.lit("gap"), F.lit(error))

    def finish(self) -> None:
        """Write the candidates of all parts as JSON lines and CSV."""
        path = f"{self.root}/candidates/run={self.number}"
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            write_candidates(self.spark.read.option("mergeSchema", True).parquet(path).drop("part"), f"{self.root}/output", self.cfg.to_json())


def run_search(spark: SparkSession, series: DataFrame, cfg: Config, root: str, catalogue: DataFrame | None = None, run: Run | None = None, part: str = "all") -> DataFrame:
    """Candidates, de-duplicated and ranked; state tables and outputs are written under root.

    series has one row per sensor and block (series_id, ifo, t0_us, arr, and block_us where padded series start before their block), catalogue has (name, cat_us). A block that lacks a sensor is recorded as a gap, one of
    gaps only as skipped, and neither is searched; a failure is recorded for the blocks at work before it is raised. A search for pairs takes all pairs of
    sensors, and the first two make the background; one for triples slides the second and third. run: the search that this is a part of, else one of its own.
    """
    whole = run is None
    run = run or Run(spark, cfg, root)
    state, ifos = run.state, list(cfg.runtime.ifos)
    if "block_us" not in series.columns:
        series = series.withColumn("block_us", F.col("t0_us"))
    with scope():
        blocks = materialise(series.select("block_us").distinct(), "blocks")
        run.log(blocks, f"part={part}/begin", F.lit("processing"), F.lit(None))
        state.progress(run.number, "init", 0.0)
        try:
            clean = materialise(conditioned(series, cfg), "conditioned")
            states = materialise(block_states(clean, ifos), "block-states")
            state.progress(run.number, "conditioned", 0.2)
            best = _candidates(run, part, clean.join(states.filter("status = 'done'").select("block_us"), "block_us", "left_semi"), states, catalogue)
        except Exception as e:
            run.log(blocks, f"part={part}/end", F.lit("error"), F.lit(str(e)[:4000]))
            state.progress(run.number, "error", 1.0, str(e)[:4000])
            raise
        run.log(states, f"part={part}/end", F.col("status"), F.col("error"))
    state.progress(run.number, "done", 1.0)
    if whole:
        run.finish()
    return best


def _candidates(run: Run, part: str, clean: DataFrame, states: DataFrame, catalogue: DataFrame | None) -> DataFrame:
    spark, cfg, state = run.spark, run.cfg, run.state
    ifos, b, r = list(cfg.runtime.ifos), cfg.background, cfg.runtime
    triggers = run.kept(find_triggers(clean, cfg, run.waves), "triggers", part)  # the kernels run once
    state.progress(run.number, "triggers", 0.7)
    near = windows(cfg)
    pairs = coincidence.all_pairs(triggers, ifos, near, same_template=b.same_template)
    loud = pairs.filter(F.col("network_stat") > b.excise_above).select(F.col("gps_us").alias("loud_us"))
    quiet = background.excise(triggers, loud, micros(b.excise_s))
    slides = background.offsets(spark, b.slides, micros(b.spacing_s))
    span_s = r.block_s * max(1, states.filter("status = 'done'").count())
    if r.network == "triples" and len(ifos) == 3:
        found = coincidence.find(triggers, ifos, near).withColumn("ifos", F.lit(",".join(sorted(ifos))))
        ends = triggers.select("event_id", F.col("rchisq")).dropDuplicates(["event_id"])
        for x in "abc":
            found = found.join(ends.toDF(f"event_id_{x}", f"rchisq_{x}"), f"event_id_{x}")
        offsets = background.offset_pairs(slides, b.strategy, b.fraction)
        order = sorted(ifos)
        of = lambda x, y: near.get((x, y), near.get((y, x)))
        slid = background.slid_triples(quiet, tuple(order), offsets, (of(order[0], order[1]), of(order[0], order[2]), of(order[1], order[2])))
        n_slides = offsets.count()
    elif r.network in ("pairs", "triples"):
        found = pairs
        slid = background.slid_pairs(quiet, ifos[0], ifos[1] if len(ifos) > 1 else "", slides, near.get(tuple(ifos[:2]), micros(b.window_s)), b.same_template)
        n_slides = 2 * b.slides
    else:
        raise ValueError(f"unknown network: {r.network}")
    slid = run.kept(slid, "background", part)
    ranked = ranking.with_far(found, slid, float(n_slides * span_s))
    sides = [c.removeprefix("event_id_") for c in found.columns if c.startswith("event_id_")]
    best = candidates.deduplicate(ranked, micros(r.dedup_s)).withColumn("id", F.xxhash64(*(f"event_id_{x}" for x in sides)))
    if catalogue is not None:
        best = nearest(best, catalogue, "gps_us", "cat_us", "name", micros(r.tolerance_s)).withColumnRenamed("name", "known_event").drop("match_gap")
    else:
        best = best.withColumn("known_event", F.lit(None).cast("string"))
    quality = S.mean_rchisq(F.create_map(*(c for x in sides for c in (F.lit(x), F.col(f"rchisq_{x}")))))
    c, g = cfg.conditioning, cfg.gating
    settings = {"gating": F.to_json(F.struct(*(F.lit(v).alias(k) for k, v in dataclasses.asdict(g).items()))), "conditioning": F.to_json(F.struct(*(F.lit(getattr(c, k)).alias(k) for k in ("rate", "highpass", "low_frequency", "segment_s")))), "notches": F.lit(json.dumps(c.notches))}
    best = best.withColumn("detchar_rank", S.detchar_rank(F.col("network_stat"), quality)).withColumn("config_hash", F.lit(cfg.hash())).withColumn("bank_hash", F.lit(bank.content_hash([dataclasses.asdict(w) for w in run.waves])))
    best = run.kept(best.withColumns(settings), "candidates", part)
    state.progress(run.number, "background", 0.8)
    seconds = (F.col("gps_us") / 1e6).alias("gps")
    payload = F.to_json(F.struct(*best.columns)).alias("payload")
    state.put("candidates", best.select("id", F.lit(run.number).alias("run_id"), seconds, "ifos", "template_id", "network_stat", F.col("far_hz").alias("far"), "ifar_days", payload, F.lit(time.time()).alias("created_at")), f"run={run.number}/part={part}")
    rate = ranking.rate(slid, n_slides / 2, span_s)
    state.put("background", rate.select(F.lit(run.number).alias("id"), F.lit(run.number).alias("run_id"), F.lit(b.spacing_s).alias("slide"), F.col("far_hz").alias("far"), F.to_json(F.struct("*")).alias("payload"), F.lit(time.time()).alias("created_at")), f"run={run.number}/part={part}")
    return best


def whole_background(spark: SparkSession, root: str) -> DataFrame:
    """The slid coincidences of all runs under root, with the run: batches add up."""
    return spark.read.option("mergeSchema", "true").parquet(f"{root}/background")


def resume_from(state: State, latest_s: float | None, lookback_s: float, mode: str = "latest", given_s: float | None = None, direction: str = "forward", now_s: float | None = None) -> float:
    """Where a search starts, in seconds.

    resume: after the last finished block of any run, or before the first one if the search goes backward; gps: at the given time, unless that is none or 0; latest: at the latest
    data, a look-back before it if the search goes forward. Where a mode has nothing to start from, a look-back before now.
    """
    backward = direction == "backward"
    if mode == "resume":
        found = state.read("blocks").filter(F.col("status").isin("done", "gap")).agg(F.min("gps_start"), F.max("gps_end")).first()
        if (end := found[0] if backward else found[1]) is not None:
            return end
    if mode == "gps" and given_s:
        return given_s
    if latest_s is not None and mode != "gps":
        return latest_s if backward else latest_s - lookback_s
    return (time.time() if now_s is None else now_s) - lookback_s


def blocks_to_search(
    start_s: float, block_s: float, has_data: Callable[[float, float], bool], direction: str = "forward", previous_end: Callable[[float], float | None] = lambda t: None,
    previous_run_end: Callable[[float], float | None] = lambda t: None, stop_s: float | None = None, end_s: float | None = None, follow: bool = False, wait: Callable[[], None] = lambda: None, stop: Callable[[], bool] = lambda: False,
) -> Iterator[tuple[float, float, str]]:
    """block_start, block_end, status (data or gap) of one block after the other, while the caller works on each.

    Forward: from the start to end_s, or, if it follows, waiting where there is no data yet. Backward: down to stop_s; at a gap it jumps to the latest data
    before (if that lies more than a block away), else to the end of the run before, and ends where there is none. It ends when asked to stop.
    """
    now = start_s
    while not stop():
        if direction == "backward":
            block = now - block_s, now
            if stop_s and block[0] < stop_s:
                return
            if has_data(*block):
                yield *block, "data"
                now = block[0]
                continue
            yield *block, "gap"
            found = previous_end(block[0])
            if found is None or found >= block[0] - block_s:
                found = previous_run_end(block[0])
            if found is None:
                return
            now = found
        else:
            block = now, now + block_s
            if end_s is not None and now >= end_s:
                return
            if has_data(*block):
                yield *block, "data"
                now = block[1]
            elif follow:
                wait()
            else:
                yield *block, "gap"
                now = block[1]


#: Time of a stretch of a backward search, in ends of runs: some ten thousand files of 4096 s at most for each sensor.
STRETCH_RUNS = 1 << 13
#: Ways into a stretch from the block above, at most: one for each second of a block, and more.
MOST_RESTS = 4_096


def backward_blocks(files: DataFrame, ifos: list[str], joint: DataFrame, joint_s: float, start_s: float, block_s: float, run_s: float, stop_s: float, stretch_runs: int | None = None) -> DataFrame:
    """block_start, block_end, status, latest first: what blocks_to_search() gives backward from start_s over files (ifo, s, e), with jumps to the ends of joint ranges (s, each joint_s long, a block at least), else to the multiples of run_s.

    Time is cut into stretches, at multiples of run_s. A search comes into a stretch in a few ways only: on from the block above (by what is left of the cut modulo a block), at the stretch's last joint end, or at its last
    multiples of run_s. Each stretch, a group of its own, follows all of them to where they leave it; the driver goes from stretch to stretch by these, and a second pass lists the blocks of the way that is taken.
    """
    stretch_runs = stretch_runs or STRETCH_RUNS
    spark, size = files.sparkSession, float(run_s * stretch_runs)
    if run_s % block_s or not block_s <= joint_s <= size or stretch_runs < 2:
        raise ValueError(f"blocks of {block_s} s, joint ranges of {joint_s} s, runs of {run_s} s and stretches of {stretch_runs} runs don't fit each other")
    number = lambda t: F.ceil(t / F.lit(size)).cast("long") - 1  # noqa: E731  (a stretch has its end, not its start)
    of = lambda t: math.ceil(t / size) - 1
    ends = joint.select((F.col("s") + joint_s).alias("e"))
    last = dict(ends.groupBy(number(F.col("e")).alias("k")).agg(F.max("e")).collect())  # one row a stretch, as are all that come to the driver here
    rests = {0.0, (-start_s) % block_s} | {r[0] for r in ends.select(F.pmod(-F.col("e"), F.lit(block_s)).alias("r")).distinct().limit(MOST_RESTS + 1).collect()}
    if len(rests) > MOST_RESTS:
        raise ValueError("joint ranges end at too many different places of a block")
    top, bottom = of(start_s), of(stop_s) - 1
    below, most = {}, max((e for k, e in last.items() if k < bottom), default=None)
    for k in range(bottom, top + 1):
        below[k], most = most, last.get(k, most)
    touched = F.explode(F.sequence(F.greatest(number(F.col("s")), F.lit(bottom)), F.least(number(F.col("e") + block_s), F.lit(top))))
    rows = files.filter(F.col("ifo").isin(*ifos) & (F.col("s") <= start_s) & (F.col("e") > F.lit(bottom * size))).select("ifo", "s", "e", touched.alias("k"))
    rows = rows.unionByName(joint.select(F.lit("").alias("ifo"), "s", (F.col("s") + joint_s).alias("e"), F.explode(F.array_distinct(F.array(number(F.col("s")), number(F.col("s") + joint_s)))).alias("k")).filter(F.col("k").between(bottom, top)))
    rows = rows.unionByName(spark.range(bottom, top + 1).select(F.lit(None).cast("string").alias("ifo"), F.lit(None).cast("double").alias("s"), F.lit(None).cast("double").alias("e"), F.col("id").alias("k")))

    def opened(table: pa.Table):
        """The stretch's number, its start, and its blocks from a time on."""
        k = table.column("k")[0].as_py()
        ifo, s, e = (table.column(c).to_pylist() for c in ("ifo", "s", "e"))
        held = {x: Ranges((a, b) for i, a, b in zip(ifo, s, e, strict=True) if i == x) for x in [*ifos, ""]}
        before = below[k]

        def previous_end(t: float) -> float | None:
            found = held[""].latest_end(t)
            return before if found is None else found if before is None else max(found, before)

        has = lambda a, b: all(held[x].holds(a, b) for x in ifos)
        return k, k * size, lambda now: blocks_to_search(now, block_s, has, "backward", previous_end, lambda t: (math.ceil(t / run_s) - 1) * run_s, stop_s=stop_s)

    def ways(table: pa.Table) -> pa.Table:
        """For each time at which a search may come in, the one at which it is out; null where it ends."""
        k, start, search = opened(table)
        into = {start + size - r for r in rests} | {start + size - run_s} | ({last[k]} if k in last else set()) | ({start_s} if k == top else set())
        known: dict[float, float | None] = {}
        for now in sorted(into, reverse=True):
            passed, out = [], None
            for _, b, _ in search(now):
                if b in known:
                    out = known[b]
                    break
                if b <= start:
                    out = b
                    break
                passed.append(b)
            known |= dict.fromkeys([*passed, now], out)
        return pa.table({"now": pa.array(sorted(into), pa.float64()), "out": pa.array([known[t] for t in sorted(into)], pa.float64())})

    found = dict(rows.groupBy("k").applyInArrow(ways, "now double, out double").collect())
    taken, now = {}, start_s
    while now is not None:
        taken[of(now)], now = now, found[now]

    def blocks(table: pa.Table) -> pa.Table:
        k, start, search = opened(table)
        listed = [x for x in takewhile(lambda x: x[1] > start, search(taken[k]))] if k in taken else []
        return pa.table({n: pa.array([x[i] for x in listed], kind) for i, (n, kind) in enumerate((("block_start", pa.float64()), ("block_end", pa.float64()), ("status", pa.string())))})

    return rows.groupBy("k").applyInArrow(blocks, "block_start double, block_end double, status string").orderBy(F.desc("block_start"))


def search_blocks(spark: SparkSession, blocks: Iterator[tuple[float, float, str]], series_of: Callable[[float, float], DataFrame], cfg: Config, root: str, catalogue: DataFrame | None = None) -> int:
    """run_search() over the series of each block with data, all as one run; gaps are recorded. Returns the number of blocks searched."""
    run, searched = None, 0
    for start, end, status in blocks:
        run = run or Run(spark, cfg, root)
        if status == "data":
            run_search(spark, series_of(start, end), cfg, root, catalogue, run, str(micros(start)))
            searched += 1
        else:
            run.gap(start)
    if run:
        run.finish()
    return searched


def _series_columns(found: DataFrame) -> DataFrame:
    """Blocks of series files as run_search() takes them."""
    return found.select(F.xxhash64("file", "block_start").alias("series_id"), "ifo", (F.col("read_start") * 1_000_000).alias("t0_us"), (F.col("block_start") * 1_000_000).alias("block_us"), "arr")


def follow(spark: SparkSession, folder: str, cfg: Config, root: str, checkpoint: str, catalogue: DataFrame | None = None, poll: str | None = None) -> StreamingQuery:
    """The search over a folder of series files as a stream: each micro-batch takes the blocks that all sensors have reached since the one before, and is a part of one run.

    The checkpoint knows the blocks that were searched, and the state the run that belongs to it, so a restart goes on with both; a batch that is searched again replaces what
    it wrote. Once over what is there, or for ever if `poll` names an interval.
    """
    ifos, state = list(cfg.runtime.ifos), State(spark, f"{root}/state")
    held = state.get_value(f"run of {checkpoint}")
    run = Run(spark, cfg, root, int(held) if held else None)
    if not held:
        state.set_value(f"run of {checkpoint}", str(run.number))

    def each(batch: DataFrame, number: int) -> None:
        with scope():
            series = materialise(_series_columns(batch.filter(F.col("ifo").isin(*ifos))), "batch")
            if not series.isEmpty():
                run_search(spark, series, cfg, root, catalogue, run, f"batch-{number}")

    return loop.run(series_files.stream(spark, folder, int(cfg.runtime.block_s), ifos), each, checkpoint, poll)


def search_folder(spark: SparkSession, folder: str, cfg: Config, root: str, catalogue: DataFrame | None = None, wait: Callable[[float], None] = time.sleep) -> int:
    """The search over a folder of series files, as the configuration says: where to start, forward or backward, following new files or not, until the stop file is there. Returns the number of blocks searched.

    A backward search resumes by itself where there is state, and stops at the start of the first run unless told otherwise. Forward without following it takes one block. The listing, a row a file, is the control loop's and is read again when it waits.
    """
    r, state, ifos = cfg.runtime, State(spark, f"{root}/state"), list(cfg.runtime.ifos)
    block_s = int(r.block_s)

    def listing() -> tuple[list, dict[str, Ranges], Ranges]:
        """The files, each sensor's ranges, and those of the first sensor that overlap one of every other."""
        found = series_files.files(folder, whole=True)
        every = {ifo: Ranges((a, b) for _, x, a, b in found if x == ifo) for ifo in ifos}
        first = ((a, b) for _, x, a, b in found if x == ifos[0])
        return found, every, Ranges(f for f in first if all(every[ifo].meets(*f) for ifo in ifos[1:]))

    listed, held, joint = listing()

    def has_data(start: float, end: float) -> bool:
        return all(held[ifo].holds(start, end) for ifo in ifos)

    def previous_end(before: float) -> float | None:
        return joint.latest_end(before)

    def refresh() -> None:
        nonlocal listed, held, joint
        wait(r.poll_s)
        listed, held, joint = listing()

    latest = held[ifos[0]].latest_end(float("inf"))
    backward = r.direction == "backward"
    mode = "resume" if backward and r.start_mode == "latest" and state.read("blocks").limit(1).count() else r.start_mode  # a backward search goes on where one was
    start = resume_from(state, latest, r.lookback_s, mode, r.start_s, r.direction)
    stop_s = r.backward_stop_s if r.backward_stop_s is not None else min(a for _, a, _ in RUNS)
    stop = lambda: bool(r.stop_file) and stop_requested(spark, r.stop_file)
    run_end = lambda t: max((e for _, _, e in RUNS if e < t), default=None)
    end = None if r.follow else start + r.block_s
    blocks = blocks_to_search(start, r.block_s, has_data, r.direction, previous_end, run_end, stop_s, end, r.follow, refresh, stop)

    def series_of(a: float, b: float) -> DataFrame:
        found = series_files.read(spark, folder, block_s, start=int(a), only=[path for path, x, s, e in listed if x in ifos and s <= a and b <= e])
        return _series_columns(found.filter(F.col("ifo").isin(*ifos)))

    return search_blocks(spark, blocks, series_of, cfg, root, catalogue)


def _slid(triggers: DataFrame, cfg: Config, kind: str) -> tuple[DataFrame | tallies.Slid, int]:
    """The slid coincidences that an estimator takes, those of pairs not listed, and the number of slides."""
    spark, ifos, b, near = triggers.sparkSession, list(cfg.runtime.ifos), cfg.background, windows(cfg)
    slides = background.offsets(spark, b.slides, micros(b.spacing_s))
    if kind in ("pairs", "native"):
        return tallies.slid(triggers, ifos[0], ifos[1], slides, near[tuple(ifos[:2])], b.same_template), 2 * b.slides
    if kind == "triples":
        offsets = background.offset_pairs(slides, b.strategy, b.fraction)
        return background.slid_triples(triggers, tuple(ifos[:3]), offsets, (near[ifos[0], ifos[1]], near[ifos[0], ifos[2]], near[ifos[1], ifos[2]])), offsets.count()
    raise ValueError(f"unknown kind: {kind}")


def _summary(triggers: DataFrame, slid: DataFrame | tallies.Slid, n_slides: int, cfg: Config, kind: str, observing_s: float | None) -> dict:
    row = ranking.summary(slid).first()
    seconds = ranking.observing_time(triggers, True).first()[0] if observing_s is None else float(observing_s)
    if kind == "native":
        n_slides = max(1, row.n // max(1, triggers.filter(F.col("ifo").isin(*cfg.runtime.ifos)).count()))
    trials = n_slides * seconds
    return {"n": row.n, "loudest": row.loudest, "median": row.median, "n_slides": n_slides, "trials_s": trials, "far_hz": row.n / trials if row.n and seconds else None, "kind": kind}


def estimate_background(triggers: DataFrame, cfg: Config, kind: str = "pairs", observing_s: float | None = None) -> dict:
    """A summary of the background of pairs or triples: n, loudest, median, n_slides, trials_s, far_hz.

    kind: pairs, triples, or native: pairs whose number of slides is not the configured one but the background's rows for each trigger of the searched sensors, at least 1. observing_s: the time that one slide stands
    for; where it isn't given, the least span of a sensor's triggers.
    """
    slid, n_slides = _slid(triggers, cfg, kind)
    return _summary(triggers, slid, n_slides, cfg, kind, observing_s)


def ranked_by_background(triggers: DataFrame, found: DataFrame, cfg: Config, kind: str = "native", observing_s: float | None = None, ordered: bool = True) -> tuple[dict, DataFrame]:
    """The summary, and `found` (network_stat) with n_louder, far_hz, far_per_year, ifar_years, p_value and sigma against that background, most significant first (then loudest) if ordered.

    A background of triples is made and written once, one of pairs is counted and never written. P-values are those of the trials shared by the background's rows; without any background rates are infinite and nothing is significant.
    """
    slid, n_slides = _slid(triggers, cfg, kind)
    if isinstance(slid, DataFrame):
        slid = materialise(slid.select("network_stat"), "estimated-background")
    summary = _summary(triggers, slid, n_slides, cfg, kind, observing_s)
    out = ranking.ranked(found, slid, summary["trials_s"], n_slides, "search").withColumn("far_per_year", F.col("far_hz") * S.YEAR_S)
    return summary, out.orderBy(F.desc("sigma"), F.desc("network_stat")) if ordered else out
