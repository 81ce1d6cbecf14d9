"""Backgrounds and de-duplication of triggers that arrive batch by batch, with state that expires by event time.

Both operators give the rows of their batch forms (operators.background.slid_pairs, operators.candidates.deduplicate) however the rows are cut into
batches, as long as none is later than the watermark (which begins at 1970, so times below zero are late). Their state lives in the stream's checkpoint, so a restart goes on where the last whole batch ended. They need the
RocksDB state store (prepare()).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType

from tallybeam.operators.candidates import DROPPED, KEPT, OPEN, greedy
from tallybeam.operators.intervals import spread, time_bin
from tallybeam.operators.tallies import expanded, reach

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SINGLES, TYPES = ("time", "square", "event", "new"), (np.int64, np.float64, np.int64, np.bool_)
MET = "template_id string, " + ", ".join(f"{n}_{side} binary" for side in "ab" for n in SINGLES)
SINGLE = "side int, time long, stat double, event long"
PAIRS = "slide long, offset_us long, template_id string, event_id_a long, event_id_b long, network_stat double"
COLUMNS = ["slide", "offset_us", "template_id", "event_id_a", "event_id_b", "network_stat"]


def prepare(spark: SparkSession) -> None:
    """Choose the state store that these operators need, for the queries that start from now on."""
    spark.conf.set(STORE, ROCKS)


def _singles(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Times, squares of the ratios (0 if broken), event ids and marks of new ones."""
    x = rows.stat.to_numpy(float)
    x = np.where(np.isfinite(x), x, 0.0)
    return rows.time.to_numpy(np.int64), x * x, rows.event.to_numpy(np.int64), rows.new.to_numpy(bool)


def listed(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], slides: list[tuple[int, int]], window: int, strict: bool) -> Iterator[pd.DataFrame]:
    """The pairs of all slides of which one is new, in blocks: a stretch has as many as the square of its singles."""
    (ta, xa, ea, new_a), (tb, xb, eb, new_b) = a, b
    for slide, offset in slides:
        for i, j in expanded(*reach(ta, tb, offset, window, strict)):
            fresh = new_a[i] | new_b[j]
            if fresh.any():
                i, j = i[fresh], j[fresh]
                yield pd.DataFrame({"slide": slide, "offset_us": offset, "event_id_a": ea[i], "event_id_b": eb[j], "network_stat": np.sqrt(xa[i] + xb[j])})


class Slides(StatefulProcessor):
    """Singles of one template and one stretch of time; each new one meets those that came before it, once for each slide.

    The stretch is as long as the widest offset and the window together, and second-sensor singles are in the stretches beside theirs too, so
    each pair meets in the first one's stretch and nowhere else. A stretch goes as a whole once the watermark leaves its reach.
    """

    def __init__(self, slides: list[tuple[int, int]], window: int, width: int, strict: bool, unlisted: bool = False):
        self.slides, self.window, self.width, self.strict, self.unlisted = slides, window, width, strict, unlisted

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.singles = handle.getListState("singles", SINGLE)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = pd.concat([*rows])[["side", "time", "stat", "event"]].assign(new=True)
        held = pd.DataFrame([*self.singles.get()], columns=["side", "time", "stat", "event"]).assign(new=False) if self.singles.exists() else new.iloc[:0]
        if not self.singles.exists():
            # Rows of the stretch and of the ones beside it may still come until the watermark is two stretches on.
            self.handle.registerTimer((int(key[1]) + 2) * self.width // 1000 + 1)
        self.singles.appendList([(int(r.side), int(r.time), float(r.stat), int(r.event)) for r in new.itertuples()])
        every = (pd.concat([held, new]) if len(held) else new).sort_values("time", kind="stable")
        a, b = (_singles(every[every.side == side]) for side in (0, 1))
        if self.unlisted:
            yield pd.DataFrame({"template_id": [key[0]], **{f"{n}_{side}": [v.tobytes()] for side, x in (("a", a), ("b", b)) for n, v in zip(SINGLES, x, strict=True)}})
            return
        yield from (block.assign(template_id=key[0])[COLUMNS] for block in listed(a, b, self.slides, self.window, self.strict))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.singles.clear()
        yield from ()

    def close(self) -> None:
        pass


def slid_pairs(triggers: DataFrame, ifo_a: str, ifo_b: str, slides: list[tuple[int, int]], window_us: int, late: str, strict: bool = True, unlisted: bool = False) -> DataFrame:
    """The background of two sensors' triggers of equal template as they arrive: rows as background.slid_pairs() gives them, each once, in the batch in which its second trigger comes.

    triggers is a stream of (ifo, gps_us, template_id, new_snr, event_id); slides are parameters (slide, offset_us); late: how far behind the latest time a trigger may come. Rows without a time, template or event id
    take no part. unlisted: instead of its pairs, a row holds the singles that meet in a stretch and batch, and the stream writes no more than it reads (once more for each batch that a stretch lasts); pairs_of() lists them.
    """
    width = max(abs(o) for _, o in slides) + window_us + 1
    rows = triggers.filter(F.col("ifo").isin(ifo_a, ifo_b)).select(
        F.col("template_id").cast("string").alias("template_id"), (F.col("ifo") == ifo_b).cast("int").alias("side"), F.col("gps_us").cast("long").alias("time"), F.col("new_snr").cast("double").alias("stat"),
        F.col("event_id").cast("long").alias("event"), F.timestamp_micros("gps_us").alias("at"),
    )
    rows = rows.na.drop(subset=["template_id", "time", "event"]).na.fill(float("nan"), ["stat"]).withWatermark("at", late)
    own = time_bin(F.col("time"), width)
    stretches = F.when(F.col("side") == 0, F.array(own)).otherwise(F.array(own - 1, own, own + 1))
    dealt = rows.withColumn("stretch", F.explode(stretches))
    return dealt.groupBy("template_id", "stretch").transformWithStateInPandas(Slides(slides, window_us, width, strict, unlisted), MET if unlisted else PAIRS, "append", "eventtime")


def pairs_of(met: DataFrame, slides: list[tuple[int, int]], window_us: int, strict: bool = True) -> DataFrame:
    """The pairs of what an unlisted stream has written, with the parameters that it had."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (tuple(np.frombuffer(batch.column(f"{n}_{side}")[i].as_buffer(), kind) for n, kind in zip(SINGLES, TYPES, strict=True)) for side in "ab")
                for block in listed(a, b, slides, window_us, strict):
                    template = pa.repeat(batch.column("template_id")[i].as_py(), len(block))
                    yield pa.RecordBatch.from_pydict({c: template if c == "template_id" else pa.array(block[c].to_numpy()) for c in COLUMNS})

    return spread(met).mapInArrow(run, PAIRS)


#: Columns of a candidate in the state: `quiet` is the statistic turned round, so smaller is better in both.
CANDIDATE = ["time", "far", "quiet", "template", "a", "b", "payload"]
DECIDED = "time long, far double, quiet double, state int, payload string"
#: A stretch of time and what it sees beyond its ends, in windows.
STRETCH, REACH = 16, 4
#: Lanes of rows that nothing undecided lies near, and the lane of all others.
LANES, CHAINS = 64, -1


def best_of_times(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """The best row of each time, in order of time, as no other can stay; equal events count once."""
    return rows.sort_values(["time", "far", "quiet", "template", "a", "b", "payload"]).drop_duplicates(["time"] if window > 0 else ["time", "a", "b"])


class Stretches(StatefulProcessor):
    """Candidates of one stretch of time and of what it sees beside it, until the watermark has left both: then all are decided that hang on nothing out of sight.

    Of the stretch's own rows the kept and the undecided ones go on; these are few however dense the candidates, as kept ones lie a window apart.
    """

    def __init__(self, window: int):
        self.window, self.width, self.reach = window, STRETCH * max(1, window), REACH * max(1, window)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "rows binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = best_of_times(pd.concat([*rows])[CANDIDATE], self.window)
        if not self.held.exists():
            self.handle.registerTimer(((int(key[-1]) + 1) * self.width + self.reach) // 1000 + 1)
        self.held.appendList([(_packed(new.iloc[i : i + 10_000]),) for i in range(0, len(new), 10_000)])
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        rows = best_of_times(pd.concat([_unpacked(r[0]) for r in self.held.get()]), self.window)
        self.held.clear()
        time, start = rows.time.to_numpy(np.int64), int(key[-1]) * self.width
        end, place = start + self.width, np.empty(len(rows), np.int64)
        place[np.lexsort((time, rows.quiet, rows.far))] = np.arange(len(rows))
        seen = (time > start - self.reach + self.window) & (time < end + self.reach - self.window)
        state = greedy(time, place, np.zeros(len(rows), np.int64), seen, self.window)
        own = (time >= start) & (time < end) & (state != DROPPED)
        out = rows[own].assign(state=state[own])
        time, waiting = out.time.to_numpy(np.int64), out.time.to_numpy(np.int64)[state[own] == OPEN]
        near = np.searchsorted(waiting, time + self.window, "left") > np.searchsorted(waiting, time - self.window, "right")
        chained = near | (time < start + self.window) | (time >= end - self.window)
        out["lane"] = np.where(chained, CHAINS, int(key[-1]) % LANES)
        out["at"] = pd.to_datetime(timerValues.getCurrentWatermarkInMs() + 1, unit="ms", utc=True)
        for i, name in enumerate(key[:-1]):
            out[f"key{i}"] = name
        if len(out):
            yield out[[f"key{i}" for i in range(len(key) - 1)] + ["lane", "time", "far", "quiet", "state", "payload", "at"]]

    def close(self) -> None:
        pass


def _packed(rows: pd.DataFrame) -> bytes:
    table, sink = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(held: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(held)).read_all().to_pandas()


class Chains(StatefulProcessor):
    """Kept and undecided candidates of all stretches: a run of which neighbours lie less than the window apart is decided once all stretches that can add to it have come.

    Kept rows alone are never so near to each other, so a run is as long as rows hang on one another across the ends of stretches. Rows of other lanes are final and pass.
    """

    def __init__(self, window: int):
        self.window, self.width, self.reach = window, STRETCH * max(1, window), REACH * max(1, window)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", DECIDED)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = pd.concat([*rows])
        if key[-1] != CHAINS:
            yield new[["payload"]]
        else:
            yield from self._settle([(int(r.time), float(r.far), float(r.quiet), int(r.state), r.payload) for r in new.itertuples()], timerValues)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield from self._settle([], timerValues)

    def _settle(self, new: list[tuple], timers: Any) -> Iterator[pd.DataFrame]:
        """Decide the runs that end the window before the last stretch that has come; hold the others."""
        come = ((timers.getCurrentWatermarkInMs() - 2) * 1000 - self.reach) // self.width * self.width
        held = [tuple(r) for r in self.open.get()] if self.open.exists() else []
        runs: list[list[tuple]] = []
        for r in sorted(held + new, key=lambda r: r[0]):
            if not runs or r[0] - runs[-1][-1][0] >= self.window:
                runs.append([])
            runs[-1].append(r)
        done = [p for run in runs if run[-1][0] + self.window <= come for p in self._decide(run)]
        waiting = [run for run in runs if run[-1][0] + self.window > come]
        if waiting:
            self.open.put([r for run in waiting for r in run])
            last = -(-(waiting[0][-1][0] + self.window) // self.width) * self.width
            self.handle.registerTimer((last + self.reach) // 1000 + 5)
        elif held:
            self.open.clear()
        if done:
            yield pd.DataFrame({"payload": done})

    def _decide(self, run: list[tuple]) -> list[str]:
        state = np.array([r[3] for r in run])
        place = np.empty(len(run), np.int64)
        # Kept rows first: whatever lies near one is dropped.
        place[sorted(range(len(run)), key=lambda i: (state[i] != KEPT, run[i][1:3], run[i][0]))] = np.arange(len(run))
        state = greedy(np.array([r[0] for r in run]), place, state, np.ones(len(run), bool), self.window)
        return [r[4] for r, s in zip(run, state, strict=True) if s == KEPT]

    def close(self) -> None:
        pass


def deduplicate(found: DataFrame, window_us: int, late: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Candidates of a stream as candidates.deduplicate() keeps them, each once the watermark has passed its stretch of time and those that it hangs on; equal events of overlapping blocks count once.

    found has far_hz, network_stat, gps_us, template_id, event_id_a and event_id_b among its columns; null or NaN statistics are the quietest. `by` columns are searched apart from each other. Open candidates are the state of their
    stretch of time (and of the one beside it, near its end), and what a stretch can't decide by itself goes to one group for each search; rows without a time or event ids, which name no event, are left out.
    """
    width, reach = STRETCH * max(1, window_us), REACH * max(1, window_us)
    rows = found.na.drop(subset=["gps_us", "event_id_a", "event_id_b"]).withColumn("_at", F.timestamp_micros("gps_us")).withWatermark("_at", late)
    loud = F.coalesce(F.nanvl(F.col("network_stat"), F.lit(float("-inf"))), F.lit(float("-inf")))
    time = F.col("gps_us").cast("long")
    keys = [f"key{i}" for i in range(len(by))]
    dealt = rows.select(
        *(F.col(f"`{c}`").alias(k) for c, k in zip(by, keys, strict=True)), F.explode(F.array_distinct(F.array(*(time_bin(time + d, width) for d in (-reach, 0, reach))))).alias("stretch"),
        time.alias("time"), F.coalesce("far_hz", F.lit(1e9)).cast("double").alias("far"), (-loud.cast("double")).alias("quiet"), F.coalesce(F.col("template_id").cast("string"), F.lit("")).alias("template"),
        F.col("event_id_a").cast("long").alias("a"), F.col("event_id_b").cast("long").alias("b"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in found.columns]), {"ignoreNullFields": "false"}).alias("payload"), "_at",
    )
    schema = StructType([StructField(k, found.schema[c].dataType) for c, k in zip(by, keys, strict=True)] + StructType.fromDDL(f"lane int, {DECIDED}, at timestamp").fields)
    decided = dealt.groupBy(*keys, "stretch").transformWithStateInPandas(Stretches(window_us), schema, "append", "eventtime", eventTimeColumnName="at")
    kept = decided.groupBy(*keys, "lane").transformWithStateInPandas(Chains(window_us), "payload string", "append", "eventtime")
    return kept.select(F.from_json("payload", found.schema, {"allowNonNumericNumbers": "true"}).alias("r")).select("r.*")
