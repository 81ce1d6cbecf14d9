"""Counts, extremes, order statistics and ranks over coincidences that are never listed.

The pairs of two sensors grow with the square of the triggers, their counts don't. So triggers are packed into units, one for each template and stretch of time, that hold the first
sensor's times and squares and those of the second that any slide can bring near; the units grow with the triggers. A task passes over the pairs of its units in
blocks of BLOCK, and only counts leave it. What needs more than one look at the pairs makes them again instead of writing them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tallybeam.operators import ranks
from tallybeam.scratch import materialise

#: Pairs that a task holds at once, about.
BLOCK = 1 << 20
#: Foreground rows that a task ranks at once, about; and as few as are worth a task of their own.
MOST_RANKED, LEAST_RANKED = 12_000_000, 500_000
#: Neighbours of one sensor that are summed with what all of them meet at once, and triggers of the other that are kept in order of value together.
STEP, TILE, BUCKETS = 64, 128, 512
#: Bits of a double (it is not negative) that the first look at the pairs sorts by, and each later one.
FIRST, NEXT = 22, 14

_UNIT = "bin long, ta binary, xa binary, tb binary, yb binary"


@dataclass(frozen=True)
class Slid:
    """The background of two sensors, not yet listed: coincidences with ifo_b shifted by each offset (slide, offset_us; a parameter list)."""

    triggers: DataFrame
    ifo_a: str
    ifo_b: str
    offsets: tuple[tuple[int, int], ...]
    window_us: int
    same_template: bool = True
    strict: bool = True
    #: Broken ratios drop the trigger instead of counting as 0.
    drop_broken: bool = False


def slid(triggers: DataFrame, ifo_a: str, ifo_b: str, slides: DataFrame, window_us: int, same_template: bool = True, strict: bool = True) -> Slid:
    return Slid(triggers, ifo_a, ifo_b, tuple(sorted((r.slide, r.offset_us) for r in slides.collect())), window_us, same_template, strict)


def coincident(triggers: DataFrame, ifo_a: str, ifo_b: str, window_us: int, same_template: bool = True) -> Slid:
    """What coincidence.pairs() lists."""
    return Slid(triggers, ifo_a, ifo_b, ((0, 0),), window_us, same_template, False)


def squares(s: np.ndarray, drop_broken: bool) -> tuple[np.ndarray, np.ndarray]:
    """Squares of ratios, broken ones counting as 0, and which of them count at all."""
    good = np.isfinite(s)
    held = np.where(good, s, 0.0)
    return held * held, good if drop_broken else np.ones(len(s), bool)


def _packed(drop_broken: bool) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        side, t, s = (table.column(c).to_numpy() for c in ("side", "t", "s"))
        x, stays = squares(s, drop_broken)
        out = {"bin": table.column("bin").combine_chunks()[:1]}
        for number, names in ((0, ("ta", "xa")), (1, ("tb", "yb"))):
            mine = np.flatnonzero((side == number) & stays)
            mine = mine[np.argsort(t[mine], kind="stable")]
            for name, values in zip(names, (t, x), strict=True):
                out[name] = pa.array([values[mine].tobytes()], pa.binary())
        return pa.table(out)

    return run


def units(b: Slid) -> DataFrame:
    """One row for each template and stretch of time with triggers of the first sensor: times and squares of both, in order of time."""
    far = max((abs(o) for _, o in b.offsets), default=0) + b.window_us
    width = max(far, 1)
    key = F.col("template_id").cast("string") if b.same_template else F.lit("")
    rows = b.triggers.select(key.alias("key"), "ifo", F.col("gps_us").alias("t"), F.col("new_snr").cast("double").alias("s")).filter("t is not null and key is not null")
    number = lambda c: F.floor(c / F.lit(width)).cast("long")
    first = rows.filter(F.col("ifo") == b.ifo_a).select("key", number(F.col("t")).alias("bin"), F.lit(0).alias("side"), "t", "s")
    second = rows.filter(F.col("ifo") == b.ifo_b).select("key", F.explode(F.sequence(number(F.col("t") - far), number(F.col("t") + far))).alias("bin"), F.lit(1).alias("side"), "t", "s")
    made = first.unionByName(second).groupBy("key", "bin").applyInArrow(_packed(b.drop_broken), _UNIT).filter("length(ta) > 0 and length(tb) > 0")
    return materialise(made, "units")


def dealt(rows: DataFrame) -> DataFrame:
    """Units over all cores, as their work is far larger than they are."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


def _opened(batch: pa.RecordBatch | pa.StructArray, i: int, names: tuple[str, ...] = ("ta", "xa", "tb", "yb")) -> list[np.ndarray]:
    column = batch.field if isinstance(batch, pa.StructArray) else batch.column
    return [np.frombuffer(column(n)[i].as_buffer(), np.int64 if n[0] == "t" else np.float64) for n in names]


def reach(ta: np.ndarray, tb: np.ndarray, offset: int, window: int, strict: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each time of the first sensor, which of the second's (rising) it meets: from, to."""
    before, after = ("right", "left") if strict else ("left", "right")
    lo = np.searchsorted(tb, ta - (offset + window), before)
    return lo, np.maximum(lo, np.searchsorted(tb, ta - (offset - window), after))


def expanded(lo: np.ndarray, hi: np.ndarray, most: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of both partners of all pairs, in blocks of about `most`."""
    n = hi - lo
    ends, s = np.cumsum(n), 0
    while s < len(n):
        e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + most, "right")))
        k = n[s:e]
        total = int(k.sum())
        if total:
            yield np.repeat(np.arange(s, e), k), np.arange(total) + np.repeat(lo[s:e] - (np.cumsum(k) - k), k)
        s = e


def statistics(unit: list[np.ndarray], b: Slid) -> Iterator[np.ndarray]:
    """The statistics of a unit's pairs of all slides, in blocks, as network_stat() gives them."""
    ta, xa, tb, yb = unit
    for _, offset in b.offsets:
        for i, j in expanded(*reach(ta, tb, offset, b.window_us, b.strict)):
            yield np.sqrt(xa[i] + yb[j])


def statistics_between(unit: list[np.ndarray], b: Slid, lo: float, hi: float) -> Iterator[np.ndarray]:
    """Those of statistics() above lo and up to hi, rising in each block.

    Where windows are long, neighbours share most of theirs, so sums of squares of a few neighbours with all that any of them meets are made at once and cut by value first.
    """
    ta, xa, tb, yb = unit
    least, most = (-np.inf if lo < 0 else lo * lo * (1 - 1e-12)), hi * hi * (1 + 1e-12)
    kept, held = [], 0
    for _, offset in b.offsets:
        begin, end = reach(ta, tb, offset, b.window_us, b.strict)
        step = int((end - begin).mean()) // 4
        if step < 32:
            found = (np.sqrt(xa[i] + yb[j]) for i, j in expanded(begin, end))
        else:
            found = _squares(xa, yb, begin, end, min(step, 64), least, most)
        for v in found:
            v = v[(v > lo) & (v <= hi)]
            kept.append(v)
            held += len(v)
            if held >= BLOCK:
                yield np.sort(np.concatenate(kept))
                kept, held = [], 0
    if held:
        yield np.sort(np.concatenate(kept))


def _squares(xa: np.ndarray, yb: np.ndarray, begin: np.ndarray, end: np.ndarray, step: int, least: float, most: float) -> Iterator[np.ndarray]:
    for s in range(0, len(xa), step):
        for p in range(begin[s], end[min(s + step, len(xa)) - 1], BLOCK // step):
            q = min(p + BLOCK // step, end[min(s + step, len(xa)) - 1])
            sums = xa[s : s + step, None] + yb[None, p:q]
            i, j = np.nonzero((sums >= least) & (sums <= most))
            good = (j + p >= begin[s + i]) & (j + p < end[s + i])
            yield np.sqrt(sums[i[good], j[good]])


def runs(ta: np.ndarray, tb: np.ndarray, b: Slid) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Stretches (from, to, sign) of the second sensor's places for each trigger of the first: signs summed, a place is met as often as by all slides.

    Slides whose windows nearly touch are one long stretch, of which what lies between them is taken away again, and where they overlap it counts once more. All ends rise along the first sensor's.
    """
    out: list[tuple[np.ndarray, np.ndarray, int]] = []
    for _, offset in sorted(b.offsets, key=lambda o: -o[1]):
        lo, hi = reach(ta, tb, offset, b.window_us, b.strict)
        if out and 4 * int(np.abs(lo - out[0][1]).sum()) <= int((hi - lo).sum()):
            begin, end, _ = out[0]
            for p, q, sign in ((end, np.maximum(end, lo), -1), (lo, np.maximum(end, lo), 1)):
                if (q > p).any():
                    out.append((p, q, sign))
            out[0] = begin, hi, 1
        else:
            out.insert(0, (lo, hi, 1))
    return out


def sums(xa: np.ndarray, yb: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[np.ndarray]:
    """Sums of squares of what a run meets, in blocks: neighbours share most of a long stretch, so STEP of them with what all of them meet are one outer sum."""
    if not len(begin) or (end - begin).mean() < 4 * STEP:
        yield from (xa[i] + yb[j] for i, j in expanded(begin, end))
        return
    first = np.arange(len(begin)) // STEP * STEP
    last = np.minimum(first + STEP, len(begin)) - 1
    apart = end[first] <= begin[last]
    for lo, hi in ((begin, np.where(apart, end, begin[last])), (np.where(apart, end, end[first]), end)):
        yield from (xa[i] + yb[j] for i, j in expanded(lo, hi))
    for s in np.flatnonzero(~apart & (first == np.arange(len(begin)))).tolist():
        for p in range(int(begin[last[s]]), int(end[s]), BLOCK // STEP):
            q = min(p + BLOCK // STEP, int(end[s]))
            yield (xa[s : last[s] + 1, None] + yb[None, p:q]).ravel()


def gathered(blocks: Iterator[np.ndarray], least: int) -> Iterator[np.ndarray]:
    """Blocks joined until they have `least` values."""
    held, n = [], 0
    for block in blocks:
        held.append(block)
        n += len(block)
        if n >= least:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def signed_statistics(unit: list[np.ndarray], b: Slid) -> Iterator[tuple[np.ndarray, int]]:
    """What statistics() gives, and with sign -1 what it has too many of."""
    ta, xa, tb, yb = unit
    for begin, end, sign in runs(ta, tb, b):
        for block in gathered(sums(xa, yb, begin, end), BLOCK):
            yield np.sqrt(block, out=block), sign


class Tiled:
    """The second sensor's squares in tiles of time, each in order of value, so that what lies between two values is one stretch of a tile."""

    def __init__(self, y: np.ndarray):
        self.y, full = y, len(y) // TILE
        body = y[: full * TILE].reshape(full, TILE)
        self.order = np.argsort(body, axis=1, kind="stable")
        self.sorted = np.take_along_axis(body, self.order, 1)
        self.order += (np.arange(full) * TILE)[:, None]
        #: Where each of BUCKETS parts of all values begins in each tile; searches tile by tile would cost more than the values that this lets in too many.
        self.edges = np.unique(np.sort(y)[:: max(1, len(y) // BUCKETS)])
        self.starts = np.array([np.searchsorted(v, self.edges, "left") for v in self.sorted] or np.zeros((0, len(self.edges))), np.int64)
        self.starts = np.concatenate([np.zeros((full, 1), np.int64), self.starts, np.full((full, 1), TILE)], 1) + (np.arange(full) * TILE)[:, None]

    def between(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray, lo: float, hi: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places of both partners, and statistics from lo on and below hi, of what a run meets."""
        for i, k, s in self._near(x, begin, end, lo, hi):
            v = np.sqrt(s)
            good = np.flatnonzero((v >= lo) & (v < hi))
            if len(good):
                i, k = i[good], k[good]
                if self.order.size:
                    k = np.where(k < 0, k, -1 - self.order.ravel()[np.maximum(k, 0)])
                yield i, -1 - k, v[good]

    def statistics_between(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray, lo: float, hi: float) -> Iterator[np.ndarray]:
        """The same statistics without the places."""
        for s in gathered((s for *_, s in self._near(x, begin, end, lo, hi)), BLOCK // 8):
            v = np.sqrt(s, out=s)
            good = (v >= lo) & (v < hi)
            yield v if good.all() else v[good]

    def _near(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray, lo: float, hi: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places of the first partner, those of the second in order of its tile (or -1 less its place), and sums, of what may lie between the bounds by rounding."""
        least, most = (-np.inf if lo <= 0 else lo * lo * (1 - 1e-12)), hi * hi * (1 + 1e-12)
        p, q = -(-begin // TILE), end // TILE
        whole = p < q
        for s, e in ((begin, np.where(whole, p * TILE, end)), (np.where(whole, q * TILE, end), end)):
            for i, j in expanded(s, e, BLOCK // 4):
                total = x[i] + self.y[j]
                good = np.flatnonzero((total >= least) & (total <= most))
                yield i[good], -1 - j[good], total[good]
        if not whole.any():
            return
        tiles = np.arange(p[whole][0], q[whole][-1])
        starts, ends = np.searchsorted(q, tiles, "right"), np.searchsorted(p, tiles, "right")
        with np.errstate(invalid="ignore"):
            below, above = np.searchsorted(self.edges, least - x, "right"), np.searchsorted(self.edges, most - x, "right") + 1
        flat = self.sorted.ravel()
        for tile, s, e in zip(tiles.tolist(), starts.tolist(), ends.tolist(), strict=True):
            if s < e:
                first = self.starts[tile].take(below[s:e])
                n = self.starts[tile].take(above[s:e]) - first
                upto = np.cumsum(n)
                if upto[-1]:
                    k = np.arange(upto[-1]) + np.repeat(first - upto + n, n)
                    i = np.repeat(np.arange(s, e), n)
                    yield i, k, x[i] + flat[k]


def _bare(b: Slid) -> Slid:
    """What a task needs to know."""
    return Slid(None, b.ifo_a, b.ifo_b, b.offsets, b.window_us, b.same_template, b.strict)


def _counts(made: DataFrame, b: Slid, places: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """How many pairs have each place; only places that occur come to the driver."""
    bare = _bare(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                for v, sign in signed_statistics(_opened(batch, i), bare):
                    p = places(v)
                    if len(p):
                        least = int(p.min())
                        held = np.bincount(p - least)
                        found[least : least + len(held)] += sign * held
        held = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(found[held])], ["place", "n"])

    found = dealt(made).mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return out


def order_statistics(made: DataFrame, b: Slid, wanted: Callable[[int], list[int]]) -> tuple[int, dict[int, float]]:
    """How many pairs there are, and the statistics at the places that `wanted` names for that number (a short list, from 0, in falling order of the statistic).

    Exact: statistics are not negative, so their bits are in their order, and each look at the pairs settles some more bits of the wanted ones.
    """
    shift = 64 - FIRST
    first = _counts(made, b, lambda v: v.view(np.int64) >> shift, 1 << (FIRST - 1))
    n = int(first.sum())
    state = {}
    for k in wanted(n):
        rising = n - 1 - k
        upto = np.cumsum(first)
        p = int(np.searchsorted(upto, rising, "right"))
        state[k] = (p, rising - (int(upto[p - 1]) if p else 0))
    while state and shift > 0:
        shift -= NEXT
        held = sorted({p for p, _ in state.values()})

        def places(v: np.ndarray, shift: int = shift, held: list[int] = held) -> np.ndarray:
            bits = v.view(np.int64) >> shift
            own = [(bits[(bits >> NEXT) == p] & ((1 << NEXT) - 1)) + (i << NEXT) for i, p in enumerate(held)]
            return np.concatenate(own)

        found = _counts(made, b, places, len(held) << NEXT).reshape(len(held), -1)
        for k, (p, left) in state.items():
            upto = np.cumsum(found[held.index(p)])
            q = int(np.searchsorted(upto, left, "right"))
            state[k] = ((p << NEXT) | q, left - (int(upto[q - 1]) if q else 0))
    return n, {k: float(np.array([p], np.int64).view(np.float64)[0]) for k, (p, _) in state.items()}


def sorted_numbers(values: list[np.ndarray]) -> np.ndarray:
    every = np.concatenate(values)
    return np.sort(every[~np.isnan(every)])


def _ranker(b: Slid, bounds: list[tuple[float, float, int]], out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (g, kind, v, row, unit) in order of g and kind: the foreground rows of a group, then all units."""
        group, rows, values, known, found = None, [], [], None, None

        def flush() -> Iterator[pa.RecordBatch]:
            if not rows:
                return
            every, counts = (sorted_numbers(values), 0) if known is None else (known, found)
            counts = np.zeros(len(every) + 1, np.int64) + counts
            louder = np.cumsum(counts[::-1])[::-1] + bounds[group][2]
            for r, v in zip(rows, values, strict=True):
                n = np.where(np.isnan(v), 0, louder[np.searchsorted(every, v, "right")])
                yield pa.RecordBatch.from_arrays([r, pa.array(n)], schema=out)

        for batch in batches:
            g, kind = (batch.column(i).to_numpy() for i in range(2))
            cuts = [0, *(np.flatnonzero((np.diff(g) != 0) | (np.diff(kind) != 0)) + 1).tolist(), len(g)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                if g[s] != group:
                    yield from flush()
                    group, rows, values, known, found = int(g[s]), [], [], None, None
                if kind[s] == 0:
                    rows.append(batch.column(3).slice(s, e - s))
                    values.append(batch.column(2).slice(s, e - s).to_numpy(zero_copy_only=False))
                    continue
                if not rows:
                    continue
                if known is None:
                    known = sorted_numbers(values)
                    found = np.zeros(len(known) + 1, np.int64)
                lo, hi, _ = bounds[group]
                column = batch.column(4)
                for i in range(s, e):
                    for v in statistics_between(_opened(column, i), b, lo, hi):
                        at = np.searchsorted(known, v, "right")
                        if len(at):
                            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                            found[at[first]] += np.diff(np.append(first, len(at)))
        yield from flush()

    return run


def count_louder(foreground: DataFrame, b: Slid, stat: str = "network_stat") -> DataFrame:
    """foreground with n_louder (background pairs of a statistic >= its own) and n_background; neither side is written, and the background isn't shuffled.

    Foreground rows are dealt once, by ranges of the statistic of about equally many rows (a tie too large for one task is several); a task holds its rows and makes the background again to count
    what falls between them. What lies above a range is counted for all ranges by one look. A null or NaN value has n_louder 0.
    Few foreground rows (ranks.MOST_ASKED at most) are one array of values, by which all tasks count in one look.
    """
    spark, made = foreground.sparkSession, units(b)
    value = F.when(F.isnan(stat), None).otherwise(F.col(stat)).cast("double")
    rows = foreground.select(value.alias("v"), F.struct(*[F.col(f"`{c}`") for c in foreground.columns]).alias("_row"))
    n = foreground.count()
    if n <= min(MOST_RANKED, ranks.MOST_ASKED):
        return _count_louder_of_few(rows, made, b)
    pieces = max(ceil(n / MOST_RANKED), min(spark.sparkContext.defaultParallelism, ceil(n / LEAST_RANKED)))
    inner = []
    if pieces > 1:
        shares = [i / pieces for i in range(1, pieces)]
        inner = sorted(set(rows.agg(F.percentile_approx("v", shares, max(1_000, 20 * pieces))).first()[0] or []))
    held = np.array(inner)
    background = _counts(made, b, lambda v: np.searchsorted(held, v, "left"), len(inner) + 1)
    ranged = rows.withColumn("r", ranks.range_of(F.col("v"), inner))
    sizes = dict(ranged.groupBy("r").count().collect()) if pieces > 1 else {0: n}
    salts = [max(1, ceil(sizes.get(r, 0) / (2 * MOST_RANKED))) for r in range(len(inner) + 1)]
    starts = np.cumsum([0, *salts]).tolist()
    edges = [-np.inf, *inner, np.inf]
    above = (np.cumsum(background[::-1])[::-1] - background).tolist()
    bounds = [(edges[r], edges[r + 1], above[r]) for r in range(len(inner) + 1) for _ in range(salts[r])]
    at = lambda listed: F.element_at(F.array(*map(F.lit, listed)), F.col("r") + 1)
    spread = F.pmod(F.xxhash64("_row"), at(salts)) if max(salts) > 1 else F.lit(0)
    dealt = ranged.select((at(starts[:-1]) + spread).cast("int").alias("g"), F.lit(0).alias("kind"), "v", "_row")
    every = made.crossJoin(F.broadcast(spark.range(starts[-1]).select(F.col("id").cast("int").alias("g"))))  # the numbers of groups
    every = every.select("g", F.lit(1).alias("kind"), F.struct("ta", "xa", "tb", "yb").alias("unit"))
    line = dealt.unionByName(every, allowMissingColumns=True).select("g", "kind", "v", "_row", "unit")
    line = line.repartitionById(starts[-1], "g").sortWithinPartitions("g", "kind")
    schema = rows.select("_row", F.lit(0).cast("long").alias("louder")).schema
    out = line.mapInArrow(_ranker(_bare(b), bounds, to_arrow_schema(schema)), schema)
    return out.select("_row.*", F.col("louder").alias("n_louder"), F.lit(int(background.sum())).cast("long").alias("n_background"))


def _count_louder_of_few(rows: DataFrame, made: DataFrame, b: Slid) -> DataFrame:
    known = np.unique(rows.select("v").filter("v is not null").toArrow().column(0).to_numpy())
    background = _counts_between(made, b, known)
    louder = np.cumsum(background[::-1])[::-1][1:].copy()
    found = rows.sparkSession.createDataFrame(pa.table({"_known": pa.array(known, pa.float64()), "_louder": pa.array(louder, pa.int64())}))
    out = rows.join(F.broadcast(found), F.col("v") == F.col("_known"), "left")
    return out.select("_row.*", F.coalesce("_louder", F.lit(0)).cast("long").alias("n_louder"), F.lit(int(background.sum())).cast("long").alias("n_background"))


def _counts_between(made: DataFrame, b: Slid, known: np.ndarray) -> np.ndarray:
    """How many pairs lie below the first of some rising values, from each on and below the next, and so on. Blocks are sorted, so a value is looked up once a block."""
    bare, most = _bare(b), max(8 * BLOCK, 16 * len(known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, sizes = np.zeros(len(known) + 1, np.int64), {1: [], -1: []}, {1: 0, -1: 0}

        def add(sign: int) -> None:
            if sizes[sign]:
                v = np.concatenate(held[sign])
                v.sort()
                found[:] += sign * np.diff(np.searchsorted(v, known, "left"), prepend=0, append=len(v))
                held[sign], sizes[sign] = [], 0

        for batch in batches:
            for i in range(batch.num_rows):
                for v, sign in signed_statistics(_opened(batch, i), bare):
                    held[sign].append(v)
                    sizes[sign] += len(v)
                    if sizes[sign] >= most:
                        add(sign)
        for sign in held:
            add(sign)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["place", "n"])

    found = dealt(made).mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(known) + 1, np.int64)
    out[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return out


def by_offset(b: Slid) -> DataFrame:
    """slide, offset_us, n, loudest of each slide that has pairs: by two searches and the largest square between them for each trigger, so the work grows with the triggers."""
    bare = _bare(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, most = np.zeros(len(bare.offsets), np.int64), np.full(len(bare.offsets), -1.0)
        for batch in batches:
            for i in range(batch.num_rows):
                ta, xa, tb, yb = _opened(batch, i)
                largest = Largest(yb)
                for k, (_, offset) in enumerate(bare.offsets):
                    lo, hi = reach(ta, tb, offset, bare.window_us, bare.strict)
                    n[k] += (hi - lo).sum()
                    met = np.flatnonzero(hi > lo)
                    if len(met):
                        most[k] = max(most[k], (xa[met] + largest.between(lo[met], hi[met])).max())
        held = np.flatnonzero(n)
        slide, offset = (np.array([o[c] for o in bare.offsets], np.int64)[held] for c in range(2))
        yield pa.RecordBatch.from_arrays([pa.array(slide), pa.array(offset), pa.array(n[held]), pa.array(np.sqrt(most[held]))], ["slide", "offset_us", "n", "loudest"])

    found = dealt(units(b)).mapInArrow(run, "slide long, offset_us long, n long, loudest double")
    return found.groupBy("slide", "offset_us").agg(F.sum("n").alias("n"), F.max("loudest").alias("loudest"))


class Largest:
    """The largest value between two places of an array, by those of all stretches of 1, 2, 4 ... values; levels are made when they are asked for."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]

    def between(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of each [lo, hi), none of them empty."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo))
        for k in np.unique(level).tolist():
            while len(self.levels) <= k:
                last, half = self.levels[-1], 1 << (len(self.levels) - 1)
                self.levels.append(np.maximum(last[:-half], last[half:]))
            mine = np.flatnonzero(level == k)
            out[mine] = np.maximum(self.levels[k][lo[mine]], self.levels[k][hi[mine] - (1 << k)])
        return out


class AtLeast:
    """How many values between two places of an array have a rank of at least so much, by the sorted ranks of all stretches of 1, 2, 4 ... values; levels are made when they are asked for."""

    def __init__(self, ranks: np.ndarray):
        self.ranks, self.levels = ranks, []

    def between(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray) -> np.ndarray:
        out, lo, hi, k = np.zeros(len(lo), np.int64), lo.copy(), hi.copy(), 0
        while (lo < hi).any():
            odd = np.flatnonzero((lo < hi) & (lo & 1 == 1))
            out[odd] += self._in(k, lo[odd], least[odd])
            lo[odd] += 1
            odd = np.flatnonzero((lo < hi) & (hi & 1 == 1))
            hi[odd] -= 1
            out[odd] += self._in(k, hi[odd], least[odd])
            lo, hi, k = lo >> 1, hi >> 1, k + 1
        return out

    def _in(self, k: int, stretch: np.ndarray, least: np.ndarray) -> np.ndarray:
        n = len(self.ranks)
        while len(self.levels) <= k:
            self.levels.append(np.sort((np.arange(n) >> len(self.levels)) * n + self.ranks))
        return np.minimum((stretch + 1) << k, n) - np.searchsorted(self.levels[k], stretch * n + least, "left")


def _merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals of integers, both ends included, that neither touch nor overlap."""
    order = np.argsort(lo, kind="stable")
    lo, upto = lo[order], np.maximum.accumulate(hi[order])
    opens = np.flatnonzero(np.append(True, lo[1:] > upto[:-1] + 1)) if len(lo) else np.zeros(0, np.int64)
    return lo[opens], np.append(upto[opens[1:] - 1], upto[-1:])


def _counted(unit: list[np.ndarray], met: tuple[np.ndarray, np.ndarray], lo: np.ndarray, hi: np.ndarray, loud: float, largest: Largest, louder: AtLeast, rising: np.ndarray) -> tuple[int, int, float]:
    """Number, number of a statistic above `loud`, and largest square of a unit's pairs whose mean time (floored) lies in one of the intervals: for each trigger these are a few stretches of the second sensor's."""
    (ta, xa, tb, _), (begin, end) = unit, met
    rows = np.flatnonzero(end > begin)
    first, last = ta[rows] + tb[begin[rows]], ta[rows] + tb[end[rows] - 1]
    n, n_loud, most = 0, 0, -1.0
    for i, k in expanded(np.searchsorted(2 * hi + 1, first, "left"), np.searchsorted(2 * lo, last, "right")):
        i = rows[i]
        p, q = np.maximum(begin[i], np.searchsorted(tb, 2 * lo[k] - ta[i], "left")), np.minimum(end[i], np.searchsorted(tb, 2 * hi[k] + 1 - ta[i], "right"))
        good = np.flatnonzero(q > p)
        if len(good):
            i, p, q = i[good], p[good], q[good]
            n += int((q - p).sum())
            most = max(most, float((xa[i] + largest.between(p, q)).max()))
            below, above = np.zeros(len(i), np.int64), np.full(len(i), len(rising))
            while (below < above).any():  # the first of the rising squares that is loud with this trigger's
                middle = np.minimum((below + above) // 2, len(rising) - 1)
                yes = np.sqrt(xa[i] + rising[middle]) > loud
                above, below = np.where((below < above) & yes, middle, above), np.where((below < above) & ~yes, middle + 1, below)
            n_loud += int(louder.between(p, q, below).sum())
    return n, n_loud, most


def known_and_new(b: Slid, catalogue: DataFrame, time: str, tolerance: int, loud: float) -> DataFrame:
    """known, n, n_loud, loudest of the pairs of a finite statistic by whether their mean time (floored) lies within the tolerance of a catalogue time, both ends included; groups without pairs have no row.

    Of a cell as wide as the tolerance only the first and the last catalogue time count, as those between reach no further. Pairs are not made: the work grows with the triggers and the catalogue, by a few searches each.
    """
    width, bare = max(b.window_us, 1), _bare(b)
    number = lambda c: F.floor(c / F.lit(width)).cast("long")
    t = F.col(time).cast("long")
    cells = catalogue.filter(t.isNotNull()).groupBy(F.floor(t / F.lit(max(1, tolerance))).alias("cell")).agg(F.min(t).alias("lo"), F.max(t).alias("hi")).select((F.col("lo") - tolerance).alias("lo"), (F.col("hi") + tolerance).alias("hi"))
    by_bin = cells.withColumn("bin", F.explode(F.sequence(number(F.col("lo") - width), number(F.col("hi") + width)))).groupBy("bin").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("c"))
    met = units(b).join(by_bin.select("bin", F.col("c.lo").alias("lo"), F.col("c.hi").alias("hi")), "bin", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {True: [0, 0, -1.0], False: [0, 0, -1.0]}
        for batch in batches:
            for r in range(batch.num_rows):
                unit = ta, xa, tb, yb = _opened(batch, r)
                lo, hi = (np.array(batch.column(c)[r].as_py() or [], np.int64) for c in ("lo", "hi"))
                lo, hi = _merged(lo, hi)
                far = np.int64(1 << 61)
                sides = {True: (lo, hi), False: (np.append(-far, hi + 1), np.append(lo - 1, far))}
                for _, offset in bare.offsets:
                    reached = reach(ta, tb + offset, 0, bare.window_us, bare.strict)
                    if np.isfinite(xa.max() + yb.max()):
                        order = np.argsort(yb, kind="stable")
                        place = np.empty(len(yb), np.int64)
                        place[order] = np.arange(len(yb))
                        largest, louder = Largest(yb), AtLeast(place)
                        counts = {k: _counted([ta, xa, tb + offset, yb], reached, *v, loud, largest, louder, yb[order]) for k, v in sides.items()}
                    else:
                        counts = _by_pairs(unit, offset, reached, lo, hi, loud)
                    for k, (n, n_loud, most) in counts.items():
                        found[k] = [found[k][0] + n, found[k][1] + n_loud, max(found[k][2], most)]
        held = [(k, n, n_loud, float(np.sqrt(most))) for k, (n, n_loud, most) in found.items() if n]
        yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], kind) for i, kind in enumerate((pa.bool_(), pa.int64(), pa.int64(), pa.float64()))], ["known", "n", "n_loud", "loudest"])

    out = dealt(met).mapInArrow(run, "known boolean, n long, n_loud long, loudest double")
    return out.groupBy("known").agg(F.sum("n").alias("n"), F.sum("n_loud").alias("n_loud"), F.max("loudest").alias("loudest"))


def _by_pairs(unit: list[np.ndarray], offset: int, reached: tuple[np.ndarray, np.ndarray], lo: np.ndarray, hi: np.ndarray, loud: float) -> dict[bool, tuple[int, int, float]]:
    """What _counted() gives for both kinds, pair by pair, as sums that overflow take no part."""
    ta, xa, tb, yb = unit
    found = {True: (0, 0, -1.0), False: (0, 0, -1.0)}
    for i, j in expanded(*reached):
        with np.errstate(over="ignore"):
            x = xa[i] + yb[j]
        middle = (ta[i] + tb[j] + offset) >> 1
        k = np.searchsorted(hi, middle, "left")
        known = np.append(lo, np.iinfo(np.int64).max)[k] <= middle
        for kind in found:
            v = x[np.isfinite(x) & (known == kind)]
            n, n_loud, most = found[kind]
            found[kind] = (n + len(v), n_loud + int((np.sqrt(v) > loud).sum()), max(most, float(v.max(initial=-1.0))))
    return found
