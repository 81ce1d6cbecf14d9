"""SimHash near-deduplication by tiled exact comparison.

Fingerprints: a text is lower-cased (A-Z) and cut into words at ASCII white space; each run of three words,
repeats included, is hashed by XXH64 (seed 42); a bit of the fingerprint is set if over half of the hashes set it.

Links: fingerprints that differ in RADIUS bits or fewer. Distinct fingerprints (each with its smallest doc_id,
so copies count once) are laid into cells by the population counts of their two halves and, where a cell is
large, into tiles of TILE_ROWS. A differing bit changes one half's count by one, so tiles whose counts differ
by more than RADIUS in sum are never paired, and no link is lost. A task compares a pair of tiles by numpy exclusive-or and
bit counts, in blocks of BLOCK fingerprints ordered by the counts of their quarters; blocks whose counts differ beyond
the radius are skipped in the same way. A task emits a spanning forest of its links, not the links: at most one edge
per fingerprint, so a group of near copies costs its size and not its square.

Components: alternating large-star and small-star steps over the edges, each a map-side combined minimum and
a join, written to the shared folder between rounds; nothing is collected.

Defined results: null text counts as empty; fewer than three words are one shingle; no words give fingerprint
zero, linked like any other. Null doc_ids count as larger than all others: a group of only such rows has a null
component_id. Repeated rows share one component; extra columns are ignored. drop_near_duplicates() keeps the row with the smallest
doc_id of each component (then the smallest hash of the text); rows equal in doc_id and text are one document there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybeam.llm.common import LOWER_ASCII, drop_marked, map_batches, materialise, release, texts

WORDS, SEED, RADIUS = 3, 42, 3
#: Fingerprints in a tile (8 bytes each; a task holds two tiles) and in a block of the comparison.
TILE_ROWS, BLOCK = 1 << 16, 512


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint as an unsigned 64-bit number."""
    found = text.translate(LOWER_ASCII).split()
    if not found:
        return 0
    if len(found) <= words:
        return xxhash.xxh64_intdigest(b" ".join(found), seed)
    joined = b" ".join(found)
    ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), len(joined))
    starts = np.append(0, ends[:-1] + 1)
    digest = xxhash.xxh64_intdigest
    n = len(found) - words + 1
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[words - 1 :].tolist(), strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 14):
        ones += np.unpackbits(hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, fp long (the fingerprint's 64 bits), digest long (of the text; with doc_id it tells rows apart)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(x, words, seed) for x in texts(batch.column(1))], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), batch.column(2)], ["doc_id", "fp", "digest"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("digest")), work, "doc_id long, fp long, digest long", "text")


def quarter_counts(fps: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit quarters, one row for each fingerprint."""
    return np.stack([np.bitwise_count(fps >> np.uint64(16 * i) & np.uint64(0xFFFF)) for i in range(4)], axis=1).astype(np.int16)


class Blocks:
    """Fingerprints ordered by their quarters' counts, in blocks that know the least and largest counts."""

    def __init__(self, fps: np.ndarray):
        counts = quarter_counts(fps)
        order = np.lexsort(counts.T[::-1])
        self.fps, counts = fps[order], counts[order]
        self.starts = np.arange(0, len(fps), BLOCK)
        self.low, self.high = (f.reduceat(counts, self.starts, axis=0) if len(fps) else counts for f in (np.minimum, np.maximum))

    def block(self, i: int) -> np.ndarray:
        return self.fps[self.starts[i] : self.starts[i] + BLOCK]


def links(a: Blocks, b: Blocks, radius: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in a.fps and b.fps of all pairs within the radius; for one tile against itself, each pair once."""
    for i in range(len(a.starts)):
        gap = np.maximum(0, np.maximum(b.low - a.high[i], a.low[i] - b.high)).sum(axis=1)
        mine = a.block(i)[:, None]
        for j in np.flatnonzero(gap <= radius):
            if same and j < i:
                continue
            x, y = np.nonzero(np.bitwise_count(mine ^ b.block(j)) <= radius)
            if same and i == j:
                x, y = x[(keep := x < y)], y[keep]
            if len(x):
                yield x + a.starts[i], y + b.starts[j]


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest position that each of n positions is connected with by the pairs."""
    root = np.arange(n)

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for xs, ys in pairs:
        for x, y in zip(xs.tolist(), ys.tolist(), strict=True):
            if (p := top(x)) != (q := top(y)):
                root[max(p, q)] = min(p, q)
    while not np.array_equal(root, up := root[root]):
        root = up
    return root


def _compare(left: np.ndarray, right: np.ndarray | None, radius: int) -> pa.RecordBatch:
    """Edges (a, b) that span the links of one pair of tiles; right is None for a tile against itself."""
    a = Blocks(left)
    if right is None:
        fps, pairs = a.fps, links(a, a, radius, True)
    else:
        b = Blocks(right)
        fps, pairs = np.concatenate([a.fps, b.fps]), ((x, y + len(left)) for x, y in links(a, b, radius, False))
    root = forest(len(fps), pairs)
    moved = np.flatnonzero(root != np.arange(len(root)))
    fps = fps.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(fps[moved]), pa.array(fps[root[moved]])], ["a", "b"])


def _compare_sorted(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (pair, side, fp) in order of pair, several pairs in a task."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        current = 0

        def flush() -> pa.RecordBatch:
            side, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            fp = fp.view(np.uint64)
            return _compare(fp, None, radius) if current & 1 else _compare(fp[side == 0], fp[side == 1], radius)

        for batch in batches:
            pair, side, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = (np.flatnonzero(np.diff(pair)) + 1).tolist()
            for s, e in zip([0, *cuts], [*cuts, len(pair)], strict=True):
                if s < e and held and pair[s] != current:
                    yield flush()
                    held = []
                if s < e:
                    current = int(pair[s])
                    held.append((side[s:e], fp[s:e]))
        if held:
            yield flush()

    return run


def tile_pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """pair, side, tile: each pair of tiles whose halves' counts differ by the radius in sum at most, as one row for each side.

    A tile's pair with itself has an odd number and side 0 only; the others have even numbers.
    """
    shifts = [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1) if abs(x) + abs(y) <= radius]
    near = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in shifts]))
    a = tiles.select(F.col("tile").alias("ta"), F.col("high").alias("ha"), F.col("low").alias("la"), near.alias("s"))
    a = a.select("ta", (F.col("ha") + F.col("s.x")).alias("high"), (F.col("la") + F.col("s.y")).alias("low"))
    b = tiles.select(F.col("tile").alias("tb"), "high", "low")
    both = a.join(b, ["high", "low"]).filter("ta <= tb").select("ta", "tb")
    pair = F.when(F.col("ta") == F.col("tb"), F.xxhash64("ta", "tb").bitwiseOR(F.lit(1))).otherwise(F.xxhash64("ta", "tb").bitwiseAND(F.lit(-2)))
    both = both.withColumn("pair", pair)
    sides = F.when(F.col("ta") == F.col("tb"), F.array(F.struct(F.lit(0).alias("side"), F.col("ta").alias("tile")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("ta").alias("tile")), F.struct(F.lit(1).alias("side"), F.col("tb").alias("tile")))
    )
    return both.select("pair", F.explode(sides).alias("s")).select("pair", "s.side", "s.tile")


def edges(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """a, b: edges between distinct fingerprints (column fp) that connect all that are linked, and no others."""
    half = lambda shift: F.bit_count(F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(0xFFFFFFFF)))
    rows = fps.select("fp", half(32).alias("high"), half(0).alias("low"))
    cells = rows.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.ceil(F.col("n") / tile_rows))  # 33 * 33 rows at most
    cells = F.broadcast(materialise(cells, "cells"))
    number = lambda part: (F.col("high") * 64 + F.col("low")).cast("long") * (1 << 40) + part
    rows = rows.join(cells, ["high", "low"]).select("fp", number(F.pmod(F.xxhash64("fp"), F.col("parts"))).alias("tile"))
    tiles = cells.select("high", "low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")).select("high", "low", number(F.col("part")).alias("tile"))
    pairs = tile_pairs(tiles, radius)
    dealt = rows.join(pairs, "tile").select("pair", "side", "fp").repartition("pair").sortWithinPartitions("pair")
    return dealt.mapInArrow(_compare_sorted(radius), "a long, b long")


def components(pairs: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of the pairs (a, b) is connected with.

    Each round is a large-star step (a node's larger neighbours link to its smallest one) and a small-star
    step (a node and its smaller neighbours link to the smallest one), until a round changes nothing.
    """
    edges = materialise(pairs.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        new = materialise(small.filter("u <> v").distinct(), "small-star")
        now = new.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        release(large)
        release(edges)
        edges = new
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def grouped(docs: DataFrame, radius: int = RADIUS, words: int = WORDS, seed: int = SEED, tile_rows: int = TILE_ROWS) -> DataFrame:
    """doc_id, digest, fp, first (no_id, doc_id, digest of the component's first row): one row per document."""
    prints = materialise(with_fingerprints(docs, words, seed), "fingerprints")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest"))
    distinct = materialise(prints.groupBy("fp").agg(least.alias("least")), "distinct-fingerprints")
    roots = components(edges(distinct.select("fp"), radius, tile_rows))
    placed = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = materialise(placed, "placed")
    groups = placed.groupBy("root").agg(F.min("least").alias("first"))
    named = materialise(placed.join(groups, "root").select("fp", "first"), "named")
    return prints.join(named, "fp").select("doc_id", "digest", "fp", "first")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per document. Options are those of grouped()."""
    return grouped(docs, **options).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """docs without all but the first row of each component; all columns kept."""
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))
    return drop_marked(docs, materialise(grouped(docs, **options).filter(~stays).select("doc_id", "digest").distinct(), "near-copies"))
