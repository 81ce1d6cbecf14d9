"""Near-deduplication by exact Jaccard similarity, with SimHash fingerprints that find the candidates.

A text's set of shingles is that of simhash (lower-cased words, runs of five here). Texts with equal sets are one node. A node's
fingerprint has 256 bits, as 64 are too few to tell a similarity of 0.8, and takes each different shingle once. Candidates are nodes whose
fingerprints differ in RADIUS bits or fewer (in FIRST_RADIUS or fewer of the first 64) and whose sets' sizes allow the similarity; a candidate pair is a link if the exact Jaccard similarity of its sets is LEAST or more.

Comparison: tiled exclusive-or and bit counts. Nodes lie in cells by the logarithm of their set's size, and large cells in tiles; sizes
of similar sets differ by a factor of 1 / LEAST at most, so only a cell and the next one meet, and in a task only blocks whose
sizes are that close. Neither loses a candidate. A task emits a spanning forest of its candidate pairs, a row for each node at most.

Verification: only nodes of one component of the candidate pairs, a class, can be linked. Hashes of their shingles (64 bits, taken for the shingles themselves)
are written once, and classes are dealt out in blocks of BLOCK_ROWS nodes and BLOCK_SHINGLES shingles in expectation. A task computes the exact similarity of all pairs of a block by
counting common shingles, and emits a spanning forest of the links. A class of one block is settled by that. A larger one is cut into blocks twice by
different hashes; then the nodes that are not in its largest component so far are compared with all of the class, block by block. So no link is
lost, and a group of near copies costs its size times a block unless its members are mostly unlike.

Defined results: null text counts as empty, and a text without words has the empty set; fewer than five words are one
shingle. The row with the smallest doc_id of a component stays (then the smallest hash of the text), null doc_ids last.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybeam.llm.common import LOWER_ASCII, bound_batches, drop_marked, map_batches, materialise, split, texts
from tallybeam.llm.simhash import SEED, components

#: Words of a shingle, percent of similarity.
WORDS, LEAST = 5, 80
#: Bits of a fingerprint in words of 64, and the most that differ: in the first word and in all. At a similarity of 0.8, a word of two fingerprints
#: differs by 9.7 bits on average with a deviation of 2.9, four by 39 with 5.7; unlike ones differ by 32 (4) and 128 (8).
FPS, FIRST_RADIUS, RADIUS = ("fp0", "fp1", "fp2", "fp3"), 25, 72
TILE_ROWS, BLOCK = 1 << 14, 512
BLOCK_ROWS, BLOCK_SHINGLES = 1 << 10, 1 << 20
#: Shingles of fewer nodes are counted by joining them, others by bits, COLUMNS at once.
COMMON, COLUMNS = 16, 1 << 12


def shingles(text: bytes, words: int = WORDS) -> set[bytes]:
    found = text.translate(LOWER_ASCII).split()
    if len(found) <= words:
        return {b" ".join(found)} if found else set()
    return {b" ".join(found[i : i + words]) for i in range(len(found) - words + 1)}


def mixed(x: np.ndarray, turn: int) -> np.ndarray:
    """Other 64-bit numbers for each turn, different for different numbers."""
    x = x * np.uint64(0x9E3779B97F4A7C15 + 2 * turn)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def shingle_hashes(text: bytes, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The set of shingles as sorted 64-bit numbers."""
    found = shingles(text, words)
    return np.sort(np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in found), np.uint64, len(found)))


def sketch(text: bytes, words: int = WORDS, seed: int = SEED) -> tuple[int, ...]:
    """Hash of the set of shingles, size of the set, and the fingerprint's words."""
    hashes = shingle_hashes(text, words, seed)
    ones = np.zeros(64 * len(FPS), np.int64)
    for i in range(0, len(hashes), 1 << 12):
        part = hashes[i : i + (1 << 12)]
        bits = np.stack([part, *(mixed(part, turn) for turn in range(1, len(FPS)))], axis=1).view(np.uint8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return xxhash.xxh64_intdigest(hashes.tobytes(), seed), len(hashes), *np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64).tolist()


def with_sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, digest long (of the text), node long, size long, fingerprint words long."""
    names = ["node", "size", *FPS]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([sketch(x, words) for x in texts(batch.column(1))], np.uint64).reshape(-1, len(names)).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(np.ascontiguousarray(x)) for x in found.T)], ["doc_id", "digest", *names])

    schema = ", ".join(f"{c} long" for c in ("doc_id", "digest", *names))
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("digest")), work, schema, "text")


class Tile:
    """Rows (node, size, fingerprint words) in order of size."""

    def __init__(self, node: np.ndarray, size: np.ndarray, *fps: np.ndarray):
        order = np.argsort(size, kind="stable")
        self.node, self.size = node[order], size[order]
        self.fps = np.stack(fps).view(np.uint64)[:, order]
        self.starts = range(0, len(node), BLOCK)


def candidates(a: Tile, b: Tile, radius: int, least: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in a and b of all candidate pairs; for one tile against itself, each pair once."""
    for i in a.starts:
        mine = slice(i, i + BLOCK)
        fps, size = a.fps[:, mine], a.size[mine]
        for j in b.starts:
            other = slice(j, j + BLOCK)
            theirs = b.size[other]
            if (same and j < i) or 100 * theirs[-1] < least * size[0] or 100 * size[-1] < least * theirs[0]:
                continue
            x, y = np.nonzero(np.bitwise_count(fps[0][:, None] ^ b.fps[0, other]) <= FIRST_RADIUS)
            s, t = size[x], theirs[y]
            apart = np.bitwise_count(fps[:, x] ^ b.fps[:, other][:, y]).sum(axis=0, dtype=np.int64)
            keep = (apart <= radius) & (100 * np.minimum(s, t) >= least * np.maximum(s, t))
            if same and i == j:
                keep &= x < y
            if keep.any():
                yield x[keep] + i, y[keep] + j


def roots(n: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest position that each of n positions is connected with by the pairs."""
    root = np.arange(n)
    for x, y in pairs:
        while len(keep := np.flatnonzero(root[x] != root[y])):
            x, y = x[keep], y[keep]
            np.minimum.at(root, np.maximum(root[x], root[y]), np.minimum(root[x], root[y]))
            while not np.array_equal(root, up := root[root]):
                root = up
    return root


def forest(node: np.ndarray, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Edges (a, b) of nodes that connect what the pairs of positions connect."""
    root = roots(len(node), pairs)
    moved = np.flatnonzero(root != np.arange(len(root)))
    return pa.RecordBatch.from_arrays([pa.array(node[root[moved]]), pa.array(node[moved])], ["a", "b"])


def by_group(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.RecordBatch]]:
    """The rows of each group, from batches in order of the first `keys` columns (long)."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        cuts = np.flatnonzero(np.any([np.diff(c) != 0 for c in columns], axis=0)) + 1
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if s < e:
                if held and (key := tuple(c[s] for c in columns)) != current:
                    yield held
                    held = []
                current = tuple(c[s] for c in columns)
                held.append(batch.slice(s, e - s))
    if held:
        yield held


def _compare(radius: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (ta, tb, side, node, size, fingerprint words) in order of the pair of tiles, several pairs in a task."""
        for held in by_group(batches, 2):
            ta, tb, side, *rows = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(held[0].num_columns))
            if ta[0] == tb[0]:
                tile = Tile(*rows)
                yield forest(tile.node, candidates(tile, tile, radius, least, True))
            else:
                a, b = (Tile(*(r[side == n] for r in rows)) for n in (0, 1))
                yield forest(np.concatenate([a.node, b.node]), ((x, y + len(a.node)) for x, y in candidates(a, b, radius, least, False)))

    return run


def compared(nodes: DataFrame, radius: int, least: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """a, b: pairs of `nodes` (node, size, fingerprint words) that connect all candidate pairs, and no others."""
    bound_batches(nodes.sparkSession)
    cell = F.when(F.col("size") > 0, F.floor(F.log(F.col("size").cast("double")) / math.log(100 / least))).otherwise(-2).cast("long")
    rows = nodes.select("node", "size", *FPS, cell.alias("cell"))
    cells = F.broadcast(materialise(rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("long").alias("parts")), "cells"))  # some hundred rows
    number = lambda c, part: c * (1 << 40) + part
    tiles = cells.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")).select("cell", number(F.col("cell"), F.col("part")).alias("tile"))
    near = tiles.select(F.col("tile").alias("ta"), F.explode(F.array(F.col("cell"), F.col("cell") + 1)).alias("cell"))
    pairs = near.join(tiles.select(F.col("tile").alias("tb"), "cell"), "cell").filter("ta <= tb")
    side = lambda n, t: F.struct(F.lit(n).alias("side"), F.col(t).alias("tile"))
    sides = pairs.select("ta", "tb", F.explode(F.when(F.col("ta") == F.col("tb"), F.array(side(0, "ta"))).otherwise(F.array(side(0, "ta"), side(1, "tb")))).alias("s")).select("ta", "tb", "s.side", "s.tile")
    dealt = rows.join(cells, "cell").withColumn("tile", number(F.col("cell"), F.pmod(F.xxhash64("node"), F.col("parts")))).join(sides, "tile")
    dealt = dealt.select("ta", "tb", "side", "node", "size", *FPS).repartition("ta", "tb").sortWithinPartitions("ta", "tb")
    return dealt.mapInArrow(_compare(radius, least), "a long, b long")


class Sets:
    """Sets of numbers: for each entry its row and its code."""

    def __init__(self, columns: list[pa.ListArray]):
        self.size = np.concatenate([np.diff(c.offsets.to_numpy()) for c in columns]).astype(np.int64)
        self.code = np.concatenate([c.flatten().to_numpy() for c in columns])
        self.row = np.repeat(np.arange(len(self.size)), self.size)

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and positions in `codes` (sorted) of the entries that are among them, in order of position."""
        at = np.minimum(np.searchsorted(codes, self.code), max(0, len(codes) - 1))
        keep = np.flatnonzero(codes[at] == self.code) if len(codes) else np.zeros(0, int)
        keep = keep[np.argsort(at[keep], kind="stable")]
        return self.row[keep], at[keep]


def shared(a: Sets, b: Sets, common: int = COMMON) -> np.ndarray:
    """Numbers of common elements of each set of a with each of b."""
    out = np.zeros((len(a.size), len(b.size)), np.int64)
    if a is b:
        codes, n = np.unique(a.code, return_counts=True)
        codes = codes[n > 1]
    else:
        codes = np.intersect1d(a.code, b.code)
    (ra, ca), (rb, cb) = a.of(codes), b.of(codes)
    na, nb = np.bincount(ca, minlength=len(codes)), np.bincount(cb, minlength=len(codes))
    rare = np.minimum(na, nb) < common
    # Rare elements: each of its rows in a with each of its rows in b, a stretch of elements at a time.
    starts_a, starts_b, weight = np.cumsum(na) - na, np.cumsum(nb) - nb, np.where(rare, na * nb, 0)
    stretch = np.cumsum(weight) // (1 << 20)
    for part in np.split(np.arange(len(codes)), np.flatnonzero(np.diff(stretch)) + 1):
        part = part[rare[part]]
        if len(part):
            w = weight[part]
            k = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            e = np.repeat(part, w)
            x, y = ra[starts_a[e] + k // nb[e]], rb[starts_b[e] + k % nb[e]]
            out += np.bincount(x * len(b.size) + y, minlength=out.size).reshape(out.shape)
    # Common ones: bit by bit.
    wide = np.flatnonzero(~rare)
    for i in range(0, len(wide), COLUMNS):
        place = np.full(len(codes), -1)
        place[wide[i : i + COLUMNS]] = np.arange(len(wide[i : i + COLUMNS]))
        x, y = bits(ra, place[ca], len(a.size)), bits(rb, place[cb], len(b.size))
        for j in range(len(x)):
            out[j] += np.bitwise_count(x[j] & y).sum(axis=1, dtype=np.int64)
    return out


def bits(row: np.ndarray, column: np.ndarray, n: int) -> np.ndarray:
    flags = np.zeros((n, COLUMNS), bool)
    keep = column >= 0
    flags[row[keep], column[keep]] = True
    return np.packbits(flags, axis=1).view(np.uint64)


def links(a: Sets, b: Sets, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a and b of the pairs with a similarity of `least` percent or more."""
    both = shared(a, b)
    return np.nonzero(100 * both >= np.maximum(1, least * (a.size[:, None] + b.size - both)))


def _verify(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (class, i, j, side, node, hashes) in order of the block or pair of blocks."""
        for held in by_group(batches, 3):
            side, node = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (3, 4))
            hashes = pa.concat_arrays([b.column(5) for b in held])
            if not side.any():
                sets = Sets([hashes])
                yield forest(node, [links(sets, sets, least)])
            elif not side.all():
                parts = [np.flatnonzero(side == n) for n in (0, 1)]
                x, y = links(*(Sets([hashes.take(pa.array(p))]) for p in parts), least)
                yield forest(np.concatenate([node[p] for p in parts]), [(x, y + len(parts[0]))])

    return run


def verified(nodes: DataFrame, least: int, block_rows: int = BLOCK_ROWS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """node, root: components of the pairs within a class of `nodes` (class, node, size, hashes) with a similarity of `least` percent or more; nodes without a link may be left out."""
    bound_batches(nodes.sparkSession)
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / block_rows, F.sum("size") / block_shingles)).cast("long")
    large = materialise(nodes.groupBy("class").agg(parts.alias("parts")).filter("parts > 1"), "large-classes")

    def check(rows: DataFrame, i: Column, j: Column, side: Column) -> DataFrame:
        dealt = rows.select("class", i.alias("i"), j.alias("j"), side.cast("int").alias("side"), "node", "hashes").repartition("class", "i", "j").sortWithinPartitions("class", "i", "j")
        return dealt.mapInArrow(_verify(least), "a long, b long")

    zero, block = F.lit(0).cast("long"), lambda turn: F.pmod(F.xxhash64("node", F.lit(turn)), F.col("parts"))
    once = check(nodes.join(large.select("class"), "class", "left_anti"), zero, zero, zero)
    if large.isEmpty():
        return components(once)
    rows = nodes.join(large, "class")
    edges = materialise(once.unionByName(check(rows, block(1), zero, zero)).unionByName(check(rows, block(2), zero, zero)), "links")
    found = components(edges)
    labelled = materialise(rows.join(found, "node", "left").withColumn("root", F.coalesce("root", "node")).drop("size"), "labelled")
    largest = labelled.groupBy("class", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("class").agg(F.max(F.struct("n", "root"))["root"].alias("main"))
    apart = labelled.join(largest, "class").filter("root <> main")
    blocks = materialise(apart.groupBy("class").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("long").alias("apart_parts")), "blocks-apart")
    if blocks.isEmpty():
        return found
    every = lambda n: F.explode(F.sequence(zero, F.col(n) - 1))
    left = apart.join(blocks, "class").withColumn("i", F.pmod(F.xxhash64("node", F.lit(3)), F.col("apart_parts"))).withColumn("j", every("parts"))
    right = labelled.join(blocks, "class").withColumn("j", block(1)).withColumn("i", every("apart_parts"))
    both = left.select("class", "i", "j", F.lit(0).alias("side"), "node", "hashes").unionByName(right.select("class", "i", "j", F.lit(1).alias("side"), "node", "hashes"))
    return components(edges.unionByName(check(both, F.col("i"), F.col("j"), F.col("side"))))


def grouped(docs: DataFrame, words: int = WORDS, least: int = LEAST, radius: int = RADIUS, tile_rows: int = TILE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, digest, first (no_id, doc_id, digest of the component's first row): one row per document."""
    sketches = materialise(with_sketches(docs, words), "sketches")
    row = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("least")
    nodes = materialise(sketches.groupBy("node").agg(*(F.first(c).alias(c) for c in ("size", *FPS)), row), "nodes")
    classes = components(compared(nodes, radius, least, tile_rows))
    classes = classes.unionByName(classes.select(F.col("root").alias("node"), "root").distinct())
    needed = materialise(nodes.join(classes, "node").select("node", "size", F.col("root").alias("class"), F.col("least.doc_id").alias("_tb_id"), F.col("least.digest").alias("_tb_digest")), "class-nodes")
    maybe = split(docs.select("doc_id", "text"), needed.select("_tb_digest"))[1]
    same = (F.xxhash64(maybe["text"]) == F.col("_tb_digest")) & maybe["doc_id"].cast("long").eqNullSafe(F.col("_tb_id"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_hashes(x, words).view(np.int64) for x in texts(batch.column(3))]
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.list_(pa.int64()))], ["class", "node", "size", "hashes"])

    held = map_batches(maybe.join(needed.hint("merge"), same).select("class", "node", "size", "text"), work, "class long, node long, size long, hashes array<long>", "text")
    held = materialise(held.dropDuplicates(["node"]), "shingles")
    roots = materialise(verified(held, least, block_rows).toDF("r_node", "root"), "similar")
    placed = nodes.join(roots, F.col("node") == F.col("r_node"), "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    groups = placed.groupBy("root").agg(F.min("least").alias("first"))
    return sketches.join(placed.join(groups, "root").select("node", "first"), "node").select("doc_id", "digest", "first")


def drop_similar(docs: DataFrame, **options) -> DataFrame:
    """docs without all but the first row of each component of similar texts; all columns kept. Options are those of grouped()."""
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))
    return drop_marked(docs, materialise(grouped(docs, **options).filter(~stays).select("doc_id", "digest").distinct(), "near-copies"))
