"""Quality classifier: a generalised additive model with pairwise interactions.

Features are cheap counts of the whole text. Each feature is cut into quantile bins; cyclic gradient boosting adds a small step of a
shallow tree (two splits) on one feature after the other to that feature's lookup table, then does the same for the pairs of
features that lower the loss most. A score is the logistic of an intercept plus one table entry a feature and a pair: vectorised bin additions.

Fitting uses a bounded, documented sample: SAMPLE labelled documents at most, chosen by hash, from rows outside the held-out fold;
of rows that repeat a doc_id the one with the smallest features counts, so the driver's share stays bounded.
Everything else covers all rows. labels, lang, source and doc_id are never inputs of a score.

Defined results: null counts as empty, and empty texts get a score like any other. With labels of one kind or none the score is the
smoothed share of label 1 (0.5 without any). Several labels of a document: their mean, 0.5 or more counting as 1. Null labels and labels without a document are ignored.
Rows with a null doc_id are scored, not held out and not learnt from. Repeated documents are scored alike.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybeam.llm.common import LOWER_ASCII, bound_batches, map_batches, slices, texts

SAMPLE, THRESHOLD, FOLDS = 20_000, 0.3, 5
ROUNDS, RATE, BINS, PAIRS, PAIR_BINS, RIDGE, LEAST_ROWS = 120, 0.15, 48, 8, 8, 5.0, 8

_CLASSES = {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": (32, 9, 10, 11, 12, 13), "line": (10,), "stop": b".?", "comma": b",;:",
    "exclaim": b"!", "pipe": b"|", "markup": b"<>{}[]=_/\\", "symbol": b"#$%&*@^~+`", "quote": b"\"'()-", "high": range(128, 256), "control": (*range(9), *range(14, 32), 127),
}
CLASS_MATRIX = np.array([[b in set(members) for b in range(256)] for members in _CLASSES.values()], float)
FEATURES = (*_CLASSES, "length", "words", "word_length", "distinct_words", "distinct_pairs", "top_word", "short_words", "long_words", "distinct_lines", "line_length", "compression", "alphabet", "capitals")


def features(raw: bytes) -> list[float]:
    """The numbers that a score depends on, in order of FEATURES."""
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(1, len(raw))
    words = raw.translate(LOWER_ASCII).split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    m, distinct = max(1, len(words)), len(set(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    numbers: dict[bytes, int] = {}
    codes = [numbers.setdefault(w, len(numbers)) for w in words]
    code = np.array(codes, np.int64)
    pairs = len(np.unique(code[1:] * (distinct + 1) + code[:-1])) if len(code) > 1 else 0
    compressed = sum(len(zlib.compress(raw[i : i + 65_536], 1)) for i in range(0, len(raw), 65_536))
    share = counts / n
    entropy = -float((share[share > 0] * np.log2(share[share > 0])).sum())
    return [
        *(CLASS_MATRIX @ counts / n).tolist(), np.log1p(len(raw)), np.log1p(len(words)), float(sizes.mean()), distinct / m, pairs / max(1, len(words) - 1),
        float(np.bincount(code).max()) / m if words else 0.0, float((sizes <= 3).mean()), float((sizes >= 14).mean()), len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))),
        compressed / n, entropy, float(sum(w[:1].isupper() for w in raw.split())) / m,
    ]


@dataclass
class Additive:
    """The fitted model: bin edges and one table a feature, and one table a pair."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        total = np.full(len(x), self.intercept)
        for j, (edges, values) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += values[np.searchsorted(edges, x[:, j], side="right")]
        for a, b, values in self.pairs:
            total += values[np.searchsorted(self.coarse[a], x[:, a], side="right"), np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values, bin by bin, of a tree of `depth` levels over ordered bins with gradient, curvature and row sums."""
    out = np.full(len(g), g.sum() / (h.sum() + RIDGE))
    if not depth or len(g) < 2:
        return out
    left = [np.cumsum(x)[:-1] for x in (g, h, n)]
    right = [x.sum() - y for x, y in zip((g, h, n), left, strict=True)]
    gain = np.where((left[2] >= LEAST_ROWS) & (right[2] >= LEAST_ROWS), _gain(*left[:2]) + _gain(*right[:2]), -np.inf)
    cut = int(gain.argmax()) + 1
    if gain[cut - 1] <= _gain(g.sum(), h.sum()) + 1e-12:
        return out
    return np.concatenate([_tree(g[:cut], h[:cut], n[:cut], depth - 1), _tree(g[cut:], h[cut:], n[cut:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of the best tree that cuts one feature once and each side once on the other; and its gain over a constant."""
    best, found = np.full(g.shape, g.sum() / (h.sum() + RIDGE)), 0.0
    whole = float(_gain(g.sum(), h.sum()))
    for axis in (0, 1):
        gs, hs, ns = (x if axis == 0 else x.T for x in (g, h, n))
        for cut in range(1, len(gs)):
            gain, values = 0.0, np.empty(gs.shape)
            for rows in (slice(None, cut), slice(cut, None)):
                sums = [x[rows].sum(axis=0) for x in (gs, hs, ns)]
                values[rows] = leaf = _tree(*sums, depth=1)
                for value in np.unique(leaf):
                    at = leaf == value
                    gain += float(_gain(sums[0][at].sum(), sums[1][at].sum()))
            if gain - whole > found:
                best, found = (values if axis == 0 else values.T).copy(), gain - whole
    return best, found


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, pairs: int = PAIRS) -> Additive:
    """The model of features x and labels y (0 or 1)."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Additive(float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    cuts = lambda v, bins: np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1]))
    model.edges = [cuts(v, BINS) for v in x.T]
    model.coarse = [cuts(v, PAIR_BINS) for v in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, v, side="right") for e, v in zip(model.edges, x.T, strict=True)]
    coarse = [np.searchsorted(e, v, side="right") for e, v in zip(model.coarse, x.T, strict=True)]
    rows = [np.bincount(b, minlength=len(t)).astype(float) for b, t in zip(bins, model.tables, strict=True)]
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for b, t, n in zip(bins, model.tables, rows, strict=True):
            if len(t) < 2:
                continue
            g, h = slopes()
            step = rate * _tree(np.bincount(b, g, len(t)), np.bincount(b, h, len(t)), n)
            t += step
            total += step[b]

    def sums(a: int, b: int, weights: np.ndarray | None) -> np.ndarray:
        shape = len(model.coarse[a]) + 1, len(model.coarse[b]) + 1
        return np.bincount(coarse[a] * shape[1] + coarse[b], weights, shape[0] * shape[1]).reshape(shape).astype(float)

    g, h = slopes()
    gains = [(_pair_tree(sums(a, b, g), sums(a, b, h), sums(a, b, None))[1], a, b) for a in range(x.shape[1]) for b in range(a)]
    chosen = [(a, b) for gain, a, b in sorted(gains, reverse=True)[:pairs] if gain > 0]
    model.pairs = [(a, b, np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1))) for a, b in chosen]
    for _ in range(rounds // 4):
        for a, b, t in model.pairs:
            g, h = slopes()
            step = rate * _pair_tree(sums(a, b, g), sums(a, b, h), sums(a, b, None))[0]
            t += step
            total += step[coarse[a], coarse[b]]
    return model


def held_out(doc_id: Column) -> Column:
    """The fold that no label is learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """text, label y and id of the rows of `rows` labelled documents at most, chosen by hash, outside the held-out fold."""
    known = labels.filter("quality is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("_tb_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("_tb_y"))
    known = known.orderBy(F.xxhash64("_tb_id"), "_tb_id").limit(rows)
    return docs.join(F.broadcast(known), docs["doc_id"] == F.col("_tb_id")).select("text", F.col("_tb_y").alias("y"), F.col("_tb_id").alias("id"))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Additive:
    """Features are computed where the rows are; the driver gets the numbers of `rows` documents at most, one row for each."""
    names = [f"f{i}" for i in range(len(FEATURES))]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([features(t) for t in texts(batch.column(0))], np.float64).reshape(-1, len(FEATURES))
        return pa.RecordBatch.from_arrays([batch.column(2), batch.column(1), *(pa.array(v) for v in x.T)], ["id", "y", *names])

    found = map_batches(sample(docs, labels, rows), work, ", ".join(["id long, y int", *(f"{n} double" for n in names)]), "text")
    found = found.groupBy("id").agg(F.min(F.struct("y", *names)).alias("row")).select("row.*").toPandas()
    found = found.sort_values(list(found.columns), kind="stable")  # the order of tasks doesn't matter
    return fit(found[names].to_numpy(float), found["y"].to_numpy(float))


def score_documents(docs: DataFrame, model: Additive) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(batch.column(1), shared.value))], ["doc_id", "score"])

    scored = map_batches(docs.select(F.col("doc_id").cast("long"), "text"), work, "doc_id long, score double", "text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _scores(column: pa.Array, model: Additive) -> np.ndarray:
    return model.score(np.array([features(t) for t in texts(column)], np.float64).reshape(-1, len(FEATURES)))


def drop_rejected(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """docs that the model accepts, all columns kept; filtered where the rows are, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bound_batches(docs.sparkSession)

    def run(batches):
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(_scores(batch.column("text"), shared.value) >= threshold))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
