"""URL filter: rules first, then the ratio of two character language models.

Rules name a host (with all its subdomains) and the start of a path; the longest that fits decides. URLs that rules allow or block
train an accepted and a rejected model: smoothed variable-order Markov models over the URL's bytes. Counts of
(context, next byte) for all orders up to ORDER are gathered from every such URL by a map-side combined aggregation.
All counted contexts belong to the models, which stay tables: the different runs of bytes of all URLs are joined with the counts of each order.
Only the scores of runs that make up one part in HOT of all rows or more (HOT at most) are broadcast; other rows (URL, run, times) are shuffled.
Probabilities are smoothed by Witten-Bell interpolation down the orders; a missing context falls back to the next shorter one.

score = (log P_accepted - log P_rejected) / length. A fifth of the ruled URLs (by hash) takes no part in the counts;
on them a logistic calibration turns the score into the probability that a URL is accepted.
A URL without a rule is allowed if that is 0.5 or more.

Defined results: a null URL has empty host and path, no rule, and score 0 like an empty URL. With no ruled URLs of a kind,
both models are uniform and every other URL is allowed. Repeated URLs count as often as they occur. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybeam.llm.common import bound_batches, materialise, slices, texts

#: Fixed values: (verdict, host, path) of the rules.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
ORDER = 5
HOT = 4_096
#: Bytes of URLs that are cut into runs at once; each takes about a hundred bytes of memory.
PIECE = 1 << 20
#: Scores are summed as whole numbers of this part, so that the order of rows doesn't matter.
PART = float(1 << 36)
#: Score bins of the calibration.
BIN, BINS = 0.01, 1_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Empty for null or where there is no "://"."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, else null."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    name = verdict = None
    for kind, h, p in ordered:
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return (name, verdict) if name is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def _packed(urls: list[bytes], order: int, piece: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each byte of the URLs: the number of its URL, the byte, and the `order` bytes before it as one integer (0 bytes pad the start).

    Yields about `piece` bytes at once; longer URLs are cut, each part with the bytes before it.
    """
    owners: list[int] = []
    parts: list[bytes] = []
    size = 0
    for i, u in enumerate(urls):
        padded = bytes(order) + u
        for start in range(0, len(u), piece):
            owners.append(i)
            parts.append(padded[start : start + piece + order])
            size += len(parts[-1])
            if size >= piece:
                yield _pack(owners, parts, order)
                owners, parts, size = [], [], 0
    if parts:
        yield _pack(owners, parts, order)


def _pack(owners: list[int], parts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of parts that start with the `order` bytes before them."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) - order
    flat = np.frombuffer(b"".join(parts), np.uint8)
    at = np.arange(lengths.sum()) + np.repeat(np.arange(1, len(parts) + 1) * order, lengths)
    context = np.zeros(len(at), np.int64)
    for i in range(order, 0, -1):
        context = context << 8 | flat[at - i]
    return np.repeat(np.array(owners, np.int64), lengths), flat[at].astype(np.int64), context


def count_ngrams(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """kind, k, context, next, n of `urls` (kind, url): occurrences of each next byte after each context of k bytes."""
    bound_batches(urls.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "url"):
            kinds, all_urls = np.array(batch.column(0).to_pylist(), object), texts(batch.column(1))
            for kind in sorted(set(kinds)):
                for _, byte, context in _packed([u for u, q in zip(all_urls, kinds, strict=True) if q == kind], order):
                    for k in range(order + 1):
                        keys, n = np.unique((context & ((1 << 8 * k) - 1)) << 8 | byte, return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([kind] * len(keys), pa.string()), pa.array(np.full(len(keys), k, np.int32)), pa.array(keys >> 8), pa.array((keys & 255).astype(np.int32)), pa.array(n)],
                            ["kind", "k", "context", "next", "n"],
                        )

    counted = urls.select("kind", "url").mapInArrow(run, "kind string, k int, context long, next int, n long")
    return counted.groupBy("kind", "k", "context", "next").agg(F.sum("n").alias("n"))


def positions(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """row, gram, n: for each url of `rows` (row, url), the different bytes with the `order` bytes before them as one integer, and how often each occurs (in parts of a long url)."""
    bound_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "url"):
            row = batch.column(0).to_numpy()
            for owner, byte, context in _packed(texts(batch.column(1)), order):
                gram = context << 8 | byte
                by = np.lexsort((gram, owner))
                owner, gram = owner[by], gram[by]
                new = np.flatnonzero(np.append(True, (np.diff(owner) != 0) | (np.diff(gram) != 0)))
                yield pa.RecordBatch.from_arrays([pa.array(row[owner[new]]), pa.array(gram[new]), pa.array(np.diff(np.append(new, len(gram))))], ["row", "gram", "n"])

    return rows.select("row", "url").mapInArrow(run, "row long, gram long, n long")


def gram_scores(grams: DataFrame, ngrams: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, d: log P_accepted - log P_rejected of the last byte after those before it, in PARTs, for different grams.

    Each order's runs are joined with their counts, their context's counts and the next lower order's probabilities; a key has 256 rows at most. All of these grow with the different runs,
    so they are merged at every size: dozens of broadcasts just below Spark's limit would meet in the driver.
    """
    lower = None
    n = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0))
    for k in range(order + 1):
        pairs = ngrams.filter(F.col("k") == k).groupBy("context", "next").agg(n("allow").alias("na"), n("block").alias("nb"))
        totals = pairs.groupBy("context").agg(F.sum("na").alias("ca"), F.sum("nb").alias("cb"), F.count_if(F.col("na") > 0).alias("fa"), F.count_if(F.col("nb") > 0).alias("fb"))
        pairs = pairs.select((F.shiftleft("context", 8) + F.col("next")).alias("gram"), "na", "nb")
        rows = grams.select(F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("gram")).distinct()
        rows = rows.join(pairs.hint("merge"), "gram", "left").withColumn("context", F.shiftright("gram", 8)).join(totals.hint("merge"), "context", "left")
        if lower is None:
            rows = rows.withColumn("la", F.lit(1 / 256)).withColumn("lb", F.lit(1 / 256))
        else:
            rows = rows.withColumn("low", F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))).join(lower.toDF("low", "la", "lb").hint("merge"), "low")
        p = lambda x: F.when(F.col(f"c{x}") > 0, (F.coalesce(f"n{x}", F.lit(0)) + F.col(f"f{x}") * F.col(f"l{x}")) / (F.col(f"c{x}") + F.col(f"f{x}"))).otherwise(F.col(f"l{x}"))
        lower = materialise(rows.select("gram", p("a").alias("pa"), p("b").alias("pb")), "url-probabilities")
    return lower.select("gram", F.round((F.log("pa") - F.log("pb")) * PART).cast("long").alias("d"))


def scored(rows: DataFrame, ngrams: DataFrame, order: int = ORDER) -> DataFrame:
    """rows (row, url, ...) with score: length-normalised log-likelihood difference of each URL; 0 for an empty one."""
    at = positions(rows, order)
    grams = materialise(at.groupBy("gram").agg(F.count(F.lit(1)).alias("rows")), "url-grams")
    total = grams.agg(F.sum("rows")).first()[0] or 0
    found = materialise(gram_scores(grams, ngrams, order).join(grams.hint("merge"), "gram"), "url-gram-scores")
    hot = F.broadcast(found.filter(F.col("rows") * HOT >= total).select("gram", "d"))
    rest = at.join(hot, "gram", "left_anti").join(found.filter(F.col("rows") * HOT < total).select("gram", "d").hint("merge"), "gram")
    sums = at.join(hot, "gram").select("row", "n", "d").unionByName(rest.select("row", "n", "d")).groupBy("row").agg(F.sum((F.col("n") * F.col("d")).cast("decimal(38,0)")).cast("double").alias("d"))
    length = F.greatest(F.lit(1), F.octet_length(F.coalesce("url", F.lit(""))))
    return rows.join(sums.hint("merge"), "row", "left").withColumn("score", F.coalesce("d", F.lit(0.0)) / PART / length).drop("d")


def calibrate(x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit to counts of accepted and rejected URLs at scores x, by Newton's method with a small ridge."""
    if not good.sum() or not bad.sum():
        return 1.0, 0.0
    t, n, y = np.array([1.0, 0.0]), good + bad, good / np.maximum(1, good + bad)
    z = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ t, -30, 30)))
        gradient = z.T @ (n * (y - p)) - 1e-3 * (t - [1.0, 0.0])
        step = np.linalg.solve((z * (n * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2), gradient)
        t = t + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(t[0], 1e-6)), float(t[1])


def judge(pages: DataFrame, rules=RULES, order: int = ORDER) -> DataFrame:
    """page_id, host, path, rule, verdict, score, probability (of being accepted) for every url."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long"), "url", host.alias("host"), path.alias("path"))
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    held_out = F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(5)) == 0
    rows = materialise(rows.select(F.monotonically_increasing_id().alias("row"), "*", name.alias("rule"), verdict.alias("kind"), held_out.alias("held_out")), "urls")
    ngrams = materialise(count_ngrams(rows.filter("kind is not null and not held_out"), order), "url-ngrams")
    rows = materialise(scored(rows, ngrams, order), "scored-urls")

    bins = rows.filter("kind is not null and held_out").groupBy("kind", F.least(F.greatest(F.round(F.col("score") / BIN), F.lit(-BINS)), F.lit(BINS)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    counts = bins.groupBy("bin").pivot("kind", ["allow", "block"]).agg(F.sum("n")).na.fill(0).toPandas().sort_values("bin")  # 2 * BINS + 1 rows at most
    slope, offset = calibrate(counts["bin"].to_numpy(float) * BIN, counts["allow"].to_numpy(float), counts["block"].to_numpy(float))

    rows = rows.withColumn("probability", 1 / (1 + F.exp(-(F.col("score") * slope + offset))))
    verdict = F.coalesce("kind", F.when(F.col("probability") >= 0.5, "allow").otherwise("block"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score", "probability")
