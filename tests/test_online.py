"""Streams with state against their batch forms, for several cuts into batches and after restarts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybeam.operators import background, candidates
from tallybeam.streaming import online

TRIGGERS = "ifo string, gps_us long, template_id string, new_snr double, event_id long"


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(online.STORE)
    online.prepare(spark)
    yield spark
    spark.conf.set(online.STORE, before)


def triggers(seed, n, span):
    rng = random.Random(seed)
    rows = [(rng.choice(["H1", "L1", "V1"]), rng.randrange(span), rng.choice("xxxxyz"), rng.choice([5.0, 7.5, float("nan"), 9.25, None]), i) for i in range(n)]
    return rows + [("H1", None, "x", 5.0, n), ("L1", 5, None, 5.0, n + 1)]


def cut(rows, sizes):
    """Rows in order of time, a little mixed up, cut into batches."""
    rows = sorted(rows, key=lambda r: (r[1] or 0) + random.Random(r[4]).randrange(3_000_000))
    out, at = [], 0
    for n in sizes:
        out.append(rows[at : at + n])
        at += n
    return [*out, rows[at:]]


def drain(spark, stream, out, checkpoint):
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


@pytest.mark.parametrize(("sizes", "strict"), [((), True), ((40, 1, 90), False), ((200,), True)])
def test_online_background_equals_the_batch_form(rocks, tmp_path, sizes, strict):
    spark, rows = rocks, triggers(1, 260, 120_000_000)
    slides = [(1, 2_000_000), (-1, -2_000_000), (2, 4_000_000), (-2, -4_000_000)]
    source, out, checkpoint = (f"{tmp_path}/{x}" for x in ("source", "out", "checkpoint"))
    for part in cut(rows, sizes):
        spark.createDataFrame(part, TRIGGERS).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(TRIGGERS).parquet(source)
        drain(spark, online.slid_pairs(stream, "H1", "L1", slides, 1_500_000, "10 seconds", strict), out, checkpoint)  # a restart for each part
    columns = ["slide", "offset_us", "template_id", "event_id_a", "event_id_b", F.round("network_stat", 9)]
    whole = background.slid_pairs(spark.createDataFrame(rows, TRIGGERS), "H1", "L1", spark.createDataFrame(slides, "slide long, offset_us long"), 1_500_000, strict=strict)
    got, want = (sorted(map(tuple, df.select(*columns).collect())) for df in (spark.read.schema(online.PAIRS).parquet(out), whole))
    assert got == want and len(want) > 50


@pytest.mark.parametrize("sizes", [(), (40, 1, 90)])
def test_unlisted_online_background_gives_the_same_pairs(rocks, tmp_path, sizes):
    """The stream writes singles, a row for each stretch and batch, and reading makes each pair once."""
    spark, rows = rocks, triggers(1, 260, 120_000_000)
    slides = [(1, 2_000_000), (-1, -2_000_000), (2, 4_000_000), (-2, -4_000_000)]
    source, out, checkpoint = (f"{tmp_path}/{x}" for x in ("source", "out", "checkpoint"))
    for part in cut(rows, sizes):
        spark.createDataFrame(part, TRIGGERS).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(TRIGGERS).parquet(source)
        drain(spark, online.slid_pairs(stream, "H1", "L1", slides, 1_500_000, "10 seconds", unlisted=True), out, checkpoint)
    columns = ["slide", "offset_us", "template_id", "event_id_a", "event_id_b", F.round("network_stat", 9)]
    whole = background.slid_pairs(spark.createDataFrame(rows, TRIGGERS), "H1", "L1", spark.createDataFrame(slides, "slide long, offset_us long"), 1_500_000)
    met = spark.read.schema(online.MET).parquet(out)
    got, want = (sorted(map(tuple, df.select(*columns).collect())) for df in (online.pairs_of(met, slides, 1_500_000), whole))
    assert got == want and len(want) > 50 and met.count() < len(want)


def test_pairs_of_a_burst_come_in_blocks():
    """A stretch with 4 million pairs of a slide yields them block by block."""
    singles = (np.arange(2000), np.ones(2000), np.arange(2000), np.ones(2000, bool))
    sizes = [len(block) for block in online.listed(singles, singles, [(1, 0), (2, 5)], 10_000, True)]
    assert sum(sizes) == 8_000_000 and max(sizes) <= 1 << 20


FOUND = "ifos string, gps_us long, template_id string, network_stat double, far_hz double, event_id_a long, event_id_b long, note string"


def found(seed, n, span):
    rng = random.Random(seed)
    return [("H1,L1", rng.randrange(span), rng.choice("xy"), rng.choice([8.0, 9.5, 11.25]), rng.choice([1e-4, 1e-3, None]), i, i + 1000, rng.choice(["é\"", None])) for i in range(n)]


@pytest.mark.parametrize("overlap", [0, 6_000_000])
def test_events_at_edges_of_blocks_are_reported_once(rocks, tmp_path, overlap):
    """Blocks of a padded search: each reports the events of its own time and those of its neighbours' edges; the stream gives the rows of the batch form over all events."""
    spark, rows, block = rocks, found(2, 240, 160_000_000), 20_000_000
    source, out, checkpoint = (f"{tmp_path}/{x}" for x in ("source", "out", "checkpoint"))
    end = [("H1,L1", 10**9, "x", 8.0, None, -1, -2, None)]  # moves the watermark past all others, and stays open itself
    for start in range(0, 160_000_000, block):
        part = [r for r in rows if start - overlap <= r[1] < start + block + overlap]
        spark.createDataFrame(part, FOUND).coalesce(1).write.mode("append").parquet(source)
        if start % (2 * block) == 0:  # two blocks a run of the stream
            drain(spark, online.deduplicate(spark.readStream.schema(FOUND).option("maxFilesPerTrigger", 1).parquet(source), 1_000_000, "15 seconds"), out, checkpoint)
    spark.createDataFrame(end, FOUND).coalesce(1).write.mode("append").parquet(source)
    drain(spark, online.deduplicate(spark.readStream.schema(FOUND).parquet(source), 1_000_000, "15 seconds"), out, checkpoint)
    got, want = (sorted(map(tuple, df.collect()), key=repr) for df in (spark.read.schema(FOUND).parquet(out), candidates.deduplicate(spark.createDataFrame(rows, FOUND), 1_000_000)))
    assert got == want and 20 < len(want) < len(rows)


def test_groups_are_searched_apart(rocks, tmp_path):
    spark, rows = rocks, [(x, 5_000_000 + k, "x", 9.0 + k, None, k, k, None) for x in ("H1,L1", "H1,V1") for k in range(3)] + [(x, 90_000_000, "x", 9.0, None, 9, 9, None) for x in ("H1,L1", "H1,V1")]
    source = f"{tmp_path}/source"
    spark.createDataFrame(rows, FOUND).write.parquet(source)
    stream = online.deduplicate(spark.readStream.schema(FOUND).parquet(source), 1_000_000, "1 second", ("ifos",))
    drain(spark, stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = spark.read.schema(FOUND).parquet(f"{tmp_path}/out").collect()
    assert sorted((r.ifos, r.event_id_a) for r in got) == [("H1,L1", 2), ("H1,V1", 2)]


def test_a_run_over_many_stretches_is_no_single_group(rocks, tmp_path):
    """Candidates without a gap hang on one another from end to end; each group is a stretch of time, and the rows are those of the batch form."""
    rng = random.Random(3)
    spark, rows = rocks, [("H1,L1", rng.randrange(90_000_000), "x", rng.random(), None, i, i, None) for i in range(3_000)]
    source = f"{tmp_path}/source"
    spark.createDataFrame([*rows, ("H1,L1", 10**9, "x", 8.0, None, -1, -2, None)], FOUND).write.parquet(source)
    stream = online.deduplicate(spark.readStream.schema(FOUND).parquet(source), 1_000_000, "1 second")
    assert "stretch" in stream._jdf.queryExecution().analyzed().toString()
    drain(spark, stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got, want = (sorted(r.event_id_a for r in df.collect()) for df in (spark.read.schema(FOUND).parquet(f"{tmp_path}/out"), candidates.deduplicate(spark.createDataFrame(rows, FOUND), 1_000_000)))
    assert got == want and 50 < len(want) < 100
