"""The two jobs: growing input, repeated and failed batches, reruns, odd rows, and their queries against SQL."""

import hashlib
import json
import logging

import duckdb
import pytest
from pyspark.sql import functions as F

from jobs import candidate_catalogue, entries, log_digest
from jobs.common import configuration
from tests.test_queries import TABLES, plain

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "user", "started"), (1, 1, "tool", "Traceback: <x> & y"), (1, 2, "tool", "started"), (1, 2, "tool", "started"), (2, 5, None, None), (2, 5, "a", "RMS too low, detector was off"), (2, None, "z", "late"),
    (None, 1, "user", "no run"), (None, None, None, None), (999, 1, "user", "é" * 5000), (1000, 1, "user", "failed\nto read"), (2500, 3, "user", ""), (-1, 0, "user", "below zero"),
]
MORE = [(1, 7, "user", "an ERROR again"), (2500, 2, "user", "earlier line, later file"), (7000, 0, "x", "new run"), (1000, 1, "user", "failed\nto read")]


def naive(rows, tail=4000):
    out = {}
    for run in {r[0] for r in rows}:
        mine = [(turn, role, text or "") for c, turn, role, text in rows if c == run]
        md5 = lambda t: hashlib.md5(t.encode()).hexdigest()

        def kind(text):
            low = text.lower()
            return "gap" if any(x in low for x in ("data gap", "detector was off", "rms")) else "error" if any(x in low for x in log_digest.FAILURES) else "info"

        last = max(mine, key=lambda x: (x[0] is not None, x[0] or 0, md5(x[2]), x[1] is not None, x[1] or ""))
        kinds = [kind(x[2]) for x in mine]
        escaped = last[2][-tail:].replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
        out[run] = (len(mine), kinds.count("error"), kinds.count("gap"), len(mine) - len({x[2] for x in mine}), sum(len(x[2]) for x in mine), last[0], last[1], kind(last[2]), escaped, -1 if run is None else run // 1000)
    return out


def found(df):
    rows = df.collect()
    assert len({r.run_id for r in rows}) == len(rows)
    return {r.run_id: tuple(r)[1:] for r in rows}


def add(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_log_digest_takes_what_is_new(spark, tmp_path, caplog):
    source, output, checkpoint = (f"file://{tmp_path}/{x}" for x in ("source", "output", "checkpoint"))
    caplog.set_level(logging.INFO, logger="log_digest")
    add(spark, source, ROWS)
    assert found(log_digest.run(spark, source, output, checkpoint)) == naive(ROWS)
    assert found(log_digest.run(spark, source, output, checkpoint)) == naive(ROWS)  # nothing new
    add(spark, source, MORE)
    assert found(log_digest.run(spark, source, output, checkpoint)) == naive(ROWS + MORE)
    read = [int(r.getMessage().split("read ")[1].split(" ")[0]) for r in caplog.records]
    assert read == [len(ROWS), len(MORE)]
    assert spark.read.parquet(f"{output}/lines").count() == len(ROWS + MORE)
    # Only the buckets that new lines met were digested again.
    batches = spark.read.parquet(f"{output}/lines").groupBy("batch").agg(F.collect_set("bucket").alias("b")).collect()
    assert {r.batch: set(r.b) for r in batches} == {0: {-1, 0, 1, 2}, 1: {0, 1, 2, 7}}


def test_log_digest_is_the_same_for_any_files(spark, tmp_path):
    source, rows = f"file://{tmp_path}/source", ROWS + MORE
    for i in range(0, len(rows), 3):
        add(spark, source, rows[i : i + 3])
    for n in (1, 100):
        got = log_digest.run(spark, source, f"file://{tmp_path}/output{n}", f"file://{tmp_path}/checkpoint{n}", {"files_per_batch": n})
        assert found(got) == naive(rows)


def test_log_digest_after_failures(spark, tmp_path, monkeypatch):
    """A batch that fails between its two writes, or that is taken again, leaves the same tables."""
    source, output, checkpoint = (f"file://{tmp_path}/{x}" for x in ("source", "output", "checkpoint"))
    add(spark, source, ROWS)
    whole = log_digest.digests

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(log_digest, "digests", broken)
    with pytest.raises(Exception, match="lost"):
        log_digest.run(spark, source, output, checkpoint)
    monkeypatch.setattr(log_digest, "digests", whole)
    assert found(log_digest.run(spark, source, output, checkpoint)) == naive(ROWS)
    batch = spark.read.schema(SCHEMA).parquet(source)
    for _ in range(2):
        log_digest.take(batch, 0, output, log_digest.DEFAULTS)
    assert found(spark.read.parquet(f"{output}/digests").select(*log_digest.run(spark, source, output, checkpoint).columns)) == naive(ROWS)
    assert spark.read.parquet(f"{output}/lines").count() == len(ROWS)


def test_log_digest_of_no_lines(spark, tmp_path):
    source, output, checkpoint = (f"file://{tmp_path}/{x}" for x in ("source", "output", "checkpoint"))
    add(spark, source, [])
    got = log_digest.run(spark, source, output, checkpoint)
    assert got.count() == 0 and "tail" in got.columns
    add(spark, source, MORE)
    assert found(log_digest.run(spark, source, output, checkpoint)) == naive(MORE)


def test_settings(spark, tmp_path):
    path = tmp_path / "own.json"
    path.write_text(json.dumps({"tail_chars": 3}))
    assert configuration(spark, f"file://{path}", log_digest.DEFAULTS)["tail_chars"] == 3
    path.write_text(json.dumps({"tails": 3}))
    with pytest.raises(ValueError, match="tails"):
        configuration(spark, f"file://{path}", log_digest.DEFAULTS)
    for job in (log_digest, candidate_catalogue):
        name = job.__name__.split(".")[1]
        assert configuration(spark, f"file://{entries.__file__.rsplit('/', 1)[0]}/{name}.json", job.DEFAULTS) == job.DEFAULTS
    source = f"file://{tmp_path}/source"
    add(spark, source, ROWS)
    got = found(log_digest.run(spark, source, f"file://{tmp_path}/o", f"file://{tmp_path}/c", {"tail_chars": 7}))
    assert got == naive(ROWS, 7)


def test_candidate_catalogue_can_be_repeated(spark, sf, tmp_path):
    """Two runs over a table that grows between them, each repeated."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    middle = events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    part, output = f"file://{tmp_path}/events", f"file://{tmp_path}/output"
    for rows in (events.filter(F.col("event_id") < middle), events):
        rows.write.mode("overwrite").parquet(part)
        first = sorted(map(tuple, candidate_catalogue.run(spark, part, output).collect()), key=repr)
        again = sorted(map(tuple, candidate_catalogue.run(spark, part, output).collect()), key=repr)
        assert first == again and first
        days = {r.day: int(r.n) for r in spark.read.option("header", True).csv(f"{output}/days").collect()}
        assert days == {r.day: r.n for r in spark.read.parquet(f"{output}/candidates").withColumn("day", F.col("day").cast("string")).groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = sorted(map(tuple, candidate_catalogue.run(spark, f"{sf}/events.parquet", f"file://{tmp_path}/other").collect()), key=repr)
    assert whole == first
    nothing = f"file://{tmp_path}/nothing"
    events.limit(0).write.parquet(nothing)
    assert candidate_catalogue.run(spark, nothing, output).count() == 0


def test_candidate_catalogue_leaves_out_events_without_a_time(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    more = events.unionByName(events.limit(50).withColumn("ts", F.lit(None).cast(events.schema["ts"].dataType)))
    more.write.parquet(f"{tmp_path}/events")
    got, want = (sorted(map(tuple, candidate_catalogue.run(spark, p, f"file://{tmp_path}/{i}").collect()), key=repr) for i, p in enumerate((f"file://{tmp_path}/events", f"{sf}/events.parquet")))
    assert got == want


@pytest.mark.parametrize("name", sorted(entries.queries()))
def test_query_equals_its_sql(spark, sf, name):
    before = dict(spark.conf.getAll) if hasattr(spark.conf, "getAll") else None
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = entries.queries()[name](spark, sf)
    rows = con.execute(entries.oracle_sql()[name])
    names = [d[0] for d in rows.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in rows.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()), key=repr) == want
    assert before is None or dict(spark.conf.getAll) == before


def test_candidate_catalogue_counts_its_background_and_lists_it_on_demand(spark, sf, tmp_path, monkeypatch):
    whole, output = candidate_catalogue.run(spark, f"{sf}/events.parquet", f"file://{tmp_path}/a", {"list_background": True}), f"file://{tmp_path}/b"
    listed = spark.read.parquet(f"file://{tmp_path}/a/slid").groupBy("slide").agg(F.count(F.lit(1)).alias("n"), F.max("network_stat").alias("loudest"))
    monkeypatch.setattr(candidate_catalogue.background, "slid_pairs", None)
    found = candidate_catalogue.run(spark, f"{sf}/events.parquet", output)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert sorted(map(tuple, spark.read.parquet(f"{output}/background").select("slide", "n", "loudest").collect())) == sorted(map(tuple, listed.collect()))
