"""Series files, sinks, listings, catalogues and run state."""

import time

import numpy as np
import pytest
from pyarrow import fs as pafs
from pyspark.sql import functions as F

from tallybeam.sources import frames, series, state, store
from tallybeam.streaming import loop


def put_series(folder, ifo, tag, start, duration, rate, channels):
    folder.mkdir(parents=True, exist_ok=True)
    n = int(duration * rate)
    np.savez(folder / series.file_name(ifo, tag, start, duration), **{c: np.arange(n) + 1000.0 * start for c in channels})


def test_series_source(spark, tmp_path, monkeypatch):
    put_series(tmp_path / "a", "H1", "GWOSC_4KHZ_R1", 1000, 600, 2, ["H1:GWOSC-4KHZ_R1_STRAIN", "other"])
    put_series(tmp_path / "a", "H1", "LOSC_V1", 4000, 300, 2, ["H1:LOSC-STRAIN"])  # the second candidate
    put_series(tmp_path / "a", "L1", "GWOSC_16KHZ_R1", 1000, 256, 4, ["L1:GWOSC-16KHZ_R1_STRAIN"])
    (tmp_path / "a" / "notes.txt").write_text("x")
    rows = series.read(spark, f"file://{tmp_path}/a", 256).orderBy("ifo", "block_start").collect()
    assert [(r.ifo, r.channel, r.block_start, r.block_end, r.read_start, r.rate, len(r.arr)) for r in rows] == [
        ("H1", "H1:GWOSC-4KHZ_R1_STRAIN", 1000, 1256, 1000, 2.0, 576), ("H1", "H1:GWOSC-4KHZ_R1_STRAIN", 1256, 1512, 1224, 2.0, 640), ("H1", "H1:GWOSC-4KHZ_R1_STRAIN", 1512, 1600, 1480, 2.0, 240),
        ("H1", "H1:LOSC-STRAIN", 4000, 4256, 4000, 2.0, 576), ("H1", "H1:LOSC-STRAIN", 4256, 4300, 4224, 2.0, 152), ("L1", "L1:GWOSC-16KHZ_R1_STRAIN", 1000, 1256, 1000, 4.0, 1024),
    ]
    assert rows[1].arr[:2] == [1_000_448.0, 1_000_449.0]
    picked = series.read(spark, f"file://{tmp_path}/a", 256).filter("ifo = 'H1' and block_start >= 1256 and block_end <= 4256")
    assert [r.block_start for r in picked.orderBy("block_start").collect()] == [1256, 1512, 4000]
    assert "Filter" not in picked._jdf.queryExecution().optimizedPlan().toString()
    reader = series.SeriesReader({"path": f"file://{tmp_path}/a", "block_s": "256"}, series.SeriesSource({}).schema() and __import__("pyspark").sql.types._parse_datatype_string(series.SCHEMA))
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, IsNotNull

    assert [*reader.pushFilters([EqualTo(("ifo",), "H1"), GreaterThanOrEqual(("block_start",), 1512), IsNotNull(("ifo",)), EqualTo(("channel",), "x")])] == [EqualTo(("channel",), "x")]
    assert sorted(run[4:] for p in reader.partitions() for run in p.runs) == [(1512, 1600), (4000, 4300)]
    assert series.read(spark, f"file://{tmp_path}/a", 256).select("file", "block_start").count() == 6


def test_series_without_a_channel(spark, tmp_path):
    put_series(tmp_path / "b", "H1", "GWOSC_4KHZ_R1", 0, 128, 2, ["something"])
    with pytest.raises(Exception, match="none of the channels"):
        series.read(spark, f"file://{tmp_path}/b", 128).collect()
    row = series.read(spark, f"file://{tmp_path}/b", 128, errors="null").first()
    assert row.arr is None and row.block_start == 0


def test_reads_seek_to_their_samples(tmp_path):
    put_series(tmp_path, "H1", "GWOSC_4KHZ_R1", 0, 4096, 256, ["H1:GWOSC-4KHZ_R1_STRAIN"])
    path = str(tmp_path / series.file_name("H1", "GWOSC_4KHZ_R1", 0, 4096))
    read = []

    class Counting:
        def __init__(self, f):
            self.f = f

        def read(self, n=-1):
            out = self.f.read(n)
            read.append(len(out))
            return out

        def __getattr__(self, name):
            return getattr(self.f, name)

    with open(path, "rb") as f:
        channel, rate, found = series.samples(Counting(f), ["H1:GWOSC-4KHZ_R1_STRAIN"], 4000, 4010, 4096)
    assert rate == 256 and found[0] == 4000 * 256 and len(found) == 2560
    assert sum(read) < 1 << 20  # of eight million bytes


def test_files_are_stored_whole_or_not_at_all(spark, tmp_path):
    class Failing:
        def __init__(self, fails):
            self.real, self.fails, self.waits = pafs.LocalFileSystem(), fails, []

        def move(self, a, b):
            if self.fails:
                self.fails -= 1
                raise OSError("busy")
            self.real.move(a, b)

        def __getattr__(self, name):
            return getattr(self.real, name)

    fs = Failing(3)
    assert store.put(fs, f"{tmp_path}/x", b"abc", wait=fs.waits.append) == 3
    assert fs.waits == [2.0, 4.0, 8.0] and [p.name for p in tmp_path.iterdir()] == ["x"]
    with pytest.raises(OSError):
        store.put(Failing(9), f"{tmp_path}/y", b"abc", wait=lambda s: None)
    assert [p.name for p in tmp_path.iterdir()] == ["x"]
    rows = spark.createDataFrame([("a.bin", bytearray(b"1")), ("b.bin", bytearray(b"22"))], "name string, content binary")
    assert sorted(map(tuple, store.store(rows, f"file://{tmp_path}/out").collect())) == [("a.bin", 1), ("b.bin", 2)]
    assert (tmp_path / "out" / "b.bin").read_bytes() == b"22"


def test_catalogue_is_refreshed_when_old(spark, tmp_path):
    clock, calls = [1000.0], []

    def fetch():
        calls.append(1)
        if len(calls) == 2:
            raise OSError("away")
        return None if len(calls) == 3 else spark.createDataFrame([(f"e{len(calls)}", 1.5)], "name string, gps double")

    c = store.Catalogue(spark, f"file://{tmp_path}/cat", fetch, 3600.0, lambda: clock[0])
    assert c.read().count() == 0 and c.refresh() and [r.name for r in c.read().collect()] == ["e1"]
    clock[0] += 3599
    assert not c.refresh() and len(calls) == 1
    clock[0] += 1
    assert not c.refresh() and not c.refresh() and [r.name for r in c.read().collect()] == ["e1"] and len(calls) == 3
    assert c.refresh() and [r.name for r in c.read().collect()] == ["e4"] and c.refresh(force=True)


def test_science_segments(spark, tmp_path):
    spark.createDataFrame([("H1", 0.0, 10.0), ("H1", 15.0, 25.0), ("H1", 30.0, 40.0), ("L1", 0.0, 99.0)], "ifo string, seg_start double, seg_end double").write.parquet(f"{tmp_path}/s")
    assert sorted(map(tuple, frames.science_segments(spark, f"{tmp_path}/s", "H1", 5.0, 20.0).collect())) == [(5.0, 10.0), (15.0, 20.0)]
    assert frames.science_segments(spark, f"{tmp_path}/none", "H1", 5.0, 20.0).count() == 0


def test_state_values_and_status(spark, tmp_path):
    s = state.State(spark, f"file://{tmp_path}")
    others = state.State(spark, f"file://{tmp_path}")
    for i in range(3):
        (s if i % 2 else others).set_value("k", str(i))
    assert s.get_value("k") == "2"
    s.progress(7, "triggers", 0.7)
    assert '"stage": "triggers"' in s.get_value("progress")
    empty = state.status(*(s.read(t) for t in ("runs", "blocks", "candidates", "background"))).first()
    assert empty.latest_run_id is None and empty.block_count == 0 and empty.candidate_count == 0 and empty.last_block_created_at is None
    tie = spark.createDataFrame([("k", "a", 5), ("k", "b", 5)], "k string, v string, seq long")
    assert state.latest_values(tie).first().v == "b"


def test_queries_stop_when_asked(spark, tmp_path):
    spark.range(40).repartition(8).write.parquet(f"{tmp_path}/in")
    stop, seen = f"file://{tmp_path}/STOP", []

    def each(batch, n):
        seen.append(batch.count())
        (tmp_path / "STOP").write_text("")

    q = loop.run(loop.source(spark, f"{tmp_path}/in", spark.range(1).schema), each, f"{tmp_path}/cp", poll="1 second")
    began = time.time()
    assert loop.run_until(q, lambda: loop.stop_requested(spark, stop), 0.2) and not q.isActive
    assert 0 < len(seen) and time.time() - began < 60


def test_listing_in_pages(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.json").write_text('{"page": 1, "num_pages": 2, "results": [{"detector": "H1", "gps_start": 8192}, {"detector": "H1"}]}\n{"page": 3, "num_pages": 2, "results": [{"detector": "H1", "gps_start": 1}]}\n{"page"\n')
    (tmp_path / "p" / "b.json").write_text('{"page": 2, "num_pages": 2, "results": [{"detector": "H1", "gps_start": 4096}, {"detector": "L1", "gps_start": 5}]}\n')
    listed = frames.listing(spark, f"{tmp_path}/p")
    assert [r.gps_start for r in frames.listed_starts(listed, "H1", 0, 9000).collect()] == [4096.0, 8192.0]
    latest = spark.range(1).select(frames.latest_end(F.lit(None).cast("double"), F.lit(0.0), F.lit(None).cast("long"), F.lit(None).cast("double"), F.lit(2e9), 10.0)).first()[0]
    assert latest == frames.KNOWN_S
