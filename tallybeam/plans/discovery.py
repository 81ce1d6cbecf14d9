"""Queries about files, listings, runs and series files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybeam import search
from tallybeam.operators import bank
from tallybeam.operators.intervals import range_join
from tallybeam.plans import views as V
from tallybeam.plans.catalogue import query
from tallybeam.scratch import materialise, new_path
from tallybeam.sources import frames, series


@query("""WITH a AS (SELECT series_id // 8 AS f, flatten(list(arr ORDER BY series_id % 8, arr)) AS arr FROM v_series GROUP BY 1), p AS (SELECT f, len(arr) AS size, unnest(range(len(arr))) AS i, unnest(arr) AS v FROM a),
    b AS (SELECT f, size, unnest(range(0, size, 64)) AS b FROM (SELECT f, len(arr) AS size FROM a)), r AS (SELECT *, greatest(b - 32, 0) AS lo, least(least(b + 64, size) + 32, size) AS hi FROM b)
    SELECT r.f * 100000 + b AS block_start, r.f * 100000 + lo AS read_start, count(*)::INT AS n, round(sum(v), 6) AS total FROM r JOIN p ON p.f = r.f AND i >= lo AND i < hi WHERE hi - lo >= 64 GROUP BY r.f, b, lo""")
def s01_s02_series_scan(spark, sf_dir):
    """Eight series make a file of a second for each sample; the files are written, and all their blocks of 64 s read back padded."""
    s = V.series(spark, sf_dir)
    files = s.groupBy(F.floor(F.col("series_id") / 8).alias("f")).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col("series_id") % 8, "arr"))), lambda x: x["arr"])).alias("arr"))
    rows = files.select(F.lit("H1").alias("ifo"), F.lit("GWOSC_4KHZ_R1").alias("tag"), (F.col("f") * 100_000).alias("start"), F.size("arr").alias("duration"), F.lit("H1:GWOSC-4KHZ_R1_STRAIN").alias("channel"), "arr")
    folder = new_path(spark, "series")
    materialise(series.write(rows, folder), "series-files")
    found = series.read(spark, folder, block_s=64).filter("ifo = 'H1'")
    return found.select("block_start", "read_start", F.size("arr").alias("n"), F.round(F.aggregate("arr", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


_NOW, _LOOKBACK = 1_400_000_000.0, 604_800.0


@query(f"""WITH f AS (SELECT o_custkey, max(o_orderkey * 4096 + 4096) FILTER (o_orderkey % 7 <> 0) AS latest, max(o_orderkey) AS k FROM orders GROUP BY o_custkey),
    e AS (SELECT o_custkey, latest, CASE WHEN o_custkey % 3 > 0 THEN k * 4000.0::DOUBLE END AS cached, {_NOW}::DOUBLE - o_custkey % 4 * 600 AS cached_at, CASE WHEN o_custkey % 5 > 1 THEN 1389456018.0::DOUBLE END AS of_runs FROM f)
    SELECT o_custkey, latest AS listed, round(coalesce(CASE WHEN {_NOW}::DOUBLE - cached_at < 1800 AND cached <= {_NOW}::DOUBLE + 1.5 * {_LOOKBACK} THEN cached END, least(coalesce(latest::DOUBLE, of_runs, 1126259462.4::DOUBLE), {_NOW}::DOUBLE + {_LOOKBACK})), 3) AS latest_end,
    coalesce(CASE WHEN {_NOW}::DOUBLE - cached_at < 1800 AND cached <= {_NOW}::DOUBLE + 1.5 * {_LOOKBACK} THEN cached END, least(coalesce(latest::DOUBLE, of_runs, 1126259462.4::DOUBLE), {_NOW}::DOUBLE + {_LOOKBACK})) > 30000001 AS has_new FROM e""", views=False)
def s08_s09_s11_latest_end(spark, sf_dir):
    """For each customer as a sensor: the end of a listing of names, the latest end by the chain of cache, listing, runs and known time, and whether there is new data."""
    o = V.read(spark, sf_dir, "orders")
    name = F.concat(F.lit("H-H1_X-"), (F.col("o_orderkey") * 4096).cast("string"), F.lit("-4096"), F.when(F.col("o_orderkey") % 7 == 0, ".txt").otherwise(".hdf5"))
    listed = o.select("o_custkey", "o_orderkey", frames.coverage(name)[1].alias("end")).groupBy("o_custkey").agg(F.max("end").alias("listed"), F.max("o_orderkey").alias("k"))
    key = F.col("o_custkey")
    latest = frames.latest_end(F.when(key % 3 > 0, F.col("k") * 4000.0), F.lit(_NOW) - key % 4 * 600, F.col("listed"), F.when(key % 5 > 1, 1389456018.0), F.lit(_NOW), _LOOKBACK)
    return listed.select("o_custkey", "listed", F.round(latest, 3).alias("latest_end"), frames.has_new_data(latest, F.lit(30_000_000.0)).alias("has_new"))


@query("""SELECT n_name AS run, CASE WHEN n_nationkey % 3 = 0 AND n_nationkey % 6 > 0 THEN n_nationkey * 90.0::DOUBLE ELSE n_nationkey * 100.0::DOUBLE END AS run_start,
    CASE WHEN n_nationkey % 3 = 0 AND n_nationkey % 6 > 0 THEN n_nationkey * 95.0::DOUBLE ELSE n_nationkey * 100.0::DOUBLE + 50 END AS run_end FROM nation""", views=False)
def s13_run_overrides(spark, sf_dir):
    n = V.read(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    runs = n.select(F.col("n_name").alias("run"), (k * 100.0).alias("run_start"), (k * 100.0 + 50).alias("run_end"))
    overrides = n.filter(k % 3 == 0).select(F.col("n_name").alias("run"), (k * 90.0).alias("run_start"), F.when(k % 6 > 0, k * 95.0).alias("run_end"))
    return frames.run_segments(runs, overrides)


_FILES = """f AS (SELECT 'f' || o_orderkey AS file, CASE o_custkey % 3 WHEN 0 THEN 'H1' WHEN 1 THEN 'L1' ELSE 'V1' END AS ifo, o_orderkey % 4 = 0 AS cached, o_orderkey // 3 * 4096 AS file_start, o_orderkey // 3 * 4096 + 4096 - o_custkey % 2 * 1024 AS file_end FROM orders),
    b AS (SELECT i * 1024 AS block_start, i * 1024 + 1024 AS block_end FROM (SELECT unnest(range((SELECT max(file_end) // 1024 FROM f))) AS i))"""


def _files(spark, sf_dir):
    o = V.read(spark, sf_dir, "orders")
    start = F.floor(F.col("o_orderkey") / 3) * 4096
    ifo = F.when(F.col("o_custkey") % 3 == 0, "H1").when(F.col("o_custkey") % 3 == 1, "L1").otherwise("V1")
    files = o.select(F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("file"), ifo.alias("ifo"), (F.col("o_orderkey") % 4 == 0).alias("cached"), start.alias("file_start"), (start + 4096 - F.col("o_custkey") % 2 * 1024).alias("file_end"))
    blocks = spark.range((files.agg(F.max("file_end")).first()[0] or 0) // 1024).select((F.col("id") * 1024).alias("block_start"), (F.col("id") * 1024 + 1024).alias("block_end"))
    return files, blocks


@query(f"""WITH {_FILES}, r AS (SELECT 'R' || i AS run, i * 300000 AS run_start, i * 300000 + 200000 AS run_end FROM range(3) g(i)),
    g AS (SELECT f.*, 'R' || (length(file) + file_start // 4096) % 3 AS run FROM f),
    t AS (SELECT b.*, r.run AS wanted FROM b LEFT JOIN r ON (run_start <= block_start AND block_start < run_end) OR (run_start < block_end AND block_end <= run_end)),
    h AS (SELECT t.block_start, t.block_end, g.run, g.file, q.run_start FROM t JOIN g ON file_start <= block_start AND block_end <= file_end AND (wanted IS NULL OR wanted = g.run) JOIN r q ON q.run = g.run)
    SELECT block_start, block_end, run, file FROM h QUALIFY row_number() OVER (PARTITION BY block_start ORDER BY run_start, file) = 1""", views=False)
def s06_file_of_a_run(spark, sf_dir):
    files, blocks = _files(spark, sf_dir)
    files = files.withColumn("run", F.concat(F.lit("R"), ((F.length("file") + F.floor(F.col("file_start") / 4096)) % 3).cast("string")))
    runs = spark.createDataFrame([(f"R{i}", i * 300_000, i * 300_000 + 200_000) for i in range(3)], "run string, run_start long, run_end long")
    return frames.resolved(blocks, files.select("run", "file", "file_start", "file_end"), runs)


@query(f"""WITH {_FILES}, h AS (SELECT block_start, block_end, CASE ifo WHEN 'H1' THEN 0 WHEN 'L1' THEN 1 ELSE 2 END AS source, file FROM b JOIN f ON file_start <= block_start AND block_end <= file_end),
    w AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY block_start ORDER BY source, file) = 1) SELECT b.block_start, b.block_end, w.source, w.file FROM b LEFT JOIN w USING (block_start, block_end)""", views=False)
def s07_first_source(spark, sf_dir):
    files, blocks = _files(spark, sf_dir)
    return frames.first_of(blocks, [files.filter(F.col("ifo") == x).select("file", "file_start", "file_end") for x in ("H1", "L1", "V1")])


@query(f"""WITH {_FILES}, a AS (SELECT block_start, block_end, unnest(['H1', 'L1', 'V1']) AS ifo FROM b), h AS (SELECT a.*, f.file, f.cached FROM a JOIN f ON f.ifo = a.ifo AND file_start <= block_start AND block_end <= file_end),
    w AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY block_start, ifo ORDER BY cached DESC, file) = 1)
    SELECT a.block_start, a.block_end, a.ifo, w.file, w.cached AS is_cached, CASE WHEN w.file IS NULL THEN 'no files found for ' || a.ifo || ' ' || a.block_start || '-' || a.block_end END AS error FROM a LEFT JOIN w USING (block_start, block_end, ifo)""", views=False)
def s14_s15_files_of_all_sensors(spark, sf_dir):
    files, blocks = _files(spark, sf_dir)
    listed = files.select("ifo", "file", "file_start", "file_end")
    return frames.fetched(blocks, files.filter("cached").select(*listed.columns), files.filter("not cached").select(*listed.columns), ["H1", "L1", "V1"])


@query("""SELECT o_orderkey * 4096.0::DOUBLE AS gps_start FROM orders WHERE o_custkey % 2 = 0""", views=False)
def s12_paged_listing(spark, sf_dir):
    """All files of the table as a listing in pages of 100, of which the first page tells the number, beside a broken page and one beyond the last; all starts of a sensor."""
    o = V.read(spark, sf_dir, "orders").withColumn("page", (F.floor(F.col("o_orderkey") / 100) + 1).cast("int"))
    item = F.struct(F.when(F.col("o_custkey") % 2 == 0, "H1").otherwise("L1").alias("detector"), (F.col("o_orderkey") * 4096.0).alias("gps_start"), F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("hdf5_url"))
    most, first, last = o.agg(F.max("page"), F.min(F.col("o_orderkey") * 4096.0), F.max(F.col("o_orderkey") * 4096.0)).first()
    pages = o.groupBy("page").agg(F.collect_list(item).alias("results"))  # a hundred files each
    pages = pages.unionByName(pages.orderBy("page").limit(1).withColumn("page", F.lit((most or 0) + 1))).withColumn("num_pages", F.lit(most))
    lines = pages.select(F.to_json(F.struct("page", "num_pages", "results")).alias("value")).unionByName(spark.createDataFrame([('{"page": 1, "num_pa',)], "value string"))
    path = new_path(spark, "listing")
    lines.write.text(path)
    return frames.listed_starts(frames.listing(spark, path), "H1", first or 0.0, (last or 0.0) + 1)


@query("""SELECT p_partkey % 50 AS bucket, round(sum(p_retailprice / 20), 4) AS mass1, round(sum(p_size + 1.0), 4) AS mass2, round(sum(CASE WHEN p_partkey % 3 > 0 THEN p_size / 100.0 ELSE 0 END), 4) AS spin1z, 0.0 AS spin2z, count(*) AS n FROM part GROUP BY 1""", views=False)
def s22_stored_bank(spark, sf_dir):
    """A bank kept as a table that lacks one spin's column and some of the other's values; sums over 50 buckets."""
    path = new_path(spark, "bank")
    V.read(spark, sf_dir, "part").select("p_partkey", (F.col("p_retailprice") / 20).alias("mass1"), (F.col("p_size") + 1.0).alias("mass2"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_size") / 100.0).alias("spin1z"), (F.col("p_partkey") % 50).alias("bucket")).write.partitionBy("bucket").parquet(path)
    sums = [F.round(F.sum(c), 4).alias(c) for c in ("mass1", "mass2", "spin1z", "spin2z")]
    return bank.stored(spark, path, keep=["bucket"]).groupBy(F.col("bucket").cast("long").alias("bucket")).agg(*sums, F.count(F.lit(1)).alias("n"))


@query(f"""SELECT max(run_end) AS previous FROM (VALUES {", ".join(f"({b}::DOUBLE)" for _, _, b in frames.RUNS)}) r(run_end) WHERE run_end < (SELECT 1126000000 + 20000 * max(o_orderkey) FROM orders)""", views=False)
def a25_previous_run_end(spark, sf_dir):
    """The end of the last run before the latest order, taken as a time."""
    latest = V.read(spark, sf_dir, "orders").agg(F.max(F.lit(1_126_000_000.0) + F.col("o_orderkey") * 20_000)).first()[0]
    return frames.previous_run_end(spark.createDataFrame(frames.RUNS, "run string, run_start double, run_end double"), latest or 0.0)


@query()
def r03_backward_blocks(spark, sf_dir):
    """Blocks of a backward search over all files of two sensors, from the latest end down, with its jumps over gaps, else to ends of runs of 8192 s; the tests hold it against a plain loop.

    The search goes by stretches of time, each a group of its own; the driver holds a few ways through each stretch and no file or block.
    """
    files, _ = _files(spark, sf_dir)
    listed = files.select("ifo", F.col("file_start").cast("double").alias("s"), F.col("file_end").cast("double").alias("e"))
    starts = lambda ifo, name: files.filter(F.col("ifo") == ifo).select(F.col("file_start").alias(name)).distinct()
    both = range_join(starts("H1", "s"), starts("L1", "o"), "s", "o", frames.FILE_S, strict=True, how="left_semi")
    joint = both.select(F.col("s").cast("double").alias("s"))
    latest = listed.filter("ifo = 'H1'").agg(F.max("e")).first()[0]
    if latest is None:
        return spark.createDataFrame([], "block_start double, block_end double, status string")
    return search.backward_blocks(listed, ["H1", "L1"], joint, float(frames.FILE_S), latest, 512.0, 8192.0, stop_s=512.0)
