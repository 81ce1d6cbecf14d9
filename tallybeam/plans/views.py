"""Views that give the supplied tables the shape of triggers, catalogue, segments, series and run state; in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybeam.functions.scalars import new_snr, reduced_chisq
from tallybeam.streaming.loop import block_times

HOUR = 3_600_000_000
MINUTE = 60_000_000
MONTH_START = 1_704_067_200_000_000  # 2024-01-01 UTC
MONTH_END = MONTH_START + 30 * 24 * HOUR
SENSOR = {"click": "H1", "view": "L1", "purchase": "V1"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts):
    return F.unix_micros(ts.cast("timestamp"))


def triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triggers_of(read(spark, sf_dir, "events"))


def triggers_of(events: DataFrame) -> DataFrame:
    e = events.filter(F.col("event_type").isin(*SENSOR))
    ifo = F.when(F.col("event_type") == "click", "H1").when(F.col("event_type") == "view", "L1").otherwise("V1")
    chisq = F.regexp_extract("props", "([0-9]+)", 1).cast("double")
    return e.select(ifo.alias("ifo"), micros(F.col("ts")).alias("gps_us"), (F.col("user_id") % 8).cast("string").alias("template_id"), F.col("value").alias("snr"), chisq.alias("chisq"), reduced_chisq(chisq).alias("rchisq"), new_snr(F.col("value"), chisq).alias("new_snr"), "event_id")


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue_of(read(spark, sf_dir, "events"))


def catalogue_of(events: DataFrame) -> DataFrame:
    e = events.filter("event_type = 'signup'")
    return e.select(F.concat(F.lit("EV"), F.col("event_id").cast("string")).alias("name"), micros(F.col("ts")).alias("cat_us"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").filter("event_type = 'error'")
    start = micros(F.col("ts"))
    return e.select(F.when(F.col("user_id") % 2 == 0, "H1").otherwise("L1").alias("ifo"), start.alias("seg_start_us"), (start + F.floor(F.col("value") * 60_000_000)).cast("long").alias("seg_end_us"), F.col("event_id").alias("seg_id"))


def blocks(spark: SparkSession) -> DataFrame:
    return block_times(spark, MONTH_START, MONTH_END, 6 * HOUR)


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("series_id"), F.when(F.col("label") % 2 == 0, "H1").otherwise("L1").alias("ifo"), F.transform("embedding", lambda x: x.cast("double")).alias("arr"))


def state_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "gap").otherwise("processing")
    return o.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 5).alias("run_id"), (F.col("o_orderkey") * 512).cast("double").alias("gps_start"), (F.col("o_orderkey") * 512 + 512).cast("double").alias("gps_end"), status.alias("status"), (micros(F.col("o_orderdate")) / 1e6).alias("created_at"))


#: The same views for the SQL that checks the queries.
SQL = """
t0 AS (SELECT CASE event_type WHEN 'click' THEN 'H1' WHEN 'view' THEN 'L1' ELSE 'V1' END AS ifo, epoch_us(ts) AS gps_us, (user_id % 8)::VARCHAR AS template_id,
    value AS snr, regexp_extract(props, '([0-9]+)', 1)::DOUBLE AS chisq, event_id FROM events WHERE event_type IN ('click', 'view', 'purchase')),
v_triggers AS (SELECT ifo, gps_us, template_id, snr, chisq, greatest(0.0, chisq) / 30.0 AS rchisq, CASE WHEN NOT isfinite(snr) OR snr <= 0 THEN 0.0 WHEN NOT isfinite(chisq) OR chisq < 0 THEN snr
    ELSE snr / pow((1.0 + least(chisq / 30.0, 1000.0) * least(chisq / 30.0, 1000.0) * least(chisq / 30.0, 1000.0)) / 2.0, 1.0 / 6.0::DOUBLE) END AS new_snr, event_id FROM t0),
v_catalogue AS (SELECT 'EV' || event_id AS name, epoch_us(ts) AS cat_us FROM events WHERE event_type = 'signup'),
v_segments AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'H1' ELSE 'L1' END AS ifo, epoch_us(ts) AS seg_start_us, (epoch_us(ts) + floor(value * 60000000))::BIGINT AS seg_end_us, event_id AS seg_id FROM events WHERE event_type = 'error'),
v_blocks AS (SELECT 1704067200000000 + i * 21600000000 AS block_start_us, 1704067200000000 + (i + 1) * 21600000000 AS block_end_us FROM range(120) r(i)),
v_series AS (SELECT vec_id AS series_id, CASE WHEN label % 2 = 0 THEN 'H1' ELSE 'L1' END AS ifo, embedding::DOUBLE[] AS arr FROM embeddings),
v_state AS (SELECT o_orderkey AS id, o_custkey % 5 AS run_id, (o_orderkey * 512)::DOUBLE AS gps_start, (o_orderkey * 512 + 512)::DOUBLE AS gps_end,
    CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'gap' ELSE 'processing' END AS status, epoch_us(o_orderdate) / 1e6::DOUBLE AS created_at FROM orders),
coinc AS (SELECT a.event_id AS event_id_a, b.event_id AS event_id_b, (a.gps_us + b.gps_us) // 2 AS gps_us, a.gps_us - b.gps_us AS dt_us, a.template_id, a.rchisq AS rchisq_a, b.rchisq AS rchisq_b,
    sqrt(a.new_snr * a.new_snr + b.new_snr * b.new_snr) AS network_stat FROM v_triggers a JOIN v_triggers b ON a.ifo = 'H1' AND b.ifo = 'L1' AND a.template_id = b.template_id AND abs(a.gps_us - b.gps_us) <= 3600000000),
slides AS (SELECT s AS slide, s * 7200000000 AS offset_us FROM range(-10, 11) r(s) WHERE s <> 0),
bg AS (SELECT slide, a.event_id AS event_id_a, b.event_id AS event_id_b, a.template_id, sqrt(a.new_snr * a.new_snr + b.new_snr * b.new_snr) AS network_stat
    FROM v_triggers a JOIN v_triggers b ON a.ifo = 'H1' AND b.ifo = 'L1' AND a.template_id = b.template_id JOIN slides ON abs(a.gps_us - b.gps_us - offset_us) < 3600000000),
far AS (SELECT c.*, (SELECT count(*) FROM bg WHERE bg.network_stat >= c.network_stat) AS n_louder FROM coinc c),
cand AS (SELECT *, (n_louder + 1) / 51840000.0::DOUBLE AS far_hz FROM far)
"""
