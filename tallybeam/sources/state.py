"""Run state as append-only tables: runs, blocks, candidates, background, and a keyed log."""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybeam.functions import scalars as S

#: The tables' columns.
TABLES = {
    "runs": "id long, started_at double, config_hash string, notes string",
    "blocks": "id long, run_id long, ifos string, gps_start double, gps_end double, status string, error string, created_at double",
    "candidates": "id long, run_id long, gps double, ifos string, template_id string, network_stat double, far double, ifar_days double, payload string, created_at double",
    "background": "id long, run_id long, slide double, far double, payload string, created_at double",
    "kv": "k string, v string, seq long",
}


class State:
    """Appends are committed by Spark's output committer; readers see whole appends only."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def append(self, table: str, rows: DataFrame) -> None:
        names = [c.split(" ")[0] for c in TABLES[table].split(", ")]
        rows.select(*names).write.mode("append").parquet(f"{self.root}/{table}")

    def put(self, table: str, rows: DataFrame, part: str) -> None:
        """Rows of one part of a run, such as a block's; written again, they replace what the part wrote before."""
        names = [c.split(" ")[0] for c in TABLES[table].split(", ")]
        rows.select(*names).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{table}/{part}")

    def read(self, table: str) -> DataFrame:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        if not where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], TABLES[table])
        return self.spark.read.schema(TABLES[table]).option("recursiveFileLookup", True).parquet(f"{self.root}/{table}")

    def number(self, *columns: str) -> Column:
        """Ids for rows that are appended now: they rise with the clock, so a block's latest row has its largest id; a hash of the columns tells rows of one moment apart."""
        return F.lit(time.time_ns() // 1_000 << 10) + F.pmod(F.xxhash64(*columns), F.lit(1 << 10))

    def set_value(self, k: str, v: str) -> None:
        """Upsert as an append. Nothing is read: the clock in nanoseconds is the sequence number, so the later writer wins; of two at the same nanosecond the larger value does."""
        self.append("kv", self.spark.createDataFrame([(k, v, time.time_ns())], TABLES["kv"]))

    def progress(self, run_id: int, stage: str, share: float, message: str | None = None) -> None:
        self.set_value("progress", json.dumps({"run_id": run_id, "stage": stage, "pct": share, "ts": time.time(), "msg": message}))

    def get_value(self, k: str) -> str | None:
        row = latest_values(self.read("kv").filter(F.col("k") == k)).first()
        return row.v if row else None


def latest_values(kv: DataFrame) -> DataFrame:
    return kv.groupBy("k").agg(F.max(F.struct("seq", "v"))["v"].alias("v"))


def last_block_end(blocks: DataFrame, run_id: int | None = None) -> DataFrame:
    chosen = blocks if run_id is None else blocks.filter(F.col("run_id") == run_id)
    return chosen.agg(F.max("gps_end").alias("last_end"))


def first_finished_start(blocks: DataFrame) -> DataFrame:
    return blocks.filter(F.col("status").isin("done", "gap")).agg(F.min("gps_start").alias("first_start"))


def current_blocks(blocks: DataFrame) -> DataFrame:
    """The latest status of each block of each run."""
    return blocks.groupBy("run_id", "gps_start").agg(F.max_by("status", "id").alias("status"))


def status_counts(blocks: DataFrame) -> DataFrame:
    """One row of counts by status and the latest time, in one pass."""
    return blocks.agg(
        F.count(F.lit(1)).alias("n_blocks"),
        *(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("done", "gap", "processing", "error", "skipped")),
        F.max("created_at").alias("last_created"),
    )


#: The names of the columns of status().
def status(runs: DataFrame, blocks: DataFrame, candidates: DataFrame, background: DataFrame) -> DataFrame:
    """One row about the latest run: its id, start and configuration, blocks by status, candidates, backgrounds and latest times; zeros and nulls without a run."""
    latest = runs.agg(F.max(F.struct("started_at", "id", "config_hash")).alias("r")).select(F.col("r.id").alias("latest_run_id"), F.col("r.started_at").alias("latest_run_started_at"), F.col("r.config_hash").alias("latest_run_config_hash"))
    of = lambda s: F.count_if(F.col("status") == s)
    parts = (
        blocks.groupBy("run_id").agg(F.count(F.lit(1)).alias("block_count"), *(of(s).alias(f"block_{s}") for s in ("done", "error", "processing")), F.max("created_at").alias("last_block_created_at")),
        candidates.groupBy("run_id").agg(F.count(F.lit(1)).alias("candidate_count"), F.max("created_at").alias("last_candidate_created_at")),
        background.groupBy("run_id").agg(F.count(F.lit(1)).alias("background_count")),
    )
    for part in parts:
        latest = latest.join(part, F.col("latest_run_id") == F.col("run_id"), "left").drop("run_id")
    return latest.na.fill(0, [c for c in latest.columns if c.endswith("_count") or c.startswith("block_")])


def recent_candidates(candidates: DataFrame, k: int = 20) -> DataFrame:
    """The k latest candidates, sensors as an array (null: one empty name)."""
    return recent(candidates, k).select("run_id", "gps", S.split_ifos(F.col("ifos")).alias("ifos"), "network_stat", "far", "ifar_days", "template_id", "created_at")


def recent_background(background: DataFrame, k: int = 50) -> DataFrame:
    """The k latest backgrounds with `parsed`: the payload as a variant, or its text as one where it is no JSON."""
    return recent(background, k).select("slide", "far", S.parse_json_or_text(F.col("payload")).alias("parsed"), "payload", "created_at")


def recent(table: DataFrame, k: int = 20, by: str = "created_at", tie: str = "id") -> DataFrame:
    """The k latest rows."""
    return table.orderBy(F.desc(by), F.desc(tie)).limit(k)


def write_candidates(candidates: DataFrame, folder: str, config_json: str) -> None:
    """JSON lines with nesting, CSV with flat fields (nested ones as JSON text), and the configuration."""
    candidates.write.mode("overwrite").json(f"{folder}/candidates.jsonl")
    flat = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("struct", "map", "array") else F.col(f.name) for f in candidates.schema.fields]
    candidates.select(*flat).write.mode("overwrite").option("header", True).csv(f"{folder}/candidates.csv")
    candidates.sparkSession.createDataFrame([(config_json,)], "value string").write.mode("overwrite").text(f"{folder}/run_config.json")
