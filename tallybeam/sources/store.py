"""An atomic sink for whole files, and a cached table that is refreshed when it is old."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ATTEMPTS, LEAST_WAIT_S, MOST_WAIT_S = 5, 2.0, 60.0


def put(fs: pafs.FileSystem, path: str, content: bytes, attempts: int = ATTEMPTS, wait: Callable[[float], None] = time.sleep) -> int:
    """Write a file under a name of its own, check its size and rename it, so that readers see it whole or not at all; failures are tried again after 2, 4, 8 ... 60 s at most."""
    for attempt in range(attempts):
        part = f"{path}.{uuid.uuid4().hex}.partial"
        try:
            with fs.open_output_stream(part, compression=None) as out:
                out.write(content)
            if fs.get_file_info(part).size != len(content):
                raise OSError(f"{part} is incomplete")
            fs.move(part, path)
            return len(content)
        except OSError:
            if fs.get_file_info(part).type == pafs.FileType.File:
                fs.delete_file(part)
            if attempt + 1 == attempts:
                raise
            wait(min(MOST_WAIT_S, LEAST_WAIT_S * 2**attempt))
    raise AssertionError("no attempts")


def store(files: DataFrame, folder: str) -> DataFrame:
    """file, bytes of `files` (name, content) once the rows are computed: each is written by put() where its row is. Retried tasks write the same files again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            names = batch.column(0).to_pylist()
            sizes = [put(fs, f"{root}/{name}", content.as_py()) for name, content in zip(names, batch.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["file", "bytes"])

    return files.select("name", "content").mapInArrow(run, "file string, bytes long")


class Catalogue:
    """Events (name, gps) in a table under a path, fetched again when they are older than ttl_s. A fetch that fails or finds nothing leaves what is there."""

    SCHEMA = "name string, gps double, fetched double"

    def __init__(self, spark: SparkSession, path: str, fetch: Callable[[], DataFrame | None], ttl_s: float = 3600.0, now: Callable[[], float] = time.time):
        self.spark, self.path, self.fetch, self.ttl_s, self.now = spark, path.rstrip("/"), fetch, ttl_s, now

    def _versions(self) -> DataFrame:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def read(self) -> DataFrame:
        """name, gps of the latest version."""
        rows = self._versions()
        latest = rows.agg(F.max("fetched")).first()[0]
        return rows.filter(F.col("fetched") == latest).select("name", "gps") if latest is not None else rows.select("name", "gps")

    def refresh(self, force: bool = False) -> bool:
        """Fetch a new version if the latest one is old (or if forced). Returns whether there is one."""
        latest, now = self._versions().agg(F.max("fetched")).first()[0], self.now()
        if not force and latest is not None and now - latest < self.ttl_s:
            return False
        try:
            found = self.fetch()
            if found is None or found.isEmpty():
                return False
            found.select("name", F.col("gps").cast("double").alias("gps"), F.lit(float(now)).alias("fetched")).write.mode("append").parquet(self.path)
        except Exception:  # a source that is away must not stop a search
            return False
        return True
