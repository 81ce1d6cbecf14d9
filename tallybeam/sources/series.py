"""Series files as a PySpark Python data source.

A file holds the series of some channels of one sensor, each sampled evenly over the whole file: an .npz archive of uncompressed arrays, named
`X-H1_TAG-start-duration.npz` (GPS seconds). Rows are blocks: partitions() lists the files, cuts each into blocks, and plans runs of blocks; predicates on
the sensor and on the blocks' times are pushed down and decided before anything is opened. A task seeks to the samples of a block, padded and cut to
the file as frames.requests() defines, and reads no others.

Channels: a 16KHZ or 4KHZ tag in the name decides, else the candidates are tried in order and the first one that the file has is read. A file
without any is an error, unless errors are to give null series.
"""

from __future__ import annotations

import json
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from tallybeam.sources.frames import LEAST_S, MOST_S, PAD_S

SCHEMA = "file string, ifo string, channel string, block_start long, block_end long, read_start long, rate double, arr array<double>"
NAME = re.compile(r"^[A-Z]-([A-Z][0-9])_.*-([0-9]+)-([0-9]+)\.npz$")
#: Names of the strain channels after the sensor's name.
CHANNELS = {"16KHZ": "GWOSC-16KHZ_R1_STRAIN", "4KHZ": "GWOSC-4KHZ_R1_STRAIN", "legacy": "LOSC-STRAIN"}
BLOCK_S, SPLIT_S = 512, 1 << 16


def channels(file: str, ifo: str) -> list[str]:
    """Names of channels to try, by the tag in the file's name."""
    tag = next((t for t in ("16KHZ", "4KHZ") if t in file), None)
    return [f"{ifo}:{CHANNELS[t]}" for t in ([tag] if tag else ["4KHZ", "legacy"])]


def file_name(ifo: str, tag: str, start: int, duration: int) -> str:
    return f"{ifo[0]}-{ifo}_{tag}-{start}-{duration}.npz"


@dataclass
class Blocks(InputPartition):
    """Blocks of files that one task reads: (path, ifo, file start, file end, first block's start, blocks' end)."""

    runs: list[tuple[str, str, int, int, int, int]]

    def __init__(self, runs: list[tuple[str, str, int, int, int, int]]):
        super().__init__(None)
        self.runs = runs


def samples(file: pa.NativeFile, names: list[str], start_s: float, end_s: float, seconds: float) -> tuple[str, float, np.ndarray]:
    """Channel, rate and the samples from start_s to end_s (from the file's start) of the first named channel that the archive has; other samples are skipped, not read."""
    with zipfile.ZipFile(file) as archive:
        held = {n.removesuffix(".npy") for n in archive.namelist()}
        channel = next((n for n in names if n in held), None)
        if channel is None:
            raise ValueError(f"none of the channels {', '.join(names)}")
        with archive.open(f"{channel}.npy") as entry:
            version = np.lib.format.read_magic(entry)
            shape, _, kind = np.lib.format.read_array_header_1_0(entry) if version == (1, 0) else np.lib.format.read_array_header_2_0(entry)
            rate = shape[0] / seconds
            first, last = max(0, round(start_s * rate)), min(shape[0], round(start_s * rate) + round((end_s - start_s) * rate))
            entry.seek(first * kind.itemsize, 1)
            return channel, rate, np.frombuffer(entry.read((last - first) * kind.itemsize), kind).astype(float)


class SeriesReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.columns = options["path"], schema.names
        self.block_s, self.strict = int(options.get("block_s", BLOCK_S)), options.get("errors", "raise") == "raise"
        self.start = int(options["start"]) if "start" in options else None
        self.only = json.loads(options["only"]) if "only" in options else None
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        """Comparisons of ifo, block_start and block_end with literals are decided here; the rest is left to Spark."""
        signs = {EqualTo: "=", In: "in", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            known = getattr(f, "attribute", ()) in (("ifo",), ("block_start",), ("block_end",))
            if known and type(f) in signs:
                self.tests.append((f.attribute[0], signs[type(f)], f.value))
            elif not (known and isinstance(f, IsNotNull)):  # these columns are never null
                yield f

    def wanted(self, **row) -> bool:
        test = {"=": lambda a, b: a == b, "in": lambda a, b: a in b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}
        return all(test[sign](row[c], v) for c, sign, v in self.tests if c in row)

    def partitions(self) -> list[Blocks]:
        def asked(start: int, end: int) -> list[int]:
            found = range(start, end, self.block_s) if self.start is None else [self.start] if start <= self.start and self.start + self.block_s <= end else []
            return [b for b in found if self.wanted(block_start=b, block_end=min(b + self.block_s, end))]

        return self.planned(asked)

    def listed(self) -> list[tuple[str, str, int, int]]:
        """(path, sensor, start, end) of the files, or of those that the option `only` names, without looking for others."""
        if self.only is None:
            return [f for f in files(self.path, whole=True) if self.wanted(ifo=f[1])]
        return [(path, m[1], int(m[2]), int(m[2]) + int(m[3])) for path in self.only if (m := NAME.match(posixpath.basename(path))) and self.wanted(ifo=m[1])]

    def planned(self, asked: Callable[[int, int], list[int]]) -> list[Blocks]:
        """Runs of neighbouring blocks of each file, of those that asked(file's start, end) names, SPLIT_S seconds a task."""
        out: list[list[tuple]] = []
        room = 0
        for path, ifo, start, end in sorted(self.listed()):
            blocks = asked(start, end)
            while blocks:
                n = 1
                while n < len(blocks) and blocks[n] == blocks[0] + n * self.block_s and n * self.block_s < SPLIT_S:
                    n += 1
                if not out or room <= 0:
                    out.append([])
                    room = SPLIT_S
                out[-1].append((path, ifo, start, end, blocks[0], min(blocks[n - 1] + self.block_s, end)))
                room -= n * self.block_s
                blocks = blocks[n:]
        return [Blocks(runs) for runs in out]

    def read(self, partition: Blocks | None) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        for path, ifo, start, end, first, last in partition.runs if partition else []:
            with fs.open_input_file(path) as file:
                for block in range(first, last, self.block_s):
                    block_end = min(block + self.block_s, last)
                    read_start, read_end = max(block - PAD_S, 0, start), min(block_end + PAD_S, end)
                    if not LEAST_S <= read_end - read_start <= MOST_S:
                        continue
                    row = {"file": posixpath.basename(path), "ifo": ifo, "channel": None, "block_start": block, "block_end": block_end, "read_start": read_start, "rate": None, "arr": None}
                    if {"arr", "rate", "channel"} & set(self.columns):
                        try:
                            row["channel"], row["rate"], row["arr"] = samples(file, channels(path, ifo), read_start - start, read_end - start, end - start)
                        except (ValueError, zipfile.BadZipFile) as e:
                            if self.strict:
                                raise ValueError(f"cannot read {path}: {e}") from e
                    yield self.batch(row)

    def batch(self, row: dict) -> pa.RecordBatch:
        kinds = {"block_start": pa.int64(), "block_end": pa.int64(), "read_start": pa.int64(), "rate": pa.float64(), "arr": pa.list_(pa.float64())}
        return pa.RecordBatch.from_arrays([pa.array([row[c]], kinds.get(c, pa.string())) for c in self.columns], self.columns)


class SeriesStreamReader(SeriesReader, DataSourceStreamReader):
    """Blocks as their files arrive. An offset is the time up to which all sensors (the option `sensors`, else all that the folder has) have files; a micro-batch takes the blocks of all sensors that end
    after the offset before and not after its own.

    The folder is listed once for each micro-batch. Files of a sensor must come in the order of time: a block that ends before an offset that has passed is not read any more.
    """

    def __init__(self, options: dict[str, str], schema: StructType):
        SeriesReader.__init__(self, options, schema)
        self.sensors = [x for x in options.get("sensors", "").split(",") if x]

    def initialOffset(self) -> dict:
        return {"end": -1}

    def latestOffset(self) -> dict:
        ends: dict[str, int] = dict.fromkeys(self.sensors, -1)
        for _, ifo, _, end in self.listed():
            if not self.sensors or ifo in ends:
                ends[ifo] = max(ends.get(ifo, -1), end)
        return {"end": min(ends.values(), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[Blocks]:
        new = lambda b, stop: start["end"] < min(b + self.block_s, stop) <= end["end"]
        return self.planned(lambda a, stop: [b for b in range(a, stop, self.block_s) if new(b, stop)])

    def commit(self, end: dict) -> None:
        pass


class SeriesSource(DataSource):
    """spark.read.format("series").load(folder), or readStream; options block_s, start (only the block that begins there, of each file that holds it whole), only (JSON list of paths of files, so the folder isn't listed), errors ("raise" or "null"), and sensors of a stream."""

    @classmethod
    def name(cls) -> str:
        return "series"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> SeriesReader:
        return SeriesReader(dict(self.options), schema)

    def streamReader(self, schema: StructType) -> SeriesStreamReader:
        return SeriesStreamReader(dict(self.options), schema)


def files(folder: str, whole: bool = False) -> list[tuple[str, str, int, int]]:
    """(file, sensor, start, end) of the series files in a folder (a URI), in order of start; whole: with their paths."""
    fs, path = pafs.FileSystem.from_uri(folder)
    infos = fs.get_file_info(pafs.FileSelector(path, recursive=True))
    found = [(m, i.path) for i in infos if i.type == pafs.FileType.File and (m := NAME.match(posixpath.basename(i.path)))]
    return sorted(((place if whole else posixpath.basename(place), m[1], int(m[2]), int(m[2]) + int(m[3])) for m, place in found), key=lambda f: (f[2], f[0]))


def read(spark: SparkSession, folder: str, block_s: int = BLOCK_S, errors: str = "raise", schema: str = SCHEMA, start: int | None = None, only: list[str] | None = None) -> DataFrame:
    """Blocks of the series files in a folder (a URI), or the one that begins at `start` of each sensor; only: paths of the files to look at. spark.sql.python.filterPushdown.enabled is set, so that predicates reach the source."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SeriesSource)
    rows = spark.read.format("series").schema(schema).option("block_s", block_s).option("errors", errors)
    if only is not None:
        rows = rows.option("only", json.dumps(only))
    return (rows if start is None else rows.option("start", start)).load(folder)


def stream(spark: SparkSession, folder: str, block_s: int = BLOCK_S, sensors: Sequence[str] = (), errors: str = "raise") -> DataFrame:
    """Blocks of the series files in a folder (a URI) as a stream, once all of the sensors have reached them."""
    spark.dataSource.register(SeriesSource)
    return spark.readStream.format("series").schema(SCHEMA).option("block_s", block_s).option("errors", errors).option("sensors", ",".join(sensors)).load(folder)


def write(rows: DataFrame, folder: str) -> DataFrame:
    """file, bytes: one series file for each row (ifo, tag, start, duration, channel, arr), written whole or not at all (store())."""
    from tallybeam.sources.store import store

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        for batch in batches:
            for r in batch.to_pylist():
                out = io.BytesIO()
                np.savez(out, **{r["channel"]: np.asarray(r["arr"], float)})
                yield pa.RecordBatch.from_arrays([pa.array([file_name(r["ifo"], r["tag"], r["start"], r["duration"])]), pa.array([out.getvalue()], pa.binary())], ["name", "content"])

    return store(rows.select("ifo", "tag", "start", "duration", "channel", "arr").mapInArrow(run, "name string, content binary"), folder)
