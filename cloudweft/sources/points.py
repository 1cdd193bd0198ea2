"""Points of scan packages as a Python data source: record-aligned byte ranges are partitions, Arrow batches the rows.

    spark.dataSource.register(ScanPoints)
    spark.read.format("scan_points").option("paths", json.dumps([...])).load()

Packages by URI are read through Spark's binary file source instead, a chunk being a row that is decoded where it was
read; such chunks hold less than 2 GB.

Options: paths (a JSON list, whose places, or the list in sources, are source_ids), split_records, and minimum_confidence, which drops points in
the reader. Filters are not pushed down: Spark 4.1 keeps a reader's pushed filters for every other query on the same table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cloudweft.schema import CHUNK_NAME, POINTS, RECORD
from cloudweft.sources.packages import ScanPackage
from cloudweft.sources.remote import Remote

SPLIT_RECORDS = 4 << 20
BATCH_RECORDS = 64 << 10


@dataclass
class ChunkRange(InputPartition):
    source_id: int
    path: str
    first: int
    count: int
    ord: int


def batch_of(records: np.ndarray, source_id: int, first: int, minimum: int) -> pa.RecordBatch:
    """Float32 coordinates are widened before anything is computed from them."""
    keep = np.flatnonzero(records["confidence"] >= minimum)
    taken = records[keep]
    xyz, rgb = taken["xyz"].astype(np.float64), taken["rgb"].astype(np.int16)
    columns = {
        "source_id": np.full(len(taken), source_id, dtype=np.int32),
        "ord": first + keep.astype(np.int64),
        **{n: np.ascontiguousarray(xyz[:, k]) for k, n in enumerate("xyz")},
        **{n: np.ascontiguousarray(rgb[:, k]) for k, n in enumerate("rgb")},
        "confidence": taken["confidence"].astype(np.int16),
        "scan_time": np.ascontiguousarray(taken["time"]),
    }
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


class ScanPointsReader(DataSourceReader):
    def __init__(self, paths: list[str], sources: list[int], split: int, minimum: int) -> None:
        self.paths, self.sources, self.split, self.minimum = paths, sources, split, minimum

    def partitions(self) -> list[ChunkRange]:
        found = []
        for source_id, path in zip(self.sources, self.paths, strict=True):
            start, manifest = 0, json.loads((Path(path) / "manifest.json").read_text(encoding="utf-8"))
            for k in range(int(manifest["chunkCount"])):
                chunk = Path(path) / CHUNK_NAME.format(k + 1)
                size = chunk.stat().st_size // RECORD.itemsize
                found += [ChunkRange(source_id, str(chunk), at, min(self.split, size - at), start + at) for at in range(0, size, self.split)]
                start += size
        return found or [ChunkRange(0, "", 0, 0, 0)]

    def read(self, part: ChunkRange) -> Iterator[pa.RecordBatch]:
        for at in range(0, part.count, BATCH_RECORDS):
            n = min(BATCH_RECORDS, part.count - at)
            records = np.fromfile(part.path, dtype=RECORD, count=n, offset=(part.first + at) * RECORD.itemsize)
            yield batch_of(records, part.source_id, part.ord + at, self.minimum)


class ScanPoints(DataSource):
    @classmethod
    def name(cls) -> str:
        return "scan_points"

    def schema(self):
        return POINTS

    def reader(self, schema) -> ScanPointsReader:
        o = self.options
        paths = json.loads(o["paths"])
        sources = json.loads(o["sources"]) if "sources" in o else list(range(len(paths)))
        return ScanPointsReader(paths, sources, int(o.get("split_records", SPLIT_RECORDS)), int(o.get("minimum_confidence", 0)))


def _by_uri(spark: SparkSession, packages: list[tuple[int, ScanPackage]], minimum: int) -> DataFrame:
    """Points of packages by URI. Where each chunk belongs, a row for each, is broadcast."""
    places = []
    for source_id, p in packages:
        ends = np.cumsum([0, *(size // RECORD.itemsize for size in p.chunk_sizes())]).tolist()
        places += [(str(chunk.resolve()), source_id, at) for chunk, at in zip(p.chunks(), ends)]
    if not places:
        return spark.createDataFrame([], POINTS)
    table = spark.createDataFrame(places, "path string, source_id int, ord long")
    chunks = spark.read.format("binaryFile").load([path for path, *_ in places]).select("path", "content").join(F.broadcast(table), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, source_id, first in zip(*(batch.column(k) for k in range(3)), strict=True):
                records = np.frombuffer(body.as_buffer(), dtype=RECORD)
                for at in range(0, len(records), BATCH_RECORDS):
                    yield batch_of(records[at : at + BATCH_RECORDS], source_id.as_py(), first.as_py() + at, minimum)

    return chunks.select("content", "source_id", "ord").mapInArrow(run, POINTS)


def read_points(spark: SparkSession, packages: list[ScanPackage], minimum_confidence: int = 0, split_records: int = SPLIT_RECORDS) -> DataFrame:
    """All points (see ``schema.POINTS``); source_id is a package's place in the list."""
    spark.dataSource.register(ScanPoints)
    far = [(k, p) for k, p in enumerate(packages) if isinstance(p.path, Remote)]
    near = {k: str(p.path) for k, p in enumerate(packages) if not isinstance(p.path, Remote)}
    options = {"paths": json.dumps(list(near.values())), "sources": json.dumps(list(near)), "split_records": str(split_records), "minimum_confidence": str(minimum_confidence)}
    local = spark.read.format("scan_points").options(**options).load()
    if not far:
        return local
    remote = _by_uri(spark, far, minimum_confidence)
    return local.unionByName(remote) if near else remote
