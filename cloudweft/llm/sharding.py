"""Shards by a consistent-hash ring with virtual nodes and bounded loads, with DataFrame operations only.

The ring has ``CELLS`` cells. A document falls into the cell of its doc_id's hash and belongs to the next virtual node
clockwise; a shard that is full passes the documents on, clockwise, to the next one with room. As documents of one cell
take the same way, the number of documents in each cell decides where they go: counts of at most ``CELLS`` cells come
to the driver, which fills the shards with ranges of ranks, and the ranges go back as a broadcast table. A rank in a
cell is an offset of one of ``PARTS`` parts of the cell and a row number within that part, so that a hot doc_id does not
meet in one task.

With ``slack`` 0 shards take N // shards rows, and the first N % shards of them one more: counts are at most one apart
(the law ``rows``). With a larger slack fewer rows move when a shard is added.

Defined results: a null text has no bytes and the checksum of the empty text; a null doc_id is a key as any other;
repeated rows are told apart by their place in the input and fill shards one by one; an empty table gives an empty
result; other columns are not read. Only the length and checksum of a text are taken, however long it is. Where hashes tie,
the place in the input decides.
"""

from __future__ import annotations

import hashlib
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cloudweft.llm.common import written

CELL_BITS = 14
CELLS = 1 << CELL_BITS
PART_BITS = 6
NODES = 64
OVERHEAD = 16


def ring(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """(cell, shard) of the virtual nodes, clockwise; the lowest shard has a cell that several want."""
    taken: dict[int, int] = {}
    for shard in range(shards):
        for node in range(nodes):
            cell = int.from_bytes(hashlib.sha256(f"{shard}/{node}".encode()).digest()[:8]) % CELLS
            taken.setdefault(cell, shard)
    return sorted(taken.items())


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    if slack > 0:
        return [ceil((1 + slack) * rows / shards)] * shards
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def fill(counts: dict[int, int], nodes: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end of ranks, shard, slot of the first): own documents first, then those that were passed on."""
    left, used = list(room), [0] * len(room)
    ranges, carried = [], []

    def take(cell: int, start: int, end: int, shard: int) -> int:
        n = min(end - start, left[shard])
        if n:
            ranges.append((cell, start, start + n, shard, used[shard]))
            left[shard] -= n
            used[shard] += n
        return start + n

    owner = 0
    for cell in sorted(counts):
        while owner < len(nodes) and nodes[owner][0] < cell:
            owner += 1
        at = owner % len(nodes)
        if (start := take(cell, 0, counts[cell], nodes[at][1])) < counts[cell]:
            carried.append((at, cell, start, counts[cell]))
    for at, cell, start, end in carried:
        while start < end:
            at = (at + 1) % len(nodes)
            start = take(cell, start, end, nodes[at][1])
    return ranges


def shard(docs: DataFrame, shards: int = 40, slack: float = 0.0, nodes: int = NODES) -> DataFrame:
    """For (doc_id, text): doc_id, size, text_crc32, shard, slot."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit("")).cast("binary")
    place = F.xxhash64("doc_id")
    rows = docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.shiftrightunsigned(place, 64 - CELL_BITS).cast("int").alias("cell"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("by", F.xxhash64("doc_id", "text_crc32", "row", F.lit("rank"))).withColumn("part", F.shiftrightunsigned("by", 64 - PART_BITS).cast("int"))
    rows = written(rows, "shards")
    parts = written(rows.groupBy("cell", "part").agg(F.count("*").alias("n")), "parts")  # at most CELLS << PART_BITS rows
    before = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("cell", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    counts = {r.cell: r.n for r in parts.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    ranges = fill(counts, ring(shards, nodes), capacities(sum(counts.values()), shards, slack))
    # A cell has one range, or more where a shard was full: at most CELLS + shards of them when filled without slack.
    table = spark.createDataFrame(ranges, "cell int, start long, end long, shard int, slot0 long")
    ranked = rows.withColumn("k", F.row_number().over(Window.partitionBy("cell", "part").orderBy("by", "row")) - 1)
    ranked = ranked.join(offsets, ["cell", "part"]).withColumn("rank", F.col("k") + F.col("offset")).drop("k", "offset")
    found = ranked.join(F.broadcast(table), (ranked.cell == table.cell) & (ranked["rank"] >= table.start) & (ranked["rank"] < table.end))
    return found.select("doc_id", "size", "text_crc32", "shard", (F.col("slot0") + F.col("rank") - F.col("start")).alias("slot"))
