"""Which scans may overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tiles along one axis at most.
TILES = 4096


def bounds(points: DataFrame) -> DataFrame:
    """(source_id, low and high of x, y, z): one small row for each scan."""
    return points.groupBy("source_id").agg(*(f(a).alias(f"{n}_{a}") for a in "xyz" for f, n in ((F.min, "low"), (F.max, "high"))))


def candidate_pairs(boxes: DataFrame, padding: float = 0.0) -> DataFrame:
    """(fixed, moving), fixed < moving, of boxes that overlap horizontally once padded, edges included.

    A range join on tiles: each box lies in the tiles that it spans, and a pair is made only in the first tile that both
    have, so neither a cross join nor duplicates arise. A tile is as wide as nine boxes of ten, and at least a
    ``TILES``th of all there is, so a few large boxes make more rows but no larger tiles.
    """
    wide = [F.percentile_approx(F.col(f"high_{x}") - F.col(f"low_{x}"), 0.9).alias(f"wide_{x}") for x in "xy"]
    whole = [(F.max(f"high_{x}") - F.min(f"low_{x}")).alias(f"whole_{x}") for x in "xy"]
    facts = boxes.agg(*wide, *whole)
    sizes = facts.select(*(F.greatest(F.col(f"wide_{x}") + padding, F.col(f"whole_{x}") / TILES, F.lit(1e-6)).alias(f"tile_{x}") for x in "xy"))
    placed = boxes.crossJoin(F.broadcast(sizes))  # one row
    first = {x: F.floor(F.col(f"low_{x}") / F.col(f"tile_{x}")) for x in "xy"}
    last = {x: F.floor((F.col(f"high_{x}") + padding) / F.col(f"tile_{x}")) for x in "xy"}
    tiles = placed.select("source_id", *(f"{n}_{x}" for x in "xy" for n in ("low", "high")), *(first[x].alias(f"first_{x}") for x in "xy"), *(F.sequence(first[x], last[x]).alias(f"span_{x}") for x in "xy"))
    tiles = tiles.withColumn("at_x", F.explode("span_x")).withColumn("at_y", F.explode("span_y")).drop("span_x", "span_y")
    a, b = tiles.alias("a"), tiles.alias("b")
    meet = F.col("a.source_id") < F.col("b.source_id")
    for x in "xy":
        meet &= (F.col(f"a.at_{x}") == F.col(f"b.at_{x}")) & (F.col(f"a.at_{x}") == F.greatest(f"a.first_{x}", f"b.first_{x}"))
        meet &= (F.col(f"a.low_{x}") - padding <= F.col(f"b.high_{x}")) & (F.col(f"b.low_{x}") - padding <= F.col(f"a.high_{x}"))
    return a.join(b, meet).select(F.col("a.source_id").alias("fixed"), F.col("b.source_id").alias("moving"))
