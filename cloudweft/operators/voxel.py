"""Voxel grids: the first or best point of each cell, by partial aggregation on the cell's key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudweft.functions.geometry import cell, finite

Size = float | tuple[float, float, float]
_CELLS = ("__kx", "__ky", "__kz")
ORD_BITS = 39


def _sizes(size: Size) -> tuple[float, float, float]:
    return tuple(size) if isinstance(size, tuple) else (size, size, size)


def keyed(points: DataFrame, size: Size, axes: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Points with finite coordinates and their cells' indexes."""
    sizes = _sizes(size)
    return points.where(finite(*(F.col(a) for a in axes))).withColumns({k: cell(F.col(a), s) for k, a, s in zip(_CELLS, axes, sizes, strict=True)})


def chosen(points: DataFrame, size: Size, order: Sequence[Column], by: Sequence[str] = (), axes: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Of each cell (and each value of ``by``) the row whose ``order`` is least, with all columns.

    One order column and plain value columns keep the aggregation in hash maps; several columns are compared as a struct.
    """
    key = order[0] if len(order) == 1 else F.struct(*order)
    rest = [c for c in points.columns if c not in by]
    return keyed(points, size, axes).groupBy(*by, *_CELLS).agg(*(F.min_by(c, key).alias(c) for c in rest)).select(*points.columns)


def downsample(points: DataFrame, size: Size, order: Sequence[str] = ("ord",), by: Sequence[str] = ("source_id",), axes: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """The first point of each cell in input order, for each scan."""
    return chosen(points, size, [F.col(c) for c in order], by, axes)


def rank(confidence: Column, mode: str = "highest") -> Column:
    """Lower ranks win. ``highest``: more confidence; ``uint8_compat``: as negation wraps in unsigned bytes, 0 first."""
    if mode == "highest":
        return 255 - confidence.cast("int")
    if mode == "uint8_compat":
        return (256 - confidence.cast("int")) % 256
    raise ValueError(f"unknown confidence rank: {mode}")


def deduplicate(points: DataFrame, size: float, mode: str = "highest", axes: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """One point for each output cell over all scans, by confidence, then source_id, then ord; a size of 0 or less keeps all.

    The three are packed into one long integer: 8 bits of rank, 16 of source_id, 39 of ord; an ord beyond these is an error.
    """
    if size <= 0:
        return points
    fits = F.col("ord") < F.lit(1 << ORD_BITS)
    points = points.withColumn("ord", F.when(fits, F.col("ord")).otherwise(F.raise_error(F.lit(f"ord has more than {ORD_BITS} bits")).cast("long")))
    packed = F.shiftleft(rank(F.col("confidence"), mode).cast("long"), ORD_BITS + 16) + F.shiftleft(F.col("source_id").cast("long"), ORD_BITS) + F.col("ord")
    return chosen(points, size, [packed], axes=axes)
