"""Nearest neighbours within a gate, and what is fitted to them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cloudweft.functions.geometry import cell
from cloudweft.scratch import is_written, written

_CELL = ("__cx", "__cy", "__cz")
#: Ranges into which distances are counted before the quantile is looked for in one or two of them.
BINS = 4096


def nearest(moving: DataFrame, fixed: DataFrame, gate: float, by: Sequence[str] = ()) -> DataFrame:
    """For each moving (id, x, y, z) its nearest fixed point closer than ``gate``: id, fid, distance and both points.

    Cells are twice as wide as the gate, so a neighbour lies in one of 8 cells: the moving point is looked for in those
    that its gate reaches and the fixed point in its own, which makes the join an equi-join; only keys and coordinates
    travel, and a dense cell is a hot key that adaptive execution can split, as no more than a join hangs on it. Ties go
    to the lowest fid. ``by`` names columns that both sides must share.
    """
    width = 2.0 * gate
    probe = moving.select(*by, "id", "x", "y", "z")
    for name, a in zip(_CELL, "xyz", strict=True):
        probe = probe.withColumn(name, F.explode(F.sequence(cell(F.col(a) - gate, width), cell(F.col(a) + gate, width))))
    target = fixed.select(*by, F.col("id").alias("fid"), *(F.col(a).alias(f"f{a}") for a in "xyz"), *(cell(F.col(a), width).alias(c) for a, c in zip("xyz", _CELL, strict=True)))
    apart = F.sqrt(sum(((F.col(a) - F.col(f"f{a}")) ** 2 for a in "yz"), (F.col("x") - F.col("fx")) ** 2))
    met = probe.join(target, [*by, *_CELL]).withColumn("distance", apart).where(F.col("distance") < gate)
    found = met.groupBy(*by, "id", "x", "y", "z").agg(F.min(F.struct("distance", "fid", "fx", "fy", "fz")).alias("best"))
    return found.select(*by, "id", "best.fid", "best.distance", "x", "y", "z", "best.fx", "best.fy", "best.fz")


def quantile(table: DataFrame, column: str, share: float, by: Sequence[str] = ()) -> DataFrame:
    """``by`` and cut: the exact quantile of a column that is not below 0, interpolated between the two values around it.

    Values are counted in ``BINS`` ranges of equal width, and then one by one only in those that hold the two values
    wanted. All counts are sums, so no task holds the values of a group; the table is read three times and should be a
    written one.
    """
    value, keys = F.col(column), list(by)
    sizes = table.where(value.isNotNull()).groupBy(*by).agg(F.max(value).alias("top"), F.count("*").alias("size"))
    at = F.lit(share) * (F.col("size") - 1)
    sizes = sizes.where("size > 0").select(*by, "top", F.floor(at).alias("low_at"), F.ceil(at).alias("high_at"), (at - F.floor(at)).alias("part"))
    joined = lambda some, small: some.join(F.broadcast(small), keys) if keys else some.crossJoin(F.broadcast(small))  # noqa: E731  a row for each group
    bin_of = F.when(F.col("top") > 0, F.least(F.floor(value / F.col("top") * BINS), F.lit(BINS - 1))).otherwise(0)
    binned = joined(table.where(value.isNotNull()), sizes).withColumn("bin", bin_of)
    upto = lambda *order: Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    bins = binned.groupBy(*by, "bin", "low_at", "high_at", "part").agg(F.count("*").alias("n"))
    bins = bins.withColumn("end", F.sum("n").over(upto("bin"))).withColumn("start", F.col("end") - F.col("n"))
    wanted = reduce(Column.__or__, ((F.col(p) >= F.col("start")) & (F.col(p) < F.col("end")) for p in ("low_at", "high_at")))
    few = bins.where(wanted).select(*by, "bin", "start")
    near = binned.join(F.broadcast(few), [*by, "bin"])  # two rows for each group at most
    each = near.groupBy(*by, "bin", "start", "low_at", "high_at", "part", value.alias("value")).agg(F.count("*").alias("n"))
    within = Window.partitionBy(*by, "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.col("start") + F.sum("n").over(within)).withColumn("begin", F.col("end") - F.col("n"))
    pick = lambda p: F.max(F.when((F.col(p) >= F.col("begin")) & (F.col(p) < F.col("end")), F.col("value")))
    low, high = pick("low_at"), pick("high_at")
    return each.groupBy(*by).agg((low + (high - low) * F.max("part")).alias("cut"))


def trimmed(matches: DataFrame, share: float = 0.8, by: Sequence[str] = ()) -> DataFrame:
    """Matches up to the exact, interpolated quantile of distances. They are written once, as they are read four times,
    unless they are a written table already."""
    matches = matches if is_written(matches) else written(matches, "matches")
    cut = quantile(matches, "distance", share, by)
    joined = matches.join(F.broadcast(cut), list(by)) if by else matches.crossJoin(F.broadcast(cut))  # one row, or one for each pair
    return joined.where(F.col("distance") <= F.col("cut")).drop("cut")


def rmse(distance: Column | str = "distance") -> Column:
    d = F.col(distance) if isinstance(distance, str) else distance
    return F.sqrt(F.avg(d * d))


def yaw_fit(matches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares yaw and translation from (x, y, z) to (fx, fy, fz). Covariances are centred, which keeps them exact at
    projected coordinates of millions of metres."""
    yaw = F.atan2(F.covar_pop("x", "fy") - F.covar_pop("y", "fx"), F.covar_pop("x", "fx") + F.covar_pop("y", "fy"))
    means = [F.avg(c).alias(f"m{c}") for c in ("x", "y", "z", "fx", "fy", "fz")]
    fit = matches.groupBy(*by).agg(yaw.alias("yaw"), *means, F.count("*").alias("n"), rmse().alias("rmse"))
    c, s = F.cos("yaw"), F.sin("yaw")
    return fit.select(*by, "yaw", (F.col("mfx") - (c * F.col("mx") - s * F.col("my"))).alias("tx"), (F.col("mfy") - (s * F.col("mx") + c * F.col("my"))).alias("ty"), (F.col("mfz") - F.col("mz")).alias("tz"), "n", "rmse")
