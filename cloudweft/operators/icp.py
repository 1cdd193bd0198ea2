"""Trimmed coarse-to-fine alignment of two clouds: yaw and translation.

``align`` works on arrays of one pair, inside a grouped pandas function for many pairs at once; ``align_frames`` does the same with
DataFrame joins for a pair too large for one worker. Both take the same steps and meet the same result.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import sqrt

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudweft.functions.geometry import moved
from cloudweft.functions.rigid import Rigid, fit_yaw
from cloudweft.operators.nearest import nearest, rmse, trimmed, yaw_fit
from cloudweft.scratch import discard, tables, written

#: The last gate in metres, the share of matches that are fitted, and the fewest matches.
FINE_GATE = 0.5
TRIM = 0.8
LEAST_MATCHES = 12
ITERATIONS = 40


@dataclass(frozen=True)
class Alignment:
    motion: Rigid
    n: int
    rmse: float
    overlap: float


def gates(widest: float, iterations: int = ITERATIONS) -> list[float]:
    """Geometric steps from the widest gate to the fine one."""
    return [float(g) for g in np.geomspace(widest, min(FINE_GATE, widest), max(2, iterations))]


class Grid:
    """Points hashed into cells as wide as the gate; a query looks at 27 cells, all points at once."""

    def __init__(self, points: np.ndarray, width: float) -> None:
        self.points, self.width = points, width
        cells = np.floor(points / width).astype(np.int64)
        self.low = cells.min(axis=0) - 1
        self.span = cells.max(axis=0) - self.low + 2
        codes = self._code(cells)
        self.order = np.argsort(codes, kind="stable")
        self.codes = codes[self.order]

    def _code(self, cells: np.ndarray) -> np.ndarray:
        at = cells - self.low
        return (at[:, 0] * self.span[1] + at[:, 1]) * self.span[2] + at[:, 2]

    def query(self, points: np.ndarray, gate: float) -> tuple[np.ndarray, np.ndarray]:
        """Distance to and index of the nearest point closer than ``gate``; infinite and -1 without one."""
        best, found = np.full(len(points), np.inf), np.full(len(points), -1)
        home = np.floor(points / self.width).astype(np.int64)
        for step in np.ndindex(3, 3, 3):
            cells = home + np.array(step) - 1
            inside = np.flatnonzero(((cells >= self.low) & (cells < self.low + self.span)).all(axis=1))
            codes = self._code(cells[inside])
            start, end = np.searchsorted(self.codes, codes, "left"), np.searchsorted(self.codes, codes, "right")
            counts = end - start
            if not counts.sum():
                continue
            who = np.repeat(inside, counts)
            offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            target = self.order[np.repeat(start, counts) + offset]
            apart = np.sqrt(((points[who] - self.points[target]) ** 2).sum(axis=1))
            close = np.flatnonzero(apart < gate)
            who, target, apart = who[close], target[close], apart[close]
            first = np.lexsort((target, apart, who))
            who, target, apart = who[first], target[first], apart[first]
            lead = np.concatenate([[True], who[1:] != who[:-1]]) if len(who) else np.empty(0, dtype=bool)
            who, target, apart = who[lead], target[lead], apart[lead]
            better = (apart < best[who]) | ((apart == best[who]) & (target < found[who]))
            best[who[better]], found[who[better]] = apart[better], target[better]
        return best, found


def align(fixed: np.ndarray, moving: np.ndarray, widest: float, iterations: int = ITERATIONS, start: Rigid | None = None) -> Alignment | None:
    """The motion from moving to fixed, or None where too few points correspond. Coordinates are counted from a centre of
    the fixed cloud while it is sought."""
    if not len(fixed) or not len(moving):
        return None
    centre = fixed.mean(axis=0)
    here, there = fixed - centre, moving - centre
    motion = (start or Rigid()).rebased(tuple(centre), to_centred=True)
    grids: dict[float, Grid] = {}
    for gate in gates(widest, iterations):
        # A new grid only once the gate has halved: a cell may be wider than the gate.
        width = min((w for w in grids if gate <= w < 2 * gate), default=gate)
        if width not in grids:
            grids[width] = Grid(here, width)
        grid = grids[width]
        placed = motion.apply(there)
        distance, index = grid.query(placed, gate)
        matched = np.isfinite(distance)
        if matched.sum() < LEAST_MATCHES:
            return None
        kept = matched & (distance <= np.quantile(distance[matched], TRIM))
        motion = fit_yaw(placed[kept], here[index[kept]]) @ motion
    fine = min(FINE_GATE, widest)
    distance, _ = Grid(here, fine).query(motion.apply(there), fine)
    matched = np.isfinite(distance)
    n = int(matched.sum())
    if n < LEAST_MATCHES:
        return None
    return Alignment(motion.rebased(tuple(centre), to_centred=False), n, sqrt(float(np.mean(distance[matched] ** 2))), n / len(moving))


def align_frames(fixed: DataFrame, moving: DataFrame, widest: float, iterations: int = ITERATIONS, start: Rigid | None = None) -> Alignment | None:
    """As ``align``, over (id, x, y, z) tables. A round writes its matches, fits them and lets them go; the motion is four
    numbers, so lineage does not grow."""
    total = moving.count()
    centre_row = fixed.agg(*(F.avg(a).alias(a) for a in "xyz")).first()
    if not total or centre_row.x is None:
        return None
    centre = (centre_row.x, centre_row.y, centre_row.z)
    shifted = lambda df: df.select("id", *((F.col(a) - c).alias(a) for a, c in zip("xyz", centre, strict=True)))
    here, there = shifted(fixed), shifted(moving)
    motion = (start or Rigid()).rebased(centre, to_centred=True)

    def placed(m: Rigid) -> DataFrame:
        x, y, z = moved(F.col("x"), F.col("y"), F.col("z"), F.lit(m.yaw), F.lit(m.tx), F.lit(m.ty), F.lit(m.tz))
        return there.select("id", x.alias("x"), y.alias("y"), z.alias("z"))

    spark = fixed.sparkSession
    for gate in gates(widest, iterations):
        mark = tables()
        matches = written(nearest(placed(motion), here, gate), "matches")
        fit = yaw_fit(trimmed(matches)).first() if matches.count() >= LEAST_MATCHES else None
        discard(spark, mark)
        if fit is None:
            return None
        motion = Rigid(fit.yaw, fit.tx, fit.ty, fit.tz) @ motion
    end = nearest(placed(motion), here, min(FINE_GATE, widest)).agg(F.count("*").alias("n"), rmse().alias("rmse")).first()
    if end.n < LEAST_MATCHES:
        return None
    return Alignment(motion.rebased(centre, to_centred=False), end.n, end.rmse, end.n / total)
