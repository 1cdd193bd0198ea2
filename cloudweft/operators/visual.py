"""Seeds for alignment from matched image features with metric depth."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudweft.functions.geometry import depth_offset, unprojected, usable_depth
from cloudweft.functions.rigid import Rigid, fit_yaw

#: The ratio test, the fewest matches and inliers, metres of an inlier, hypotheses and the seed of their draws.
RATIO = 0.75
LEAST_INLIERS = 20
INLIER_METRES = 0.20
HYPOTHESES = 2500
SEED = 0
#: Rows of a block of descriptors, and those whose distances to a block are held at once.
BLOCK = 2048
PART = 256
#: Rows of a block that is dealt out to be held against others, and targets of which only the least distance is looked at first.
DEALT = 8192
GROUP = 32


@dataclass(frozen=True)
class VisualSeed:
    motion: Rigid
    matches: int
    inliers: int
    rmse: float


def ratio_matches(moving: np.ndarray, fixed: np.ndarray, ratio: float = RATIO) -> list[tuple[int, int]]:
    """(moving, nearest fixed) where the nearest is closer than ``ratio`` times the second; exact, in blocks."""
    if len(fixed) < 2:
        return []
    found = []
    norms = (fixed.astype(float) ** 2).sum(axis=1)
    for start in range(0, len(moving), BLOCK):
        part = moving[start : start + BLOCK].astype(float)
        squared = np.maximum((part**2).sum(axis=1)[:, None] + norms[None] - 2 * part @ fixed.T.astype(float), 0)
        two = np.argpartition(squared, 1, axis=1)[:, :2]
        first, second = np.sort(np.sqrt(np.take_along_axis(squared, two, axis=1)), axis=1).T
        best = squared.argmin(axis=1)
        found += [(start + int(k), int(best[k])) for k in np.flatnonzero(first < ratio * second)]
    return found


def ransac(source: np.ndarray, target: np.ndarray, threshold: float = INLIER_METRES, hypotheses: int = HYPOTHESES) -> np.ndarray:
    """The inliers of the first hypothesis, three drawn pairs each, that has most of them."""
    draws = np.random.default_rng(SEED)
    best = np.zeros(len(source), dtype=bool)
    for _ in range(hypotheses):
        three = draws.choice(len(source), 3, replace=False)
        inlier = np.linalg.norm(fit_yaw(source[three], target[three]).apply(source) - target, axis=1) <= threshold
        if inlier.sum() > best.sum():
            best = inlier
    return best


def seeded(pairs: np.ndarray, targets: np.ndarray, matches: int, least: int = LEAST_INLIERS, threshold: float = INLIER_METRES) -> VisualSeed | None:
    """The seed from projected moving and fixed points, or None with too few pairs or inliers."""
    if len(pairs) < least:
        return None
    inlier = ransac(pairs, targets, threshold)
    if inlier.sum() < least:
        return None
    motion = fit_yaw(pairs[inlier], targets[inlier])
    errors = np.linalg.norm(motion.apply(pairs[inlier]) - targets[inlier], axis=1)
    return VisualSeed(motion, matches, int(inlier.sum()), float(np.sqrt((errors**2).mean())))


def seed_table(sides: DataFrame, least: int = LEAST_INLIERS, threshold: float = INLIER_METRES) -> DataFrame:
    """(fixed, moving, yaw, tx, ty, tz, matches, inliers, rmse) of the pairs that have a seed. ``sides`` holds the features of
    both scans of each pair: fixed, moving, is_fixed, feat_id, descriptor, and x, y, z, projected, null without a depth.

    A pair is a group, so all pairs are matched at once; keyframes bound the features of a scan.
    """

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("feat_id")
        here, there = pdf[pdf["is_fixed"]], pdf[~pdf["is_fixed"]]
        rows = []
        if len(here) and len(there):
            found = np.array(ratio_matches(np.stack(there["descriptor"]), np.stack(here["descriptor"])), dtype=int).reshape(-1, 2)
            source, target = (side[["x", "y", "z"]].to_numpy(dtype=float)[found[:, k]] for k, side in enumerate((there, here)))
            known = np.isfinite(source).all(axis=1) & np.isfinite(target).all(axis=1)
            if (seed := seeded(source[known], target[known], len(found), least, threshold)) is not None:
                m = seed.motion
                rows = [(int(pdf["fixed"].iloc[0]), int(pdf["moving"].iloc[0]), m.yaw, m.tx, m.ty, m.tz, seed.matches, seed.inliers, seed.rmse)]
        return pd.DataFrame(rows, columns=["fixed", "moving", "yaw", "tx", "ty", "tz", "matches", "inliers", "rmse"])

    schema = "fixed int, moving int, yaw double, tx double, ty double, tz double, matches int, inliers int, rmse double"
    columns = ("fixed", "moving", "is_fixed", "feat_id", "descriptor", "x", "y", "z")
    return sides.select(*columns).groupBy("fixed", "moving").applyInPandas(one, schema)


def vectors(descriptors: pd.Series, lengths: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """The descriptors as rows of a matrix, zero where they are null, and which are not. ``lengths`` are those of all that
    they are to be compared with, which must be equal."""
    if len(set(lengths)) > 1:
        raise ValueError("descriptors differ in length")
    known = descriptors.notna().to_numpy(dtype=bool)
    found = np.zeros((len(descriptors), lengths[0] if lengths else 0))
    if known.any():
        found[known] = np.stack(descriptors[known].to_list())
    return found, known


def two_nearest(here: np.ndarray, here_known: np.ndarray, there: np.ndarray, there_known: np.ndarray, same: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(row of here, row of there, distance, whether it is known): for each row of ``here`` its two nearest but ``same`` ones.

    Products of matrices round, so they only choose: whatever may be among the two within the error of a product, copies
    of one vector for example, has its distance summed term by term. Of equal distances the first row counts.

    ``low`` is the square of a distance less here's own norm and less the part of the error that grows with there's. The
    least of two groups of targets bound the second nearest, so one pass finds the bound and one who is within it."""
    n, width = there.shape
    groups = max(2, -(-n // GROUP))
    with np.errstate(invalid="ignore", over="ignore"):
        c = 16 * (width + 8) * np.finfo(float).eps
        own, norms = (here**2).sum(axis=1), (there**2).sum(axis=1)
        plain = np.isfinite(norms) & there_known
        sides = np.zeros((groups * GROUP, width + 1))  # what is not plain, and what fills the last group up, is far from all
        sides[:, width] = np.inf
        sides[:n][plain] = np.column_stack([there[plain], (1 - c) * norms[plain]])
        spread = np.append(np.where(plain, 2 * c * norms, np.inf), np.full(len(sides) - n, np.inf))
        low = np.column_stack([-2 * here, np.ones(len(here))]) @ sides.T
        if same is not None:
            low[:, :n][same] = np.inf
        rows = np.arange(len(here))[:, None]
        grouped = low.reshape(len(here), GROUP, groups)
        two = np.argpartition(grouped.min(axis=1), 1, axis=1)[:, :2]
        first = grouped[rows, :, two].argmin(axis=2) * groups + two
        most = (low[rows, first] + spread[first]).max(axis=1) + 2 * c * own
        most[~(np.isfinite(own) & here_known)] = np.inf
        may = ~(low > most[:, None])[:, :n]  # NaN may, too
        may[:, ~np.isfinite(norms) & there_known] = True
        if same is not None:
            may &= ~same
        who, target = np.nonzero(may)
        apart = np.zeros(len(who))
        for k in range(width):
            apart += (here[who, k] - there[target, k]) ** 2
    known = here_known[who] & there_known[target]
    apart = np.where(known, np.sqrt(apart), 0.0)
    order = np.lexsort((target, apart, ~known, who))
    who, target, apart, known = who[order], target[order], apart[order], known[order]
    taken = np.arange(len(who)) - np.searchsorted(who, who) < 2
    return who[taken], target[taken], apart[taken], known[taken]


def knn2(queries: DataFrame, targets: DataFrame, ratio: float | None = RATIO, blocks: int | None = None, skip_same: bool = False) -> DataFrame:
    """(qid, tid, d1, d2) of the nearest and second nearest target of each (qid, descriptor) among (tid, descriptor).

    Both sides are dealt into blocks of about ``DEALT`` rows; each pair of blocks meets in one worker as one product of
    matrices, which keeps the two nearest of its block for each query, so neither side is ever whole in one place. Exact,
    so it costs the product of both sides; ties go to the lowest tid. With a ratio, only matches that pass its test are
    kept; ``skip_same`` leaves out a target with the query's own id.

    Defined results: rows without an id take no part; a distance to or from a null descriptor is null and comes after all
    others, NaN too; d2 is null with a single target, and a query without any has no row.
    """
    queries, targets = queries.where("qid is not null"), targets.where("tid is not null")
    n_q, n_t = (blocks, blocks) if blocks else (max(1, -(-side.count() // DEALT)) for side in (queries, targets))
    # Keys of one type on both sides: those of different types are hashed to different partitions and never meet.
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Names of their own, too: of one column on both sides, as when a table is held against itself, Spark may lose one.
    left = queries.select("qid", F.col("descriptor").alias("here"), block("qid", n_q).alias("qb"), every(n_t).alias("tb"))
    right = targets.select("tid", F.col("descriptor").alias("there"), block("tid", n_t).alias("tb"), every(n_q).alias("qb"))

    def two(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(t):
            return pd.DataFrame({"qid": [], "tid": [], "d": [], "known": []})
        t = t.sort_values("tid")
        ids, parts = t["tid"].to_numpy(), []
        lengths = [len(x) for side in (q["here"], t["there"]) for x in side if x is not None]
        there, known = vectors(t["there"], lengths)
        for start in range(0, len(q), PART):
            part = q.iloc[start : start + PART]
            here, own = vectors(part["here"], lengths), part["qid"].to_numpy()
            same = own[:, None] == ids[None] if skip_same and np.isin(own, ids).any() else None
            who, target, apart, sure = two_nearest(*here, there, known, same)
            parts.append(pd.DataFrame({"qid": own[who], "tid": ids[target], "d": apart, "known": sure}))
        return pd.concat(parts)

    kinds = f"qid {queries.schema['qid'].dataType.simpleString()}, tid {targets.schema['tid'].dataType.simpleString()}, d double, known boolean"
    near = left.groupBy("qb", "tb").cogroup(right.groupBy("qb", "tb")).applyInPandas(two, kinds)
    near = near.withColumn("d", F.when(F.col("known"), F.coalesce("d", F.lit(float("nan")))))  # pandas has one mark for NaN and null
    best = near.groupBy("qid").agg(F.slice(F.array_sort(F.collect_list(F.struct(~F.col("known"), "d", "tid"))), 1, 2).alias("two"))  # two for each block
    found = best.select("qid", F.col("two")[0]["tid"].alias("tid"), F.col("two")[0]["d"].alias("d1"), F.get("two", F.lit(1))["d"].alias("d2"))
    return found if ratio is None else found.where(F.col("d1") < ratio * F.col("d2"))


def lifted(features: DataFrame, frames: DataFrame, grids: DataFrame) -> DataFrame:
    """(source_id, feat_id, x, y, z) of features with a usable depth: equi-joins with keyframes and their rasters."""
    usable = frames.where("width > 0 and height > 0 and image_width > 0 and image_height > 0")
    at = features.join(usable, ["source_id", "frame_idx"]).join(grids, ["source_id", "frame_idx"]).where("depths is not null")
    at = at.withColumn("offset", depth_offset(F.col("u").cast("double"), F.col("v").cast("double"), F.col("width"), F.col("height"), F.col("image_width"), F.col("image_height")))
    at = at.withColumn("depth_m", F.get("depths", F.col("offset").cast("int"))).where(usable_depth(F.col("depth_m")))
    at = at.where(F.col("trusted") | (F.get("trust", F.col("offset").cast("int")) >= 1))
    x, y, z = unprojected(F.col("u").cast("double"), F.col("v").cast("double"), F.col("depth_m"), F.col("intrinsics"), F.col("pose"))
    return at.select("source_id", "feat_id", x.alias("x"), y.alias("y"), z.alias("z"))


def inlier_counts(matches: DataFrame, hypotheses: DataFrame, threshold: float = INLIER_METRES, by: Sequence[str] = ()) -> DataFrame:
    """(``by``, hypothesis, inliers): how many matches (x, y, z, fx, fy, fz) each motion (hypothesis, yaw, tx, ty, tz) explains.

    Hypotheses are a fixed number of rows and are broadcast; matches stay where they are.
    """
    m = F.broadcast(hypotheses)
    c, s = F.cos("yaw"), F.sin("yaw")
    dx, dy, dz = c * F.col("x") - s * F.col("y") + F.col("tx") - F.col("fx"), s * F.col("x") + c * F.col("y") + F.col("ty") - F.col("fy"), F.col("z") + F.col("tz") - F.col("fz")
    return matches.crossJoin(m).groupBy(*by, "hypothesis").agg(F.sum((F.sqrt(dx * dx + dy * dy + dz * dz) <= threshold).cast("long")).alias("inliers"))


def best_hypothesis(counts: DataFrame) -> DataFrame:
    """The hypothesis with most inliers; the earliest of equals."""
    return counts.agg(F.max_by("hypothesis", F.struct("inliers", -F.col("hypothesis"))).alias("hypothesis"), F.max("inliers").alias("inliers"))
