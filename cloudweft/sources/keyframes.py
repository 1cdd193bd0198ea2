"""Keyframes of a scan package, their depth and confidence rasters, and tables of image features.

Feature detection needs an image library; where there is none, features come in as a table (see ``schema.FEATURES``).
"""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession

MAXIMUM_KEYFRAMES = 120


def sidecar(package: Path, name: str) -> Path | None:
    """A file below the package's keyframes folder, or None for a name that leads elsewhere."""
    base = (package / "keyframes").resolve()
    file = (base / name).resolve()
    return file if file != base and file.is_relative_to(base) else None


def frames(package: Path, limit: int = MAXIMUM_KEYFRAMES) -> list[dict[str, Any]] | None:
    """Keyframes with depth, at most ``limit`` of them, evenly spaced; None where a package has none."""
    file = package / "keyframes.json"
    if not file.is_file():
        return None
    found = [f for f in json.loads(file.read_text(encoding="utf-8")) if f.get("sceneDepthPayload")]
    if len(found) > limit:
        found = [found[k * (len(found) - 1) // (limit - 1)] for k in range(limit)]
    return found or None


def raster(package: Path, name: str, dtype: str, count: int) -> np.ndarray | None:
    """The first ``count`` samples of a raster, mapped; None if it is missing, too short or outside the package."""
    file = sidecar(package, name)
    if file is None or not file.is_file() or file.stat().st_size < count * np.dtype(dtype).itemsize:
        return None
    return np.memmap(file, dtype=dtype, mode="r", shape=(count,))


def frame_table(spark: SparkSession, packages: list[Path]) -> DataFrame:
    """(source_id, frame_idx, width, height, image_width, image_height, depth, confidence, intrinsics, pose)."""
    rows = []
    for source_id, package in enumerate(packages):
        for k, f in enumerate(frames(package) or []):
            p = f["sceneDepthPayload"]
            rows.append((source_id, k, int(p["width"]), int(p["height"]), int(f["imageWidth"]), int(f["imageHeight"]), p["depthMapFilename"], p.get("confidenceMapFilename"), [float(x) for x in f["cameraIntrinsics"]], [float(x) for x in f["cameraTransform"]]))
    return spark.createDataFrame(rows, "source_id int, frame_idx int, width int, height int, image_width int, image_height int, depth string, confidence string, intrinsics array<double>, pose array<double>")


def grid_table(spark: SparkSession, packages: list[Path]) -> DataFrame:
    """(source_id, frame_idx, depth, confidence): rasters as arrays, read on the executors; one row for each keyframe."""
    table = frame_table(spark, packages)
    paths = {k: str(p) for k, p in enumerate(packages)}

    def run(batches):
        for pdf in batches:
            out = pdf[["source_id", "frame_idx"]].copy()
            values = [(raster(Path(paths[s]), d, "<f4", w * h), raster(Path(paths[s]), c, "u1", w * h) if c else None, c) for s, d, c, w, h in zip(pdf.source_id, pdf.depth, pdf.confidence, pdf.width, pdf.height, strict=True)]
            out["depths"] = [None if d is None else np.asarray(d, dtype=float) for d, _, _ in values]
            out["trust"] = [None if t is None else np.asarray(t, dtype=np.int16) for _, t, _ in values]
            out["trusted"] = [not c for _, _, c in values]
            yield out

    usable = table.where("width > 0 and height > 0 and image_width > 0 and image_height > 0")
    return usable.mapInPandas(run, "source_id int, frame_idx int, depths array<double>, trust array<smallint>, trusted boolean")
