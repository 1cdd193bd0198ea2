"""Scan packages: discovery, manifest and chunk checks. Small per-package facts stay on the driver; points never do."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable
from dataclasses import dataclass
from pathlib import Path
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from cloudweft.errors import ScanPackageError
from cloudweft.schema import CHUNK_NAME, DEFAULT_VOXEL_METRES, MAXIMUM_POINTS, MAXIMUM_SCANS, RECORD, SCANS, SUFFIX
from cloudweft.sources.remote import Remote, is_uri


@dataclass(frozen=True)
class GeoReference:
    """Where a scan's local origin lies, and how far its axes are turned; accuracies are None where unknown."""

    epsg: int
    e0: float
    n0: float
    h0: float
    rot: float
    acc_h: float | None = None
    acc_v: float | None = None
    acc_heading: float | None = None

    def matrix(self) -> np.ndarray:
        """Local to projected coordinates, 4 x 4: local x and -z are horizontal, y is up."""
        c, s = math.cos(self.rot), math.sin(self.rot)
        return np.array([[c, 0, s, self.e0], [s, 0, -c, self.n0], [0, 1, 0, self.h0], [0, 0, 0, 1]], dtype=float)

    def row(self) -> tuple:
        return (self.epsg, self.e0, self.n0, self.h0, self.rot, self.acc_h, self.acc_v, self.acc_heading)


#: Names on the wire, and for each accuracy the place that is looked at first.
_ACCURACIES = {
    "acc_h": (("alignmentMetadata", "horizontalAccuracyMeters"), ("originHorizontalAccuracy",)),
    "acc_v": (("alignmentMetadata", "verticalAccuracyMeters"), ("originVerticalAccuracy",)),
    "acc_heading": (("alignmentMetadata", "headingAccuracyDegrees"), ("headingAccuracy",)),
}


def _accuracy(value: dict[str, Any], places: tuple[tuple[str, ...], ...]) -> float | None:
    """The first place with a positive number, or else a zero at the last one. Negative numbers mean unknown."""
    found: float | None = None
    for place in places:
        at: Any = value
        for key in place:
            at = at[key] if isinstance(at, dict) and key in at else None
            if at is None:
                break
        found = None if at is None or float(at) < 0 else float(at)
        if found:
            return found
    return found


def georeference(value: dict[str, Any]) -> GeoReference:
    numbers = {"e0": "originEasting", "n0": "originNorthing", "h0": "originAltitude", "rot": "worldToENURotationRadians"}
    return GeoReference(epsg=int(value["epsgCode"]), **{k: float(value[name]) for k, name in numbers.items()}, **{k: _accuracy(value, places) for k, places in _ACCURACIES.items()})


@dataclass(frozen=True)
class ScanPackage:
    path: Path | Remote
    key: str
    point_count: int
    chunk_count: int
    voxel_size: float
    geo: GeoReference | None
    manifest: dict[str, Any]

    def chunks(self) -> list[Path | Remote]:
        return [self.path / CHUNK_NAME.format(k + 1) for k in range(self.chunk_count)]

    def chunk_sizes(self) -> list[int | None]:
        """Bytes of each chunk, None where it is missing. The folder is listed once."""
        found = self.path.sizes() if isinstance(self.path, Remote) else {p.name: p.stat().st_size for p in self.path.iterdir() if p.is_file()}
        return [found.get(chunk.name) for chunk in self.chunks()]


def located(path: str | Path | Remote) -> Path | Remote:
    """A path of this machine, or a URI, which Spark's file systems read."""
    return Remote(str(path)) if isinstance(path, Remote) or is_uri(path) else Path(path)


def _whole(manifest: dict[str, Any], name: str) -> int:
    value = manifest[name]
    if isinstance(value, bool) or not isinstance(value, int | float | str) or int(float(value)) != float(value):
        raise ValueError(f"{name} is not a whole number")
    return int(float(value))


def open_package(path: str | Path | Remote, *, maximum_points: int = MAXIMUM_POINTS) -> ScanPackage:
    """Reads and checks a manifest and the sizes of its chunks; reads no points."""
    package = located(path)
    file = package / "manifest.json"
    if not file.is_file():
        raise ScanPackageError(f"no scan package: {package}")
    try:
        manifest = json.loads(file.read_text(encoding="utf-8"))
        points, chunks = _whole(manifest, "pointCount"), _whole(manifest, "chunkCount")
        voxel = float(manifest.get("voxelSizeMeters", DEFAULT_VOXEL_METRES))
    except (OSError, KeyError, TypeError, ValueError) as error:
        raise ScanPackageError(f"manifest of {package}: {error}") from error
    if min(points, chunks) < 0:
        raise ScanPackageError(f"manifest of {package}: negative count")
    if points > maximum_points:
        raise ScanPackageError(f"manifest of {package}: {points} points, at most {maximum_points} are allowed")
    try:
        geo = georeference(manifest["geoReference"]) if manifest.get("geoReference") else None
    except (KeyError, TypeError, ValueError) as error:
        raise ScanPackageError(f"georeference of {package}: {error}") from error
    found = ScanPackage(package, str(manifest.get("id", package.stem)), points, chunks, voxel, geo, manifest)
    _check_chunks(found)
    return found


def _check_chunks(package: ScanPackage) -> None:
    total = 0
    for chunk, size in zip(package.chunks(), package.chunk_sizes(), strict=True):
        if size is None:
            raise ScanPackageError(f"chunk is missing: {chunk}")
        whole, rest = divmod(size, RECORD.itemsize)
        if rest:
            raise ScanPackageError(f"chunk does not hold whole records of {RECORD.itemsize} bytes: {chunk}")
        total += whole
    if total != package.point_count:
        raise ScanPackageError(f"{package.path}: {package.point_count} points announced, {total} found")


def discover(inputs: Iterable[str | Path | Remote]) -> list[Path | Remote]:
    """Packages named or lying directly in a named folder, each once, in the order of their resolved paths."""
    found: set[Path | Remote] = set()
    for item in map(located, inputs):
        if item.name.endswith(SUFFIX):
            found.add(item.resolve())
        elif item.is_dir():
            names = item.sizes() if isinstance(item, Remote) else [p.name for p in item.iterdir()]
            found.update((item / name).resolve() for name in names if name.endswith(SUFFIX))
        else:
            raise ScanPackageError(f"neither a folder nor a scan package: {item}")
    if not found:
        raise ScanPackageError("no scan packages")
    if len(found) > MAXIMUM_SCANS:
        raise ScanPackageError(f"more than {MAXIMUM_SCANS} scan packages")
    return sorted(found, key=str)


def scans(spark: SparkSession, packages: list[ScanPackage]) -> DataFrame:
    """One row for each package; source_id is its place in the list."""
    rows = [(k, p.key, str(p.path), p.point_count, p.chunk_count, p.voxel_size, p.geo.row() if p.geo else None, json.dumps(p.manifest)) for k, p in enumerate(packages)]
    return spark.createDataFrame(rows, SCANS)
