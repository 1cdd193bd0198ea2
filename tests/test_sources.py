import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloudweft.errors import ScanPackageError
from cloudweft.functions.geometry import to_projected
from cloudweft.sources.keyframes import frames, raster, sidecar
from cloudweft.sources.packages import discover, georeference, open_package, scans
from cloudweft.sources.points import read_points
from tests.packages import write_package


def test_points_keep_order_types_and_confidence(spark, tmp_path):
    xyz = np.arange(60).reshape(20, 3) / 7
    packages = [open_package(write_package(tmp_path, "a", xyz, chunks=3)), open_package(write_package(tmp_path, "b", xyz[:4], confidence=[0, 255, 200, 1]))]
    rows = read_points(spark, packages, split_records=4).orderBy("source_id", "ord").collect()
    assert [r.ord for r in rows] == [*range(20), *range(4)]
    assert [(r.x, r.y, r.z) for r in rows[:20]] == [tuple(map(float, p)) for p in xyz.astype(np.float32).astype(float)]
    assert [r.confidence for r in rows[20:]] == [0, 255, 200, 1]
    assert rows[0].g == 96 and rows[3].scan_time == 10.75
    some = read_points(spark, packages, minimum_confidence=2)
    assert sorted(some.where("source_id = 1").toPandas()["ord"]) == [1, 2]
    assert read_points(spark, packages).where(F.col("confidence") >= 2).count() == some.count()


def test_packages_by_uri(spark, tmp_path):
    xyz = np.arange(60).reshape(20, 3) / 7
    for name, chunks in (("a", 3), ("b", 1), ("hollow", 0)):
        write_package(tmp_path / "in", name, xyz if chunks else [], chunks=chunks)
    found = discover([f"file://{tmp_path}/in"])
    assert [p.stem for p in found] == ["a", "b", "hollow"] and discover([found[1], tmp_path / "in" / "b.scanproject"])[1:] == [found[1]]
    far = [open_package(p) for p in found]
    near = [open_package(p) for p in discover([tmp_path / "in"])]
    assert [(p.key, p.point_count, p.geo) for p in far] == [(p.key, p.point_count, p.geo) for p in near]
    want = sorted(map(tuple, read_points(spark, near, 1).collect()))
    assert sorted(map(tuple, read_points(spark, far, 1).collect())) == want
    assert sorted(map(tuple, read_points(spark, [far[0], near[1], far[2]], 1).collect())) == want
    assert read_points(spark, far[2:]).count() == 0
    (tmp_path / "in" / "b.scanproject" / "chunk-00001.bin").write_bytes(b"x")
    with pytest.raises(ScanPackageError, match="24"):
        open_package(found[1])
    for missing in (f"file://{tmp_path}/none", f"file://{tmp_path}/in/none.scanproject"):
        with pytest.raises(ScanPackageError):
            [open_package(p) for p in discover([missing])]


def test_package_without_chunks(spark, tmp_path):
    package = open_package(write_package(tmp_path, "empty", [], chunks=0))
    assert read_points(spark, [package]).count() == 0


@pytest.mark.parametrize(
    ("changes", "message"),
    [({"pointCount": 5}, "5 points announced"), ({"pointCount": -1}, "negative"), ({"pointCount": 10**9}, "at most"), ({"chunkCount": 2}, "missing"), ({"pointCount": 2.5}, "whole"), ({"geoReference": {"epsgCode": 1}}, "georeference"), ({"voxelSizeMeters": "wide"}, "manifest")],
)
def test_malformed_manifests(tmp_path, changes, message):
    with pytest.raises(ScanPackageError, match=message):
        open_package(write_package(tmp_path, "bad", np.zeros((3, 3)), **changes))


def test_truncated_chunk_and_absent_manifest(tmp_path):
    path = write_package(tmp_path, "bad", np.zeros((3, 3)))
    with (path / "chunk-00001.bin").open("ab") as f:
        f.write(b"x")
    with pytest.raises(ScanPackageError, match="24"):
        open_package(path)
    (path / "manifest.json").write_text("{")
    with pytest.raises(ScanPackageError):
        open_package(path)
    with pytest.raises(ScanPackageError):
        open_package(tmp_path / "none.scanproject")


def test_discovery(tmp_path):
    b, a = write_package(tmp_path, "b", []), write_package(tmp_path, "a", [])
    assert discover([tmp_path, b]) == [a.resolve(), b.resolve()]
    with pytest.raises(ScanPackageError):
        discover([tmp_path / "nothing"])
    (tmp_path / "hollow").mkdir()
    with pytest.raises(ScanPackageError):
        discover([tmp_path / "hollow"])


def test_accuracies():
    base = {"epsgCode": 32618, "originEasting": 1, "originNorthing": 2, "originAltitude": 3, "worldToENURotationRadians": 0}
    geo = georeference(base | {"originHorizontalAccuracy": 3, "originVerticalAccuracy": -1, "headingAccuracy": 0, "alignmentMetadata": {"horizontalAccuracyMeters": 0.0, "headingAccuracyDegrees": -4}})
    assert (geo.acc_h, geo.acc_v, geo.acc_heading) == (3.0, None, 0.0)
    assert georeference(base | {"originHorizontalAccuracy": 3, "alignmentMetadata": {"horizontalAccuracyMeters": 2}}).acc_h == 2.0


def test_projection(spark, tmp_path):
    package = open_package(write_package(tmp_path, "a", [[5, 1.5, -2]]))
    table = scans(spark, [package])
    row = read_points(spark, [package]).join(table.select("source_id", "geo"), "source_id").select(*to_projected(F.col("x"), F.col("y"), F.col("z"), F.col("geo"))).first()
    assert tuple(row) == (612005.0, 5204002.0, 40.0)
    assert (package.geo.matrix() @ [5, 1.5, -2, 1])[:3].tolist() == [612005.0, 5204002.0, 40.0]
    assert table.first().geo.acc_v is None


def test_rasters_and_names(tmp_path):
    (tmp_path / "keyframes").mkdir()
    np.full(4, 2.0, dtype="<f4").tofile(tmp_path / "keyframes" / "d.bin")
    for name in ("../d.bin", "/etc/passwd", "", "."):
        assert sidecar(tmp_path, name) is None
    assert raster(tmp_path, "d.bin", "<f4", 4).tolist() == [2.0] * 4
    assert raster(tmp_path, "d.bin", "<f4", 5) is None and raster(tmp_path, "absent", "<f4", 1) is None


def test_keyframe_selection(tmp_path):
    assert frames(tmp_path) is None
    (tmp_path / "keyframes.json").write_text(json.dumps([{"n": k, "sceneDepthPayload": {"width": 1} if k % 2 else None} for k in range(600)]))
    found = [f["n"] for f in frames(tmp_path)]
    assert len(found) == 120 and found[0] == 1 and found[-1] == 599
    assert found == [2 * int(x) + 1 for x in np.linspace(0, 299, 120, dtype=int)]
