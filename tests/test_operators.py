from functools import reduce
from math import radians, sqrt
from operator import add

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cloudweft.functions import geometry as g
from cloudweft.functions.rigid import Rigid, fit_yaw
from cloudweft.operators import icp, nearest, pairs, pose_graph, visual, voxel
from cloudweft.operators.pose_graph import Edge

numbers = st.floats(-1000, 1000)
motions = st.builds(Rigid, st.floats(-3, 3), numbers, numbers, numbers)


@given(motions, motions)
def test_rigid_motions_match_matrices(a, b):
    assert np.allclose((a @ b).matrix(), a.matrix() @ b.matrix(), atol=1e-9)
    assert np.allclose(a.inverse().matrix(), np.linalg.inv(a.matrix()), atol=1e-8)
    origin = (465182.0, 3139419.0, 27.0)
    t = np.eye(4)
    t[:3, 3] = origin
    assert np.allclose(a.rebased(origin, to_centred=True).matrix(), np.linalg.inv(t) @ a.matrix() @ t, atol=1e-6)
    assert np.allclose(a.rebased(origin, to_centred=True).rebased(origin, to_centred=False).matrix(), a.matrix(), atol=1e-6)
    assert np.allclose(Rigid.of_matrix(a.matrix()).matrix(), a.matrix())


def test_yaw_fit_recovers_a_motion():
    points = np.random.default_rng(8).normal(size=(50, 3))
    true = Rigid(-0.2, 0.4, -0.3, 0.1)
    assert np.allclose(fit_yaw(points, true.apply(points)).matrix(), true.matrix(), atol=1e-10)


def test_yaw_fit_in_spark_at_projected_coordinates(spark):
    p = np.random.default_rng(3).uniform(-20, 20, (500, 3)) + (500_000, 4_500_000, 100)
    q = Rigid(0.01).rebased((500_000, 4_500_000, 0), to_centred=False).apply(p) + (0.2, -0.1, 0.05)
    table = spark.createDataFrame([tuple(map(float, (*a, *b, np.linalg.norm(a - b)))) for a, b in zip(p, q)], "x double, y double, z double, fx double, fy double, fz double, distance double")
    row = nearest.yaw_fit(table).first()
    assert abs(row.yaw - 0.01) < 1e-9
    assert np.allclose(Rigid(row.yaw, row.tx, row.ty, row.tz).apply(p), q, atol=1e-4)


def cloud(spark, xyz, extra=None):
    rows = [(0, k, *map(float, p), 1 if extra is None else int(extra[k])) for k, p in enumerate(xyz)]
    return spark.createDataFrame(rows, "source_id int, ord long, x double, y double, z double, confidence int")


def test_first_of_each_voxel(spark):
    xyz = np.random.default_rng(1).uniform(-1, 1, (3000, 3))
    _, first = np.unique(np.floor(xyz / 0.25).astype(int), axis=0, return_index=True)
    found = voxel.downsample(cloud(spark, xyz), 0.25)
    assert sorted(r.ord for r in found.collect()) == sorted(first.tolist())
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert voxel.downsample(cloud(spark, xyz).limit(0), 0.25).count() == 0
    assert voxel.downsample(cloud(spark, [[float("nan"), 0, 0], [float("inf"), 0, 0], [0, 0, 0]]), 1.0).count() == 1


@pytest.mark.parametrize("mode", ["highest", "uint8_compat"])
def test_deduplication_by_confidence(spark, mode):
    rng = np.random.default_rng(2)
    xyz, trust = rng.uniform(0, 1, (2000, 3)), rng.integers(0, 256, 2000)
    rank = 255 - trust if mode == "highest" else (-trust.astype(np.uint8)).astype(int)
    order = np.argsort(rank, kind="stable")
    _, first = np.unique(np.floor(xyz[order] / 0.3).astype(int), axis=0, return_index=True)
    found = voxel.deduplicate(cloud(spark, xyz, trust), 0.3, mode)
    assert sorted(r.ord for r in found.collect()) == sorted(order[first].tolist())
    assert voxel.deduplicate(cloud(spark, xyz, trust), 0).count() == 2000


def test_confidence_zero_wins_only_in_the_compatible_mode(spark):
    two = cloud(spark, [[0.1, 0, 0], [0.2, 0, 0]], [3, 0])
    assert voxel.deduplicate(two, 1.0).first().confidence == 3
    assert voxel.deduplicate(two, 1.0, "uint8_compat").first().confidence == 0
    with pytest.raises(ValueError):
        voxel.deduplicate(two, 1.0, "other")


def test_candidate_pairs_match_all_pairs(spark):
    rng = np.random.default_rng(5)
    low = rng.uniform(0, 100, (60, 2))
    high = low + rng.uniform(0, 15, (60, 2))
    boxes = spark.createDataFrame([(k, float(a[0]), float(b[0]), float(a[1]), float(b[1])) for k, (a, b) in enumerate(zip(low, high))], "source_id int, low_x double, high_x double, low_y double, high_y double")
    for padding in (0.0, 4.0):
        want = {(i, j) for i in range(60) for j in range(i + 1, 60) if (low[i] - padding <= high[j]).all() and (low[j] - padding <= high[i]).all()}
        got = [tuple(r) for r in pairs.candidate_pairs(boxes, padding).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    touching = spark.createDataFrame([(0, 0.0, 1.0, 0.0, 1.0), (1, 1.0, 2.0, 1.0, 2.0)], boxes.schema)
    assert pairs.candidate_pairs(touching).count() == 1


def test_nearest_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    fixed, moving = rng.uniform(-2, 2, (300, 3)), rng.uniform(-2, 2, (200, 3))
    apart = np.linalg.norm(moving[:, None] - fixed[None], axis=2)
    frame = lambda p: spark.createDataFrame([(k, *map(float, x)) for k, x in enumerate(p)], "id long, x double, y double, z double")
    for gate in (0.3, 1.0):
        got = {r.id: r.fid for r in nearest.nearest(frame(moving), frame(fixed), gate).collect()}
        assert got == {k: int(d.argmin()) for k, d in enumerate(apart) if d.min() < gate}
        distance, index = icp.Grid(fixed, gate).query(moving, gate)
        assert {k: int(i) for k, i in enumerate(index) if i >= 0} == got
        assert np.allclose(distance[index >= 0], apart.min(axis=1)[index >= 0])


def test_trimming_is_an_exact_quantile(spark):
    d = np.random.default_rng(4).uniform(0, 1, 1003)
    kept = nearest.trimmed(spark.createDataFrame([(float(x),) for x in d], "distance double"))
    assert kept.count() == (d <= np.quantile(d, 0.8)).sum()


@pytest.mark.parametrize("share", [0.0, 0.37, 0.8, 1.0])
def test_quantiles_of_groups(spark, share):
    rng = np.random.default_rng(7)
    groups = {"spread": rng.exponential(1, 501), "ties": rng.integers(0, 4, 300) / 3, "zeros": np.zeros(40), "one": np.array([2.5]), "two": np.array([1.0, 4.0])}
    table = spark.createDataFrame([(k, float(v)) for k, values in groups.items() for v in values] + [("one", None)], "k string, d double")
    got = {r.k: r.cut for r in nearest.quantile(table, "d", share, ["k"]).collect()}
    assert got.keys() == groups.keys() and all(abs(got[k] - np.quantile(v, share)) < 1e-12 for k, v in groups.items())
    assert nearest.trimmed(table.limit(0).select("k", F.col("d").alias("distance")), by=["k"]).count() == 0


def test_alignment_recovers_a_motion():
    rng = np.random.default_rng(42)
    moving = np.column_stack([rng.uniform(-4, 4, 2000), rng.uniform(-2, 2, 2000), rng.uniform(-1, 2, 2000)])
    true = Rigid(0.07, 0.35, -0.22, 0.12)
    found = icp.align(true.apply(moving), moving, 1.0)
    assert np.allclose(found.motion.matrix(), true.matrix(), atol=1e-3)
    assert found.n == 2000 and found.rmse < 1e-3 and found.overlap == 1.0


def test_seeded_alignment():
    rng = np.random.default_rng(9)
    moving = np.column_stack([rng.uniform(-4, 4, 2000), rng.uniform(-2, 2, 2000), rng.uniform(-1, 2, 2000)])
    true = Rigid(0.25, 1.5, -0.8, 0.2)
    found = icp.align(true.apply(moving), moving, 0.75, start=Rigid(0.24, 1.45, -0.75, 0.18))
    assert np.allclose(found.motion.matrix(), true.matrix(), atol=1e-3)


def test_alignment_needs_matches():
    points = np.random.default_rng(0).uniform(0, 1, (11, 3))
    assert icp.align(points, points, 1.0) is None
    assert icp.align(points, np.empty((0, 3)), 1.0) is None
    many = np.random.default_rng(0).uniform(0, 1, (100, 3))
    assert icp.align(many, many + 100, 1.0) is None


def test_both_forms_of_alignment_agree(spark):
    rng = np.random.default_rng(6)
    moving = rng.uniform(-2, 2, (200, 3))
    fixed = Rigid(0.02, 0.1, -0.05, 0.02).apply(moving)
    frame = lambda p: spark.createDataFrame([(k, *map(float, x)) for k, x in enumerate(p)], "id long, x double, y double, z double")
    a, b = icp.align(fixed, moving, 0.6, 3), icp.align_frames(frame(fixed), frame(moving), 0.6, 3)
    assert np.allclose(a.motion.matrix(), b.motion.matrix(), atol=1e-9) and a.n == b.n and abs(a.rmse - b.rmse) < 1e-9


def test_gates():
    assert np.allclose(icp.gates(5.0), np.geomspace(5.0, 0.5, 40))
    assert icp.gates(0.3, 1) == [0.3, 0.3]


def edge(a, b, motion, overlap=0.5, n=100, rmse=0.01):
    return Edge(a, b, motion, n, rmse, overlap)


def test_single_edges_are_exact():
    for motion in (Rigid(0.05, 0.4, -0.1, 0.2), Rigid(0.13, -399694, 85842, -2.1)):
        assert np.allclose(pose_graph.optimised(2, [edge(0, 1, motion)])[1].matrix(), motion.matrix(), atol=1e-6)


def test_noisy_loop_drifts_little():
    origin = (465182.0, 3139419.0, 27.0)
    edges = [edge(a, b, Rigid(yaw)) for a, b, yaw in ((0, 1, 0.001), (0, 2, -0.001), (1, 2, 0.0008))]
    for p in pose_graph.optimised(3, edges):
        moved = p.rebased(origin, to_centred=False)
        at = moved.apply(np.array([origin]))[0] - origin
        assert np.hypot(at[0], at[1]) < 2.0
    optimum = pose_graph.optimised(3, edges)
    assert abs(optimum[1].yaw) < 0.001 and abs(optimum[2].yaw) < 0.001


def test_contradictory_loop_is_rejected():
    good = [edge(1, 2, Rigid(0, 1, 0, 0), 0.9), edge(0, 2, Rigid(0, 2, 0, 0), 0.8), edge(0, 1, Rigid(radians(10), 4, 0, 0), 0.3)]
    taken, refused = pose_graph.consistent(3, good)
    assert [e.key for e in taken] == [(1, 2), (0, 2)] and [r.edge.key for r in refused] == [(0, 1)]
    assert abs(refused[0].yaw_degrees - 10) < 1e-9 and abs(refused[0].horizontal - 3) < 1e-9
    with pytest.raises(ValueError, match="connect"):
        pose_graph.consistent(4, good)
    with pytest.raises(ValueError, match="connect"):
        pose_graph.optimised(4, good)
    assert pose_graph.optimised(1, []) == [Rigid()]


def test_ratio_matches_and_seed():
    rng = np.random.default_rng(11)
    fixed = rng.normal(size=(80, 16))
    moving = np.vstack([fixed[:60] + 0.01, rng.normal(size=(20, 16))])
    found = dict(visual.ratio_matches(moving, fixed))
    assert all(found[k] == k for k in range(60))
    apart = np.sort(np.linalg.norm(moving[:, None] - fixed[None], axis=2), axis=1)
    assert set(found) == {k for k in range(80) if apart[k, 0] < 0.75 * apart[k, 1]}
    points = rng.uniform(-5, 5, (60, 3))
    true = Rigid(0.3, 2.0, 1.0, 0.1)
    target = true.apply(points)
    target[:20] += rng.uniform(5, 9, (20, 3))
    seed = visual.seeded(points, target, 77)
    assert np.allclose(seed.motion.matrix(), true.matrix(), atol=1e-9) and seed.inliers == 40 and seed.matches == 77
    assert visual.seeded(points[:19], target[:19], 19) is None
    assert visual.ratio_matches(moving, fixed[:1]) == []


def test_two_nearest_in_spark(spark):
    rng = np.random.default_rng(12)
    q, t = rng.normal(size=(20, 8)), rng.normal(size=(100, 8))
    frame = lambda p, name: spark.createDataFrame([(k, [float(v) for v in x]) for k, x in enumerate(p)], f"{name} long, descriptor array<float>")
    got = {r.qid: r.tid for r in visual.knn2(frame(q, "qid"), frame(t, "tid")).collect()}
    assert got == dict(visual.ratio_matches(q.astype(np.float32), t.astype(np.float32)))


def test_two_nearest_in_blocks_with_ties(spark):
    rng = np.random.default_rng(13)
    t = rng.integers(0, 3, (90, 4)).astype(float)
    frame = lambda name: spark.createDataFrame([(k, [float(v) for v in x]) for k, x in enumerate(t)], f"{name} long, descriptor array<float>")
    got = {r.qid: (r.tid, r.d1, r.d2) for r in visual.knn2(frame("qid"), frame("tid"), None, blocks=3, skip_same=True).collect()}
    for k in range(90):
        apart = np.linalg.norm(t - t[k], axis=1)
        apart[k] = np.inf
        order = np.argsort(apart, kind="stable")
        assert got[k] == (order[0], apart[order[0]], apart[order[1]])


def _two_nearest(q, t):
    """By id of each query: (nearest id, its distance, the second distance), summed term by term; ``t`` and ``q`` by id."""
    found = {}
    for k, x in q.items():
        each = sorted((sqrt(reduce(add, ((a - b) * (a - b) for a, b in zip(x, y, strict=True)))), i) for i, y in t.items() if i != k)
        found[k] = (each[0][1], each[0][0], each[1][0])
    return found


@pytest.mark.parametrize("copies", [1, 40])
def test_two_nearest_of_a_table_with_itself_in_partitions_apart(spark, copies):
    rng = np.random.default_rng(16)
    distinct = rng.normal(size=(120 // copies, 24)).astype(np.float32).astype(float)
    vectors = {k: [float(v) for v in distinct[k % len(distinct)]] for k in range(120)}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, descriptor array<float>").localCheckpoint()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = visual.knn2(frame.withColumnRenamed("vec_id", "qid"), frame.withColumnRenamed("vec_id", "tid"), None, blocks=3, skip_same=True).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.qid: (r.tid, r.d1, r.d2) for r in found} == _two_nearest(vectors, vectors) and len(found) == 120


def test_two_nearest_choose_by_exact_distances():
    rng = np.random.default_rng(17)
    many = np.vstack([rng.normal(size=(1, 64)) + 1000.0] * 300 + [rng.normal(size=(5, 64))])  # products round differently by place
    known = np.ones(len(many), dtype=bool)
    who, target, apart, sure = visual.two_nearest(many[:300], known[:300], many, known, np.eye(305, dtype=bool)[:300])
    assert sure.all() and (apart == 0).all() and (np.bincount(who) == 2).all()
    assert [tuple(x) for x in target.reshape(-1, 2)] == [tuple(i for i in range(4) if i != k)[:2] for k in range(300)]
    who, target, apart, sure = visual.two_nearest(np.array([[0.0], [np.nan]]), known[:2], np.array([[np.inf], [1.0], [np.nan]]), known[:3])
    assert target.tolist() == [1, 0, 0, 1] and apart[:2].tolist() == [1.0, np.inf] and np.isnan(apart[2:]).all()


def test_two_nearest_query_on_few_and_null_vectors(spark, tmp_path):
    import duckdb

    from cloudweft.plans import catalog

    one, nan = [0.5, -1.0], [float("nan"), 0.0]
    for n, rows in enumerate(([], [(0, one)], [(0, one), (7, [1.0, 1.0])], [(0, one), (7, None)], [(0, None), (None, one), (7, one), (100, one), (200, nan), (300, one), (3, nan), (5, None)], [(0, None), (100, None), (7, None)])):
        spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/{n}/embeddings.parquet")
        embeddings = duckdb.sql(f"SELECT * FROM '{tmp_path}/{n}/embeddings.parquet/*.parquet'")  # noqa: F841
        want = {tuple(map(repr, r)) for r in duckdb.sql(catalog.oracle_sql()["knn2_ratio"]).fetchall()}
        assert {tuple(map(repr, r)) for r in catalog.queries()["knn2_ratio"](spark, f"{tmp_path}/{n}").collect()} == want


def test_two_nearest_query_answers_for_every_vector(spark, tmp_path):
    import duckdb

    from cloudweft.plans import catalog

    rng = np.random.default_rng(18)
    vectors = {k: [float(v) for v in x] for k, x in enumerate(rng.normal(size=(230, 6)).astype(np.float32), 51)}
    vectors[77] = vectors[150]
    spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = catalog.queries()["knn2_ratio"](spark, str(tmp_path)).collect()
    want = {k: (tid, round(d1, 6), round(d2, 6), d1 < 0.95 * d2) for k, (tid, d1, d2) in _two_nearest(vectors, vectors).items()}
    assert {r.qid: (r.tid, r.d1, r.d2, r.passes) for r in found} == want and len(found) == 230
    embeddings = duckdb.sql(f"SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")  # noqa: F841
    assert {r[0]: r[1:] for r in duckdb.sql(catalog.oracle_sql()["knn2_ratio"]).fetchall()} == want


def test_candidate_pairs_with_one_wide_box(spark):
    rng = np.random.default_rng(14)
    low = rng.uniform(-50, 50, (60, 2))
    high = low + rng.uniform(0, 4, (60, 2))
    low[7], high[7] = (-200, -3), (300, 2)
    rows = [(k, *map(float, (low[k, 0], high[k, 0], low[k, 1], high[k, 1]))) for k in range(60)]
    boxes = spark.createDataFrame(rows, "source_id int, low_x double, high_x double, low_y double, high_y double")
    for padding in (0.0, 1.5):
        want = {(a, b) for a in range(60) for b in range(a + 1, 60) if (low[a] - padding <= high[b]).all() and (low[b] - padding <= high[a]).all()}
        found = [(r.fixed, r.moving) for r in pairs.candidate_pairs(boxes, padding).collect()]
        assert set(found) == want and len(found) == len(want)


def test_derivatives_of_the_pose_graph():
    rng = np.random.default_rng(15)
    edges = [edge(a, b, Rigid(*rng.uniform(-1, 1, 4))) for a, b in ((0, 1), (1, 2), (0, 2))]
    system, x = pose_graph.Equations(3, edges), rng.uniform(-0.5, 0.5, (3, 4))
    d = system.derivatives(x)
    for k, e in enumerate(edges):
        for column in range(8):
            step = np.zeros((3, 4))
            step[(e.fixed, e.moving)[column // 4], column % 4] = 1e-6
            slope = (system.residuals(x + step)[k] - system.residuals(x - step)[k]) / 2e-6
            assert np.allclose(d[k, :, column], slope, atol=1e-6)
    for k, e in enumerate(edges):
        gap = Rigid(*x[e.fixed]).inverse() @ Rigid(*x[e.moving]) @ e.motion.inverse()
        assert np.allclose(system.residuals(x)[k], [pose_graph.YAW_METRES * gap.yaw, gap.tx, gap.ty, gap.tz])


def test_best_hypothesis_is_the_earliest(spark):
    counts = spark.createDataFrame([(0, 4), (1, 9), (2, 9)], "hypothesis int, inliers long")
    assert visual.best_hypothesis(counts).first().hypothesis == 1


def test_rounding_of_depth_places(spark):
    values = spark.createDataFrame([(0.5, 1.5), (2.5, -3.0), (99.0, 3.49)], "u double, v double")
    got = values.select(g.depth_offset(F.col("u"), F.col("v"), *(F.lit(4) for _ in range(4)))).toPandas().iloc[:, 0].tolist()
    assert got == [8, 2, 15]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(-100, 100), min_size=16, max_size=16))
def test_column_major(spark, values):
    df = spark.createDataFrame([(values,)], "m array<double>")
    row = df.select(*(g.column_major(F.col("m"), 4, r, c) for r in range(4) for c in range(4))).first()
    assert np.array_equal(np.reshape(tuple(row), (4, 4)), np.reshape(values, (4, 4), order="F"))


def seen_at(folder, frame, u, v):
    """Where an image point lies, by hand; None without a depth that counts."""
    payload = frame["sceneDepthPayload"]
    size = (payload["height"], payload["width"])
    if min(*size, frame["imageWidth"], frame["imageHeight"]) <= 0:
        return None
    at = [min(max(int(np.rint(p * n / m)), 0), n - 1) for p, n, m in ((v, size[0], frame["imageHeight"]), (u, size[1], frame["imageWidth"]))]
    file = folder / "keyframes" / payload["depthMapFilename"]
    if not file.is_file() or file.stat().st_size < 4 * size[0] * size[1]:
        return None
    depth = np.fromfile(file, "<f4", size[0] * size[1]).reshape(size)[*at].astype(float)
    if not 0.05 < depth <= 8.0:
        return None
    if (name := payload.get("confidenceMapFilename")) and np.fromfile(folder / "keyframes" / name, "u1").reshape(size)[*at] < 1:
        return None
    fx, fy, cx, cy = (frame["cameraIntrinsics"][k] for k in (0, 4, 6, 7))
    local = np.array([(u - cx) / fx * depth, (cy - v) / fy * depth, -depth, 1.0])
    return (np.reshape(frame["cameraTransform"], (4, 4), order="F") @ local)[:3]


def test_lifted_features_match_the_lookup(spark, tmp_path):
    import json

    from cloudweft.schema import FEATURES
    from cloudweft.sources.keyframes import frame_table, grid_table

    (tmp_path / "keyframes").mkdir()
    np.linspace(0, 9, 12).astype("<f4").tofile(tmp_path / "keyframes" / "d.bin")
    np.arange(12, dtype="u1").__mod__(3).astype("u1").tofile(tmp_path / "keyframes" / "c.bin")
    plain = {"width": 4, "height": 3, "depthMapFilename": "d.bin"}
    frame = {"sceneDepthPayload": plain, "imageWidth": 40, "imageHeight": 30, "cameraIntrinsics": [50, 0, 0, 0, 60, 0, 20, 15, 1], "cameraTransform": [0, 1, 0, 0, -1, 0, 0, 0, 0, 0, 1, 0, 5, 6, 7, 1], "imageFilename": "i"}
    every = [frame | {"sceneDepthPayload": plain | x} for x in ({}, {"confidenceMapFilename": "c.bin"}, {"depthMapFilename": "absent"}, {"width": 9}, {"width": 0})] + [frame | {"imageWidth": 0}]
    (tmp_path / "keyframes.json").write_text(json.dumps(every))
    rng = np.random.default_rng(1)
    uv = rng.uniform(-5, 45, (240, 2)).astype(np.float32)
    table = spark.createDataFrame([(0, k, k % 6, float(u), float(v), [0.0]) for k, (u, v) in enumerate(uv)], FEATURES)
    got = {r.feat_id: (r.x, r.y, r.z) for r in visual.lifted(table, frame_table(spark, [tmp_path]), grid_table(spark, [tmp_path])).collect()}
    want = {k: p for k, (u, v) in enumerate(uv) if (p := seen_at(tmp_path, every[k % 6], float(u), float(v))) is not None}
    assert got.keys() == want.keys() and len(got) > 30 and {k % 6 for k in got} == {0, 1}
    assert all(np.allclose(got[k], want[k]) for k in got)
