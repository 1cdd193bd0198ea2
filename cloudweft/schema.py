"""Tables of the engine, and the binary record of a scan chunk."""

from __future__ import annotations

import numpy as np
from pyspark.sql import types as T

#: The packed little-endian record of a point, 24 bytes.
RECORD = np.dtype([("xyz", "<f4", (3,)), ("rgb", "u1", (3,)), ("confidence", "u1"), ("time", "<f8")], align=False)
#: Limits and defaults of a scan package.
MAXIMUM_POINTS = 100_000_000
DEFAULT_VOXEL_METRES = 0.02
CHUNK_NAME = "chunk-{:05d}.bin"
SUFFIX = ".scanproject"
#: source_id is stored as an unsigned 16-bit number.
MAXIMUM_SCANS = 1 << 16

POINTS = T.StructType([
    T.StructField("source_id", T.IntegerType(), False),
    T.StructField("ord", T.LongType(), False),
    T.StructField("x", T.DoubleType(), False),
    T.StructField("y", T.DoubleType(), False),
    T.StructField("z", T.DoubleType(), False),
    T.StructField("r", T.ShortType(), False),
    T.StructField("g", T.ShortType(), False),
    T.StructField("b", T.ShortType(), False),
    T.StructField("confidence", T.ShortType(), False),
    T.StructField("scan_time", T.DoubleType(), False),
])

GEO = T.StructType([
    T.StructField("epsg", T.IntegerType(), False),
    *(T.StructField(n, T.DoubleType(), False) for n in ("e0", "n0", "h0", "rot")),
    *(T.StructField(n, T.DoubleType(), True) for n in ("acc_h", "acc_v", "acc_heading")),
])

SCANS = T.StructType([
    T.StructField("source_id", T.IntegerType(), False),
    T.StructField("scan_key", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("point_count", T.LongType(), False),
    T.StructField("chunk_count", T.IntegerType(), False),
    T.StructField("voxel_size", T.DoubleType(), False),
    T.StructField("geo", GEO, True),
    T.StructField("manifest", T.StringType(), False),
])

EDGES = T.StructType([
    T.StructField("fixed", T.IntegerType(), False),
    T.StructField("moving", T.IntegerType(), False),
    *(T.StructField(n, T.DoubleType(), False) for n in ("yaw", "tx", "ty", "tz")),
    T.StructField("n", T.LongType(), False),
    T.StructField("rmse", T.DoubleType(), False),
    T.StructField("overlap", T.DoubleType(), False),
    T.StructField("initialization", T.StringType(), False),
    T.StructField("v_match", T.IntegerType(), False),
    T.StructField("v_inlier", T.IntegerType(), False),
    T.StructField("v_rmse", T.DoubleType(), True),
])

FEATURES = T.StructType([
    T.StructField("source_id", T.IntegerType(), False),
    T.StructField("feat_id", T.LongType(), False),
    T.StructField("frame_idx", T.IntegerType(), False),
    T.StructField("u", T.FloatType(), False),
    T.StructField("v", T.FloatType(), False),
    T.StructField("descriptor", T.ArrayType(T.FloatType(), False), False),
])
