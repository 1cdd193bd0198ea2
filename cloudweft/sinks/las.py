"""Uncompressed LAS 1.4 clouds, point format 7, with confidence, source_id and scan_time as extra dimensions.

Points are dealt into ranges of ord, counted, and each range is encoded and written at its place in the file by the task
that has it, so no point passes through the driver, nothing is sorted as a whole, and a task that runs again writes the
same bytes. The folder of the file must be one that all executors see, as that of the packages. The compressed form
needs a codec that is not part of this library.
"""

from __future__ import annotations

import os
import struct
from contextlib import ExitStack
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Layout of a LAS 1.4 point record of format 7 with the three extra dimensions.
SCALE = 0.001
RECORD = np.dtype([("X", "<i4"), ("Y", "<i4"), ("Z", "<i4"), ("intensity", "<u2"), ("returns", "u1"), ("flags", "u1"), ("classification", "u1"), ("user_data", "u1"), ("scan_angle", "<i2"), ("point_source_id", "<u2"), ("gps_time", "<f8"), ("red", "<u2"), ("green", "<u2"), ("blue", "<u2"), ("confidence", "u1"), ("source_id", "<u2"), ("scan_time", "<f8")])
HEADER_BYTES, VLR_BYTES, EXTRA_BYTES = 375, 54, 192
EXTRA_TYPES = (("confidence", 1), ("source_id", 3), ("scan_time", 10))
#: Bits of ord within a range: a task holds at most so many points of one scan at once.
RANGE_BITS = 20


def utm_wkt(epsg: int) -> str:
    """The coordinate system of a WGS 84 UTM zone as text; other codes need ``wkt`` from the caller."""
    north, zone = divmod(epsg, 100)
    if north not in (326, 327) or not 1 <= zone <= 60:
        raise ValueError(f"no text for EPSG:{epsg}; supply wkt")
    geographic = 'GEOGCS["WGS 84",DATUM["WGS_1984",SPHEROID["WGS 84",6378137,298.257223563,AUTHORITY["EPSG","7030"]],AUTHORITY["EPSG","6326"]],PRIMEM["Greenwich",0,AUTHORITY["EPSG","8901"]],UNIT["degree",0.0174532925199433,AUTHORITY["EPSG","9122"]],AUTHORITY["EPSG","4326"]]'
    shift = 0 if north == 326 else 10_000_000
    parameters = {"latitude_of_origin": 0, "central_meridian": zone * 6 - 183, "scale_factor": 0.9996, "false_easting": 500_000, "false_northing": shift}
    lines = ",".join(f'PARAMETER["{k}",{v}]' for k, v in parameters.items())
    return f'PROJCS["WGS 84 / UTM zone {zone}{"N" if north == 326 else "S"}",{geographic},PROJECTION["Transverse_Mercator"],{lines},UNIT["metre",1,AUTHORITY["EPSG","9001"]],AXIS["Easting",EAST],AXIS["Northing",NORTH],AUTHORITY["EPSG","{epsg}"]]'


def _vlr(user: bytes, number: int, body: bytes, text: bytes) -> bytes:
    return struct.pack("<H16sHH32s", 0, user, number, len(body), text) + body


def header(count: int, offset: tuple[float, ...], high: tuple[float, ...], wkt: str) -> bytes:
    """Everything before the points."""
    extra = b"".join(struct.pack("<2sBB32s4s24s24s24s24s24s32s", b"", kind, 0, name.encode(), b"", b"", b"", b"", b"", b"", name.encode()) for name, kind in EXTRA_TYPES)
    assert len(extra) == EXTRA_BYTES * len(EXTRA_TYPES)
    vlrs = [_vlr(b"LASF_Spec", 4, extra, b"extra bytes"), _vlr(b"LASF_Projection", 2112, wkt.encode() + b"\0", b"coordinate system")]
    points_at = HEADER_BYTES + sum(map(len, vlrs))
    low = offset if count else (0.0, 0.0, 0.0)
    top = high if count else (0.0, 0.0, 0.0)
    head = struct.pack("<4sHHIHH8sBB32s32sHHHIIBHI5I", b"LASF", 0, 1 << 4, 0, 0, 0, b"", 1, 4, b"", b"cloudweft", 1, 1, HEADER_BYTES, points_at, len(vlrs), 7, RECORD.itemsize, 0, *[0] * 5)
    head += struct.pack("<12d", SCALE, SCALE, SCALE, *offset, top[0], low[0], top[1], low[1], top[2], low[2])
    head += struct.pack("<QQIQ15Q", 0, 0, 0, count, *[0] * 15)
    assert len(head) == HEADER_BYTES
    return head + b"".join(vlrs)


def encode(pdf: pd.DataFrame, offset: tuple[float, ...]) -> bytes:
    out = np.zeros(len(pdf), dtype=RECORD)
    for name, axis, low in zip("XYZ", "xyz", offset, strict=True):
        out[name] = np.rint((pdf[axis].to_numpy() - low) / SCALE)
    for name, column in (("red", "r"), ("green", "g"), ("blue", "b")):
        out[name] = pdf[column].to_numpy().astype(np.uint16) * 257
    for name in ("confidence", "source_id", "scan_time"):
        out[name] = pdf[name].to_numpy()
    return out.tobytes()


def temporary(output: Path) -> Path:
    """A name beside ``output`` with its suffix, unique to this process."""
    return output.with_name(f"{output.stem}.{os.getpid()}.tmp{output.suffix}")


def write_clouds(points: DataFrame, outputs: dict[int | None, Path], epsg: int, wkt: str | None = None) -> dict[int | None, int]:
    """Writes points (see ``schema.POINTS``, projected) by source_id, or all of them where the key is None; counts of points.

    Each file appears whole or not at all.
    """
    if any(p.suffix.lower() != ".las" for p in outputs.values()):
        raise ValueError("clouds are written as .las")
    whole = None in outputs
    text = wkt or utm_wkt(epsg)
    group = F.lit(None).cast("int") if whole else F.col("source_id")
    facts = {r.k: r for r in points.groupBy(group.alias("k")).agg(F.count("*").alias("n"), *(f(a).alias(f"{m}_{a}") for a in "xyz" for f, m in ((F.min, "low"), (F.max, "high")))).collect()}
    offsets = {k: tuple(facts[k][f"low_{a}"] for a in "xyz") if k in facts else (0.0, 0.0, 0.0) for k in outputs}
    for k, r in facts.items():
        if max(r[f"high_{a}"] - r[f"low_{a}"] for a in "xyz") / SCALE >= 2**31:
            raise ValueError("a cloud is too wide for millimetres in 32 bits")

    temps = {k: temporary(p) for k, p in outputs.items()}
    begins = {}
    with ExitStack() as stack:
        stack.callback(lambda: [t.unlink(missing_ok=True) for t in temps.values()])
        for k, t in temps.items():
            r = facts.get(k)
            head = header(r.n if r else 0, offsets[k], tuple(r[f"high_{a}"] for a in "xyz") if r else (0.0, 0.0, 0.0), text)
            begins[k] = len(head)
            with t.open("wb") as f:
                f.write(head)
                f.truncate(len(head) + (r.n if r else 0) * RECORD.itemsize)
        names = {k: str(t.absolute()) for k, t in temps.items()}

        def put(points: pd.DataFrame, places: pd.DataFrame) -> pd.DataFrame:
            k = None if whole else int(places["source"].iloc[0])
            own = points.sort_values("ord")
            handle = os.open(names[k], os.O_WRONLY)
            try:
                raw, at = memoryview(encode(own, offsets[k])), begins[k] + int(places["start"].iloc[0]) * RECORD.itemsize
                while raw:
                    done = os.pwrite(handle, raw, at)
                    raw, at = raw[done:], at + done
                os.fsync(handle)
            finally:
                os.close(handle)
            return pd.DataFrame({"k": pd.array([k], dtype="Int32"), "n": [len(own)]})

        ranged = points.withColumn("part", F.shiftright("ord", RANGE_BITS))
        before = Window.partitionBy(*([] if whole else ["source_id"])).orderBy("source_id", "part").rowsBetween(Window.unboundedPreceding, -1)
        places = ranged.groupBy("source_id", "part").agg(F.count("*").alias("n")).select(F.col("source_id").alias("source"), F.col("part").alias("range"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # a row for each range
        both = ranged.groupBy("source_id", "part").cogroup(places.groupBy("source", "range"))
        counts: dict[int | None, int] = dict.fromkeys(outputs, 0)
        for r in both.applyInPandas(put, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
            counts[r.k] = r.n
        if any(counts[k] != (facts[k].n if k in facts else 0) for k in outputs):
            raise RuntimeError("the points changed while they were written")
        for k, t in temps.items():
            os.replace(t, outputs[k])
    return counts


def read_cloud(path: Path) -> tuple[dict, np.ndarray]:
    """Header facts and structured records, with x, y, z recovered; for checks of what was written."""
    raw = path.read_bytes()
    points_at, = struct.unpack_from("<I", raw, 96)
    kind, size = raw[104], struct.unpack_from("<H", raw, 105)[0]
    numbers = struct.unpack_from("<12d", raw, 131)
    count, = struct.unpack_from("<Q", raw, 247)
    records = np.frombuffer(raw, dtype=RECORD, count=count, offset=points_at)
    xyz = np.column_stack([records[a] * numbers[k] + numbers[3 + k] for k, a in enumerate("XYZ")]) if count else np.empty((0, 3))
    return {"version": tuple(raw[24:26]), "format": kind, "size": size, "count": count, "offsets": numbers[3:6], "wkt": b"PROJCS" in raw[:points_at], "xyz": xyz}, records
