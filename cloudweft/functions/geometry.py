"""Geometry as column expressions; nothing here leaves whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Triple = tuple[Column, Column, Column]


def to_projected(x: Column, y: Column, z: Column, geo: Column) -> Triple:
    """Local (x, y, z) with y up into east, north, altitude: local x and -z are horizontal."""
    c, s = F.cos(geo["rot"]), F.sin(geo["rot"])
    return c * x + s * z + geo["e0"], s * x - c * z + geo["n0"], y + geo["h0"]


def moved(x: Column, y: Column, z: Column, yaw: Column, tx: Column, ty: Column, tz: Column) -> Triple:
    c, s = F.cos(yaw), F.sin(yaw)
    return c * x - s * y + tx, s * x + c * y + ty, z + tz


def affine(x: Column, y: Column, z: Column, matrix: Column) -> Triple:
    """``matrix`` is an array of rows."""
    return tuple(matrix[k][0] * x + matrix[k][1] * y + matrix[k][2] * z + matrix[k][3] for k in range(3))


def yaw_matrix(yaw: Column, tx: Column, ty: Column, tz: Column) -> Column:
    c, s, o, one = F.cos(yaw), F.sin(yaw), F.lit(0.0), F.lit(1.0)
    return F.array(F.array(c, -s, o, tx), F.array(s, c, o, ty), F.array(o, o, one, tz), F.array(o, o, o, one))


def parameters(matrix: Column) -> Column:
    return F.struct(F.atan2(matrix[1][0], matrix[0][0]).alias("yaw"), matrix[0][3].alias("tx"), matrix[1][3].alias("ty"), matrix[2][3].alias("tz"))


def rebased(yaw: Column, tx: Column, ty: Column, ox: Column, oy: Column, *, to_centred: bool) -> tuple[Column, Column]:
    """The translation of the same motion about another origin."""
    sign = F.lit(1.0 if to_centred else -1.0)
    c, s = F.cos(yaw), F.sin(yaw)
    return tx + sign * (c * ox - s * oy - ox), ty + sign * (s * ox + c * oy - oy)


def cell(value: Column, size: float) -> Column:
    """The voxel index; callers filter values that are not finite."""
    return F.floor(value / F.lit(float(size))).cast("long")


def finite(*values: Column) -> Column:
    out = F.lit(True)
    for v in values:
        out = out & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return out


def depth_offset(u: Column, v: Column, width: Column, height: Column, image_width: Column, image_height: Column) -> Column:
    """Row-major place in a depth raster of an image point; halves round to even."""
    at = lambda p, n, m: F.least(F.greatest(F.rint(p * n / m), F.lit(0.0)), n - F.lit(1.0)).cast("long")
    return at(v, height, image_height) * width.cast("long") + at(u, width, image_width)


def column_major(values: Column, size: int, row: int, col: int) -> Column:
    return F.element_at(values, col * size + row + 1)


def unprojected(u: Column, v: Column, depth: Column, intrinsics: Column, pose: Column) -> Triple:
    """World point of an image point with metric depth; both matrices are column by column on the wire."""
    k = lambda r, c: column_major(intrinsics, 3, r, c)
    x, y, z = (u - k(0, 2)) * depth / k(0, 0), -((v - k(1, 2)) * depth / k(1, 1)), -depth
    m = lambda r, c: column_major(pose, 4, r, c)
    return tuple(m(r, 0) * x + m(r, 1) * y + m(r, 2) * z + m(r, 3) for r in range(3))


def usable_depth(depth: Column) -> Column:
    return finite(depth) & (depth > 0.05) & (depth <= 8.0)


def wide_colour(value: Column) -> Column:
    return value.cast("int") * 257


def quality_score(overlap: Column, rmse: Column) -> Column:
    return overlap / F.greatest(rmse, F.lit(0.001))


def loop_errors(yaw: Column, tx: Column, ty: Column, tz: Column) -> Triple:
    """Degrees of yaw, horizontal and vertical metres by which a loop does not close."""
    return F.abs(F.degrees(yaw)), F.sqrt(tx * tx + ty * ty), F.abs(tz)


def tolerated(errors: Triple, yaw: float, horizontal: float, vertical: float) -> Column:
    return (errors[0] <= yaw) & (errors[1] <= horizontal) & (errors[2] <= vertical)


def quantised(value: Column, offset: Column, scale: float = 0.001) -> Column:
    return F.rint((value - offset) / F.lit(scale)).cast("int")
