"""Rigid motions with yaw about the vertical axis: four numbers, closed-form composition and inverse."""

from __future__ import annotations

from dataclasses import dataclass
from math import atan2, cos, sin

import numpy as np


@dataclass(frozen=True)
class Rigid:
    """p -> R(yaw) p + (tx, ty, tz)."""

    yaw: float = 0.0
    tx: float = 0.0
    ty: float = 0.0
    tz: float = 0.0

    @classmethod
    def of_matrix(cls, m: np.ndarray) -> Rigid:
        return cls(atan2(m[1][0], m[0][0]), float(m[0][3]), float(m[1][3]), float(m[2][3]))

    def matrix(self) -> np.ndarray:
        out = np.eye(4)
        out[:2, :2] = [[cos(self.yaw), -sin(self.yaw)], [sin(self.yaw), cos(self.yaw)]]
        out[:3, 3] = self.tx, self.ty, self.tz
        return out

    def turned(self, x: float, y: float) -> tuple[float, float]:
        c, s = cos(self.yaw), sin(self.yaw)
        return c * x - s * y, s * x + c * y

    def __matmul__(self, first: Rigid) -> Rigid:
        """The motion that makes ``first`` and then this one."""
        x, y = self.turned(first.tx, first.ty)
        yaw = self.yaw + first.yaw
        return Rigid(atan2(sin(yaw), cos(yaw)), x + self.tx, y + self.ty, first.tz + self.tz)

    def inverse(self) -> Rigid:
        x, y = Rigid(-self.yaw).turned(self.tx, self.ty)
        return Rigid(-self.yaw, -x, -y, -self.tz)

    def apply(self, points: np.ndarray) -> np.ndarray:
        c, s = np.cos(self.yaw), np.sin(self.yaw)
        x, y, z = points[:, 0], points[:, 1], points[:, 2]
        return np.column_stack([c * x - s * y + self.tx, s * x + c * y + self.ty, z + self.tz])

    def rebased(self, origin: tuple[float, float, float], *, to_centred: bool) -> Rigid:
        """The same motion where coordinates are counted from ``origin``, or the way back."""
        sign = 1.0 if to_centred else -1.0
        ox, oy, _ = origin
        x, y = self.turned(ox, oy)
        return Rigid(self.yaw, self.tx + sign * (x - ox), self.ty + sign * (y - oy), self.tz)


def fit_yaw(source: np.ndarray, target: np.ndarray) -> Rigid:
    """Least-squares yaw and translation from source to target points, about their means."""
    a, b = source.mean(axis=0), target.mean(axis=0)
    p, q = source[:, :2] - a[:2], target[:, :2] - b[:2]
    yaw = atan2(float((p[:, 0] * q[:, 1] - p[:, 1] * q[:, 0]).sum()), float((p * q).sum()))
    x, y = Rigid(yaw).turned(a[0], a[1])
    return Rigid(yaw, float(b[0] - x), float(b[1] - y), float(b[2] - a[2]))
