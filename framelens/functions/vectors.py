"""Vector expressions over arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column, floor: float = 1e-12) -> Column:
    length = F.greatest(norm(a), F.lit(floor))
    return F.transform(a, lambda x: x.cast("double") / length)


def cosine(a: Column, b: Column, floor: float = 1e-12) -> Column:
    return dot(a, b) / (F.greatest(norm(a), F.lit(floor)) * F.greatest(norm(b), F.lit(floor)))


def cosine_distance(a: Column, b: Column, missing: float = 2.0) -> Column:
    """1 - cosine, not below zero; ``missing`` where either vector is."""
    return F.coalesce(F.greatest(F.lit(0.0), 1 - cosine(a, b)), F.lit(missing))


def joint_angle(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """The angle at b between a and c, in degrees from 0 to 180."""
    turn = F.abs(F.degrees(F.atan2(cy - by, cx - bx) - F.atan2(ay - by, ax - bx)))
    return F.when(turn > 180, 360 - turn).otherwise(turn)
