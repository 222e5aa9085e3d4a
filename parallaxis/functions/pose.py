"""Camera poses as column expressions: rotation, centre, viewing direction, angles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm(*parts: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]))


def unit_quaternion(w: Column, x: Column, y: Column, z: Column, check: bool = True) -> tuple[Column, ...]:
    """The quaternion over its length; a zero or non-finite one raises (or is null without ``check``)."""
    size = norm(w, x, y, z)
    good = (size > 0) & (size < float("inf")) & ~F.isnan(size)
    bad = F.raise_error(F.lit("quaternion is zero or not finite")).cast("double") if check else F.lit(None).cast("double")
    return tuple(F.when(good, part / size).otherwise(bad) for part in (w, x, y, z))


def rotation(w: Column, x: Column, y: Column, z: Column) -> list[list[Column]]:
    """World-to-camera rotation matrix of a unit quaternion, by rows."""
    return [
        [1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)],
        [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)],
        [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)],
    ]


def camera_center(q: tuple[Column, ...], t: tuple[Column, ...]) -> tuple[Column, ...]:
    """Centre in world coordinates, -R^T t."""
    r = rotation(*q)
    return tuple(-(r[0][k] * t[0] + r[1][k] * t[1] + r[2][k] * t[2]) for k in range(3))


def view_direction(q: tuple[Column, ...]) -> tuple[Column, ...]:
    """Viewing direction in world coordinates, the third row of R."""
    return tuple(rotation(*q)[2])


def distance(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    return norm(*(p - q for p, q in zip(a, b, strict=True)))


def cosine(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    parts = [p * q for p, q in zip(a, b, strict=True)]
    return sum(parts[1:], parts[0])


def view_angle(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Angle in degrees between unit directions."""
    return F.degrees(F.acos(F.greatest(F.least(cosine(a, b), F.lit(1.0)), F.lit(-1.0))))
