"""Principal-axis projection onto the floor plane."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallaxis.operators.numbering import percentiles


def covariance(points: DataFrame, axes=("x", "y", "z")):
    """``(n, mean, population covariance)`` in one pass of distributed aggregates."""
    c = [F.col(a).cast("double") for a in axes]
    pairs = [(i, j) for i in range(3) for j in range(i, 3)]
    row = points.agg(F.count("*").alias("n"), *[F.avg(x).alias(f"m{k}") for k, x in enumerate(c)], *[F.covar_pop(c[i], c[j]).alias(f"c{i}{j}") for i, j in pairs]).first()
    if not row["n"]:
        return 0, np.zeros(3), np.zeros((3, 3))
    cov = np.zeros((3, 3))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c{i}{j}"]
    return row["n"], np.array([row[f"m{k}"] for k in range(3)]), cov


def principal_axes(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and axes by rows; each axis' largest entry is positive."""
    values, vectors = np.linalg.eigh(cov)
    axes = vectors.T[::-1]
    sign = np.sign(axes[np.arange(3), np.abs(axes).argmax(1)])
    return np.maximum(values[::-1], 0), axes * np.where(sign == 0, 1, sign)[:, None]


def project_top_down(points: DataFrame, axes=("x", "y", "z")) -> DataFrame | None:
    """``points`` with ``u``, ``v`` in the floor plane and ``height``; None for fewer than three points or a line."""
    n, mean, cov = covariance(points, axes)
    values, basis = principal_axes(cov)
    if n < 3 or values[1] <= 1e-12 * max(values[0], 1e-300):
        return None
    dot = lambda b: sum(((F.col(a).cast("double") - float(m)) * float(w) for a, m, w in zip(axes[1:], mean[1:], b[1:], strict=True)), (F.col(axes[0]).cast("double") - float(mean[0])) * float(b[0]))
    return points.withColumns({"u": dot(basis[0]), "v": dot(basis[1]), "height": dot(basis[2])})


def planarity(points: DataFrame, axes=("x", "y", "z")) -> DataFrame:
    """One row: n, ratio of the third singular value to the second, and the height's p95 - p05."""
    n, _, cov = covariance(points, axes)
    values, _ = principal_axes(cov)
    flat = project_top_down(points, axes)
    ratio = float(np.sqrt(values[2] / values[1])) if flat is not None else None
    spread = percentiles(flat, "height", [0.05, 0.95]).first()["p"] if flat is not None else None
    return points.sparkSession.createDataFrame([(n, ratio, spread[1] - spread[0] if spread else None)], "n LONG, planarity DOUBLE, height_spread DOUBLE")
