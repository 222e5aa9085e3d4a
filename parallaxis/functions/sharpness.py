"""Sharpness of images: variance of the Laplacian."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: BT.601 weights of blue, green, red.
GRAY = (0.114, 0.587, 0.299)


def laplacian_variance(gray: np.ndarray) -> float:
    """Population variance of the 3x3 Laplacian with the border mirrored without its edge row."""
    g = np.pad(gray.astype(np.float64), 1, mode="reflect") if min(gray.shape) > 1 else np.pad(gray.astype(np.float64), 1, mode="edge")
    lap = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
    return float(lap.var())


def to_gray(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Whole-number gray levels of Spark's image rows (BGR order)."""
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return pixels[:, :, 0]
    return np.rint(pixels[:, :, :3].astype(np.float64) @ np.array(GRAY)).astype(np.uint8)


@F.pandas_udf(T.DoubleType())
def sharpness(data: pd.Series, height: pd.Series, width: pd.Series, channels: pd.Series) -> pd.Series:
    """Score of ``image.data`` with its sizes; null for images that could not be read."""
    rows = zip(data, height, width, channels, strict=True)
    return pd.Series([laplacian_variance(to_gray(bytes(d), h, w, c)) if d is not None and h > 0 else None for d, h, w, c in rows], dtype="float64")
