"""Pixel operators on struct<width,height,channels,data> pictures, as pandas UDFs over numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pixels(width: int, height: int, channels: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(height, width, channels)


def grey(image: np.ndarray) -> np.ndarray:
    if image.shape[2] == 1:
        return image[:, :, 0].astype(float)
    return np.rint(image[:, :, :3].astype(float) @ np.array([0.299, 0.587, 0.114]))


def laplacian_variance(g: np.ndarray) -> float:
    """Variance of the four-neighbour Laplacian, edges mirrored."""
    p = np.pad(g, 1, mode="reflect") if min(g.shape) > 1 else np.pad(g, 1, mode="edge")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g).var())


def edge_sharpness(g: np.ndarray) -> float:
    """Variance of the eight-neighbour edge filter over 500, in 0 to 1; the border keeps its pixels."""
    out = g.copy()
    if min(g.shape) > 2:
        around = sum(g[1 + i : g.shape[0] - 1 + i, 1 + j : g.shape[1] - 1 + j] for i in (-1, 0, 1) for j in (-1, 0, 1))
        out[1:-1, 1:-1] = np.clip(9 * g[1:-1, 1:-1] - around, 0, 255)
    return float(min(1.0, out.var() / 500.0))


def blur_region(image: np.ndarray, x: int, y: int, w: int, h: int) -> np.ndarray:
    """The picture with a box-blurred region; a region without pixels changes nothing."""
    x1, y1, x2, y2 = max(x, 0), max(y, 0), min(x + w, image.shape[1]), min(y + h, image.shape[0])
    out = image.copy()
    if x2 <= x1 or y2 <= y1:
        return out
    k = max(31, int(max(x2 - x1, y2 - y1) * 0.4) | 1)
    part = image[y1:y2, x1:x2].astype(float)
    for axis in (0, 1):
        pad = [(k // 2, k // 2) if a == axis else (0, 0) for a in range(3)]
        total = np.cumsum(np.pad(part, pad, mode="edge"), axis=axis)
        zero = np.zeros_like(np.take(total, [0], axis=axis))
        total = np.concatenate([zero, total], axis=axis)
        n = part.shape[axis]
        part = (np.take(total, np.arange(n) + k, axis=axis) - np.take(total, np.arange(n), axis=axis)) / k
    out[y1:y2, x1:x2] = np.rint(part)
    return out


@F.pandas_udf(T.DoubleType())
def blur_score(image: pd.DataFrame) -> pd.Series:
    return pd.Series([laplacian_variance(grey(pixels(r.width, r.height, r.channels, r.data))) for r in image.itertuples()])


@F.pandas_udf(T.DoubleType())
def crop_sharpness(image: pd.DataFrame) -> pd.Series:
    return pd.Series([edge_sharpness(grey(pixels(r.width, r.height, r.channels, r.data))) for r in image.itertuples()])


@F.pandas_udf(T.BinaryType())
def blurred(image: pd.DataFrame, box: pd.DataFrame) -> pd.Series:
    done = (
        blur_region(pixels(r.width, r.height, r.channels, r.data), b.x, b.y, b.w, b.h).tobytes()
        for r, b in zip(image.itertuples(), box.itertuples())
    )
    return pd.Series(list(done))


@F.pandas_udf(T.BinaryType())
def mask_raster(size: pd.DataFrame, rects: pd.Series) -> pd.Series:
    """One byte a pixel, 255 inside any rectangle (x1, y1, x2, y2)."""
    out = []
    for s, own in zip(size.itertuples(), rects):
        m = np.zeros((s.height, s.width), np.uint8)
        for x1, y1, x2, y2 in own if own is not None else ():
            m[max(y1, 0) : max(y2, 0), max(x1, 0) : max(x2, 0)] = 255
        out.append(m.tobytes())
    return pd.Series(out)
