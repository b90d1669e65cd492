"""Vectors as arrays, and the reference points of the two pivot indexes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str = "embedding") -> Column:
    """Whether a vector is given, not empty and has finite components only."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(column) > 0) & ~bad, F.lit(False))


def flat_lists(column: pa.ListArray) -> list[np.ndarray]:
    """A list column of lists of numbers: the matrix of each row; the lists of a row have equal lengths."""
    outer = column.offsets.to_numpy()
    inner = column.values.offsets.to_numpy()
    flat = column.values.values.to_numpy(zero_copy_only=False)
    rows = []
    for a, b in zip(outer[:-1].tolist(), outer[1:].tolist(), strict=True):
        part = flat[inner[a] : inner[b]]
        rows.append(part.reshape(b - a, -1) if b > a else part.reshape(0, 0))
    return rows


def lists(column: pa.ListArray) -> list[np.ndarray]:
    """A list column of numbers as one array per row."""
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def padded(rows: list, width: int) -> np.ndarray:
    """Vectors of any length as rows of ``width`` numbers, filled up with zeros."""
    if all(len(r) == width for r in rows):
        return np.asarray(rows, dtype=np.float64).reshape(len(rows), width)
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        k = min(width, len(r))
        out[i, :k] = r[:k]
    return out


def pivot_count(rows: int, least: int = 64, most: int = 4096) -> int:
    """Reference points for ``rows`` vectors: their number grows with the root, so lists and distances stay in balance."""
    return int(min(most, max(least, 2 * rows**0.5)))


def choose_pivots(vectors: DataFrame, count: int, column: str = "embedding", unit: bool = False) -> np.ndarray:
    """At most ``count`` reference points, spread out: a bounded sample, of which the farthest from those chosen so far are taken.

    The sample is three times as large and chosen by the hash of the components; ``unit`` compares directions. A crowded
    spot so gets one reference point and not many that its vectors could hardly tell apart.
    """
    picked = vectors.select(column, F.xxhash64(column).alias("h")).distinct().orderBy("h").limit(3 * count).collect()
    width = max((len(r[0]) for r in picked), default=0)
    sample = padded([r[0] for r in picked], width)
    if unit:
        sample = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    if not len(sample):
        return sample
    squares = (sample**2).sum(axis=1)
    distance, chosen = np.full(len(sample), np.inf), [0]
    while len(chosen) < min(count, len(sample)):
        last = sample[chosen[-1]]
        distance = np.minimum(distance, squares - 2 * sample @ last + last @ last)
        chosen.append(int(distance.argmax()))
    return sample[chosen]
