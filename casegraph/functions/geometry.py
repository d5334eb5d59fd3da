"""Functions on rings of coordinates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType


def thin(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Places of the points that a line keeps: the farthest from each chord, while beyond the tolerance."""
    keep = np.zeros(len(points), bool)
    if len(points):
        keep[[0, -1]] = True
    todo = [(0, len(points) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        chord, rest = points[b] - points[a], points[a + 1 : b] - points[a]
        length = np.hypot(*chord)
        far = np.abs(chord[0] * rest[:, 1] - chord[1] * rest[:, 0]) / length if length else np.hypot(rest[:, 0], rest[:, 1])
        k = int(np.argmax(far))
        if far[k] > tolerance:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return np.flatnonzero(keep)


def simplify(tolerance: float = 0.002):
    """A vectorised function on arrays of [lng, lat]."""

    @F.pandas_udf(ArrayType(ArrayType(DoubleType())))
    def run(rings: pd.Series) -> pd.Series:
        return rings.map(lambda r: None if r is None else (p := np.array([list(x) for x in r], float).reshape(-1, 2))[thin(p, tolerance)].tolist())

    return run
