"""Edit distance with adjacent transpositions, on batches of pairs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _codes(texts: pd.Series, width: int) -> np.ndarray:
    table = np.zeros((len(texts), width), dtype=np.int32)
    for i, t in enumerate(texts):
        if t:
            table[i, : len(t)] = np.frombuffer(t.encode("utf-32-le"), dtype=np.int32)
    return table


def edit_distances(left: pd.Series, right: pd.Series) -> np.ndarray:
    """Insertions, deletions, substitutions and swaps of neighbours, all pairs of a batch at once."""
    n = len(left)
    if n == 0:
        return np.zeros(0, dtype=np.int32)
    la, lb = left.str.len().to_numpy(), right.str.len().to_numpy()
    wa, wb = int(la.max()), int(lb.max())
    # a row for each place and a column for each pair, so that a step reads and writes whole rows
    a, b = np.ascontiguousarray(_codes(left, wa).T), np.ascontiguousarray(_codes(right, wb).T)
    result = np.where(la == 0, lb, 0).astype(np.int32)
    two_back = None
    previous = np.repeat(np.arange(wb + 1, dtype=np.int32)[:, None], n, axis=1)
    for i in range(1, wa + 1):
        current = np.empty_like(previous)
        current[0] = i
        for j in range(1, wb + 1):
            best = np.minimum(np.minimum(previous[j], current[j - 1]) + 1, previous[j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1:
                swap = (a[i - 1] == b[j - 2]) & (a[i - 2] == b[j - 1])
                best = np.where(swap, np.minimum(best, two_back[j - 2] + 1), best)
            current[j] = best
        done = np.flatnonzero(la == i)
        result[done] = current[lb[done], done]
        two_back, previous = previous, current
    return result


@F.pandas_udf(T.IntegerType())
def edit_distance(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(edit_distances(left, right))
