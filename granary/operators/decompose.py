"""Truncated singular value decomposition of a sparse matrix kept as (row, term, weight) rows.

Subspace iteration: a table of one short vector for each term is multiplied by the matrix and
back in one sweep over blocks of rows (:mod:`granary.operators.blocks`), and made orthonormal through
the table of its inner products, which is as small as the vectors are short. Nothing on the driver
grows with rows or terms. A sweep's table goes when the next one is written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.blocks import Block, lists, packed
from granary.operators.vectors import product_matrix
from granary.session import discard, durable, is_durable

#: Columns beyond those wanted, and passes; both only sharpen the last of the wanted ones.
EXTRA, PASSES = 10, 6


def _started(terms: DataFrame, width: int) -> DataFrame:
    """A vector for each term, drawn by hashes, so that it depends on the term alone."""
    span = 1 << 20
    draw = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.pmod(F.xxhash64("term", i), F.lit(span)) / (span / 2) - 1)
    return terms.select("number", draw.alias("v"))


def _turned(vectors: DataFrame, key: str, matrix: np.ndarray) -> DataFrame:
    """Every vector times a small matrix."""
    kind = dict(vectors.dtypes)[key]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(v=list(np.stack(batch["v"].to_numpy()) @ matrix))

    return vectors.select(key, "v").mapInPandas(rows, f"`{key}` {kind}, v ARRAY<DOUBLE>")


def _whitening(products: np.ndarray) -> np.ndarray:
    """What makes vectors of these inner products orthonormal; directions they don't have are left out."""
    if not products.size:
        return np.zeros((0, 0))
    values, turns = np.linalg.eigh(products)
    kept = values > values.max(initial=0) * 1e-13
    return (turns[:, kept] / np.sqrt(values[kept]))[:, ::-1]


def truncated_svd(cells: DataFrame, id_col: str, k: int, passes: int = PASSES) -> tuple[DataFrame, DataFrame, list[float]]:
    """(scores of rows, axes of terms, singular values) of the ``k`` largest; vectors in ``v``.

    The entry of an axis that is largest in size is positive. A matrix of smaller rank has fewer.
    ``id_col`` and term must not be null, and a pair of them may stand once only.
    """
    known = cells if is_durable(cells) else durable(cells.select(id_col, "term", "weight"))
    blocks = packed(known, id_col)
    if known is not cells:
        discard(known)
    width = k + EXTRA
    axes = blocks.state(_started(blocks.terms, width), width)

    def there_and_back(block: Block, vectors: np.ndarray) -> tuple[np.ndarray, float]:
        return block.back(block.times(vectors)), 0.0

    def there(block: Block, vectors: np.ndarray) -> pa.Table:
        return pa.table({id_col: block.ids, "v": lists(block.times(vectors))})

    for left in range(passes, -1, -1):
        products = blocks.seen(axes, lambda m: m.T @ m)
        turn = _whitening(np.zeros((0, 0)) if products is None else products)
        width = turn.shape[1]
        if not width:
            none = F.array().cast("array<double>").alias("v")
            return cells.select(id_col, none).limit(0), cells.select("term", none).limit(0), []
        turned = lambda m, turn=turn: m @ turn
        if left:
            was, axes = axes, blocks.there_and_back(axes, turned, there_and_back, width)
            discard(was)
    found = durable(blocks.there(axes, turned, there, f"`{id_col}` {blocks.kind}, v ARRAY<DOUBLE>"))
    values, turns = np.linalg.eigh(product_matrix(found, "v"))
    order = np.argsort(values)[::-1][: min(k, width)]
    order = order[values[order] > values.max() * 1e-13]
    last = turn @ turns[:, order]
    axes = durable(blocks.listed(axes, lambda m: m @ last).join(blocks.terms, "number").select("term", "v"))
    largest = [F.max_by(F.get("v", F.lit(i)), F.struct(F.abs(F.get("v", F.lit(i))), "term")).alias(f"c{i}") for i in range(len(order))]
    signs = np.sign(np.array(list(axes.agg(*largest).first()), float))
    return _turned(found, id_col, turns[:, order] * signs), _turned(axes, "term", np.diag(signs)), np.sqrt(values[order]).tolist()
