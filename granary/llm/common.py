"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.session import shared_path

#: Texts are worked on in slices of about so many bytes, whatever the size of an Arrow batch.
SLICE_BYTES = 8 << 20
#: Rows of a small Arrow batch.
SMALL_ROWS = 1000
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder_uri(spark: SparkSession, label: str) -> str:
    """A new folder of the shared storage, as a URI that tasks can open."""
    path = shared_path(spark, label)
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path.removeprefix("file:")
    return path if "://" in path else f"file://{path}"


@contextmanager
def small_batches(spark: SparkSession, rows: int = SMALL_ROWS) -> Iterator[None]:
    """Jobs inside send at most ``rows`` rows to Python at a time: long texts make large batches, held on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def exact(key: str) -> list[Column]:
    """A long column for pandas batches: ``key`` with 0 for null, and ``key_known``.

    A long column with a null would reach pandas as floats, which round what is above 2**53.
    """
    return [F.coalesce(F.col(key), F.lit(0)).alias(key), F.col(key).isNotNull().alias(f"{key}_known")]


def longs(values: Iterable[int | None]) -> pd.api.extensions.ExtensionArray:
    """Whole numbers and None as a column that keeps them as they are."""
    return pd.array(np.array([*values, None], object)[:-1], dtype="Int64")


def known_longs(batch: pd.DataFrame, key: str) -> pd.api.extensions.ExtensionArray:
    """The column of :func:`exact`, with its nulls."""
    out = pd.array(batch[key].to_numpy(np.int64), dtype="Int64")
    out[~batch[f"{key}_known"].to_numpy(bool)] = pd.NA
    return out


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 of an Arrow string array; null is empty."""
    return [b"" if t is None else t for t in texts.cast(pa.large_binary()).to_pylist()]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of ``texts`` of at most ``limit`` bytes, or of one text."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    start = 0
    while start < len(lengths):
        stop = start + max(1, int(np.searchsorted(np.cumsum(lengths[start:]), limit, side="right")))
        yield texts.slice(start, stop - start)
        start = stop


def concat(parts: Iterable[pa.Array], kind: pa.DataType) -> pa.Array:
    found = list(parts)
    return pa.concat_arrays(found) if found else pa.array([], kind)


def released() -> None:
    """Hand the memory of what a task has dropped back to the system: its worker lives on through later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)
