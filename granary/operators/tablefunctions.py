"""Table functions: one row to many, over a whole table or over the ordered rows of each key.

They take Arrow batches as they come and hand on batches, so a key's rows stream by: what is
held is what the function looks back on, never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def overlapping_pairs(df: DataFrame, id_col: str, text: str, token: str = r"\S+") -> DataFrame:
    """(id, position, first, second) of each token and the one behind it; the matches overlap by look-ahead.

    Tokens are runs of ``token`` between white space; positions count from 1. A null text has none.
    """
    field = df.schema[id_col]
    pair = regex.compile(rf"(?<!\S)({token})(?=\s+({token})(?!\S))")
    schema = pa.schema([(id_col, to_arrow_type(field.dataType)), ("position", pa.int32()), ("first", pa.string()), ("second", pa.string())])

    @F.arrow_udtf(returnType=T.StructType([field, *T.StructType.fromDDL("position INT, first STRING, second STRING").fields]))
    class Pairs:
        def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
            owner, place, first, second = [], [], [], []
            for k, said in enumerate(rows.column("_text").to_pylist()):
                for i, found in enumerate(pair.finditer(said or ""), 1):
                    owner.append(k)
                    place.append(i)
                    first.append(found[1])
                    second.append(found[2])
            ids = rows.column(id_col).take(pa.array(owner, pa.int64()))
            yield pa.table([ids, pa.array(place, pa.int32()), pa.array(first, pa.string()), pa.array(second, pa.string())], schema=schema)

    return Pairs(df.select(id_col, F.col(text).alias("_text")).asTable())


def follow_ups(df: DataFrame, key: str, order: str, id_col: str, horizon_seconds: int) -> DataFrame:
    """(key, id, next_id, microseconds): every row with each later one of its key within the horizon.

    Rows of a key come in the order of (time, id); only those that the next row may still reach
    are held. The result has as many rows as there are pairs, which the horizon bounds.
    """
    horizon = horizon_seconds * 1_000_000
    fields = [df.schema[key], df.schema[id_col]]
    names = (key, id_col, f"next_{id_col}", "microseconds")
    kinds = [to_arrow_type(fields[0].dataType), *[to_arrow_type(fields[1].dataType)] * 2, pa.int64()]
    result = T.StructType([T.StructField(n, t) for n, t in zip(names, (fields[0].dataType, fields[1].dataType, fields[1].dataType, T.LongType()))])

    @F.arrow_udtf(returnType=result)
    class FollowUps:
        def __init__(self):
            self.times, self.ids = np.empty(0, np.int64), None

        def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
            fresh = rows.column("_time").to_numpy(zero_copy_only=False)
            held = len(self.times)
            times = np.concatenate([self.times, fresh])
            own = rows.column(id_col)
            ids = own if self.ids is None else pa.concat_arrays([self.ids, own])
            at = np.arange(held, len(times))
            low = np.searchsorted(times, fresh - horizon)
            count = at - low
            ends = np.cumsum(count)
            later = np.repeat(at, count)
            before = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - count, count) + np.repeat(low, count)
            keys = rows.column(key).take(pa.array(later - held))
            yield pa.table([keys, ids.take(pa.array(before)), ids.take(pa.array(later)), pa.array(times[later] - times[before])], schema=pa.schema(list(zip(names, kinds))))
            if len(times):
                keep = int(np.searchsorted(times, times[-1] - horizon))
                self.times, self.ids = times[keep:], ids.slice(keep)

    timed = df.where(F.col(order).isNotNull()).select(key, id_col, F.unix_micros(F.col(order).cast("timestamp")).alias("_time"))
    return FollowUps(timed.asTable().partitionBy(key).orderBy("_time", id_col))
