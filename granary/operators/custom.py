"""Aggregates of the user's own: a state that rows change and that merges with other states.

Every task puts its rows in order of the groups, folds them into a state for each and hands on the states, not
the rows; those of a group meet behind one shuffle and stream by, merged one after the other.
A key that holds much of the table is a state for each task, whatever its rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Groups that a task holds at a time; then it hands on what it has and starts afresh.
HELD = 20_000


@dataclass(frozen=True)
class Aggregator:
    """``update`` takes a state and the group's rows of a batch, an array for each column.

    ``merge`` must not depend on the order or grouping of states; ``finish`` gives the fields of
    ``returns``, a schema in DDL.
    """

    zero: Callable[[], Any]
    update: Callable[[Any, dict[str, np.ndarray]], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], dict]
    returns: str


def _groups(batch: pa.RecordBatch, keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each group of a batch, and the group of each row."""
    code = np.zeros(batch.num_rows, np.int64)
    for key in keys:
        column = pc.dictionary_encode(batch.column(key))
        code = code * (len(column.dictionary) + 1) + column.indices.to_numpy(zero_copy_only=False)
        code = np.unique(code, return_inverse=True)[1]
    return np.unique(code, return_index=True, return_inverse=True)[1:]


def aggregate(df: DataFrame, keys: Sequence[str], columns: Sequence[str], aggregator: Aggregator) -> DataFrame:
    """Group by ``keys`` and apply ``aggregator`` to ``columns``.

    Rows with a missing key are left out; a row with a null in one of the columns changes no
    state, and a group of only such rows has the result of the zero state.
    """
    keys, columns = list(keys), list(columns)
    key_fields = [df.schema[k] for k in keys]
    states = T.StructType([*key_fields, T.StructField("_state", T.BinaryType())])
    fields = T.StructType.fromDDL(aggregator.returns).fields
    result = T.StructType([*key_fields, *fields])
    state_schema, result_schema = to_arrow_schema(states), to_arrow_schema(result)

    def handed(held: dict) -> pa.RecordBatch:
        rows = [[k[i] for k in held] for i in range(len(keys))] + [[pickle.dumps(s) for s in held.values()]]
        return pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, state_schema)], schema=state_schema)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Any] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            first, group = _groups(batch, keys)
            names = list(zip(*[batch.column(k).take(pa.array(first)).to_pylist() for k in keys])) if keys else [()]
            whole = np.ones(batch.num_rows, bool)
            for c in columns:
                whole &= batch.column(c).is_valid().to_numpy(zero_copy_only=False)
            # null rows are gone before the values leave Arrow, so whole numbers stay whole
            kept = batch.filter(pa.array(whole))
            order = np.argsort(group[whole], kind="stable")
            cuts = np.searchsorted(group[whole][order], np.arange(len(names) + 1))
            values = {c: kept.column(c).to_numpy(zero_copy_only=False)[order] for c in columns}
            for name, a, b in zip(names, cuts, cuts[1:]):
                state = held[name] if name in held else aggregator.zero()
                held[name] = aggregator.update(state, {c: v[a:b] for c, v in values.items()}) if a < b else state
            if len(held) >= HELD:
                yield handed(held)
                held = {}
        if held:
            yield handed(held)

    def finished(done: list[tuple]) -> pa.RecordBatch:
        rows = [[k[i] for k, _ in done] for i in range(len(keys))]
        found = [aggregator.finish(s) for _, s in done]
        rows += [[x[f.name] for x in found] for f in fields]
        return pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, result_schema)], schema=result_schema)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for batch in batches:
            for *key, raw in zip(*[c.to_pylist() for c in batch.columns]):
                if tuple(key) != now:
                    if now is not None:
                        done.append((now, state))
                    now, state = tuple(key), pickle.loads(raw)
                else:
                    state = aggregator.merge(state, pickle.loads(raw))
            if len(done) >= HELD:
                yield finished(done)
                done = []
        if now is not None:
            done.append((now, state))
        if done:
            yield finished(done)

    rows = df.select(*keys, *columns).dropna(subset=keys) if keys else df.select(*columns)
    # in order, a group is folded once a batch and not a row or two at a time
    partial = (rows.sortWithinPartitions(*keys) if keys else rows).mapInArrow(folded, states)
    dealt = partial.repartition(*keys).sortWithinPartitions(*keys) if keys else partial.coalesce(1)
    return dealt.mapInArrow(merged, result)


#: Leading binary digits that a bucket of values keeps.
DIGITS = 6


def weighted_quantiles(value: str, weight: str, percents: Sequence[int]) -> Aggregator:
    """Quantiles of whole numbers from 0 under whole weights, to within one part in 2 ** DIGITS.

    The state counts weights in buckets of values with equal leading digits; it has at most some
    64 * 2 ** DIGITS of them, and merging adds them up, so the result depends on no order.
    """

    def update(state: dict, rows: dict[str, np.ndarray]) -> dict:
        values = rows[value].astype(np.int64)
        shift = np.maximum(np.frexp(values.astype(np.float64))[1] - DIGITS, 0)
        shift -= (shift > 0) & ((values >> np.minimum(shift + DIGITS - 1, 63)) == 0)  # rounded up to the next power of two
        low, at = np.unique((values >> shift) << shift, return_inverse=True)
        sums = np.bincount(at, weights=rows[weight])
        for bucket, total in zip(low.tolist(), sums.tolist()):
            state[bucket] = state.get(bucket, 0) + int(total)
        return state

    def merge(a: dict, b: dict) -> dict:
        for bucket, total in b.items():
            a[bucket] = a.get(bucket, 0) + total
        return a

    def finish(state: dict) -> dict:
        total, out, running = sum(state.values()), {f"p{p}": None for p in percents}, 0
        for bucket in sorted(state):
            running += state[bucket]
            width = 1 << max(bucket.bit_length() - DIGITS, 0)
            for p in percents:
                if out[f"p{p}"] is None and running * 100 >= p * total and running > 0:
                    out[f"p{p}"] = bucket + width / 2 if width > 1 else float(bucket)
        return {"weight": total, **out}

    returns = "weight BIGINT, " + ", ".join(f"p{p} DOUBLE" for p in percents)
    return Aggregator(dict, update, merge, finish, returns)


def peak_to_peak(value: str) -> Aggregator:
    """Largest less smallest value of a group."""
    return Aggregator(
        zero=lambda: None,
        update=lambda s, rows: _spread(s, (rows[value].min(), rows[value].max())),
        merge=_spread,
        finish=lambda s: {"ptp": None if s is None else float(s[1] - s[0])},
        returns="ptp DOUBLE",
    )


def _spread(a, b):
    if a is None or b is None:
        return b if a is None else a
    return min(a[0], b[0]), max(a[1], b[1])
