"""Aggregates that the caller writes: accumulate rows, merge states, evaluate.

Tasks accumulate their rows into one state a key, Arrow batch by Arrow batch; only states are shuffled, and they are merged as a stream of sorted
rows, a thousand parts of a key at a time and then these, so neither a key's rows nor its states meet in memory.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType

from flowtables.ordered import positions

#: Parts of a key that one task merges at the first level, and states that a task holds before it puts them out.
FAN, MOST_STATES = 1000, 10_000


@dataclass(frozen=True)
class Aggregate:
    """`zero()` is the state of no rows, `accumulate(state, rows)` adds a pyarrow table of some rows of a group, with `columns`, `merge(a, b)` is associative
    and has b's rows after a's, `evaluate(state)` is the value, of the Spark type `kind`, or None. States must be picklable."""

    columns: tuple[str, ...]
    zero: Callable[[], object]
    accumulate: Callable[[object, pa.Table], object]
    merge: Callable[[object, object], object]
    evaluate: Callable[[object], object]
    kind: str


def aggregate(df: DataFrame, keys: Sequence[str], aggs: dict[str, Aggregate], *, order: Sequence[str] | None = None, slot: Column | None = None, block: int = 10_000) -> DataFrame:
    """The keys and a column for each of `aggs`, a row per key; null is a key, no keys make one group, an empty table gives no rows.

    Without `order` the states of a group are merged in any order. With `order`, a total order of a key's rows (nulls last) and a coarse `slot` that
    never falls along it, rows come to `accumulate` in that order and states are merged in it. Keys of floating point are an error.
    Names that begin with __ are not for columns.
    """
    if floats := [f.name for f in df.schema if f.name in keys and isinstance(f.dataType, FloatType | DoubleType)]:
        raise ValueError(f"keys of floating point: {', '.join(floats)}")
    if order is not None and slot is None:
        raise ValueError("an order needs a slot")
    names = [f"__key{i}" for i in range(max(1, len(keys)))]
    given = [F.col(k).alias(n) for k, n in zip(keys, names)] or [F.lit(0).alias(*names)]
    used = list(dict.fromkeys(c for a in aggs.values() for c in a.columns))
    if order is None:
        rows, groups = df.select(*given, *used), names
    else:
        placed = positions(df.select(*given, "*"), names, order, slot, out="__pos")
        blocks = placed.select(*names, F.floor(F.col("__pos") / block).alias("__block"), "__pos", *used)
        rows, groups = blocks.repartition(*names, "__block").sortWithinPartitions(*names, "__block", "__pos"), [*names, "__block"]
    key_fields = [rows.schema[n] for n in names]
    parts = StructType([*key_fields, *StructType.fromDDL("__at long, __seq long, __state binary")])
    todo = list(aggs.values())
    states = rows.mapInArrow(_accumulating(groups, names, todo, to_arrow_schema(parts)), parts)
    near = states.withColumn("__part", F.floor(F.col("__at") / FAN)).repartition(*names, "__part").sortWithinPartitions(*names, "__part", "__at", "__seq")
    merged = near.mapInArrow(_merging([*names, "__part"], names, todo, to_arrow_schema(parts), False), parts)
    done = StructType([*key_fields, *[StructField(n, StructType.fromDDL(f"x {a.kind}")["x"].dataType) for n, a in aggs.items()]])
    last = merged.repartition(*names).sortWithinPartitions(*names, "__at", "__seq")
    out = last.mapInArrow(_merging(names, names, todo, to_arrow_schema(done), True), done)
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], *aggs)


def _groups(table: pa.Table, keys: Sequence[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Each key of a batch with its rows in the order that they have there."""
    code = np.zeros(len(table), dtype=np.int64)
    for k in keys:
        column = table.column(k).combine_chunks()
        encoded = (column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)).dictionary_encode(null_encoding="encode")
        code = np.unique(code * len(encoded.dictionary) + encoded.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    by = np.argsort(code, kind="stable")
    table, code = table.take(pa.array(by)), code[by]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], len(code)]):
        yield tuple(table.column(k)[int(a)].as_py() for k in keys), table.slice(a, b - a)


def _accumulating(groups: list[str], names: list[str], aggs: list[Aggregate], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq, held = TaskContext.get().partitionId(), 0, {}

        def out():
            made = [(*key[: len(names)], key[-1] if len(groups) > len(names) else task, seq, pickle.dumps(s)) for key, s in held.items()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), schema.types)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            for key, rows in _groups(pa.Table.from_batches([batch]), groups):
                states = held.get(key) or [a.zero() for a in aggs]
                held[key] = [a.accumulate(s, rows.select(list(a.columns))) for a, s in zip(aggs, states)]
            if len(held) >= MOST_STATES:
                yield out()
                seq, held = seq + 1, {}
        if held:
            yield out()

    return run


def _merging(groups: list[str], names: list[str], aggs: list[Aggregate], schema: pa.Schema, last: bool):
    """States that come sorted by group and place, merged; in the end their values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, at, states = [], None, None

        def close():
            rest = [a.evaluate(s) for a, s in zip(aggs, states)] if last else [at[-1], 0, pickle.dumps(states)]
            made.append((*at[: len(names)], *rest))

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), schema.types)], schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                key, came = tuple(row[g] for g in groups), pickle.loads(row["__state"])
                if key == at:
                    states = [a.merge(x, y) for a, x, y in zip(aggs, states, came)]
                    continue
                if at is not None:
                    close()
                at, states = key, came
            if len(made) >= MOST_STATES:
                yield out()
                made.clear()
        if at is not None:
            close()
        if made:
            yield out()

    return run


def _numbers(rows: pa.Table, column: str) -> np.ndarray:
    """The column's numbers without nulls."""
    return rows.column(column).drop_null().to_numpy().astype(float)


def mean(column: str) -> Aggregate:
    """The average; None without values."""
    add = lambda s, v: (s[0] + float(v.sum()), s[1] + len(v))
    return Aggregate((column,), lambda: (0.0, 0), lambda s, rows: add(s, _numbers(rows, column)), lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda s: s[0] / s[1] if s[1] else None, "double")


def ema(column: str, alpha: float) -> Aggregate:
    """The exponential moving average after the last value, begun with the first; needs an order. Nulls are passed over.

    The state is the number of values, the first, and what they add: a step v, e -> alpha v + (1 - alpha) e, and steps compose.
    """
    keep = 1 - alpha

    def accumulate(state, rows):
        v = _numbers(rows, column)
        return merge(state, (len(v), float(v[0]), float((alpha * v * keep ** np.arange(len(v) - 1, -1, -1)).sum()))) if len(v) else state

    def merge(a, b):
        return b if not a[0] else a if not b[0] else (a[0] + b[0], a[1], a[2] * keep ** b[0] + b[2])

    return Aggregate((column,), lambda: (0, None, 0.0), accumulate, merge, lambda s: s[2] + keep ** s[0] * s[1] if s[0] else None, "double")


def quantile(column: str, share: float, error: float = 0.01) -> Aggregate:
    """A quantile within a relative `error`, of any number of values: they are counted in buckets whose bounds grow by a constant factor.

    The state has a count for each bucket that has values, some 75,000 at most for all doubles at the given error, and merging is exact. Nulls and NaN are passed over.
    """
    step = np.log((1 + error) / (1 - error))

    def accumulate(state, rows):
        v = _numbers(rows, column)
        v = v[~np.isnan(v)]
        with np.errstate(divide="ignore", invalid="ignore"):
            buckets = np.where(v == 0, 0, np.sign(v) * np.ceil(np.log(np.abs(v)) / step))
        numbers, counts = np.unique(np.stack([np.sign(v), buckets], axis=1), axis=0, return_counts=True)
        return state + Counter({tuple(b): int(n) for b, n in zip(numbers.tolist(), counts)})

    def evaluate(state):
        left = share * (sum(state.values()) - 1)
        for (sign, number), n in sorted(state.items()):
            left -= n
            if left < 0:
                with np.errstate(over="ignore"):
                    return float(sign * np.exp(sign * number * step) * (1 - error)) if sign else 0.0
        return None

    return Aggregate((column,), Counter, accumulate, lambda a, b: a + b, evaluate, "double")
