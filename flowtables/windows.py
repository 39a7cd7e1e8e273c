"""Time windows over an event-time column: tumbling, hopping and session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def micros(interval: str) -> int:
    """The length of `5 seconds`, `1 minute` or `'5' SECOND` in microseconds; anything else raises ValueError."""
    number, _, unit = interval.replace("'", "").strip().partition(" ")
    unit = unit.strip().lower().removesuffix("s")
    if unit not in UNITS or not number.isdigit() or not int(number):
        raise ValueError(f"no interval: {interval}")
    return int(number) * UNITS[unit]


def _spelt(interval: str) -> str:
    return f"{micros(interval)} microseconds"


def _interval(length: int) -> Column:
    return F.expr(f"interval '{length // 1_000_000}.{length % 1_000_000:06d}' second")


def _named(grouped: DataFrame, keys: Sequence[str]) -> DataFrame:
    return grouped.select(*keys, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *[c for c in grouped.columns if c not in ("__w", *keys)])


def end_of(ts: str, size: str) -> Column:
    """When the tumbling window of a row ends; null without a time (a bare window expression would drop such rows)."""
    there = F.coalesce(F.col(ts), F.expr("timestamp_ntz'1970-01-01'"))
    return F.when(F.col(ts).isNotNull(), F.window(there, _spelt(size))["end"])


def tumble(df: DataFrame, ts: str, *, size: str, keys: Sequence[str] = (), aggs: Sequence[Column]) -> DataFrame:
    """Aggregates per key and window of `size`; windows start at multiples of `size` since the epoch.

    A row on a window's end belongs to the next window; rows without a time are left out; windows without rows give none.
    """
    return _named(df.where(F.col(ts).isNotNull()).groupBy(F.window(ts, _spelt(size)).alias("__w"), *keys).agg(*aggs), keys)


def tumble_millis(df: DataFrame, millis: str, *, size_ms: int, keys: Sequence[str] = (), aggs: Sequence[Column]) -> DataFrame:
    """`tumble` over an epoch-millisecond column; windows of negative times start below zero too."""
    start = F.floor(F.col(millis) / size_ms).cast("long") * size_ms
    grouped = df.where(F.col(millis).isNotNull()).groupBy(*keys, start.alias("window_start")).agg(*aggs)
    return grouped.withColumn("window_end", F.col("window_start") + size_ms)


def hop(df: DataFrame, ts: str, *, size: str, slide: str, keys: Sequence[str] = (), value: str) -> DataFrame:
    """n, total, low and high of `value` per key and window of `size`, a window starting every `slide`.

    Rows are first brought down to panes of `slide` (which must divide `size`), and the panes, not the rows, are copied
    into the windows that they lie in.
    """
    if micros(size) % micros(slide):
        raise ValueError("the slide must divide the size")
    panes = tumble(df, ts, size=slide, keys=keys, aggs=[F.count(value).alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high")])
    steps = micros(size) // micros(slide)
    starts = F.array(*[F.col("window_start") - _interval(k * micros(slide)) for k in range(steps)])
    copied = panes.withColumn("window_start", F.explode(starts))
    out = copied.groupBy(*keys, "window_start").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))
    return out.withColumn("window_end", F.col("window_start") + _interval(micros(size)))


def session(df: DataFrame, ts: str, *, gap: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Aggregates per key and session: rows at most `gap` apart (inclusive) are one session, which ends `gap` after its last row.

    One key's sessions are built in one task, so the keys must be fine-grained.
    """
    return _named(df.where(F.col(ts).isNotNull()).groupBy(F.session_window(ts, _spelt(gap)).alias("__w"), *keys).agg(*aggs), keys)
