"""Watermarks as data: per source, for a pipeline, sent by the producer, and the rows that come too late."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.ordered import positions, running_max
from flowtables.windows import end_of


def assign(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """A stream with its event-time column and how long late rows are waited for."""
    return df.withWatermark(ts, delay)


def by_source(df: DataFrame, source: str, ts: str, delay: str) -> DataFrame:
    """source and watermark: its latest time less the delay."""
    return df.groupBy(source).agg((F.max(ts) - F.expr(f"interval {delay}")).alias("watermark"))


def of_pipeline(df: DataFrame, source: str, ts: str, delay: str) -> DataFrame:
    """The pipeline's watermark: the least of its sources'."""
    return by_source(df, source, ts, delay).agg(F.min("watermark").alias("watermark"))


def arrivals(df: DataFrame, arrival: str, tie: str, slot: int = 1000) -> DataFrame:
    """`df` with `pos`, the row's place in order of an arrival number; `slot` arrival numbers are ranked together."""
    return positions(df, [], [arrival, tie], F.floor(F.col(arrival) / slot))


def punctuated(df: DataFrame, ts: str, every: int, pos: str = "pos", block: int = 1000) -> DataFrame:
    """`df` with the watermark its producer had sent when the row came, and `late`: whether ts <= watermark.

    The producer sends the largest time so far after every `every` rows. Rows of one stretch share a watermark, so the
    running maximum goes over stretches.
    """
    rows = df.withColumn("__stretch", F.floor(F.col(pos) / every))
    tops = rows.groupBy("__stretch").agg(F.max(ts).alias("__top")).withColumnRenamed("__stretch", "__s")
    sent = running_max(tops, "__top", "watermark", "__s", block).select("__s", "watermark")
    joined = rows.join(sent, F.col("__stretch") == F.col("__s"))
    return joined.withColumn("late", F.coalesce(F.col(ts) <= F.col("watermark"), F.lit(False))).select(*df.columns, "watermark", "late")


def late_for_window(df: DataFrame, ts: str, size: str, pos: str = "pos", block: int = 1000) -> DataFrame:
    """`df` with the watermark of a delay of zero before the row, and `late`: whether the row's tumbling window was closed by it."""
    rows = running_max(df, ts, "watermark", pos, block)
    closed = end_of(ts, size) <= F.col("watermark")
    return rows.withColumn("late", F.coalesce(closed, F.lit(False)))


def lag_millis(df: DataFrame, watermark: str, reference: str) -> DataFrame:
    """How far a watermark is behind a reference time, in milliseconds."""
    return df.withColumn("lag_ms", F.unix_millis(F.col(reference).cast("timestamp")) - F.unix_millis(F.col(watermark).cast("timestamp")))


def kept_and_dropped(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows kept and dropped per key, of rows marked `late`."""
    return df.groupBy(*keys).agg(F.sum(F.when(F.col("late"), 0).otherwise(1)).alias("kept"), F.sum(F.when(F.col("late"), 1).otherwise(0)).alias("dropped"))
