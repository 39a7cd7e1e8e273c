"""Counters of sources, streams and pipelines as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counters(df: DataFrame, name: str, ts: str, delay: str) -> DataFrame:
    """name, events and watermark (latest time less the delay) of each source or stream."""
    return df.groupBy(name).agg(F.count("*").alias("events"), (F.max(ts) - F.expr(f"interval {delay}")).alias("watermark"))


def pipeline(rows: DataFrame, ts: str, batch: Column) -> DataFrame:
    """One row of totals over rows marked `late`: ingested, emitted, dropped, batches, and the latest time as watermark."""
    return rows.agg(F.count("*").alias("ingested"), F.count_if(~F.col("late")).alias("emitted"), F.count_if(F.col("late")).alias("dropped"), F.count_distinct(batch).alias("batches"), F.max(ts).alias("watermark"))


def throughput(df: DataFrame, name: str, ts: str) -> DataFrame:
    """name and events_per_second over the span of its times; 0 where it has no length."""
    span = (F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))) / 1e6
    rows = df.groupBy(name).agg(F.count("*").alias("events"), span.alias("__s"))
    return rows.select(name, "events", F.when(F.col("__s") > 0, F.col("events") / F.col("__s")).otherwise(0.0).alias("events_per_second"))
