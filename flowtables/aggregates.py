"""Aggregates of market-style analytics; all have partial forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.ordered import positions


def vwap(price: str, quantity: str) -> Column:
    """Volume-weighted average price; null where the volume is zero."""
    return F.try_divide(F.sum(F.col(price) * F.col(quantity)), F.sum(quantity))


def ohlc(value: str, order: Sequence[str]) -> list[Column]:
    """open, high, low and close in the given total order."""
    at = F.struct(*order)
    return [F.min_by(value, at).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"), F.max_by(value, at).alias("close")]


def histogram(df: DataFrame, key: str, value: str, bins: int = 60) -> DataFrame:
    """key, bin (from 1) and n: values counted in `bins` equal parts of the key's own range, the largest in the last bin."""
    ranges = df.groupBy(key).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    share = F.try_divide(F.col(value) - F.col("__lo"), F.col("__hi") - F.col("__lo"))
    number = F.least(F.lit(bins), F.floor(F.coalesce(share, F.lit(0.0)) * bins).cast("int") + 1)
    return df.where(F.col(value).isNotNull()).join(ranges, key).groupBy(key, number.alias("bin")).agg(F.count("*").alias("n"))


def ema(df: DataFrame, key: str, value: str, order: Sequence[str], slot: Column, alpha: float) -> DataFrame:
    """key and ema: the exponential moving average after the key's last row, begun with its first value.

    A step is v, e -> alpha * v + (1 - alpha) * e, and such steps compose: each slot of a key sums its values weighted by
    the rows after them, and the slots fold by the number of rows in later ones.
    """
    keep = 1 - alpha
    rows = positions(df, [key], order, slot).withColumn("__slot", slot)
    sizes = rows.groupBy(key, "__slot").agg(F.max("pos").alias("__last"), F.min_by(value, "pos").alias("__first"), F.min("pos").alias("__from"))
    total = Window.partitionBy(key)
    sizes = sizes.withColumn("__end", F.max("__last").over(total)).select(F.col(key).alias("__k"), F.col("__slot").alias("__s"), "__last", "__first", "__from", "__end")
    parts = rows.join(sizes, F.col(key).eqNullSafe(F.col("__k")) & F.col("__slot").eqNullSafe(F.col("__s")))
    part = F.sum(F.lit(alpha) * F.col(value) * F.pow(F.lit(keep), F.col("__last") - F.col("pos")))
    slots = parts.groupBy(key, "__slot", "__last", "__from", "__first", "__end").agg(part.alias("__part"))
    folded = F.sum(F.col("__part") * F.pow(F.lit(keep), F.col("__end") - F.col("__last")))
    start = F.max_by("__first", -F.col("__from")) * F.pow(F.lit(keep), F.max("__end") + 1)
    return slots.groupBy(key).agg((folded + start).alias("ema"))
