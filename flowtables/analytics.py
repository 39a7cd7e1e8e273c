"""Analytic jobs over prices: rolling means, crossover signals, returns, value at risk, correlation, portfolios, alerts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from flowtables.ordered import over_rows


def rolling_mean(df: DataFrame, key: str, value: str, *, short: int = 10, long: int = 30, block: int = 10_000) -> DataFrame:
    """`df` (with `pos`) with short_mean and long_mean of the last rows of the key; null until there are as many."""

    def mean(n):
        return lambda w: F.when(F.col("pos") >= n - 1, F.sum(value).over(w.rowsBetween(1 - n, 0)) / n)

    return over_rows(df, [key], reach=max(short, long) - 1, columns={"short_mean": mean(short), "long_mean": mean(long)}, block=block)


def crossover(df: DataFrame, key: str, value: str, *, short: int = 10, long: int = 30, block: int = 10_000) -> DataFrame:
    """`df` (with `pos`, a whole-number `value`) with signal: BUY where the short mean comes above the long one, SELL where it
    falls below, else HOLD; null before the long mean's first row, HOLD on it."""
    # short mean less long mean, times short * long, in whole numbers
    gap = lambda w, back: long * F.sum(value).over(w.rowsBetween(1 - short - back, -back)) - short * F.sum(value).over(w.rowsBetween(1 - long - back, -back))
    rows = over_rows(df, [key], reach=long, columns={"__now": lambda w: gap(w, 0), "__was": lambda w: gap(w, 1)}, block=block)
    crossed = F.when((F.col("__was") <= 0) & (F.col("__now") > 0), "BUY").when((F.col("__was") >= 0) & (F.col("__now") < 0), "SELL").otherwise("HOLD")
    return rows.withColumn("signal", F.when(F.col("pos") == long - 1, "HOLD").when(F.col("pos") >= long, crossed)).drop("__now", "__was")


def _change(value: Column, before: Column) -> Column:
    """The change as a share of `before`, a double; from zero it is infinite, or NaN if nothing changed, as IEEE 754 divides."""
    return F.coalesce(F.try_divide(value - before, before), (value - before) * F.pow(before, F.lit(-1)))


def returns(df: DataFrame, key: str, value: str, block: int = 10_000) -> DataFrame:
    """`df` (with `pos`) with ret: the change from the key's row before as a share of it, infinite or NaN from zero; null for the first."""
    return over_rows(df, [key], reach=1, columns={"ret": lambda w: _change(F.col(value), F.lag(value).over(w))}, block=block)


def last_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Each key's last n rows with `back`, 1 for the last; tasks keep only n of a key before they send it on."""
    return df.withColumn("back", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("back") <= n)


def _last_returns(df: DataFrame, key: str, value: str, order: Sequence[Column], prices: int) -> DataFrame:
    rows = last_rows(df, [key], order, prices)
    before = F.lead(value).over(Window.partitionBy(key).orderBy("back"))
    return rows.withColumn("ret", _change(F.col(value), before)).where("ret is not null")


def value_at_risk(df: DataFrame, key: str, value: str, order: Sequence[Column], *, prices: int = 200, least: int = 20, share: float = 0.05) -> DataFrame:
    """key and var: the interpolated `share` percentile of the returns between the key's last `prices` prices, of which there must be `least`."""
    return _last_returns(df, key, value, order, prices).groupBy(key).agg(F.percentile("ret", share).alias("var"), F.count("*").alias("__n")).where(F.col("__n") >= least - 1).drop("__n")


def key_pairs(df: DataFrame, key: str, most: int = 1000) -> DataFrame:
    """a, b: every pair a < b of the key's values, without null. The keys are listed on the driver; more than `most` are an error, never cut."""
    found = sorted(r[0] for r in df.where(F.col(key).isNotNull()).select(key).distinct().limit(most + 1).collect())  # most + 1 values at most
    if len(found) > most:
        raise ValueError(f"{key} has more than {most} values")
    kind = df.schema[key].dataType
    return df.sparkSession.createDataFrame(list(combinations(found, 2)), StructType([StructField("a", kind), StructField("b", kind)]))


def correlations(df: DataFrame, pairs: DataFrame, key: str, value: str, order: Sequence[Column], *, prices: int = 30) -> DataFrame:
    """a, b and corr of the returns between the last `prices` prices, matched from the last on; NaN where the returns of either do not vary.

    Only the pairs of keys in `pairs` (a, b) are computed, of keys with that many prices; never all pairs of keys.
    """
    rets = _last_returns(df, key, value, order, prices)
    full = rets.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") == prices - 1).select(key)
    rets = rets.join(full, key)
    a, b = (rets.select(F.col(key).alias(x), "back", F.col("ret").alias(f"r{x}")) for x in "ab")
    # F.corr fails the whole query where one key's returns are all the same
    corr = F.try_divide(F.covar_pop("ra", "rb"), F.stddev_pop("ra") * F.stddev_pop("rb"))
    return pairs.join(a, "a").join(b, ["b", "back"]).groupBy("a", "b").agg(F.coalesce(corr, F.lit(math.nan)).alias("corr"))


def high_correlations(corr: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of `correlations` whose corr is beyond `threshold`, positive or negative; NaN is not."""
    return corr.where((F.abs("corr") > threshold) & ~F.isnan("corr"))


def portfolio(positions: DataFrame, prices: DataFrame, account: str, symbol: str) -> DataFrame:
    """account, positions, exposure (market value) and pnl (unrealised) of holdings (quantity, avg_cost); a holding without price counts but adds nothing."""
    joined = positions.join(prices.select(symbol, "price"), symbol, "left")
    worth = F.col("quantity") * F.col("price")
    return joined.groupBy(account).agg(F.count("*").alias("positions"), F.coalesce(F.sum(worth), F.lit(0.0)).alias("exposure"), F.coalesce(F.sum(worth - F.col("quantity") * F.col("avg_cost")), F.lit(0.0)).alias("pnl"))


def breaches(exposures: DataFrame, limits: DataFrame, account: str) -> DataFrame:
    """Each account's exposure and risk against its limits: BREACH where either is beyond, UNKNOWN where neither is but one has no limit or no value, else OK."""
    joined = exposures.join(limits, account, "left")
    beyond = F.coalesce(F.col("exposure") > F.col("max_notional"), F.lit(False)) | F.coalesce(F.abs("var") > F.col("max_var"), F.lit(False))
    known = F.col("exposure").isNotNull() & F.col("var").isNotNull() & F.col("max_notional").isNotNull() & F.col("max_var").isNotNull()
    return joined.withColumn("status", F.when(beyond, "BREACH").when(~known, "UNKNOWN").otherwise("OK"))


def alerts(df: DataFrame, kind: str, when: Column, ts: str, symbol: str, price: Column, volume: Column) -> DataFrame:
    """The rows that meet a condition, in the common form ts, symbol, signal, price, volume of an alert log."""
    return df.where(when).select(F.col(ts).alias("ts"), F.col(symbol).cast("string").alias("symbol"), F.lit(kind).alias("signal"), price.cast("double").alias("price"), volume.cast("double").alias("volume"))
