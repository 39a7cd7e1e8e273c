"""Row order at scale: exact positions, blocks with a halo, running maxima; no key's rows ever meet in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], slot: Column, out: str = "pos") -> DataFrame:
    """`df` with each row's place (from 0) among its key's rows in `order`.

    `slot` is a coarse value that never falls along the order, such as an hour of the time. Rows are counted by key and slot; the counts
    before a slot and the place inside it give the position. The order must be total. Nulls come last, a null slot after all others.
    """
    rows = df.withColumn("__slot", slot)
    counts = rows.groupBy(*keys, "__slot").agg(F.count("*").alias("__n"))
    # slots that are numbers are summed by level, so that not even the slots of a key meet in one task
    levels = 2 if dict(counts.dtypes)["__slot"] in ("int", "bigint") else 0
    starts = running_total(counts, keys, "__n", "__start", "__slot", levels=levels)
    inside = F.row_number().over(Window.partitionBy(*keys, "__slot").orderBy(*[F.col(c).asc_nulls_last() for c in order]))
    placed = rows.withColumn("__in", inside)
    joined = placed.join(starts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__slot").alias("__s"), "__start"), _equal(keys))
    return joined.withColumn(out, F.col("__start") + F.col("__in") - 1).select(*df.columns, out)


def _equal(keys: Sequence[str]) -> Column:
    match = F.col("__slot").eqNullSafe(F.col("__s"))
    for i, k in enumerate(keys):
        match &= F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return match


def running_total(df: DataFrame, keys: Sequence[str], value: str, out: str, pos: str, block: int = 1000, levels: int = 2) -> DataFrame:
    """`df` with the sum of `value` over the key's rows of smaller position, 0 for the first; by levels, like `running_max`. A null position is the last."""
    if not levels:
        before = Window.partitionBy(*keys).orderBy(F.col(pos).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.coalesce(F.sum(value).over(before), F.lit(0)))
    mine, carry, number, total = (f"__{x}{levels}" for x in ("block", "carry", "number", "total"))
    rows = df.withColumn(mine, F.floor(F.col(pos) / block))
    sums = rows.groupBy(*keys, mine).agg(F.sum(value).alias(total))
    carried = running_total(sums, keys, total, carry, mine, block, levels - 1)
    carried = carried.select(*[F.col(k).alias(f"{number}_{i}") for i, k in enumerate(keys)], F.col(mine).alias(number), carry)
    match = F.col(mine).eqNullSafe(F.col(number))
    for i, k in enumerate(keys):
        match &= F.col(k).eqNullSafe(F.col(f"{number}_{i}"))
    inside = F.sum(value).over(Window.partitionBy(*keys, mine).orderBy(F.col(pos).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1))
    joined = rows.withColumn("__inside", inside).join(carried, match)
    return joined.withColumn(out, F.coalesce("__inside", F.lit(0)) + F.col(carry)).select(*df.columns, out)


def over_rows(df: DataFrame, keys: Sequence[str], *, reach: int, columns: dict[str, object], pos: str = "pos", block: int = 10_000) -> DataFrame:
    """`df` with `columns` (name to a function of a window of the key's rows by position) that look at most `reach` rows back.

    Rows are dealt into blocks of `block` positions; each goes also into the later blocks that it is in reach of, and is
    dropped there once the columns are there. Any block size gives the same rows.
    """
    own = F.floor(F.col(pos) / block)
    spread = df.withColumn("__block", F.explode(F.sequence(own, F.floor((F.col(pos) + reach) / block))))
    window = Window.partitionBy(*keys, "__block").orderBy(pos)
    return spread.select("*", *[f(window).alias(name) for name, f in columns.items()]).where(own == F.col("__block")).drop("__block")


def running_max(df: DataFrame, value: str, out: str, pos: str = "pos", block: int = 1000, levels: int = 3) -> DataFrame:
    """`df` with the largest `value` of all rows of smaller position; null for the first.

    Maxima of blocks are carried along by the same step over the blocks, `levels` times, so the one window that is not
    partitioned sees a row for each block ** levels positions.
    """
    if not levels:
        return df.withColumn(out, F.max(value).over(Window.orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)))
    number, mine, top, carry = F.floor(F.col(pos) / block), f"__block{levels}", f"__top{levels}", f"__carry{levels}"
    rows = df.withColumn(mine, number)
    tops = rows.groupBy(F.col(mine).alias(f"__n{levels}")).agg(F.max(value).alias(top))
    carried = running_max(tops, top, carry, f"__n{levels}", block, levels - 1).select(f"__n{levels}", carry)
    inside = F.max(value).over(Window.partitionBy(mine).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1))
    joined = rows.withColumn("__inside", inside).join(carried, F.col(mine) == F.col(f"__n{levels}"))
    return joined.withColumn(out, F.greatest("__inside", carry)).select(*df.columns, out)
