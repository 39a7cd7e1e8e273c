"""Plain writes, encoding, partition transforms, compaction, schema evolution; tables with versions, upserts and batches that count once are in `commits`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def without_repeats(df: DataFrame, keys: list[str], watermarked: bool = False) -> DataFrame:
    """One row per key; on a stream with a watermark the state is bounded by it."""
    return df.dropDuplicatesWithinWatermark(keys) if watermarked else df.dropDuplicates(keys)


def encode(df: DataFrame, form: str) -> DataFrame:
    """The rows as messages in one column `value`: json or csv."""
    if form not in ("json", "csv"):
        raise ValueError(f"unknown format {form}")
    row = F.struct(*df.columns)
    return df.select((F.to_json(row) if form == "json" else F.to_csv(row)).alias("value"))


def days(ts: str) -> Column:
    return F.date_trunc("day", F.col(ts))


def hours(ts: str) -> Column:
    return F.date_trunc("hour", F.col(ts))


def bucket(col: str, n: int) -> Column:
    """A bucket from the value's MD5, the same in every system."""
    return (F.conv(F.substring(F.md5(F.col(col).cast("string")), 1, 8), 16, 10).cast("long") % n).cast("int")


def truncate(col: str, width: int, text: bool = False) -> Column:
    """The first `width` characters of a text, or the next lower multiple of `width`."""
    return F.substring(col, 1, width) if text else F.floor(F.col(col) / width) * width


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Rewrite a table of many small files; the engine sizes the new ones by bytes."""
    spark.read.parquet(path).hint("rebalance").write.parquet(target)


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both versions of a table; columns that one lacks are null in its rows."""
    return old.unionByName(new, allowMissingColumns=True)
