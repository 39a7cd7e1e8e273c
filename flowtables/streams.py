"""Continuous queries: the same functions over a stream, run until all that is there has been read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.tables import work_dir


def file_source(spark: SparkSession, folder: str, name: str, *, ts: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """The table `name` of a folder as a stream of files; `ts` becomes a timestamp, which watermarks need.

    `options` go to the file source: latestFirst, maxFileAge or maxFilesPerTrigger say where and how fast to read.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    stream = spark.readStream.schema(schema).options(**(options or {})).option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return stream.withColumn(ts, F.col(ts).cast("timestamp")) if ts else stream


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Give each batch of a stream to a function until what is there has been read; a later call goes on where this one ended."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def to_table(stream: DataFrame, mode: str = "append", path: str | None = None) -> DataFrame:
    """A stream's output as a table: its batches with their number in `batch`, each written once even if it is delivered again."""
    root = work_dir(stream.sparkSession, path)

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    run_available(stream, each, f"{root}/checkpoint", mode)
    return stream.sparkSession.read.schema(stream.schema.add("batch", "long")).parquet(f"{root}/out")


def latest(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The table that a stream of changed rows leads to: each key's row of the last batch."""
    rest = [c for c in changes.columns if c not in (*keys, "batch")]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("__last")).select(*keys, "__last.*")


def guarded(each: Callable[[DataFrame, int], None], on_error: Callable[[Exception, int], bool] | None = None) -> Callable[[DataFrame, int], None]:
    """A batch function whose errors go to `on_error`: true goes on with the next batch, false stops; without a handler an error stops."""

    def run(batch: DataFrame, number: int) -> None:
        try:
            each(batch, number)
        except Exception as error:
            if on_error is None or not on_error(error, number):
                raise

    return run


def fan_out(outputs: dict[str, Callable[[DataFrame], DataFrame]], root: str) -> Callable[[DataFrame, int], None]:
    """A batch function that reads a batch once and writes several streams of it, each to its own table below `root`."""

    def run(batch: DataFrame, number: int) -> None:
        batch.persist()
        for name, fn in outputs.items():
            fn(batch).write.mode("overwrite").parquet(f"{root}/{name}/batch={number}")
        batch.unpersist()

    return run


def within(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, bound: str) -> DataFrame:
    """Pairs of equal keys where the right row is not before the left one and at most `bound` after it; as streams both need watermarks, and the state stays bounded."""
    near = (F.col(right_ts) >= F.col(left_ts)) & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"interval {bound}"))
    return left.join(right.withColumnRenamed(key, f"__{key}"), (F.col(key) == F.col(f"__{key}")) & near).drop(f"__{key}")


def as_of(df: DataFrame, ts: str, time) -> DataFrame:
    """The rows known at a time."""
    return df.where(F.col(ts) <= F.lit(time))


def replay(df: DataFrame, ts: str, begin, end) -> DataFrame:
    """The rows from `begin` up to but without `end`."""
    return df.where((F.col(ts) >= F.lit(begin)) & (F.col(ts) < F.lit(end)))
