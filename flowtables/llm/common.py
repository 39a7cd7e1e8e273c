"""Helpers the operators share: text as bytes, word hashes, link components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.tables import cut, drop_path, work_dir

SLICE_BYTES = 1 << 20


def _random_words(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, n, dtype=np.uint64)


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_WORDS = _random_words(256, 11)
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A text or binary column as one byte array and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column.cast(pa.large_binary() if binary else pa.large_string()), b"" if binary else "")
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each slice holds about `limit` bytes of text, or one row."""
    for batch in batches:
        ends = utf8(batch.column(text))[1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def word_hashes(raw: np.ndarray, ends: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the white-space separated words (A-Z lower-cased) and the row offsets into them."""
    buf = LOWER[raw] if lower else raw
    solid = ~SPACE[buf]
    starts = solid.copy()
    if len(buf):
        starts[1:] &= ~solid[:-1]
        first = ends[:-1][ends[:-1] < ends[1:]]
        starts[first] = solid[first]
    begin = np.flatnonzero(starts)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    idx = np.flatnonzero(solid)
    at = np.flatnonzero(starts[idx])
    pos = idx - np.repeat(begin, np.diff(np.append(at, len(idx))))
    powers = np.full(int(pos.max()) + 1, ODD, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    return mix(np.add.reduceat(BYTE_WORDS[buf[idx]] * powers[pos], at)), np.searchsorted(begin, ends)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; of the whole sequence where it is shorter."""
    n = len(words)
    k = min(k, n)
    if not n:
        return words
    out = mix(words[: n - k + 1] + np.uint64(k))
    for j in range(1, k):
        out = mix(out * ODD + words[j : n - k + 1 + j])
    return out


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component) for every id in `links`: component is the smallest id it is connected to.

    Alternates large-star and small-star steps on the link table, each one a shuffle by id with
    a partial minimum, until every link leads straight to a least id; the number of rounds grows with the logarithm of the
    longest chain. Nothing but a row count reaches the driver. Links with a null end and self-links say nothing and are dropped.
    """
    spark = links.sparkSession
    hi, lo = F.greatest(a, b), F.least(a, b)
    path = work_dir(spark)
    links.where(F.col(a) != F.col(b)).select(hi.alias("u"), lo.alias("v")).distinct().write.parquet(path)
    edges = spark.read.schema("u long, v long").parquet(path)

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else pairs
        # written, so that the join below shuffles both sides itself and a vertex with very many links can be split
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        joined = both.join(least, "u")
        if large:
            return joined.where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        return joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.where("u != m").select("u", F.col("m").alias("v"))).distinct()

    def open_ends(pairs: DataFrame) -> int:
        """Vertices with two smaller neighbours, or with a smaller and a larger one; without any, all links lead to a component's least id."""
        ends = pairs.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(pairs.select(F.col("v").alias("x"), F.lit(0), F.lit(1)))
        return ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or (down = 1 and up = 1)").count()

    while open_ends(edges):
        to = work_dir(spark)
        star(star(edges, True), False).write.parquet(to)
        drop_path(spark, path)
        path, edges = to, spark.read.schema("u long, v long").parquet(to)
    tops = edges.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id").union(tops)
