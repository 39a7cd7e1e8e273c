"""Quality by importance resampling.

Words and word pairs are hashed into `BUCKETS` buckets. Two bag-of-buckets models are counted: one on good (target)
texts, one on all texts. A text's weight is the log of the ratio of its probabilities under the two; adding Gumbel
noise and keeping the largest sums draws texts without replacement in proportion to their weights.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import ODD, mix, slices, utf8, word_hashes
from flowtables.tables import cut

BUCKETS, SHARE, SEED = 10_000, 0.8, 42
SCORE_TYPE = "doc_id long, n_grams long, log_weight double, quality double, gumbel_key double, order_key long"


def buckets(raw: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the words and word pairs of each row, and the row of each."""
    words, at = word_hashes(raw, ends)
    row = np.repeat(np.arange(len(ends) - 1), np.diff(at))
    pair = row[1:] == row[:-1]
    both = mix(words[:-1] * ODD + words[1:])[pair]
    return (np.concatenate([words, both]) % np.uint64(size)).astype(np.int64), np.concatenate([row, row[1:][pair]])


def _counts(size: int):
    def run(batches):
        total = np.zeros(size, np.int64)
        for part in slices(batches, "text"):
            total += np.bincount(buckets(*utf8(part.column("text")), size)[0], minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    return run


def fit(docs: DataFrame, good_ids: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = BUCKETS) -> np.ndarray:
    """The log ratio of each bucket's probability in good texts to that in all texts.

    `good_ids` names good texts in its first column; all of them are counted as the target, all texts as the raw
    model. One added to each count keeps the ratio finite; it is 0 everywhere where there is no good text. Every task
    counts into `size` buckets first, so at most that many rows a task move. All texts are counted where they lie; for the
    target, texts move once to the good ids, of which only hashed parts are held, so that the texts need no sort.
    """
    ids = good_ids.select(F.col(good_ids.columns[0]).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = base.where("doc_id is not null").join(ids.hint("shuffle_hash"), "doc_id", "left_semi")
    count = lambda df, name: df.select("text").mapInArrow(_counts(size), "bucket long, n long").select("bucket", *[(F.col("n") if name == c else F.lit(0).cast("long")).alias(c) for c in ("every", "good")])
    counts = count(base, "every").union(count(known, "good")).groupBy("bucket").agg(F.sum("every").alias("every"), F.sum("good").alias("good")).toPandas()
    every, good = np.ones(size), np.ones(size)
    every[counts.bucket], good[counts.bucket] = counts.every + 1.0, counts.good + 1.0
    return np.zeros(size) if good.sum() == size else np.log(good / good.sum()) - np.log(every / every.sum())


def gumbel(ids: np.ndarray, seed: int) -> np.ndarray:
    """Standard Gumbel noise that depends on the id and the seed alone."""
    u = ((mix(ids.view(np.uint64) + np.uint64(seed) * ODD) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    return -np.log(-np.log(u))


def score(docs: DataFrame, ratio: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """doc_id, n_grams, log_weight (the sum over a text's n-grams), quality (their mean), gumbel_key and a whole number that sorts like it.

    Null, empty and blank texts have no n-grams, weight 0 and quality 0. A null id draws the noise of id -1.
    """

    def run(batches):
        for part in slices(batches, "text"):
            n = part.num_rows
            b, row = buckets(*utf8(part.column("text")), len(ratio))
            count, total = np.bincount(row, minlength=n), np.bincount(row, ratio[b], n).astype(np.float64)
            ids = part.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
            key = total + gumbel(ids, seed) + 0.0
            bits = key.view(np.int64)
            order = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, (count, total, total / np.maximum(count, 1), key, order))], ["doc_id", "n_grams", "log_weight", "quality", "gumbel_key", "order_key"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCORE_TYPE)


def kth_largest(df: DataFrame, col: str, k: int) -> int | None:
    """The exact k-th largest of a long column: counts by 16 bits at a time, from the highest, so few rows reach the driver."""
    prefix = None
    for shift in (48, 32, 16, 0):
        rows = df if prefix is None else df.where(F.shiftright(col, shift + 16) == prefix)
        for b, n in sorted(rows.groupBy(F.shiftright(col, shift).alias("b")).count().collect(), reverse=True):
            if n >= k:
                prefix = b
                break
            k -= n
        else:
            return None
    return prefix


def resample(docs: DataFrame, ratio: np.ndarray, *, share: float = SHARE, **names) -> DataFrame:
    """The scores of every row and `selected`: whether it is among the ceil(share * rows) largest Gumbel keys.

    Rows that tie with the last one drawn (copies of a row) are drawn with it. Nothing is drawn from an empty table.
    """
    scored = cut(score(docs, ratio, **names))
    k = math.ceil(share * scored.count())
    least = kth_largest(scored, "order_key", k) if k else None
    chosen = F.lit(False) if least is None else F.col("order_key") >= F.lit(least)
    return scored.withColumn("selected", chosen).drop("order_key")
