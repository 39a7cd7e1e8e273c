"""Change logs: envelopes, the table they lead to, and the changes between two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def envelopes(df: DataFrame, payload: str, schema: str, position: str) -> DataFrame:
    """op (I, U, D), position and the columns of the row: after the change, or before it for a deletion."""
    parsed = F.from_json(payload, f"before struct<{schema}>, after struct<{schema}>, op string")
    kind = F.when(F.col("p.op").isin("c", "r"), "I").when(F.col("p.op") == "u", "U").when(F.col("p.op") == "d", "D")
    return df.select(parsed.alias("p"), position).select(kind.alias("op"), position, F.coalesce("p.after", "p.before").alias("row")).select("op", position, "row.*")


def apply_changes(log: DataFrame, key: str, position: str, op: str = "op") -> DataFrame:
    """The current table: each key's row at its last position, without the keys that are deleted there."""
    rest = [c for c in log.columns if c != key]
    last = log.groupBy(key).agg(F.max_by(F.struct(*rest), position).alias("last")).select(key, "last.*")
    return last.where(F.col(op) != "D").drop(op, position)


def changes(old: DataFrame, new: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """key, op and the values that lead from the old table to the new one: I and U with the new values, D with the old. A null key is a key like others."""
    a = old.select(F.col(key).alias("__a"), F.struct(*values).alias("a"), F.lit(True).alias("in_a"))
    b = new.select(F.col(key).alias("__b"), F.struct(*values).alias("b"), F.lit(True).alias("in_b"))
    op = F.when(F.col("in_a").isNull(), "I").when(F.col("in_b").isNull(), "D").when(~F.col("a").eqNullSafe(F.col("b")), "U")
    both = a.join(b, F.col("__a").eqNullSafe(F.col("__b")), "full").withColumn("op", op).where("op is not null")
    at = F.when(F.col("in_b").isNull(), F.col("__a")).otherwise(F.col("__b"))
    return both.select(at.alias(key), "op", F.when(F.col("in_b").isNull(), F.col("a")).otherwise(F.col("b")).alias("row")).select(key, "op", "row.*")
