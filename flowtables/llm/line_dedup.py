"""Line dedup: lines that several documents share stay only in the first of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.tables import cut

WHITE = " \t\n\x0b\x0c\r"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line):
    """The line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, SMALL)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """`docs` with shared lines dropped from `text_col`, and the columns n_lines and n_dropped.

    Texts are split at \\n. A line whose key has at least `min_chars` code points and is found in at least
    `min_docs` documents is dropped from all of them but the one with the smallest id. The rest is joined by \\n.

    Null or empty text is one empty line, and stays so. Rows with the same id are one document: a line
    repeated only among them is kept. Rows with a null id are one document that sorts last. A text all of
    whose lines go becomes empty. Input columns named n_lines or n_dropped are replaced; others pass through.
    An empty table gives an empty one.

    Lines are hashed to 128 bits and counted by partial aggregation, so a very frequent line is one row per task
    when counted; where lines meet the shared ones, both sides are plain tables, so Spark can split a frequent line.
    Texts move once, to meet the positions of their dropped lines.
    """
    key, last = line_key(F.col("line")), F.lit((1 << 63) - 1)
    base = docs.withColumns({"__id": F.coalesce(F.col(id_col).cast("long"), last), "__text": F.coalesce(F.col(text_col), F.lit(""))}).withColumns({"__th": F.xxhash64("__text")})
    lines = base.select("__id", "__th", F.posexplode(F.split("__text", "\n", -1)).alias("pos", "line")).withColumn("key", key).where(F.length("key") >= min_chars)
    lines = cut(lines.select("__id", "__th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("b"), "key").alias("h2")))
    if min_docs == 2:
        shared = lines.groupBy("h1", "h2").agg(F.min("__id").alias("first"), F.max("__id").alias("last")).where("first != last")
    else:
        shared = lines.groupBy("h1", "h2", "__id").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.min("__id").alias("first"), F.count("*").alias("n")).where(F.col("n") >= min_docs)
    gone = lines.join(cut(shared), ["h1", "h2"]).where("__id != first").groupBy("__id", "__th").agg(F.collect_set("pos").alias("__gone"))
    out = base.join(gone, ["__id", "__th"], "left").withColumn("__lines", F.split("__text", "\n", -1))
    n, dropped = F.size("__lines"), F.coalesce(F.size("__gone"), F.lit(0))
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("__gone"))
    kept = F.when(F.col("__gone").isNull(), F.col("__text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("__lines", i)), "\n"))
    names = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    cols = [F.col(c) if c in names else kept.alias(text_col) for c in docs.columns if c in names or c == text_col]
    return out.select(*cols, n.cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"))
