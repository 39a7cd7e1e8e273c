"""The corpus pipeline: five stages from raw documents to pieces, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.llm import decontaminate, line_dedup, near_dup, pieces
from flowtables.llm import toxicity as toxic
from flowtables.tables import cut, read_table

TOXIC = 0.7


def aside(docs: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """`docs` with those of its columns that an operator adds under the same name called otherwise, and their names by the new ones."""
    taken = {}
    for name in names:
        if name in docs.columns:
            other = f"__{name}"
            while other in docs.columns:
                other = f"_{other}"
            docs = docs.withColumnRenamed(name, other)
            taken[other] = name
    return docs, taken


def back(df: DataFrame, columns: list[str], taken: dict[str, str]) -> DataFrame:
    """`df` with the columns it had before `aside`, in their order."""
    names = {name: other for other, name in taken.items()}
    return df.select(*[F.col(names.get(c, c)).alias(c) for c in columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score is below TOXIC; learned from their labelled ones.

    Null and empty texts score as texts without suspect words and stay; rows with null or repeated ids are judged each by its text.
    """
    machine = toxic.fit(docs, read_table(spark, sf_dir, "labels"))
    renamed, taken = aside(docs, ["score"])
    return back(toxic.score(renamed, machine).where(F.col("score") < TOXIC), docs.columns, taken)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines stay in their first document only; n_chars follows. A document of which nothing is left goes.

    Null and blank texts, which had nothing to lose, stay as empty ones. Rows that repeat an id are one document, those with a null id one that sorts last.
    """
    renamed, taken = aside(docs, ["n_lines", "n_dropped"])
    kept = line_dedup.dedup_lines(renamed).where("n_dropped = 0 or trim(text) != ''")
    out = back(kept, docs.columns, taken)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8) stays.

    Documents are alike if their texts are, as they are or as they were before their shared lines went: copies have lost most of what shows them to be
    copies by then. The smallest id of a group stays. Rows with a null id and texts without words stay; rows that repeat an id stay or go together.
    """
    before = cut(read_table(spark, sf_dir, "documents").select("doc_id", "text").join(docs.select("doc_id").distinct(), "doc_id", "left_semi"))
    gone = [near_dup.near_duplicates(texts, words=5, percent=80).where("not kept and doc_id is not null").select("doc_id") for texts in (before, docs)]
    return docs.join(gone[0].union(gone[1]).distinct(), "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts, null and repeated ids stay as they are."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the pieces of their text and their number; none for null and empty texts."""
    return pieces.encode(docs).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("sentencepiece", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written to the shared work folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        docs = docs if name == STAGES[-1][0] else cut(docs)
    return docs


# Scores, near-duplicates and pieces have no SQL: tests/llm/test_pipeline.py holds run() against plain Python.
ORACLE_SQL = None
