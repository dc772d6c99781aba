"""From raw documents to packed sequences: quality rules, near-duplicates, repeated passages, packing.

Each stage takes what the one before kept, as a stored table, and all but the last return the columns of ``documents``.
Defined results: a null or wordless text fails the base rules and goes; rows with a null id pass the rules by their text alone, are
never near-duplicates, neither lose nor take passages, and are packed as pieces without an id; repeated rows and rows of one
id count as one document, of which the near-duplicate stage keeps one row (see ``simhash.keep_one``); texts of any length go
through whole; an empty table gives an empty result; further columns pass through the first three stages, whatever their
names, and ``n_chars``, if there is one, follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import packing, quality, simhash, suffixes
from corpusloom.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the trees accept; the trees are fitted on the labels."""
    return quality.keep_documents(docs, quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group whose fingerprints of three-word shingles differ in three bits or fewer."""
    return simhash.keep_one(docs, simhash.SHINGLE, simhash.BITS)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that a document with a smaller id has, whole characters only."""
    cleaned = suffixes.keep_texts(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A place in a sequence for every piece of every document."""
    return packing.pack_documents(packing.document_lengths(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_good),
    ("near-duplicates", keep_one_of_group),
    ("repeated passages", remove_passages),
    ("best-fit packing", pack),
]

#: No SQL: trees, fingerprints and byte strings are not stated in it. The tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written out and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{number}")
    return docs
