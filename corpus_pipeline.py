"""From documents to packed training sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.

Defined cases: a null or empty text, and one of white space alone, has no language and goes in the first stage; null
languages are filled in there; null ids and sources stay, as the operators' modules say. Ties: of near copies the least id
stays. Rows that repeat id and text stay repeated until the near-duplicate join, which keeps one. Texts are read whole,
however long. An empty table, or a stage that keeps nothing, gives empty tables from there on. Further columns pass through
to mixing; those named `__runs`, `__clean` or `__key` would clash with the stages' own and must be renamed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanweave.llm import jaccard, langid, line_dedup, mixing, packing
from chanweave.llm.common import delete, read, shared_folder


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determined language go: those without a letter, and noise in letters of no learned language.
    Documents in several languages stay. A null language is filled in."""
    return langid.keep_known(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines go; a document with nothing left goes."""
    marked = line_dedup.mark(docs, runs="__runs", clean="__clean").where(F.col("__clean").rlike(r"(?U)\S"))
    new = {"text": F.col("__clean"), "n_chars": F.length("__clean").cast("long")}
    return marked.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, similarity of 0.8)."""
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or left out, so that each source comes near its target."""
    return mixing.repeat(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths."""
    return packing.pack_public(docs)


STAGES = [
    ("language ID", language_id),
    ("line dedup", dedup_lines),
    ("near-duplicate join", dedup_near),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Expectation-maximisation and tokens have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents. What each stage keeps is written to the shared checkpoint folder and read again.

    A stage's table is deleted when the next one is written; the last one stays for the result that reads it.
    """
    folder = shared_folder(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            delete(spark, f"{folder}/{k - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
