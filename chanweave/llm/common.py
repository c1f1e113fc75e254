"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import cut, delete, release, shared_folder

__all__ = ["cut", "delete", "read", "release", "row_key", "shared_folder", "text_of"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(text: str | Column) -> Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def row_key(doc_id: str, text: str) -> Column:
    """Identity of a document: its id together with its text. Rows that repeat both are one document."""
    return F.xxhash64(F.col(doc_id), F.col(text))
