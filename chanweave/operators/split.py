"""Curated catalogue and extended list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dims import RADIO, position_of
from .order import numbered


def split_target(include_overseas: bool = False) -> Column:
    """catalog, more or dropped. Overseas rows go nowhere unless included."""
    named = F.when(F.coalesce("standard_name", F.lit("")) != "", "catalog").otherwise("more")
    dropped = F.lit(not include_overseas) & (F.col("category") == "overseas")
    return F.when(F.col("category") == RADIO[0], "catalog").when(dropped, "dropped").otherwise(named)


def split_catalog_more(selected: DataFrame, include_overseas: bool = False) -> DataFrame:
    return selected.withColumn("target", split_target(include_overseas))


def order_main(catalog: DataFrame) -> DataFrame:
    """Categories in canonical order, inside them the order of selection; radio is not in the main list."""
    return catalog.where(F.col("category") != RADIO[0]).orderBy(position_of("category"), "p1", "p2")


def main_positions(catalog: DataFrame, name: str = "pos") -> DataFrame:
    """The main list with each entry's place in it."""
    main = catalog.where(F.col("category") != RADIO[0])
    return numbered(main, position_of("category"), "p1", "p2", name=name)


def order_more(more: DataFrame) -> DataFrame:
    return more.orderBy(position_of("category"), "name", "cat_ord", "p1", "p2")


def more_positions(more: DataFrame, name: str = "pos") -> DataFrame:
    """The extended list with each entry's place in it."""
    return numbered(more, position_of("category"), "name", "cat_ord", "p1", "p2", name=name)


def cap_more(more: DataFrame, most: int = 3000) -> DataFrame:
    return order_more(more).limit(most)


def latest_reports(runs: DataFrame, keep: int, at: str = "generated_at") -> DataFrame:
    return runs.orderBy(F.desc(at)).limit(keep)
