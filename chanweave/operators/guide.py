"""Merging guides: first channel per id, first programme per channel, start and title.

Late materialisation: keys and places alone are aggregated; whole elements are joined to the winners where they are asked
for, so that no element of a duplicate is ever shuffled for the choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACE = ["doc_idx", "elem_idx"]


def _first(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """First row per key by (doc_idx, elem_idx), as an aggregation with map-side combine over narrow columns."""
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*PLACE, *values), F.struct(*PLACE)).alias("f"))
    return picked.select("f.doc_idx", "f.elem_idx", *keys, *[F.col(f"f.{v}").alias(v) for v in values])


def merge_guide_channels(channels: DataFrame) -> DataFrame:
    return _first(channels.where(F.coalesce("id", F.lit("")) != ""), ["id"], ["display_name"])


def merge_guide_programmes(programmes: DataFrame) -> DataFrame:
    keyed = programmes.withColumns({c: F.coalesce(c, F.lit("")) for c in ("channel", "start", "title")})
    return _first(keyed, ["channel", "start", "title"], ["stop"])


def with_elements(winners: DataFrame, rows: DataFrame) -> DataFrame:
    """The winners' whole elements, by their place."""
    return winners.join(rows.select(*PLACE, "element"), PLACE)
