"""Matching entries to the standard channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dims import title_for
from ..functions.names import strip
from ..functions.rules import classify_with_region

FIELDS = ("standard_name", "category", "tvg_id", "display_name")


def lookup_table(channels: DataFrame, aliases: DataFrame) -> DataFrame:
    """(key, matched_by, channel fields): standard names first, then aliases; one row per key.

    Of channels with one name the first in the file wins (ord, as read_dictionary gives it).
    """
    if "ord" not in channels.columns:
        channels = channels.withColumn("ord", F.lit(0).cast("long"))
    exact = channels.select(strip(F.col("standard_name")).alias("key"), F.lit(0).alias("prio"), "ord", *FIELDS)
    targets = channels.withColumn("target", strip(F.col("standard_name")))
    by_alias = aliases.select("alias", F.col("standard_name").alias("target")).join(targets, "target")
    by_alias = by_alias.select(F.col("alias").alias("key"), F.lit(1).alias("prio"), "ord", *FIELDS)
    best = F.row_number().over(Window.partitionBy("key").orderBy("prio", "ord", "standard_name"))
    found = exact.unionByName(by_alias).withColumn("place", best).where("place = 1")
    return found.select("key", F.when(F.col("prio") == 0, "exact").otherwise("alias").alias("matched_by"), *FIELDS)


def match_channels(names: DataFrame, channels: DataFrame, aliases: DataFrame, name: str = "name") -> DataFrame:
    """Rows with match_* columns, null where nothing matches. One equi-join; Spark broadcasts the dictionary below its threshold."""
    table = lookup_table(channels, aliases).where("key <> ''")
    table = table.select("key", "matched_by", *[F.col(c).alias(f"match_{c}") for c in FIELDS])
    return names.withColumn("key", strip(F.coalesce(name, F.lit("")))).join(table, "key", "left").drop("key")


GRAM = 3


def _grams(text: Column, size: Column) -> Column:
    """Distinct pieces of `size` characters."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda k: F.substr(text, k, size)))


def match_fuzzy(names: DataFrame, channels: DataFrame, name: str = "name") -> DataFrame:
    """(name, standard_name): folded names that lie inside exactly one standard name.

    Standard names are indexed by their pieces of three characters (shorter ones for shorter names). A name is looked up
    by its rarest piece, and what it finds is verified, so no name meets the whole dictionary.
    """
    wanted = names.select(strip(F.lower(name)).alias("low"), F.col(name).alias("name")).where("low <> ''").distinct()
    sizes = F.explode(F.sequence(F.lit(1), F.lit(GRAM))).alias("size")
    index = channels.select("standard_name", F.lower("standard_name").alias("inside"), sizes)
    index = index.select("standard_name", "inside", "size", F.explode(_grams(F.col("inside"), F.col("size"))).alias("gram"))
    found = index.groupBy("size", "gram").agg(F.count(F.lit(1)).alias("entries"))
    asked = wanted.withColumn("size", F.least(F.lit(GRAM), F.length("low"))).withColumn("gram", F.explode(_grams(F.col("low"), F.col("size"))))
    asked = asked.join(found, ["size", "gram"], "left").groupBy("name", "low", "size")
    rarest = asked.agg(F.min(F.struct(F.coalesce("entries", F.lit(0)).alias("entries"), "gram")).alias("r")).select("name", "low", "size", "r.entries", "r.gram")
    # A name that is one piece lies in as many standard names as the piece has entries.
    rarest = rarest.where((F.length("low") > F.col("size")) | (F.col("entries") == 1))
    hits = rarest.join(index, ["size", "gram"]).where(F.contains("inside", "low"))
    return hits.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("standard_name").alias("standard_name")).where("n = 1").drop("n")


def match_and_classify(entries: DataFrame, channels: DataFrame, aliases: DataFrame) -> DataFrame:
    """category, standard_name, group_title, name and tvg_id of every entry: by dictionary, else by rules."""
    found = match_channels(entries, channels, aliases)
    hit = F.col("match_standard_name").isNotNull()
    category = F.when(hit, F.col("match_category")).otherwise(classify_with_region("name", "group_title", "source_region"))
    display = F.coalesce(F.when(F.col("match_display_name") != "", F.col("match_display_name")), F.col("match_standard_name"))
    found = found.withColumns(
        {
            "category": category,
            "standard_name": F.coalesce("match_standard_name", F.lit("")),
            "tvg_id": F.when(hit & (F.coalesce("tvg_id", F.lit("")) == ""), F.coalesce("match_tvg_id", F.lit(""))).otherwise(F.col("tvg_id")),
        }
    )
    return found.withColumn("name", F.when(hit, display).otherwise(F.col("name"))).withColumn("group_title", title_for("category")).select(
        *entries.columns, *[c for c in ("category", "standard_name") if c not in entries.columns]
    )


def orphan_aliases(channels: DataFrame, aliases: DataFrame) -> DataFrame:
    return aliases.join(channels.select("standard_name"), "standard_name", "left_anti")
