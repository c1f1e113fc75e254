"""Writers of playlists, guides and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.order import numbered
from ..scratch import delete, shared_folder

HEADER, ROOT = "#EXTM3U", "tv"
#: Entries of a part of a list; parts' numbers have so many digits, so their names are in order.
PART_ENTRIES, PART_DIGITS = 100_000, 9


def render_entry(name: str = "name", url: str = "url", tvg_id: str = "tvg_id", tvg_logo: str = "tvg_logo", group_title: str = "group_title") -> Column:
    """The two lines of an entry; empty attributes are left out."""
    attribute = lambda key, c: F.when(F.col(c) != "", F.concat(F.lit(f' {key}="'), F.col(c), F.lit('"'))).otherwise("")
    attributes = [attribute("tvg-id", tvg_id), attribute("tvg-logo", tvg_logo), attribute("group-title", group_title)]
    return F.concat(F.lit("#EXTINF:-1"), *[F.coalesce(a, F.lit("")) for a in attributes], F.lit(","), F.coalesce(name, F.lit("Unknown")), F.lit("\n"), F.col(url))


def playlist_lines(entries: DataFrame, playlists: DataFrame) -> DataFrame:
    """(playlist, pos, value): a header for every playlist, empty ones too, then its entries by pos (1 on)."""
    headers = playlists.select("playlist", F.lit(0).cast("long").alias("pos"), F.lit(HEADER).alias("value"))
    return headers.unionByName(entries.select("playlist", F.col("pos").cast("long").alias("pos"), render_entry().alias("value")))


def write_playlists(lines: DataFrame, path: str, part_entries: int = PART_ENTRIES) -> None:
    """One folder per playlist; in it, numbered parts of `part_entries` entries, one file each. Read in the order of their
    names, the parts are the list.

    Parts go to tasks by hash, so a long list is many tasks. `_manifest` beside the lists names each part's first position
    and number of entries.
    """
    part = F.concat(F.lit("p"), F.lpad(F.floor(F.col("pos") / part_entries).cast("string"), PART_DIGITS, "0"))
    parts = lines.withColumn("part", part)
    ordered = parts.repartition("playlist", "part").sortWithinPartitions("playlist", "part", "pos")
    ordered.select("playlist", "part", "value").write.mode("overwrite").partitionBy("playlist", "part").text(path)
    counted = parts.groupBy("playlist", "part").agg(F.min("pos").alias("first"), F.count_if(F.col("pos") > 0).alias("entries"))
    counted.coalesce(1).sortWithinPartitions("playlist", "part").write.mode("overwrite").json(f"{path}/_manifest")


GUIDE = "guide.xml"


def write_guide(channels: DataFrame, programmes: DataFrame, path: str, part_entries: int = PART_ENTRIES) -> None:
    """One guide, in numbered parts that make one document when put together in order: a root element with all channels,
    then all programmes, each in the order of documents and elements. Elements are whole, one entry each."""
    spark = channels.sparkSession
    options = {"ignoreSurroundingSpaces": "false"}
    folder = shared_folder(spark, "guide")
    kinds = []
    for rows, tag in ((channels, "channel"), (programmes, "programme")):  # made once; dealing out by ranges looks at its rows twice
        rows.select("doc_idx", "elem_idx", F.to_xml("element", {**options, "rowTag": tag}).alias("value")).write.parquet(f"{folder}/{tag}")
        kinds.append(numbered(spark.read.parquet(f"{folder}/{tag}"), "doc_idx", "elem_idx"))
    before = kinds[0].count()  # numbers are places, so one count tells where programmes begin
    last = before + kinds[1].count() + 1
    ends = spark.createDataFrame([(0, f'<?xml version="1.0" encoding="UTF-8"?>\n<{ROOT}>'), (last, f"</{ROOT}>")], "pos long, value string")
    body = kinds[0].select(F.col("number").alias("pos"), "value").unionByName(kinds[1].select((F.col("number") + before).alias("pos"), "value"))
    write_playlists(ends.unionByName(body).select(F.lit(GUIDE).alias("playlist"), "pos", "value"), path, part_entries)
    delete(spark, folder)


def write_summary(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").json(path)
