"""Playlist text to entries.

Order has meaning: every entry carries `ord`, the place of its source in the registry and of its line in the file, in
one number. "First" always means least `ord`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.addresses import LINE_END
from ..functions.names import strip

LINE_BITS = 40
#: A whole text is scanned in segments of this many lines (as a power of two), a landed file in Spark's splits of it.
SEGMENT_BITS = 14
NOT_LANDED = "ERROR: not landed"
RECORD_SCHEMA = "name string, content string"
ENTRY_COLUMNS = ("ord", "name", "url", "tvg_id", "tvg_name", "tvg_logo", "group_title", "source", "source_region")
# Marks of the playlist format, in any case; the name follows the first comma.
EXTINF = r"(?iuU)^#EXTINF\s*+:\s*+-?\d++\s*+(?:[^,]*+,)(.+)"


def source_name(folders: bool) -> Column:
    """The file's name without its ending; with folders, the name of its folder (after an equals sign, if there is one)."""
    return F.regexp_extract("file_path", "/(?:[^/=]*=)?([^/]+)/[^/]+$", 1) if folders else F.regexp_replace("file_name", r"\.[^.]*$", "")


def read_payloads(spark: SparkSession, path: str, registry: DataFrame, folders: bool = False, records: str | None = None) -> DataFrame:
    """Landed files, one whole text each, of enabled sources. The file's name without its ending is the source's name;
    with `folders`, the name of the file's folder (after an equals sign, if there is one).

    Files cost by their number. A landing of very many sources packs them: `records` is a folder of Parquet with a row
    (name, content) a source, read beside the files of `path`.

    A source of which nothing landed (no file, an empty one, a row without text) is a failed one: it stays, with an error as
    its content, so that counts and gates see it. The registry is small (one row per source) and its side of the join is
    broadcast below Spark's threshold.
    """
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select("value", "_metadata.file_path", "_metadata.file_name")
    landed = files.select(source_name(folders).alias("name"), F.col("value").alias("content"))
    if records is not None:
        landed = landed.unionByName(spark.read.schema(RECORD_SCHEMA).parquet(records))
    enabled = enabled_sources(registry)
    absent = enabled.join(landed.select("name").distinct(), "name", "left_anti").withColumn("content", F.lit(NOT_LANDED))
    there = landed.join(enabled, "name").withColumn("content", F.coalesce(F.nullif("content", F.lit("")), F.lit(NOT_LANDED)))
    return there.unionByName(absent).select("source_idx", F.col("name").alias("source"), "url", "type", "region", "content")


def enabled_sources(registry: DataFrame) -> DataFrame:
    return registry.where(F.coalesce("enabled", F.lit(True)))


def is_error_payload(content: Column | str) -> Column:
    content = F.col(content) if isinstance(content, str) else content
    return content.startswith("HTTP ") | content.startswith("ERROR:")


def is_guide_payload(content: Column | str) -> Column:
    """Whether the text can be a guide document."""
    text = strip(F.col(content) if isinstance(content, str) else content)
    return text.startswith("<?xml") | text.startswith("<tv")


def _lines(payloads: DataFrame) -> DataFrame:
    """Lines of whole texts: source columns, file, segment, at (the place), line, and whether there can be more segments."""
    text = F.posexplode(F.split(F.coalesce("content", F.lit("")), LINE_END)).alias("line_no", "raw")
    lines = payloads.select("source_idx", "source", "region", (F.length("content") >= 1 << SEGMENT_BITS).alias("long"), text)
    segment = F.shiftright("line_no", SEGMENT_BITS).cast("long")
    at = F.struct(segment.alias("segment"), F.col("line_no").cast("long").alias("row"), F.lit(0).alias("sub"))
    return lines.select("source_idx", "source", "region", "long", F.lit("").alias("file"), segment.alias("segment"), at.alias("at"), strip(F.col("raw")).alias("line"))


def read_landed_lines(spark: SparkSession, path: str, registry: DataFrame, folders: bool = False) -> DataFrame:
    """Lines of landed files of enabled sources, read by Spark's splits: one file is many tasks. Adds type.

    A segment is a split: its start in the file, and in it the order in which its task reads.
    """
    read = spark.read.option("recursiveFileLookup", "true").text(path)
    read = read.select("value", "_metadata.file_path", "_metadata.file_name", F.col("_metadata.file_block_start").alias("segment"), F.monotonically_increasing_id().alias("row"))
    named = read.select(source_name(folders).alias("name"), F.col("file_path").alias("file"), "segment", "row", F.posexplode(F.split("value", LINE_END)).alias("sub", "raw"))
    known = named.join(enabled_sources(registry).select("source_idx", "name", "type", "region"), "name")
    return known.select(
        "source_idx", F.col("name").alias("source"), "region", F.lit(True).alias("long"), "file", "segment", F.struct("segment", "row", "sub").alias("at"),
        strip(F.col("raw")).alias("line"), "type",
    )


def _scanned(lines: DataFrame, **states: Column) -> DataFrame:
    """Adds ord, head (the file's first line) and, for each state, its last value on a line before (null where there was none).

    A segmented scan: windows run inside segments; what a segment inherits, its lines' number and the last states, comes
    from one row per segment, combined in file order and joined back on the partitioning that the windows have already.
    """
    by = ["source_idx", "file", "segment"]
    inside = Window.partitionBy(*by).orderBy("at")
    earlier = Window.partitionBy("source_idx", "file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    files = Window.partitionBy("source_idx").orderBy("file", "segment").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("source_idx", "file").orderBy("segment").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = [F.max_by(s, F.when(s.isNotNull(), F.col("at"))).alias(n) for n, s in states.items()]
    ends = lines.where("long").groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min_by("line", "at").alias("first"), *last)
    carried = ends.select(
        *by, F.sum("n").over(files).alias("lines_before"), F.first("first").over(whole).alias("head"), *[F.last(n, ignorenulls=True).over(earlier).alias(f"carried_{n}") for n in states]
    )
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.withColumns({n: F.last(s, ignorenulls=True).over(before) for n, s in states.items()} | {"place": F.row_number().over(inside) - 1})
    joined = placed.where("line <> ''").join(carried, by, "left")
    number = F.shiftleft(F.col("source_idx").cast("long"), LINE_BITS) + F.coalesce("lines_before", F.lit(0)) + F.col("place")
    return joined.withColumns({n: F.coalesce(n, f"carried_{n}") for n in states} | {"ord": number})


def extinf_fields(line: Column) -> dict[str, Column]:
    """Name (after the first comma) and the quoted attributes of an #EXTINF line."""
    attribute = lambda key: F.regexp_extract(line, rf'(?iuU){key}\s*=\s*"([^"]*)"', 1)
    return {
        "name": strip(F.regexp_extract(line, EXTINF, 1)),
        "tvg_id": attribute("tvg-id"),
        "tvg_name": attribute("tvg-name"),
        "tvg_logo": attribute("tvg-logo"),
        "group_title": attribute("group-title"),
    }


def m3u_entries(lines: DataFrame) -> DataFrame:
    """Entries of playlist lines: an address belongs to the last #EXTINF before it, unless another address came between."""
    kind = (
        F.when(F.col("line").rlike(EXTINF), "E")
        .when(F.upper("line").startswith("#EXTGRP:"), "G")
        .when((F.col("line") != "") & ~F.col("line").startswith("#"), "U")
    )
    lines = lines.withColumn("kind", kind)
    k = F.col("kind")
    pending = F.when(k.isin("E", "U"), F.struct("kind", "at", F.when(k == "E", F.col("line")).alias("line")))
    marked = _scanned(lines, pending=pending, group=F.when(k == "G", F.struct("at", "line")))
    marked = marked.where((k == "U") & (F.col("pending.kind") == "E"))
    fields = extinf_fields(F.col("pending.line"))
    later_group = F.col("group.at") > F.col("pending.at")
    fields["group_title"] = F.when(later_group, strip(F.regexp_replace("group.line", "^[^:]*:", ""))).otherwise(fields["group_title"])
    return marked.select(
        "ord", fields["name"].alias("name"), F.col("line").alias("url"), *[fields[c].alias(c) for c in ENTRY_COLUMNS[3:7]],
        "source", F.col("region").alias("source_region"), "head",
    )


def txt_entries(lines: DataFrame) -> DataFrame:
    """Entries of "name,address" lines under "group,#genre#" lines; only http and https addresses."""
    header = F.col("line").contains("#genre#")
    marked = _scanned(lines, group=F.when(header, F.struct(strip(F.substring_index("line", ",", 1)).alias("title"))))
    entries = marked.withColumn("group_title", F.coalesce("group.title", F.lit(""))).where(~header & F.col("line").contains(",") & ~F.col("line").startswith("#"))
    entries = entries.withColumn("url", strip(F.regexp_replace("line", "^[^,]*,", ""))).where(F.col("url").rlike("^https?://"))
    empty = [F.lit("").alias(c) for c in ("tvg_id", "tvg_name", "tvg_logo")]
    return entries.select("ord", strip(F.substring_index("line", ",", 1)).alias("name"), "url", *empty, "group_title", "source", F.col("region").alias("source_region"), "head")


def parse_m3u(payloads: DataFrame) -> DataFrame:
    """Entries of whole playlist texts. Long ones are scanned in segments, so a text is as many tasks as it has."""
    return m3u_entries(_lines(payloads)).drop("head")


def parse_txt(payloads: DataFrame) -> DataFrame:
    return txt_entries(_lines(payloads)).drop("head")


def parse_landed(spark: SparkSession, path: str, registry: DataFrame, folders: bool = False) -> DataFrame:
    """Entries of all landed files of enabled sources, by type, without files that begin as an error. No file is ever one
    value or one task; the entries are those of parse_payloads(read_payloads(...))."""
    lines = read_landed_lines(spark, path, registry, folders)
    of_type = F.coalesce("type", F.lit("m3u")) == "txt"
    both = m3u_entries(lines.where(~of_type)).unionByName(txt_entries(lines.where(of_type)))
    return both.where(~is_error_payload("head")).drop("head")


def parse_payloads(payloads: DataFrame) -> DataFrame:
    """Entries of all payloads without errors, by type."""
    good = payloads.where(~F.coalesce(is_error_payload("content"), F.lit(True)))
    return parse_m3u(good.where(F.coalesce("type", F.lit("m3u")) != "txt")).unionByName(parse_txt(good.where("type = 'txt'")))
