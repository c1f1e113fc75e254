"""Counts, summaries and checks of written playlists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.addresses import LINE_END, is_timestamp
from ..functions.dims import CATEGORIES, RADIO
from ..functions.names import strip
from .order import numbered

OTHER_TITLE = dict(CATEGORIES)["other"]
OTHER_LEAST, OTHER_FAIL, OTHER_WARN = 50, 85, 70
GROUP_TITLE = 'group-title="([^"]+)"'


def source_success(payloads: DataFrame, error: Column) -> DataFrame:
    """ok, total, rate (percent, 0 for none)."""
    counted = payloads.agg(F.count_if(~error).alias("ok"), F.count(F.lit(1)).alias("total"))
    return counted.withColumn("rate", F.when(F.col("total") > 0, F.col("ok") * 100.0 / F.col("total")).otherwise(F.lit(0.0)))


def core_gate(payloads: DataFrame, error: Column, core: Column, strict: bool = True) -> DataFrame:
    """core_ok, core_total, failed (strict and some core source is missing)."""
    counted = payloads.agg(F.count_if(core & ~error).alias("core_ok"), F.count_if(core).alias("core_total"))
    return counted.withColumn("failed", F.lit(strict) & (F.col("core_total") > 0) & (F.col("core_ok") < F.col("core_total")))


def category_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n")).orderBy("category")


def match_stats(rows: DataFrame) -> DataFrame:
    named = F.coalesce("standard_name", F.lit("")) != ""
    return rows.agg(F.count_if(named).alias("matched"), F.count_if(~named).alias("classified"))


def run_summary(split: DataFrame) -> DataFrame:
    """total_selected, catalog_count (radio included), more_count (before the cap)."""
    of = lambda t: F.count_if(F.col("target") == t)
    return split.agg(F.count(F.lit(1)).alias("total_selected"), of("catalog").alias("catalog_count"), of("more").alias("more_count"))


def count_entries(lines: DataFrame, expected: DataFrame) -> DataFrame:
    """(file, line) and the expected files -> (file, entries); a missing file has none."""
    found = lines.where(F.upper(strip(F.col("line"))).startswith("#EXTINF")).groupBy("file").agg(F.count(F.lit(1)).alias("entries"))
    return expected.join(found, "file", "left").select("file", F.coalesce("entries", F.lit(0)).cast("long").alias("entries"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of written playlists; the file is the playlist's folder."""
    return spark.read.text(path).select(F.col("playlist").alias("file"), F.col("value").alias("line"))


def read_written(spark: SparkSession, path: str) -> DataFrame:
    """(file, ord, line) of written playlists: parts by their names, and in a part's one file the order of its lines."""
    at = F.struct("part", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select(F.col("playlist").alias("file"), at.alias("ord"), F.col("value").alias("line"))


def line_numbers(lines: DataFrame) -> DataFrame:
    """(file, ord, line) -> (file, line_no, line): the place of each line in its list, over all parts."""
    placed = numbered(lines, "file", "ord")
    first = placed.groupBy("file").agg(F.min("number").alias("first"))
    return placed.join(first, "file").select("file", (F.col("number") - F.col("first") + 1).alias("line_no"), "line")


def file_overview(lines: DataFrame) -> DataFrame:
    return count_entries(lines, lines.select("file").distinct()).orderBy("file")


def group_distribution(lines: DataFrame) -> DataFrame:
    """(ord, line) -> group_title, n, first: most frequent first, ties by first seen; several a line count."""
    titles = lines.select("ord", F.posexplode(F.regexp_extract_all("line", F.lit(GROUP_TITLE), F.lit(1))).alias("at", "group_title"))
    counted = titles.groupBy("group_title").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ord", "at")).alias("first"))
    return counted.orderBy(F.desc("n"), "first").select("group_title", "n")


def playlist_names_urls(lines: DataFrame) -> DataFrame:
    """(file, ord, line) -> (file, ord, kind, value): lax reading of a written list."""
    line = strip(F.col("line"))
    is_entry = line.startswith("#EXTINF:")
    kind = F.when(is_entry & line.contains(","), "name").when((line != "") & ~line.startswith("#"), "url")
    value = F.when(kind == "name", strip(F.regexp_replace(line, "^[^,]*,", ""))).otherwise(line)
    return lines.select("file", "ord", kind.alias("kind"), value.alias("value")).where("kind IS NOT NULL")


def quality_stats(rows: DataFrame) -> DataFrame:
    """entries, names, urls, max_per_name, dup_names, dup_urls; each key is counted in a two-level aggregation.

    An empty or missing name or address is none.
    """
    def of(column: str, most: str, repeated: str) -> DataFrame:
        counts = rows.where(F.col(column) != "").groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        return counts.agg(
            F.sum("n").alias("entries"), F.count(F.lit(1)).alias(column), F.max("n").alias(most), F.count_if(F.col("n") > 1).alias(repeated)
        )

    names = of("name", "max_per_name", "dup_names").withColumnRenamed("name", "unique_names")
    urls = of("url", "max_per_url", "dup_urls").select(F.col("url").alias("unique_urls"), "dup_urls")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    one = F.lit(1).alias("one")  # both sides have one row
    return names.select("*", one).join(urls.select("*", one), "one").select(*[zero(c) for c in ("entries", "unique_names", "unique_urls", "max_per_name", "dup_names", "dup_urls")])


def other_ratio(rows: DataFrame) -> DataFrame:
    """entries, other, ratio (percent), verdict: only judged above 50 entries."""
    counted = rows.agg(F.count(F.lit(1)).alias("entries"), F.count_if(F.col("group_title") == OTHER_TITLE).alias("other"))
    ratio = F.when(F.col("entries") > 0, F.col("other") * 100.0 / F.col("entries")).otherwise(F.lit(0.0))
    verdict = F.when(F.col("entries") <= OTHER_LEAST, "skipped").when(F.col("ratio") > OTHER_FAIL, "fail").when(F.col("ratio") > OTHER_WARN, "warn").otherwise("ok")
    return counted.withColumn("ratio", ratio).withColumn("verdict", verdict)


def bad_groups(rows: DataFrame, allowed: DataFrame) -> DataFrame:
    """Group titles that are not canonical."""
    return rows.where(F.coalesce("group_title", F.lit("")) != "").select("group_title").distinct().join(allowed, "group_title", "left_anti")


def parse_written(lines: DataFrame) -> DataFrame:
    """(file, ord, line) of written lists -> file, ord, name, url, group_title; an address follows its entry's line, or is null.

    Without a file column it is one list.
    """
    line, named = strip(F.col("line")), "file" in lines.columns
    kept = lines.select("file" if named else F.lit("").alias("file"), "ord", line.alias("line")).where("line <> '' AND line NOT LIKE '#EXTM3U%'")
    ahead = kept.withColumn("url", F.lead("line").over(Window.partitionBy("file").orderBy("ord"))).where("line LIKE '#EXTINF:%'")
    title = F.regexp_extract(F.substring_index("line", ",", 1), GROUP_TITLE, 1)
    url = F.when(~F.col("url").startswith("#"), F.col("url")).alias("url")
    return ahead.select(*(["file"] if named else []), "ord", strip(F.regexp_replace("line", "^[^,]*,", "")).alias("name"), url, title.alias("group_title"))


def validate_outputs(live: DataFrame, more: DataFrame, verified_exists: bool, summary: DataFrame, allowed: DataFrame) -> DataFrame:
    """All checks as rows (check, severity, value, ok). live, more: name, url, group_title. summary: one row."""
    stats, groups = quality_stats(live), bad_groups(live, allowed).agg(F.count(F.lit(1)).alias("value"))
    other = other_ratio(live)
    radio = live.agg(F.count_if(F.col("group_title") == RADIO[1]).alias("value"))
    probing = F.coalesce("probe_enabled", F.lit(False)) | (F.coalesce("stage", F.lit("")) == "probe")

    def check(name: str, severity: str, rows: DataFrame, value: Column, ok: Column) -> DataFrame:
        return rows.select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), value.cast("double").alias("value"), F.coalesce(ok, F.lit(False)).alias("ok"))

    rows = [
        check("schema_version", "fail", summary, F.col("schema_version"), F.col("schema_version") == 1),
        check("stage", "fail", summary, F.lit(None), F.col("stage").isin("collect", "probe")),
        check("generated_at", "fail", summary, F.lit(None), is_timestamp("generated_at")),
        check("radio_in_live", "fail", radio, F.col("value"), F.col("value") == 0),
        check("max_per_name", "fail", stats, F.col("max_per_name"), F.col("max_per_name") <= 1),
        check("dup_names", "fail", stats, F.col("dup_names"), F.col("dup_names") == 0),
        check("dup_urls", "fail", stats, F.col("dup_urls"), F.col("dup_urls") == 0),
        check("bad_groups", "fail", groups, F.col("value"), F.col("value") == 0),
        check("more_not_empty", "warn", more.agg(F.count(F.lit(1)).alias("value")), F.col("value"), F.col("value") > 0),
        check("verified_exists", "fail", summary, F.lit(float(verified_exists)), ~probing | F.lit(verified_exists)),
        check("other_ratio", "fail", other, F.col("ratio"), F.col("verdict") != "fail"),
        check("other_ratio", "warn", other, F.col("ratio"), F.col("verdict") != "warn"),
    ]
    return reduce(DataFrame.unionByName, rows)


def split_lines(text: Column) -> Column:
    return F.split(text, LINE_END)
