"""The three workloads end to end."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dims import CORE_SOURCES, RADIO, categories, core_flag, file_for, normalise_group_title, position_of
from ..functions.names import clean_channels
from ..operators import guide, health, probe, quality, select, split
from ..operators.match import match_and_classify
from ..operators.order import numbered
from ..scratch import cut
from ..sources import history, sinks
from ..sources.playlists import is_error_payload, parse_payloads
from ..sources.tables import read_conversion, read_guides


VERIFIED = "live_verified.m3u"
#: Up to so many numbers of documents are sent to every task; more are joined by a shuffle.
SENT_PLACES = 1 << 20


def validate_run(spark: SparkSession, out: str) -> DataFrame:
    """All checks of a written run, read from its folder: (check, severity, value, ok), files first."""
    lines = quality.read_written(spark, f"{out}/playlists")
    expected = spark.createDataFrame([("live.m3u", "fail"), ("live_more.m3u", "fail")], "file string, severity string")
    there = expected.join(lines.select("file").distinct().withColumn("there", F.lit(True)), "file", "left")
    files = there.select(F.concat(F.lit("exists "), "file").alias("check"), "severity", F.lit(None).cast("double").alias("value"), F.coalesce("there", F.lit(False)).alias("ok"))
    entries = quality.parse_written(lines)
    verified = not lines.where(F.col("file") == VERIFIED).isEmpty()
    summary = spark.read.schema("schema_version int, stage string, generated_at string, probe_enabled boolean").json(f"{out}/summary")
    allowed = categories(spark).select(F.col("title").alias("group_title"))
    return files.unionByName(quality.validate_outputs(entries.where("file = 'live.m3u'"), entries.where("file = 'live_more.m3u'"), verified, summary, allowed))


@dataclass(frozen=True)
class Settings:
    keep: int = 1
    include_overseas: bool = False
    more_most: int = 3000
    strict_sources: bool = True
    probe_region: str = "cn"
    probe_concurrency: int = 10
    probe_timeout: int = 10
    core_sources: tuple[str, ...] = CORE_SOURCES


def matched(
    payloads: DataFrame, channels: DataFrame, aliases: DataFrame, verdicts: DataFrame | None = None,
    phrases: DataFrame | None = None, characters: DataFrame | None = None,
) -> DataFrame:
    """Payloads to cleaned, matched and classified entries with their liveness. phrases, characters: see clean_channels."""
    entries = match_and_classify(clean_channels(parse_payloads(payloads), phrases=phrases, characters=characters), channels, aliases)
    return probe.apply_probe(entries, verdicts) if verdicts is not None else probe.default_alive(entries.withColumn("latency_ms", F.lit(None).cast("int")))


def catalogue(
    payloads: DataFrame, channels: DataFrame, aliases: DataFrame, verdicts: DataFrame | None = None, settings: Settings = Settings(),
    phrases: DataFrame | None = None, characters: DataFrame | None = None,
) -> DataFrame:
    """Payloads to selected entries, with target (catalog, more, dropped)."""
    return chosen(matched(payloads, channels, aliases, verdicts, phrases, characters), settings)


def chosen(entries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return split.split_catalog_more(select.select_best(entries, settings.keep), settings.include_overseas)


def playlists(selected: DataFrame, settings: Settings = Settings(), verified: DataFrame | None = None) -> DataFrame:
    """(playlist, pos, entry columns) of the main list, the category lists, radio, the capped extended list, and the verified one."""
    columns = ["name", "url", "tvg_id", "tvg_logo", "group_title"]
    catalog = normalise_group_title(selected.where("target = 'catalog'")).withColumn("position", position_of("category"))
    order = F.struct("position", "p1", "p2")
    main = catalog.where(F.col("category") != RADIO[0]).select(F.lit("live.m3u").alias("playlist"), order.alias("o"), *columns)
    each = catalog.select(file_for("category").alias("playlist"), order.alias("o"), *columns)
    more = normalise_group_title(selected.where("target = 'more'"))
    more = split.cap_more(more, settings.more_most)
    by_name = F.struct(position_of("category").alias("position"), "name", "cat_ord", "p1", "p2")
    extended = more.select(F.lit("live_more.m3u").alias("playlist"), by_name.alias("o"), *columns)

    def placed(rows: DataFrame) -> DataFrame:
        """Places in each list, from ranges of all lists: no list meets in one task."""
        ordered = numbered(rows, "playlist", "o")
        first = ordered.groupBy("playlist").agg(F.min("number").alias("first"))
        return ordered.join(first, "playlist").withColumn("pos", F.col("number") - F.col("first") + 1).drop("o", "number", "first")

    # The extended list has settings.more_most entries at most.
    capped = extended.withColumn("pos", F.row_number().over(Window.partitionBy("playlist").orderBy("o")).cast("long")).drop("o")
    lists = placed(main.unionByName(each)).unionByName(capped)
    return lists if verified is None else lists.unionByName(placed(verified.select(F.lit(VERIFIED).alias("playlist"), F.col("ord").alias("o"), *columns)))


class CoreSourcesFailed(RuntimeError):
    """Some core source did not come, and the run is strict: nothing is written, the last good lists stay."""


def run_catalogue(
    spark: SparkSession, payloads: DataFrame, channels: DataFrame, aliases: DataFrame, out: str, verdicts: DataFrame | None = None, settings: Settings = Settings(),
    phrases: DataFrame | str | None = None, characters: DataFrame | str | None = None,
) -> DataFrame:
    """Write all lists and the summary; gives the summary row. With verdicts the run is a probing one and lists what is verified.

    phrases, characters: conversion tables, or paths of such (read_conversion). A strict run whose core sources are not all
    there raises CoreSourcesFailed before the first write.
    """
    gate = quality.core_gate(payloads, is_error_payload("content"), core_flag("source", settings.core_sources), settings.strict_sources).first()
    if gate["failed"]:
        raise CoreSourcesFailed(f"{gate['core_ok']} of {gate['core_total']} core sources")
    phrases, characters = (read_conversion(spark, t) if isinstance(t, str) else t for t in (phrases, characters))
    return write_run(spark, matched(payloads, channels, aliases, verdicts, phrases, characters), out, verdicts is not None, settings)


SUMMARY_SCHEMA = (
    "schema_version int, stage string, generated_at string, timezone string, region string, total long, catalog_count long, more_count long, ok long, fail long, ratio double, "
    "probe_enabled boolean, probe_concurrency int, probe_timeout int, channels array<string>"
)


def write_run(spark: SparkSession, entries: DataFrame, out: str, probing: bool, settings: Settings = Settings(), generated_at: str | None = None) -> DataFrame:
    """Entries of a run to its tables, lists and summary.

    What the summary counts is observed while the tables are written, so no table is read again to be counted.
    """
    liveness, targets = Observation("liveness"), Observation("targets")
    alive = F.count_if(F.col("alive").eqNullSafe(F.lit(True))).alias("ok")
    entries.observe(liveness, alive, F.count(F.lit(1)).alias("entries")).write.mode("overwrite").parquet(f"{out}/entries")
    entries = spark.read.parquet(f"{out}/entries")
    of = lambda t: F.count_if(F.col("target") == t).alias(t)
    chosen(entries, settings).observe(targets, F.count(F.lit(1)).alias("total"), of("catalog"), of("more")).write.mode("overwrite").parquet(f"{out}/selected")
    selected = spark.read.parquet(f"{out}/selected")

    names = selected.select(file_for("category").alias("playlist")).distinct()
    always = ["live.m3u", "live_more.m3u", *([VERIFIED] if probing else [])]
    names = names.union(spark.createDataFrame([(n,) for n in always], "playlist string"))
    verified = select.verified(entries) if probing else None
    sinks.write_playlists(sinks.playlist_lines(playlists(selected, settings, verified), names), f"{out}/playlists")

    # Without probing nothing is counted as alive or dead.
    ok, seen, counts = liveness.get["ok"] if probing else 0, liveness.get["entries"] if probing else 0, targets.get
    ratio = float(Decimal(100 * ok / seen).quantize(Decimal("0.1"), ROUND_HALF_UP)) if seen else 0.0
    at = generated_at or (datetime.now(timezone.utc) + timedelta(hours=8)).strftime("%Y-%m-%d %H:%M:%S")
    row = (1, "probe" if probing else "collect", at, "Asia/Shanghai", settings.probe_region, counts["total"], counts["catalog"], counts["more"], ok, seen - ok, ratio, probing, settings.probe_concurrency, settings.probe_timeout, [])
    summary = spark.createDataFrame([row], SUMMARY_SCHEMA)
    sinks.write_summary(summary, f"{out}/summary")
    return summary


def merge_guides(documents: DataFrame, element: bool = True) -> tuple[DataFrame, DataFrame]:
    """Channels and programmes of all guide documents, first ones kept; with `element`, whole ones to be written."""
    channels, programmes = read_guides(documents, element=False)
    channels, programmes = guide.merge_guide_channels(channels), guide.merge_guide_programmes(programmes)
    if not element:
        return channels, programmes
    channels, programmes = cut(channels), cut(programmes)
    return guide.with_elements(channels, read_guides(_of_winners(documents, channels))[0]), guide.with_elements(programmes, read_guides(_of_winners(documents, programmes))[1])


def _of_winners(documents: DataFrame, winners: DataFrame) -> DataFrame:
    """The documents that winners lie in: only these are parsed whole. Places are counted before they are sent to tasks."""
    places = winners.select("doc_idx").distinct()
    return documents.join(F.broadcast(places) if places.count() <= SENT_PLACES else places, "doc_idx", "left_semi")


def source_health(old: DataFrame, new: DataFrame, registry: DataFrame, probe_mode: bool = True, total: int = 1) -> DataFrame:
    """Actions after a day's results have been added to the history."""
    return health.flag_dead_sources(health.upsert_history(old, new), registry, probe_mode, total)


def daily_health(spark: SparkSession, store: str, new: DataFrame, registry: DataFrame, probe_mode: bool = True, total: int = 1, dead_days: int = health.DEAD_DAYS) -> DataFrame:
    """A day's results into the stored history, the stored streaks on by that day, and the actions that follow.

    Reads the folders of the day and the states, not the history; that only for sources whose last success was taken back.
    Running a day again changes nothing.
    """
    days = history.upsert_days(spark, f"{store}/days", new)
    written, whole = history.read_history(spark, f"{store}/days", days), history.read_history(spark, f"{store}/days")
    states = history.read_streaks(spark, f"{store}/streaks")
    states = health.streak_states(whole) if states is None else health.advance_states(states, written, whole)
    history.write_streaks(spark, states, f"{store}/streaks")
    known = health.history_in_registry(history.read_streaks(spark, f"{store}/streaks"), registry).where(F.lit(probe_mode and total > 0))
    return health.actions(health.streaks_of(known, dead_days))


def run_guides(documents: DataFrame, out: str) -> None:
    """All guide documents into one."""
    sinks.write_guide(*merge_guides(documents), out)
