"""Health of sources over days, and checks of the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.addresses import is_valid_url
from ..functions.dims import CORE_HEALTH_SOURCES, core_flag

DEAD_DAYS = 3


def latest_days(rows: DataFrame) -> DataFrame:
    """One row per (source, day): the one written last (ties: the failure, then the greater address)."""
    order = F.struct("written_at", ~F.col("success"), "url")
    last = rows.groupBy("source", "day").agg(F.max_by(F.struct("url", "success", "written_at"), order).alias("r"))
    return last.select("source", "r.url", "r.success", "r.written_at", "day")


def upsert_history(history: DataFrame, new: DataFrame) -> DataFrame:
    """One value per (source, day): the one written last (written_at) wins; the address is the latest of the source."""
    rows = history.unionByName(new)
    latest = rows.groupBy("source").agg(F.max_by("url", F.struct("written_at", "day")).alias("url"))
    return latest_days(rows).drop("url").join(latest, "source").select("source", "url", "day", "success", "written_at")


def dead_streaks(history: DataFrame, dead_days: int = DEAD_DAYS) -> DataFrame:
    """source, streak (failures since the newest recorded day), dead. Days without a record do not break a streak.

    As an aggregation: the failures after the last success, or all of them.
    """
    last = history.where("success").groupBy("source").agg(F.max("day").alias("last_success"))
    later = history.join(last, "source", "left").where(~F.col("success"))
    open_ = later.where(F.col("last_success").isNull() | (F.col("day") > F.col("last_success"))).groupBy("source").agg(F.count_distinct("day").alias("streak"))
    streak = F.coalesce("streak", F.lit(0)).cast("long")
    return history.select("source").distinct().join(open_, "source", "left").select("source", streak.alias("streak"), (streak >= dead_days).alias("dead"))


def streak_states(history: DataFrame) -> DataFrame:
    """source, last_success, fails: the failing days after the last success, in order; they are at most the calendar's days.

    States of disjoint sets of days merge (merge_states), in any order.
    """
    days = history.groupBy("source").agg(F.max(F.when(F.col("success"), F.col("day"))).alias("last_success"), F.collect_set(F.when(~F.col("success"), F.col("day"))).alias("fails"))
    return days.select("source", "last_success", _after("fails", "last_success").alias("fails"))


def _after(fails: str, last: str) -> Column:
    return F.array_sort(F.filter(fails, lambda d: F.col(last).isNull() | (d > F.col(last))))


def merge_states(states: DataFrame, more: DataFrame) -> DataFrame:
    """States of both: the later success, and the failures after it. One row per source on each side, one join."""
    old = states.select("source", F.col("last_success").alias("l1"), F.col("fails").alias("f1"))
    new = more.select("source", F.col("last_success").alias("l2"), F.col("fails").alias("f2"))
    none = F.array().cast("array<date>")
    both = old.join(new, "source", "full").withColumns({"last_success": F.greatest("l1", "l2"), "fails": F.array_union(F.coalesce("f1", none), F.coalesce("f2", none))})
    return both.select("source", "last_success", _after("fails", "last_success").alias("fails"))


def rewritten_sources(states: DataFrame, days: DataFrame) -> DataFrame:
    """Sources whose state a day's new value contradicts: their last success is now a failure, or a failure a success
    (that is no contradiction where it is the later success). Their states come from the history again."""
    changed = states.join(days.select("source", "day", "success"), "source").where((F.col("day") == F.col("last_success")) & ~F.col("success"))
    return changed.select("source").distinct()


def advance_states(states: DataFrame, days: DataFrame, history: DataFrame) -> DataFrame:
    """States after the rows of some days (one per source and day), late ones too. `history` already holds those rows; it is
    read only for sources whose last success was taken back."""
    stale = rewritten_sources(states, days)
    fresh = merge_states(states, streak_states(days)).join(stale, "source", "left_anti")
    return fresh.unionByName(streak_states(history.join(stale, "source", "left_semi")))


def streaks_of(states: DataFrame, dead_days: int = DEAD_DAYS) -> DataFrame:
    """source, streak, dead, as dead_streaks gives them."""
    streak = F.size("fails").cast("long")
    return states.select("source", streak.alias("streak"), (streak >= dead_days).alias("dead"))


def history_in_registry(history: DataFrame, registry: DataFrame) -> DataFrame:
    return history.join(registry.select(F.col("name").alias("source")), "source", "left_semi")


def flag_dead_sources(history: DataFrame, registry: DataFrame, probe_mode: bool, total: int, core: tuple[str, ...] = CORE_HEALTH_SOURCES, dead_days: int = DEAD_DAYS) -> DataFrame:
    """source, streak, action (warn for core sources, else disable). Without probing or rows there is nothing to tell."""
    known = history_in_registry(history, registry).where(F.lit(probe_mode and total > 0))
    return actions(dead_streaks(known, dead_days), core)


def actions(streaks: DataFrame, core: tuple[str, ...] = CORE_HEALTH_SOURCES) -> DataFrame:
    """What is done about dead sources: source, streak, action."""
    dead = streaks.where("dead")
    return dead.select("source", "streak", F.when(core_flag("source", core), "warn").otherwise("disable").alias("action"))


def duplicate_occurrences(registry: DataFrame, column: str) -> DataFrame:
    """Rows from the second use of a non-empty value on."""
    used = registry.where(F.coalesce(column, F.lit("")) != "")
    return used.withColumn("use", F.row_number().over(Window.partitionBy(column).orderBy("source_idx"))).where("use > 1")


def validate_registry(registry: DataFrame) -> DataFrame:
    """source_idx, problem. A row without address is not checked further."""
    text = lambda c: F.coalesce(c, F.lit(""))
    rows = registry.withColumns({c: text(c) for c in ("name", "url", "type")})
    use = lambda c: F.row_number().over(Window.partitionBy(c).orderBy("source_idx"))
    rows = rows.withColumn("name_use", use("name")).withColumn("url_use", use("url"))
    has_url = F.col("url") != ""
    problems = F.array_compact(
        F.array(
            F.when(F.col("name") == "", "missing name"),
            F.when((F.col("name") != "") & (F.col("name_use") > 1), "duplicate name"),
            F.when(~has_url, "empty url"),
            F.when(has_url & ~is_valid_url("url"), "malformed url"),
            F.when(has_url & (F.col("url_use") > 1), "duplicate url"),
            F.when(has_url & ~F.col("type").isin("m3u", "txt"), "unknown type"),
        )
    )
    return rows.select("source_idx", F.explode(problems).alias("problem"))
