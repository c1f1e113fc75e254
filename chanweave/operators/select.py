"""Best links: K per name and category, one owner per address, K per name over all, one owner over all.

Cuts are row numbers, so Spark can cut before the shuffle; order keys come from aggregations with map-side combine. No
step uses its input twice but the first. Rows without an address are alone in address windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.addresses import is_rtp, selection_key
from ..functions.dims import RADIO, region_rank

NO_LATENCY = 999_999


def alive_only(rows: DataFrame) -> DataFrame:
    """Without rows that are known dead; unknown stays."""
    return rows.where(~F.col("alive").eqNullSafe(F.lit(False)))


def _cost() -> list[Column]:
    return [F.col("s_region"), F.col("s_rtp"), F.col("s_latency")]


def _with_keys(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("url", F.coalesce("url", F.lit(""))).withColumn("k", selection_key())
    return rows.withColumns(
        {"s_region": region_rank("source_region"), "s_rtp": is_rtp("url").cast("int"), "s_latency": F.coalesce("latency_ms", F.lit(NO_LATENCY))}
    )


def top_k_per_key(rows: DataFrame, keep: int) -> DataFrame:
    """rows with keys -> rows with r1, the place in (category, k)."""
    place = F.row_number().over(Window.partitionBy("category", "k").orderBy(*_cost(), "ord"))
    return rows.withColumn("r1", place).where(F.col("r1") <= keep)


def best_per_key(rows: DataFrame) -> DataFrame:
    """rows with keys -> the cheapest one of each (category, k), with r1 = 1 and key_ord: one aggregation with map-side
    combine, so a hot channel is one row a task before the shuffle."""
    kept = [c for c in rows.columns if c not in ("category", "k")]
    best = F.min_by(F.struct(*kept), F.struct(*_cost(), "ord")).alias("best")
    return rows.groupBy("category", "k").agg(best, F.min("ord").alias("key_ord")).select("category", "k", "best.*", "key_ord", F.lit(1).alias("r1"))


def _owner_key() -> Column:
    """The address; rows without one are alone, and so spread."""
    return F.when(F.col("url") != "", F.col("url")).otherwise(F.concat(F.lit("\x00"), F.col("ord")))


def dedup_url(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """First row per address within `by`; rows without address stay."""
    place = F.row_number().over(Window.partitionBy(*by, _owner_key()).orderBy(*order))
    return rows.withColumn("place", place).where("place = 1").drop("place")


def global_top_k(rows: DataFrame, keep: int) -> DataFrame:
    """Survivors of all categories -> rows with r2, the place in k."""
    place = F.row_number().over(Window.partitionBy("k").orderBy(*_cost(), "cat_ord", "key_ord", "r1"))
    return rows.withColumn("r2", place).where(F.col("r2") <= keep)


def select_best(rows: DataFrame, keep: int = 1, url_policy: str = "first") -> DataFrame:
    """The chosen rows, with cat_ord, key_ord and the place keys p1, p2 that order them inside a category.

    url_policy: "first" gives a shared address to the entry that comes first, "best" to the one with the lowest cost.
    """
    columns = rows.columns
    cat_ord = rows.groupBy("category").agg(F.min("ord").alias("cat_ord"))
    keyed = _with_keys(alive_only(rows))
    if keep == 1:
        first = best_per_key(keyed)
    else:  # the window's cut comes before its shuffle, too
        first = top_k_per_key(keyed, keep).join(keyed.groupBy("category", "k").agg(F.min("ord").alias("key_ord")), ["category", "k"])
    first = first.join(cat_ord, "category")
    lowest = [] if url_policy == "first" else ["s_region", "s_rtp", "s_latency"]
    first = dedup_url(first, ["category"], [*lowest, "key_ord", "r1"])

    # Radio goes along in the same rows: it is not cut by name, and it gives way to all others at shared addresses. A name
    # has at most `keep` rows a category here, so its windows are small.
    place = F.struct("cat_ord", "key_ord", "r1")
    radio = F.coalesce(F.col("category") == RADIO[0], F.lit(False))
    of_name = Window.partitionBy("radio", "k")
    ranked = first.withColumn("radio", radio).withColumn("nk_first", F.min(place).over(of_name))
    ranked = ranked.withColumn("r2", F.row_number().over(of_name.orderBy(*_cost(), "cat_ord", "key_ord", "r1"))).where(F.col("radio") | (F.col("r2") <= keep))
    owners = dedup_url(ranked, [], ["radio", *lowest, "cat_ord", "nk_first", "r2"])
    p1 = F.when(F.col("radio"), place).otherwise(F.col("nk_first"))
    return owners.select(*columns, "cat_ord", "key_ord", p1.alias("p1"), F.when(F.col("radio"), F.col("r1")).otherwise(F.col("r2")).alias("p2"))


def radio_anti(radio: DataFrame, others: DataFrame) -> DataFrame:
    """Radio rows whose address no other row owns; rows without address stay."""
    return radio.join(others.where("url <> ''").select("url").distinct(), "url", "left_anti")


def verified(rows: DataFrame) -> DataFrame:
    """Rows known alive, first per address, without empty addresses."""
    good = rows.where(F.col("alive").eqNullSafe(F.lit(True)) & (F.coalesce("url", F.lit("")) != ""))
    return good.withColumn("place", F.row_number().over(Window.partitionBy("url").orderBy("ord"))).where("place = 1").drop("place")
