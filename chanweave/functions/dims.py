"""Categories, regions and source sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Category keys in canonical order, titles, file suffixes. Radio stands outside the order.
CATEGORIES = (
    ("cctv", "央视"),
    ("weishi", "卫视"),
    ("local", "各省市"),
    ("gangtai", "港澳台"),
    ("sports", "体育"),
    ("live", "网络直播"),
    ("overseas", "国际"),
    ("special", "特殊·酒店源"),
    ("other", "其他"),
)
RADIO = ("radio", "电台")

# Preference of source regions, and the two sets of core sources.
REGION_RANK = {"cn": 0, "hk_tw": 1, "hotel": 2, "overseas": 3}
UNKNOWN_REGION_RANK = 99
CORE_SOURCES = ("fanmingming-ipv6", "guovin-iptv-api", "iptv-org-cn", "iptv-org-hk", "iptv-org-tw", "yuechan-cn")
CORE_HEALTH_SOURCES = ("fanmingming-ipv6", "iptv-org-cn", "iptv-org-hk", "iptv-org-tw", "yuechan-cn")

UNPLACED = 999


def categories(spark: SparkSession) -> DataFrame:
    """category, ord (null for radio), title, file, is_radio: ten rows."""
    rows = [(key, k, title, f"live_{key}.m3u", False) for k, (key, title) in enumerate(CATEGORIES)]
    return spark.createDataFrame([*rows, (RADIO[0], None, RADIO[1], f"live_{RADIO[0]}.m3u", True)], "category string, ord int, title string, file string, is_radio boolean")


def _lookup(key: Column | str, values: dict) -> Column:
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return table[F.col(key) if isinstance(key, str) else key]


def title_for(category: Column | str) -> Column:
    return _lookup(category, dict((*CATEGORIES, RADIO)))


def file_for(category: Column | str) -> Column:
    return _lookup(category, {key: f"live_{key}.m3u" for key, _ in (*CATEGORIES, RADIO)})


def position_of(category: Column | str) -> Column:
    """Place in the canonical order; 999 for radio and unknown keys."""
    return F.coalesce(_lookup(category, {key: k for k, (key, _) in enumerate(CATEGORIES)}), F.lit(UNPLACED))


def is_radio(category: Column | str) -> Column:
    return (F.col(category) if isinstance(category, str) else category) == RADIO[0]


def region_rank(region: Column | str) -> Column:
    """Missing counts as cn, unknown comes last."""
    region = F.col(region) if isinstance(region, str) else region
    return F.coalesce(_lookup(F.coalesce(region, F.lit("cn")), REGION_RANK), F.lit(UNKNOWN_REGION_RANK))


def core_flag(source: Column | str, core: tuple[str, ...] = CORE_SOURCES) -> Column:
    """Whether the source is in the core set; a missing name is not."""
    source = F.col(source) if isinstance(source, str) else source
    return F.coalesce(source.isin(*core), F.lit(False))


def normalise_group_title(entries: DataFrame) -> DataFrame:
    """group_title by category; unknown categories keep theirs."""
    return entries.withColumn("group_title", F.coalesce(title_for("category"), "group_title"))
