"""Channel names: cleaning and tests. All are built-in expressions but phrase conversion."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A run of blanks is tried once, from its start (the lookbehind). Patterns carry (?U) so that \s, \d, \w and \b follow Unicode, whatever the Java version.
# What counts as a resolution, status or icon tag, as junk, and as a China Central Television name.
RESOLUTION = r"(?iuU)[\[\(]?(?<!\s)\s*(\d{3,4}[pPiI]|4K|UHD|FHD|HD|SD|超清[普标]?|高清[普标]?|标清[普标]?|极清|蓝光|流畅)\s*[\]\)]?"
STATUS = (
    r"(?iuU)\[?(?<!\s)\s*(失效|备用|官方|测试|主用|唯一|电信|联通|移动|广电|中国|默认|\d+M|Not\s*24/7|geo[- ]?block|geo[- ]?restrict)\s*\]?"
)
ICON = r"(?iuU)\[(?:file|icon|logo|img)\]"
JUNK = r"(?iuU)^[#\s]*$|^Mozilla/|^User-Agent|^#(?:EXTM3U|EXTINF|EXTVLCOPT|KODIPROP)"
CCTV = r"(?iuU)\bCCTV\s*(\d+)((?:\s*[-—]\s*)?)"
EMPTY_BRACKETS = r"(?U)\(\s*\)|\[\s*\]"
EDGE_MARKS = "—\\-–\\s,，、"
LEAST_LENGTH = 2
#: A conversion table up to this size is sent to every task; an entry counts its texts and ROW_BYTES.
TABLE_BYTES, ROW_BYTES = 32 << 20, 64

# Traditional characters and their simplified forms, as far as channel names use them. Users with wider
# needs pass tables of their own.
TRADITIONAL = "鳳凰衛視臺灣電體廣東華綜亞龍頻貓財經紀錄樂動畫軍國際農業劇聞資訊購兒戲學衝線網絡頭條無馬會邁遼寧雲貴陝蘇濟瀋長門視聲樂廈歡緯來現場影業"
SIMPLIFIED = "凤凰卫视台湾电体广东华综亚龙频猫财经纪录乐动画军国际农业剧闻资讯购儿戏学冲线网络头条无马会迈辽宁云贵陕苏济沈长门视声乐厦欢纬来现场影业"


def strip(x: Column) -> Column:
    """Without white space (of Unicode) at both ends. One match from the start, so long runs of blanks cost linear time."""
    return F.regexp_extract(x, r"(?sU)\A\s*(.*\S)?\s*\z", 1)


def has_chinese(x: Column | str) -> Column:
    return F.col(x).rlike("[一-鿿]") if isinstance(x, str) else x.rlike("[一-鿿]")


def is_junk_name(x: Column) -> Column:
    return x.rlike(JUNK)


def strip_resolution(x: Column) -> Column:
    return F.regexp_replace(x, RESOLUTION, "")


def strip_status(x: Column) -> Column:
    return F.regexp_replace(x, STATUS, "")


def strip_icons(x: Column) -> Column:
    return F.regexp_replace(x, ICON, "")


def normalise_cctv(x: Column) -> Column:
    """Put one dash between the letters and the number; a dash after the number stays, one at the very end goes."""
    return F.regexp_replace(F.regexp_replace(x, CCTV, "CCTV-$1$2"), r"(?U)\bCCTV-\s*$", "CCTV")


def drop_empty_brackets(x: Column) -> Column:
    return F.regexp_replace(x, EMPTY_BRACKETS, "")


def trim_marks(x: Column) -> Column:
    return strip(F.regexp_extract(x, rf"(?sU)\A[{EDGE_MARKS}]*(.*[^{EDGE_MARKS}])?[{EDGE_MARKS}]*\z", 1))


def to_simplified(x: Column, traditional: str = TRADITIONAL, simplified: str = SIMPLIFIED) -> Column:
    """Character by character."""
    return F.translate(x, traditional, simplified)


def without_tags(raw: Column | str) -> Column:
    """The steps before conversion to simplified characters. Empty where the name is junk."""
    x = strip(F.coalesce(F.col(raw) if isinstance(raw, str) else raw, F.lit("")))
    junk = is_junk_name(x)
    x = strip(strip_resolution(x))
    x = strip(strip_status(x))
    x = strip(strip_icons(x))
    x = strip(drop_empty_brackets(normalise_cctv(x)))
    return F.when(junk, "").otherwise(F.regexp_replace(x, " {2,}", " "))


def trimmed(x: Column) -> Column:
    """The steps after conversion. Empty where the name is shorter than two characters.

    x occurs once: the filter on the result is pushed down, and every copy of x there would carry all steps of cleaning.
    """
    return F.regexp_replace(trim_marks(x), rf"(?s)\A.{{0,{LEAST_LENGTH - 1}}}\z", "")


def clean_channel_name(raw: Column | str, traditional: str = TRADITIONAL, simplified: str = SIMPLIFIED) -> Column:
    """Null where the name is junk or shorter than two characters at the end."""
    clean = trimmed(to_simplified(without_tags(raw), traditional, simplified))
    return F.when(clean != "", clean)


def _small(table: DataFrame) -> list[tuple[str, str]] | None:
    """The rows of a conversion table, or None where they are over TABLE_BYTES: Spark measures them first."""
    rows = table.select("traditional", "simplified").where("traditional <> '' AND simplified IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("traditional") + F.octet_length("simplified") + ROW_BYTES)).first()[0] or 0
    return [tuple(r) for r in rows.groupBy("traditional").agg(F.min("simplified")).collect()] if size <= TABLE_BYTES else None


def _kept_apart(x: Column) -> Column:
    """The same value behind an outer explode. Filters and joins on it stay above: as a plain expression of the raw name Spark
    would infer them for both sides of the join by that name, below the distinct too, and clean every row several times."""
    return F.explode_outer(F.array(x))


def clean_channels(entries: DataFrame, name: str = "name", phrases: DataFrame | None = None, characters: DataFrame | None = None) -> DataFrame:
    """Replace names by clean ones and drop rows without. Distinct raw names are cleaned once and joined back.

    phrases, characters: (traditional, simplified) tables for the conversion, phrases first; characters add to the fixed ones.
    """
    names = entries.select(F.coalesce(F.col(name), F.lit("")).alias("__raw")).distinct()
    if phrases is None and characters is None:
        names = names.select("__raw", _kept_apart(trimmed(to_simplified(without_tags("__raw")))).alias("__clean"))
    else:
        names = simplify_phrases(names.select("__raw", _kept_apart(without_tags("__raw")).alias("__clean")), phrases, "__clean", characters)
        names = names.select("__raw", _kept_apart(trimmed(F.col("__clean"))).alias("__clean"))
    joined = entries.withColumn("__raw", F.coalesce(F.col(name), F.lit(""))).join(names.where("__clean <> ''"), "__raw")
    return joined.withColumn(name, F.col("__clean")).drop("__raw", "__clean")


def conversion(phrases: DataFrame | None, characters: DataFrame | None, spark: SparkSession) -> DataFrame:
    """One table (traditional, simplified): of a key's entries the phrase counts, then the character, then
    the fixed one (the least, if a table has several)."""
    fixed = spark.createDataFrame(list(zip(TRADITIONAL, SIMPLIFIED, strict=True)), "traditional string, simplified string")
    tables = [t.select("traditional", "simplified") for t in (phrases, characters, fixed) if t is not None]
    ranked = [t.withColumn("rank", F.lit(k)) for k, t in enumerate(tables)]
    known = reduce(DataFrame.unionByName, ranked).where("traditional <> '' AND simplified IS NOT NULL")
    return known.groupBy("traditional").agg(F.min(F.struct("rank", "simplified"))["simplified"].alias("simplified"))


def simplify_phrases(names: DataFrame, phrases: DataFrame | None, name: str = "name", characters: DataFrame | None = None) -> DataFrame:
    """Replace from the left, the longest phrase first; a character that begins no phrase stays as it is.

    Single characters are phrases of length one, so one pass does all. While the table is small (TABLE_BYTES, measured
    before it is collected), it goes to every task, which makes a trie of it once and sends names through it in Arrow batches.
    Beyond that the names' pieces meet the table in a join.
    """
    table = conversion(phrases, characters, names.sparkSession)
    rows = _small(table)
    return _by_trie(names, name, rows) if rows is not None else _by_join(names, name, table)


def phrase_trie(rows: list[tuple[str, str]]) -> dict:
    """Nested by character; under the empty key, what the phrase that ends there becomes."""
    root: dict = {}
    for traditional, simplified in rows:
        node = root
        for c in traditional:
            node = node.setdefault(c, {})
        node[""] = simplified
    return root


def replaced(text: str, trie: dict) -> str:
    out, at = [], 0
    while at < len(text):
        node, found, end = trie, text[at], at + 1
        for k in range(at, len(text)):
            node = node.get(text[k])
            if node is None:
                break
            if "" in node:
                found, end = node[""], k + 1
        out.append(found)
        at = end
    return "".join(out)


def _by_trie(names: DataFrame, name: str, rows: list[tuple[str, str]]) -> DataFrame:
    shared = names.sparkSession.sparkContext.broadcast(rows)

    @F.pandas_udf("string")
    def converted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trie = phrase_trie(shared.value)
        for batch in texts:
            yield batch.map(lambda x: replaced(x, trie), na_action="ignore")

    return names.withColumn(name, converted(name))


def _by_join(names: DataFrame, name: str, table: DataFrame) -> DataFrame:
    """Each distinct name is cut at the characters that begin a phrase, into windows as long as such phrases can be. Beginnings
    of distinct windows are looked up by an equi-join, and the matches are walked from the left.

    The table of first characters has at most a row per character there is, so it goes to every task. Single characters are
    looked up in it; what is shuffled grows with the places where a longer phrase can begin, not with the length of names.
    """
    text, length = F.col("__text"), F.length("traditional")
    firsts = table.groupBy(F.substring("traditional", 1, 1).alias("first")).agg(F.max(length).alias("longest"), F.max(F.when(length == 1, F.col("simplified"))).alias("single"))
    once = names.select(F.col(name).alias("__text")).where("__text <> ''").distinct()
    starts = once.select("__text", F.explode(F.sequence(F.lit(1), F.length(text))).alias("at"))
    starts = starts.withColumn("first", F.substr(text, F.col("at"), F.lit(1))).join(F.broadcast(firsts), "first")
    starts = starts.select("__text", "at", F.substr(text, F.col("at"), F.col("longest")).alias("window"), "single")
    long = starts.where(F.length("window") > 1)
    windows = long.select("window").distinct()
    begin = lambda n: F.substr(F.col("window"), F.lit(1), n)
    pieces = windows.select("window", F.explode(F.sequence(F.lit(2), F.length("window"))).alias("n"))
    # Lengths first: the aggregate over all matches stays free of texts that no window keeps.
    best = pieces.join(table.where(length > 1).select("traditional"), begin(F.col("n")) == F.col("traditional")).groupBy("window").agg(F.max("n").alias("n"))
    best = best.join(table, begin(F.col("n")) == F.col("traditional")).select("window", "n", "simplified")
    looked_up = long.join(best, "window", "left").select("__text", "at", F.coalesce("n", F.lit(1)).alias("n"), F.when(F.col("n").isNull(), F.col("single")).otherwise(F.col("simplified")).alias("simplified"))
    matches = looked_up.unionByName(starts.where(F.length("window") == 1).select("__text", "at", F.lit(1).alias("n"), F.col("single").alias("simplified"))).where("simplified IS NOT NULL")
    found = matches.groupBy("__text").agg(F.sort_array(F.collect_list(F.struct("at", "n", "simplified"))).alias("found"))
    origin = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
    step = lambda s, m: F.when(m["at"] < s["at"], s).otherwise(
        F.struct((m["at"] + m["n"]).alias("at"), F.concat(s["out"], F.substr(text, s["at"], m["at"] - s["at"]), m["simplified"]).alias("out"))
    )
    walked = found.withColumn("s", F.aggregate("found", origin, step))
    changed = walked.select("__text", F.concat("s.out", F.substr(text, F.col("s.at"), F.length(text))).alias("__changed"))
    joined = names.join(changed, F.col(name) == F.col("__text"), "left")
    return joined.withColumn(name, F.coalesce("__changed", name)).drop("__text", "__changed")
