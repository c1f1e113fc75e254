"""Registered queries of the catalogue operators, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import scratch
from ..functions import addresses, dims, names
from ..functions.rules import classify_by_rules
from ..operators import health, match, order, probe, quality, select, split
from ..sources import history, playlists, sinks, tables
from . import derive, jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Register the function under its name, with its SQL."""
    def keep(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return keep


def text_list(values) -> str:
    return ", ".join("(" + ", ".join("NULL" if v is None else str(v) if isinstance(v, (int, bool)) else "'" + v.replace("'", "''") + "'" for v in row) + ")" for row in values)


C = f"c AS ({derive.CANDIDATE_SQL})"
RANK = "CASE coalesce(source_region, 'cn') WHEN 'cn' THEN 0 WHEN 'hk_tw' THEN 1 WHEN 'hotel' THEN 2 WHEN 'overseas' THEN 3 ELSE 99 END"
POSITION = "CASE category WHEN 'cctv' THEN 0 WHEN 'local' THEN 2 WHEN 'sports' THEN 4 WHEN 'overseas' THEN 6 ELSE 999 END"
TITLE = "CASE category WHEN 'cctv' THEN '央视' WHEN 'local' THEN '各省市' WHEN 'sports' THEN '体育' WHEN 'overseas' THEN '国际' WHEN 'radio' THEN '电台' END"


def best(keep: int) -> str:
    """Common table expressions up to sel: the selected rows."""
    return f"""{C},
co AS (SELECT category, min(ord) AS cat_ord FROM c GROUP BY category),
w AS (SELECT *, coalesce(nullif(standard_name, ''), name, '?') AS k, {RANK} AS sr, CAST(lower(url) LIKE 'rtp://%' AS INT) AS sp,
             coalesce(latency_ms, 999999) AS sl FROM c WHERE alive IS DISTINCT FROM FALSE),
ko AS (SELECT category, k, min(ord) AS key_ord FROM w GROUP BY category, k),
a AS (SELECT w.*, key_ord, cat_ord, row_number() OVER (PARTITION BY w.category, w.k ORDER BY sr, sp, sl, ord) AS r1
      FROM w JOIN ko ON w.category = ko.category AND w.k = ko.k JOIN co ON w.category = co.category QUALIFY r1 <= {keep}),
u1 AS (SELECT * FROM a QUALIFY url = '' OR row_number() OVER (PARTITION BY category, url ORDER BY key_ord, r1) = 1),
nk AS (SELECT k, min({{'a': cat_ord, 'b': key_ord, 'c': r1}}) AS nk FROM u1 WHERE category <> 'radio' GROUP BY k),
b AS (SELECT u1.*, nk, row_number() OVER (PARTITION BY u1.k ORDER BY sr, sp, sl, cat_ord, key_ord, r1) AS r2
      FROM u1 JOIN nk ON u1.k = nk.k WHERE category <> 'radio' QUALIFY r2 <= {keep}),
u2 AS (SELECT * FROM b QUALIFY url = '' OR row_number() OVER (PARTITION BY url ORDER BY cat_ord, nk, r2) = 1),
sel AS (SELECT ord, name, url, category, standard_name, alive, cat_ord, nk, r2 FROM u2
        UNION ALL SELECT ord, name, url, category, standard_name, alive, cat_ord, {{'a': cat_ord, 'b': key_ord, 'c': r1}}, r1 FROM u1
        WHERE category = 'radio' AND (url = '' OR url NOT IN (SELECT url FROM u2 WHERE url <> ''))),
tgt AS (SELECT *, CASE WHEN category = 'radio' THEN 'catalog' WHEN category = 'overseas' THEN 'dropped' WHEN standard_name <> '' THEN 'catalog' ELSE 'more' END AS target FROM sel)"""


SEL = ["ord", "name", "url", "category", "standard_name"]


def selected(spark: SparkSession, sf_dir: str, keep: int = 1) -> DataFrame:
    return select.select_best(derive.candidates(spark, sf_dir), keep)


# Sources and sinks

BLOCK_LENGTH = """
SELECT user_id, 9 + sum(length(concat_ws(chr(10), CASE WHEN event_id % 5 = 0 THEN 'http://stray.example.com/x' END,
  concat('#EXTINF:-1 tvg-id="t', event_id % 10, '" group-title="g', event_id % 4, '",Name ', event_id),
  CASE WHEN event_id % 3 = 0 THEN concat('#EXTGRP: late', event_id % 2) END,
  CASE WHEN event_id % 7 = 0 THEN '#EXTVLCOPT:http-user-agent=x' END, concat('http://h.example.com/', event_id)))) + count(*) - 1 AS n
FROM events GROUP BY user_id"""


@query(f"""SELECT concat('u', user_id) AS source, 'cn' AS region, CASE WHEN user_id % 7 = 1 THEN {len(playlists.NOT_LANDED)} ELSE CAST(n AS BIGINT) END AS n_chars,
user_id % 7 = 1 AS failed FROM ({BLOCK_LENGTH}) WHERE user_id % 3 <> 0""")
def s1_read_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are landed, most of them packed, then read with the registry of their sources: every third is disabled, and
    of every seventh nothing landed."""
    docs = derive.playlist_documents(spark, sf_dir).withColumnRenamed("source", "name")
    files, records = derive.land(docs.where("source_idx % 7 <> 1"), scratch.shared_folder(spark, "landing"))
    registry = docs.select("source_idx", "name", "url", "type", "region", (F.col("source_idx") % 3 != 0).alias("enabled"))
    read = playlists.read_payloads(spark, files, registry, folders=True, records=records)
    text = F.regexp_replace("content", "\n$", "")
    return read.select("source", "region", F.length(text).cast("long").alias("n_chars"), playlists.is_error_payload("content").alias("failed"))


M3U_ROWS = """SELECT user_id AS source_idx, concat('Name ', event_id) AS name, concat('http://h.example.com/', event_id) AS url,
  concat('t', event_id % 10) AS tvg_id, CASE WHEN event_id % 3 = 0 THEN concat('late', event_id % 2) ELSE concat('g', event_id % 4) END AS group_title FROM events"""
TXT_ROWS = """SELECT source_idx, name, url, '' AS tvg_id, group_title FROM (
  SELECT user_id AS source_idx, event_id, concat('Name ', event_id) AS name, concat('http://h.example.com/', event_id, ',x') AS url,
  coalesce(last_value(CASE WHEN event_id % 4 = 0 THEN concat('G', event_id % 6) END IGNORE NULLS)
    OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS group_title FROM events) WHERE event_id % 9 <> 0"""


def _parsed(entries: DataFrame) -> DataFrame:
    return entries.select(F.shiftright("ord", playlists.LINE_BITS).alias("source_idx"), "name", "url", "tvg_id", "group_title")


@query(M3U_ROWS)
def s2_parse_m3u(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(playlists.parse_m3u(derive.playlist_documents(spark, sf_dir)))


@query(TXT_ROWS)
def s3_parse_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(playlists.parse_txt(derive.txt_documents(spark, sf_dir)))


def _landed(spark: SparkSession, sf_dir: str, lines: str, kind: str) -> DataFrame:
    """Entries of long lists, read in splits so small that each list has several."""
    path = scratch.shared_folder(spark, "lists")
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    small.conf.set("spark.sql.files.openCostInBytes", "1k")
    entries = playlists.parse_landed(small, path, derive.land_long_lists(small, sf_dir, lines, kind, path), folders=True)
    line_no = F.col("ord").bitwiseAND(F.lit((1 << playlists.LINE_BITS) - 1))
    return entries.select(F.shiftright("ord", playlists.LINE_BITS).alias("source_idx"), line_no.alias("line_no"), "name", "url", "tvg_id", "group_title")


@query("""SELECT CAST(user_id % 3 AS BIGINT) AS source_idx, CAST(sum(2 + CAST(event_id % 5 = 0 AS INT) + CAST(event_id % 3 = 0 AS INT) + CAST(event_id % 7 = 0 AS INT))
    OVER (PARTITION BY user_id % 3 ORDER BY user_id, event_id) - 1 AS BIGINT) AS line_no, concat('Name ', event_id) AS name, concat('http://h.example.com/', event_id) AS url,
  concat('t', event_id % 10) AS tvg_id, CASE WHEN event_id % 3 = 0 THEN concat('late', event_id % 2) ELSE concat('g', event_id % 4) END AS group_title FROM events""")
def s2_parse_landed_m3u(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three long lists, each in several splits."""
    return _landed(spark, sf_dir, derive.M3U_LINES, "m3u")


@query("""SELECT source_idx, line_no, name, url, '' AS tvg_id, group_title FROM (
  SELECT CAST(user_id % 3 AS BIGINT) AS source_idx, event_id, concat('Name ', event_id) AS name, concat('http://h.example.com/', event_id, ',x') AS url,
    CAST(sum(2 + CAST(event_id % 64 = 0 AS INT)) OVER w - 2 AS BIGINT) AS line_no,
    coalesce(last_value(CASE WHEN event_id % 64 = 0 THEN concat('G', event_id % 6) END IGNORE NULLS) OVER w, '') AS group_title
  FROM events WINDOW w AS (PARTITION BY user_id % 3 ORDER BY user_id, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) WHERE event_id % 9 <> 0""")
def s3_parse_landed_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with text lists, whose group headers lie far apart and are carried over splits."""
    return _landed(spark, sf_dir, derive.TXT_LINES, "txt")


def _mixed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even users as playlists, odd ones as text lists; every tenth fetch failed."""
    m3u, txt = derive.playlist_documents(spark, sf_dir).where("source_idx % 2 = 0"), derive.txt_documents(spark, sf_dir).where("source_idx % 2 = 1")
    failed = F.when(F.col("source_idx") % 10 == 0, "HTTP 404").when(F.col("source_idx") % 10 == 5, "ERROR: timeout").otherwise(F.col("content"))
    return m3u.unionByName(txt).withColumn("content", failed)


@query(f"SELECT * FROM ({M3U_ROWS}) WHERE source_idx % 2 = 0 AND source_idx % 5 <> 0 UNION ALL SELECT * FROM ({TXT_ROWS}) WHERE source_idx % 2 = 1 AND source_idx % 5 <> 0")
def s4_parse_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also the union of all sources' entries (U1) and the error test (F4)."""
    return _parsed(playlists.parse_payloads(_mixed_payloads(spark, sf_dir)))


GUIDE_PROGRAMMES = """SELECT user_id AS doc_idx, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS elem_idx, concat('c', event_id % 20) AS channel,
  CAST(event_id % 50 AS VARCHAR) AS start, CAST(event_id AS VARCHAR) AS stop, CASE WHEN event_id % 3 = 0 THEN '' ELSE concat('T', event_id % 7) END AS title
  FROM events WHERE user_id % 41 <> 7"""
GUIDE_CHANNELS = """SELECT user_id AS doc_idx, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS elem_idx,
  CASE WHEN event_id % 29 = 0 THEN '' ELSE concat('c', event_id % 300) END AS id, concat('D', event_id) AS display_name FROM events WHERE user_id % 41 <> 7"""


@query(GUIDE_PROGRAMMES)
def s6_read_guides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_guides(derive.guide_documents(spark, sf_dir), element=False)[1]


@query(f"SELECT g.*, concat('i', event_id % 9) AS icon FROM ({GUIDE_CHANNELS.replace('FROM events', ', event_id FROM events')}) g".replace("g.*", "doc_idx, elem_idx, id, display_name"))
def s6_read_guide_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = tables.read_guides(derive.guide_documents(spark, sf_dir))[0]
    return channels.select("doc_idx", "elem_idx", "id", "display_name", F.element_at("element.icon._src", 1).alias("icon"))


def _landed_guides(spark: SparkSession, sf_dir: str) -> dict:
    """Guides are landed, broken ones too, most of them packed; what is to be read. Files are read element by element."""
    docs = derive.guide_documents(spark, sf_dir).select(F.col("doc_idx").alias("source_idx"), F.concat(F.lit("g"), "doc_idx").alias("name"), F.col("xml").alias("content"))
    files, records = derive.land(docs, scratch.shared_folder(spark, "guides"))
    return {"path": files, "records": records, "registry": docs.select("source_idx", "name", F.lit(True).alias("enabled")), "folders": True, "element": False}


@query(GUIDE_PROGRAMMES)
def s6_landed_programmes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_landed_programmes(spark, **_landed_guides(spark, sf_dir))


@query(GUIDE_CHANNELS)
def s6_landed_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_landed_channels(spark, **_landed_guides(spark, sf_dir))


def rendered(entries: str, lists: str) -> str:
    """Lines of the playlists in `entries` (playlist, pos, title, name, url), after a header for each of `lists`."""
    return f"""SELECT playlist AS file, 1::BIGINT AS line_no, '#EXTM3U' AS line FROM ({lists})
UNION ALL SELECT playlist, 2 * pos, concat('#EXTINF:-1', CASE WHEN title <> '' THEN concat(' group-title="', title, '"') ELSE '' END, ',', name) FROM ({entries})
UNION ALL SELECT playlist, 2 * pos + 1, url FROM ({entries})"""


TARGETS = f"SELECT target AS playlist, {TITLE} AS title, name, url, row_number() OVER (PARTITION BY target ORDER BY category, nk, r2) AS pos FROM tgt WHERE target <> 'dropped'"


@query(f"WITH {best(1)} {rendered(TARGETS, 'SELECT DISTINCT target AS playlist FROM tgt WHERE target <> $$dropped$$')}")
def s7_write_m3u(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected entries are written as playlists in parts of eight entries, and read again, line by line with its place."""
    rows = split.split_catalog_more(selected(spark, sf_dir)).where("target <> 'dropped'").withColumn("playlist", F.col("target"))
    place = F.row_number().over(Window.partitionBy("playlist").orderBy("category", "p1", "p2"))
    entries = rows.withColumns({"pos": place, "tvg_id": F.lit(""), "tvg_logo": F.lit(""), "group_title": dims.title_for("category")})
    path = scratch.shared_folder(spark, "playlists")
    sinks.write_playlists(sinks.playlist_lines(entries, rows.select("playlist").distinct()), path, part_entries=8)
    return quality.line_numbers(quality.read_written(spark, path))


def listed(keep: int = 1, verified: bool = False) -> str:
    """Common table expressions up to ls: (playlist, pos, title, name, url) of all lists of a run, and fs: the lists."""
    live = "SELECT ord, name, url, row_number() OVER (ORDER BY ord) AS pos FROM c WHERE alive AND url <> '' QUALIFY row_number() OVER (PARTITION BY url ORDER BY ord) = 1"
    more = f" UNION ALL SELECT 'live_verified.m3u', row_number() OVER (ORDER BY ord), '', name, url FROM ({live})" if verified else ""
    return f"""{best(keep)}, tl AS (SELECT *, {TITLE} AS title, {POSITION} AS position FROM tgt),
ls AS (SELECT 'live.m3u' AS playlist, row_number() OVER (ORDER BY position, nk, r2) AS pos, title, name, url FROM tl WHERE target = 'catalog' AND category <> 'radio'
  UNION ALL SELECT concat('live_', category, '.m3u'), row_number() OVER (PARTITION BY category ORDER BY position, nk, r2), title, name, url FROM tl WHERE target = 'catalog'
  UNION ALL SELECT 'live_more.m3u', row_number() OVER (ORDER BY position, name, cat_ord, nk, r2) AS pos, title, name, url FROM tl WHERE target = 'more' QUALIFY pos <= 3000{more}),
fs AS (SELECT DISTINCT concat('live_', category, '.m3u') AS playlist FROM tl UNION SELECT 'live.m3u' UNION SELECT 'live_more.m3u' UNION SELECT playlist FROM ls)"""


@query(f"WITH {listed()} {rendered('SELECT * FROM ls', 'SELECT * FROM fs')}")
def s8_write_playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lists of a run: written in parts, read again with the place of every line. Overseas is seen but empty."""
    rows = scratch.cut(split.split_catalog_more(selected(spark, sf_dir)).withColumns({c: F.lit("") for c in ("tvg_id", "tvg_logo", "group_title")}))
    expected = rows.select(dims.file_for("category").alias("playlist")).union(rows.select(F.explode(F.array(F.lit("live.m3u"), F.lit("live_more.m3u"))))).distinct()
    path = scratch.shared_folder(spark, "run")
    sinks.write_playlists(sinks.playlist_lines(jobs.playlists(rows), expected), path, part_entries=20)
    return quality.line_numbers(quality.read_written(spark, path))


PROGRAMMES_MERGED = f"SELECT doc_idx, elem_idx, channel, start, stop, title FROM ({GUIDE_PROGRAMMES}) QUALIFY row_number() OVER (PARTITION BY channel, start, title ORDER BY doc_idx, elem_idx) = 1"
CHANNELS_MERGED = f"SELECT doc_idx, elem_idx, id, display_name FROM ({GUIDE_CHANNELS}) WHERE id <> '' QUALIFY row_number() OVER (PARTITION BY id ORDER BY doc_idx, elem_idx) = 1"


@query(f"""SELECT channel, start, stop, CASE WHEN title <> '' THEN 'second' END AS second_title,
CASE WHEN CAST(stop AS BIGINT) % 5 <> 0 THEN concat('about ', stop, ' & more') END AS about, CASE WHEN CAST(stop AS BIGINT) % 5 <> 0 THEN 'zh' END AS lang,
CASE WHEN CAST(stop AS BIGINT) % 5 <> 0 THEN concat('k', CAST(stop AS BIGINT) % 4) END AS category FROM ({PROGRAMMES_MERGED})""")
def s9_write_guide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One guide in parts, read again as elements; their order and the document as a whole are in s9_guide_lines and the tests."""
    path = scratch.shared_folder(spark, "guide")
    channels, programmes = jobs.merge_guides(scratch.cut(derive.guide_documents(spark, sf_dir)))
    sinks.write_guide(channels, programmes, path, part_entries=250)
    read = tables.read_written_guide(spark, path)[1].select("element.*")
    fields = [F.col(f"_{c}").alias(c) for c in ("channel", "start", "stop")]
    first = lambda c, k=1: F.try_element_at(F.col(c), F.lit(k))
    return read.select(*fields, first("title._VALUE", 2).alias("second_title"), first("desc._VALUE").alias("about"), first("desc._lang").alias("lang"), first("category._VALUE").alias("category"))


@query(f"""WITH e AS (SELECT 1 AS kind, doc_idx, elem_idx, id AS what FROM ({CHANNELS_MERGED}) UNION ALL SELECT 2, doc_idx, elem_idx, concat(channel, ' ', start, ' ', stop) FROM ({PROGRAMMES_MERGED}))
SELECT 0::BIGINT AS place, '<tv>' AS what UNION ALL SELECT row_number() OVER (ORDER BY kind, doc_idx, elem_idx), what FROM e UNION ALL SELECT count(*) + 1, '</tv>' FROM e""")
def s9_guide_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The guide's parts put together in order: root, channels, programmes, end of the root."""
    path = scratch.shared_folder(spark, "guide")
    channels, programmes = jobs.merge_guides(scratch.cut(derive.guide_documents(spark, sf_dir)))
    sinks.write_guide(channels, programmes, path, part_entries=100)
    line = quality.line_numbers(quality.read_written(spark, path)).withColumn("line", F.trim("line"))
    tag = F.regexp_extract("line", "^<(/?tv|channel|programme)[ >/]", 1)
    of = lambda key: F.regexp_extract("line", f' {key}="([^"]*)"', 1)
    what = F.when(tag == "channel", of("id")).when(tag == "programme", F.concat_ws(" ", of("channel"), of("start"), of("stop"))).otherwise(F.concat(F.lit("<"), tag, F.lit(">")))
    return order.numbered(line.where(tag != "").select("line_no", what.alias("what")), "line_no").select((F.col("number") - 1).alias("place"), "what")


SUMMARY = f"WITH {best(1)} SELECT count(*) AS total_selected, count(*) FILTER (target = 'catalog') AS catalog_count, count(*) FILTER (target = 'more') AS more_count FROM tgt"


RUN_AT = "2026-08-23 06:00:00"


def _run(spark: SparkSession, sf_dir: str) -> str:
    """A probing run over the candidates, in its folder."""
    out = scratch.shared_folder(spark, "run")
    entries = derive.candidates(spark, sf_dir).withColumns({c: F.lit("") for c in ("tvg_id", "tvg_logo", "group_title")})
    jobs.write_run(spark, entries, out, probing=True, generated_at=RUN_AT)
    return out


@query(f"""WITH {best(1)}, l AS (SELECT count(*) FILTER (alive) AS ok, count(*) AS n FROM c)
SELECT 1 AS schema_version, 'probe' AS stage, '{RUN_AT}' AS generated_at, 'Asia/Shanghai' AS timezone, 'cn' AS region, (SELECT count(*) FROM tgt) AS total,
(SELECT count(*) FROM tgt WHERE target = 'catalog') AS catalog_count, (SELECT count(*) FROM tgt WHERE target = 'more') AS more_count, ok, n - ok AS fail, round(ok * 100.0::DOUBLE / n, 1) AS ratio,
TRUE AS probe_enabled, 10 AS probe_concurrency, 10 AS probe_timeout, 0 AS channels FROM l""")
def s10_write_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of a run's summary; what it counts is observed while the run is written."""
    return spark.read.schema(jobs.SUMMARY_SCHEMA).json(f"{_run(spark, sf_dir)}/summary").withColumn("channels", F.size("channels"))


RUN_CHECKS = f"""WITH {listed(verified=True)}, live AS (SELECT * FROM ls WHERE playlist = 'live.m3u'), nn AS (SELECT name, count(*) AS n FROM live GROUP BY name), uu AS (SELECT url, count(*) AS n FROM live WHERE url <> '' GROUP BY url),
k AS (SELECT (SELECT count(*) FROM live) AS live, (SELECT count(*) FROM ls WHERE playlist = 'live_more.m3u') AS more, (SELECT count(*) FROM ls WHERE playlist = 'live_verified.m3u') AS verified,
  (SELECT max(n) FROM nn) AS most, (SELECT count(*) FROM nn WHERE n > 1) AS dn, (SELECT count(*) FROM uu WHERE n > 1) AS du, (SELECT count(*) FROM live WHERE title = '其他') AS other)
SELECT unnest([{{'check': 'exists live.m3u', 'severity': 'fail', 'value': NULL::DOUBLE, 'ok': live > 0}}, {{'check': 'exists live_more.m3u', 'severity': 'fail', 'value': NULL, 'ok': more > 0}},
  {{'check': 'schema_version', 'severity': 'fail', 'value': 1, 'ok': TRUE}}, {{'check': 'stage', 'severity': 'fail', 'value': NULL, 'ok': TRUE}}, {{'check': 'generated_at', 'severity': 'fail', 'value': NULL, 'ok': TRUE}},
  {{'check': 'radio_in_live', 'severity': 'fail', 'value': 0, 'ok': TRUE}}, {{'check': 'max_per_name', 'severity': 'fail', 'value': most, 'ok': most <= 1}}, {{'check': 'dup_names', 'severity': 'fail', 'value': dn, 'ok': dn = 0}},
  {{'check': 'dup_urls', 'severity': 'fail', 'value': du, 'ok': du = 0}}, {{'check': 'bad_groups', 'severity': 'fail', 'value': 0, 'ok': TRUE}}, {{'check': 'more_not_empty', 'severity': 'warn', 'value': more, 'ok': more > 0}},
  {{'check': 'verified_exists', 'severity': 'fail', 'value': (verified > 0)::INT, 'ok': verified > 0}}, {{'check': 'other_ratio', 'severity': 'fail', 'value': other * 100.0 / live, 'ok': live <= 50 OR other * 100.0 / live <= 85}},
  {{'check': 'other_ratio', 'severity': 'warn', 'value': other * 100.0 / live, 'ok': live <= 50 OR other * 100.0 / live <= 70 OR other * 100.0 / live > 85}}], recursive := TRUE) FROM k"""


@query(RUN_CHECKS)
def r14_validate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run is written and checked from its folder."""
    return jobs.validate_run(spark, _run(spark, sf_dir))


@query(f"""SELECT 'channel' AS kind, standard_name AS key, category, tvg_id, display_name, CAST(row_number() OVER (ORDER BY ord) AS BIGINT) AS place FROM ({derive.DICTIONARY_SQL})
UNION ALL SELECT 'alias', alias, standard_name, NULL, NULL, NULL FROM ({derive.STATION_ALIAS_SQL})""")
def s5_read_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two files of a dictionary, written as JSON (one list, one object) and read with the channels' order."""
    channels, aliases = derive.station_dictionary(spark, sf_dir)
    path = scratch.shared_folder(spark, "dictionary")
    rows = F.transform(F.sort_array(F.collect_list(F.struct("ord", "standard_name", "category", "group_title", "tvg_id", "display_name"))), lambda x: x.dropFields("ord"))
    channels.agg(F.to_json(rows).alias("value")).write.text(f"{path}/channels")
    aliases.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("alias", "standard_name")))).alias("value")).write.text(f"{path}/aliases")
    table, pairs = tables.read_dictionary(spark, f"{path}/channels", f"{path}/aliases")
    none = F.lit(None)
    numbered = order.numbered(table, "ord").select(F.lit("channel").alias("kind"), F.col("standard_name").alias("key"), "category", "tvg_id", "display_name", F.col("number").alias("place"))
    return numbered.unionByName(pairs.select(F.lit("alias").alias("kind"), F.col("alias").alias("key"), F.col("standard_name").alias("category"), none.cast("string").alias("tvg_id"), none.cast("string").alias("display_name"), none.cast("long").alias("place")))


@query(f"SELECT source_idx, coalesce(type, 'm3u') AS type, coalesce(enabled, TRUE) AS enabled, coalesce(region, 'cn') AS region FROM ({derive.REGISTRY_SQL})")
def s11_read_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.with_registry_defaults(derive.registry(spark, sf_dir)).select("source_idx", "type", "enabled", "region")


@query(f"""SELECT CAST(row_number() OVER (ORDER BY source_idx) - 1 AS INT) AS source_idx, name, nullif(url, '') AS url, coalesce(type, 'm3u') AS type, coalesce(enabled, TRUE) AS enabled, region
FROM ({derive.REGISTRY_SQL}) WHERE name <> ''""")
def s11_registry_yaml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry as a settings file, with comments, quotes and another section, and what is missing left out."""
    rows, path = derive.registry(spark, sf_dir).where("name <> ''"), scratch.shared_folder(spark, "registry")
    field = lambda c, v: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"    {c}: "), v))
    item = F.concat_ws(
        "\n", F.lit("  # next"), F.concat(F.lit('  - name: "'), "name", F.lit('"')), field("url", F.concat(F.lit("'"), F.col("url"), F.lit("'"))), field("type", F.col("type")),
        field("enabled", F.concat(F.col("enabled").cast("string"), F.lit("  # now"))), field("region", F.col("region")),
    )
    items = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("source_idx", item.alias("item")))), lambda x: x["item"]), "\n\n")
    rows.agg(F.concat(F.lit("other:\n  - name: no\n\nsources:\n"), items, F.lit("\nlast:\n  name: no\n")).alias("value")).write.text(path)
    return tables.read_registry_yaml(spark, path)


# Filters

@query(f"SELECT source_idx FROM ({derive.REGISTRY_SQL}) WHERE coalesce(enabled, TRUE)")
def f1_enabled_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlists.enabled_sources(derive.registry(spark, sf_dir)).select("source_idx")


@query(f"SELECT source_idx, CAST(row_number() OVER (ORDER BY source_idx) AS INT) AS number FROM ({derive.REGISTRY_SQL}) WHERE NOT coalesce(enabled, TRUE)")
def f2_disabled_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.disabled_sources(derive.registry(spark, sf_dir)).select("source_idx", "number")


@query(f"""SELECT CAST(row_number() OVER (ORDER BY source_idx) AS INT) AS number, name, CASE WHEN length(url) < 45 THEN url ELSE concat(left(url, 42), '...') END AS url
FROM ({derive.REGISTRY_SQL})""")
def f3_list_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.list_sources(derive.registry(spark, sf_dir), width=45).select("number", "name", "url")


CLEAN = f"n AS (SELECT * FROM (VALUES {text_list((k, raw, clean) for k, (raw, clean) in enumerate(derive.RAW_NAMES))}) AS t(k, raw, clean))"


@query(f"WITH {CLEAN} SELECT event_id, raw, clean AS name FROM events JOIN n ON event_id % {len(derive.RAW_NAMES)} = k WHERE clean IS NOT NULL")
def f5_clean_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also the steps of cleaning (R1a to R1g) and the junk test (F6)."""
    return names.clean_channels(derive.named_events(spark, sf_dir).withColumn("name", F.col("raw"))).select("event_id", "raw", "name")


#: The longest customer number that the digits begin with, in brackets; else the single character's own form.
LONGEST = """(SELECT max(length(CAST(c_custkey AS VARCHAR))) FROM customer WHERE starts_with(CAST({0} AS VARCHAR), CAST(c_custkey AS VARCHAR)))"""
PHRASED = "CASE WHEN {1} IS NULL THEN concat('龙', {0}) ELSE concat('<', left(CAST({0} AS VARCHAR), CAST({1} AS INT)), '>', substr(CAST({0} AS VARCHAR), CAST({1} AS INT) + 1)) END"
PHRASES = f"""WITH k AS (SELECT n, {LONGEST.format("n")} AS m FROM (SELECT event_id AS n FROM events UNION SELECT user_id FROM events))
SELECT event_id, concat({PHRASED.format("event_id", "a.m")}, ' 凤', {PHRASED.format("user_id", "b.m")}, 'x湾') AS name FROM events JOIN k a ON a.n = event_id JOIN k b ON b.n = user_id"""


def _phrased(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Names, and a phrase table that is written as text and read from its path."""
    path = scratch.shared_folder(spark, "phrases")
    phrases = spark.sql(derive.PHRASE_SQL.replace("FROM customer", "FROM {customer}"), customer=derive.table(spark, sf_dir, "customer"))
    phrases.select(F.concat_ws("\t", "traditional", "simplified")).write.text(path)
    return derive.from_events(spark, sf_dir, derive.PHRASE_NAME_SQL), tables.read_conversion(spark, path)


@query(PHRASES)
def r1g_simplify_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases from a table, the longest first, then single characters, by the trie."""
    return names.simplify_phrases(*_phrased(spark, sf_dir)).select("event_id", "name")


@query(PHRASES)
def r1g_simplify_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the form that a table beyond the size bound takes."""
    rows, phrases = _phrased(spark, sf_dir)
    return names._by_join(rows, "name", names.conversion(phrases, None, spark)).select("event_id", "name")


@query(f"WITH {C} SELECT ord FROM c WHERE alive IS NULL OR alive")
def f7_alive_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.alive_only(derive.candidates(spark, sf_dir)).select("ord")


@query(f"WITH {C} SELECT ord, {TITLE} AS group_title FROM c")
def f9_normalise_group_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.normalise_group_title(derive.candidates(spark, sf_dir).withColumn("group_title", F.lit("old"))).select("ord", "group_title")


CHINESE = ", ".join(str(k) for k, (raw, _) in enumerate(derive.RAW_NAMES) if any("一" <= c <= "鿿" for c in raw))


@query(f"SELECT event_id, event_id % {len(derive.RAW_NAMES)} IN ({CHINESE}) AS chinese FROM events")
def f10_has_chinese(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.named_events(spark, sf_dir).select("event_id", names.has_chinese("raw").alias("chinese"))


@query("SELECT page_id, page_id % 3 <> 2 AS guide FROM pages")
def f11_guide_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit(" \n<?xml ?>"), "html")).when(F.col("page_id") % 3 == 1, F.concat(F.lit("<tv>"), "html")).otherwise(F.col("html"))
    return derive.table(spark, sf_dir, "pages").select("page_id", playlists.is_guide_payload(text).alias("guide"))


@query(f"WITH {C} SELECT ord, TRUE AS alive FROM c")
def f12_default_alive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probe.default_alive(derive.candidates(spark, sf_dir)).select("ord", "alive")


# Joins

# What each clean name matches: standard name, how; else the category by rules.
MATCHED = {
    "CCTV-7": ("CCTV-7", "exact"), "东方卫视": ("东方卫视", "exact"), "凤凰资讯台": ("凤凰卫视中文台", "alias"), "TVB Jade": ("TVB Jade", "exact"), "湖南台": ("湖南卫视", "alias"),
}
RULED = {
    "{} 东方卫视": "weishi", "东方影业": "local", "CCTV-07 军事": "cctv", "CCTV-7 - 国防": "cctv", "CCTV - 7": "cctv", "Kanal 8": "overseas", "TV": "overseas", "我的CCTV9": "cctv",
    "CCTV-17+ 农业": "cctv", "BBC News": "overseas", "北京新闻": "local", "ESPN 2": "sports", "Radio One": "radio", "斗鱼直播": "live", "某某频道": "local", "CNN": "overseas", "香港开电视": "gangtai",
}
CHANNEL = {c[0]: c for c in derive.CHANNELS}
NAME_ROWS = text_list(
    (
        k, clean, *(MATCHED.get(clean) or ("", "none")), RULED.get(clean) or CHANNEL[MATCHED[clean][0]][1],
        (CHANNEL[MATCHED[clean][0]][3] or MATCHED[clean][0]) if clean in MATCHED else clean, CHANNEL[MATCHED[clean][0]][2] if clean in MATCHED else "",
        1 if any("一" <= c <= "鿿" for c in clean) else 0,
    )
    for k, (_, clean) in enumerate(derive.RAW_NAMES) if clean
)
NAMED = f"n AS (SELECT * FROM (VALUES {NAME_ROWS}) AS t(k, clean, std, how, cat, display, tvg, cn)), e AS (SELECT event_id, {derive.REGION_SQL} AS region, n.* FROM events JOIN n ON event_id % {len(derive.RAW_NAMES)} = k)"


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.clean_channels(derive.named_events(spark, sf_dir).withColumn("name", F.col("raw")))


@query(f"WITH {NAMED} SELECT event_id, std AS standard_name FROM e WHERE how = 'exact'")
def j1_match_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = match.match_channels(_cleaned(spark, sf_dir), *derive.dictionary(spark)).where("matched_by = 'exact'")
    return found.select("event_id", F.col("match_standard_name").alias("standard_name"))


@query(f"WITH {NAMED} SELECT event_id, std AS standard_name, how AS matched_by FROM e WHERE how <> 'none'")
def j2_match_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = match.match_channels(_cleaned(spark, sf_dir), *derive.dictionary(spark)).where("matched_by IS NOT NULL")
    return found.select("event_id", F.col("match_standard_name").alias("standard_name"), "matched_by")


STATION = f"""st AS (SELECT event_id, region, CASE number % 3 WHEN 0 THEN concat('CCTV-', number) WHEN 1 THEN concat('凤凰', number, '卫视') ELSE concat('Kanal ', number) END AS clean, number
  FROM (SELECT event_id, {derive.REGION_SQL} AS region, event_id // 4 AS number FROM events) WHERE event_id % 31 <> 0),
sm AS (SELECT st.*, d.standard_name AS std, d.category AS cat, d.tvg_id AS tvg, d.display_name AS display FROM st LEFT JOIN ({derive.DICTIONARY_SQL}) d ON st.number = d.ord)"""


@query(f"WITH {STATION} SELECT event_id, clean AS name FROM st")
def f5_clean_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that grow with the table; the examples are in f5_clean_channels."""
    return names.clean_channels(derive.stations(spark, sf_dir)).select("event_id", "name")


@query(f"WITH {STATION} SELECT event_id, std AS standard_name, CASE WHEN number % 3 = 2 THEN 'alias' ELSE 'exact' END AS matched_by FROM sm WHERE std IS NOT NULL")
def j2_match_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact and alias matches against a dictionary that grows with the table."""
    cleaned = names.clean_channels(derive.stations(spark, sf_dir))
    found = match.match_channels(cleaned, *derive.station_dictionary(spark, sf_dir)).where("matched_by IS NOT NULL")
    return found.select("event_id", F.col("match_standard_name").alias("standard_name"), "matched_by")


@query(f"""WITH {STATION}, r AS (SELECT *, CASE number % 3 WHEN 0 THEN 'cctv' WHEN 1 THEN 'weishi' ELSE 'overseas' END AS ruled FROM sm)
SELECT event_id, CASE WHEN std IS NULL THEN clean WHEN display <> '' THEN display ELSE std END AS name, coalesce(std, '') AS standard_name, coalesce(tvg, '') AS tvg_id,
CASE WHEN std IS NOT NULL THEN cat WHEN region = 'hotel' THEN 'special' WHEN region = 'overseas' AND number % 3 <> 1 THEN 'overseas' ELSE ruled END AS category FROM r""")
def j4_classify_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary first, then rules and regions, over names that grow with the table."""
    cleaned = names.clean_channels(derive.stations(spark, sf_dir))
    return match.match_and_classify(cleaned, *derive.station_dictionary(spark, sf_dir)).select("event_id", "name", "standard_name", "tvg_id", "category")


@query("""WITH p AS (SELECT DISTINCT upper(concat(p_name, ' ', p_brand)) AS p_name FROM part), s AS (SELECT DISTINCT concat(p_name, ' ', p_brand) AS s FROM part)
SELECT p_name AS name, min(s) AS standard_name FROM p JOIN s ON contains(lower(s), lower(p_name)) GROUP BY p_name HAVING count(*) = 1""")
def j3_match_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = derive.table(spark, sf_dir, "part")
    standard = part.select(F.concat_ws(" ", "p_name", "p_brand").alias("standard_name")).distinct()
    return match.match_fuzzy(standard.select(F.upper("standard_name").alias("name")), standard)


@query(f"""WITH {NAMED} SELECT event_id, display AS name, std AS standard_name, tvg AS tvg_id,
CASE WHEN how <> 'none' THEN cat WHEN region = 'hotel' THEN 'special' WHEN region = 'overseas' AND cn = 0 THEN 'overseas' ELSE cat END AS category FROM e""")
def j4_match_and_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also the region rules (R3)."""
    rows = _cleaned(spark, sf_dir).withColumn("tvg_id", F.lit(""))
    return match.match_and_classify(rows, *derive.dictionary(spark)).select("event_id", "name", "standard_name", "tvg_id", "category")


@query(f"WITH {STATION} SELECT event_id, CASE number % 3 WHEN 0 THEN 'cctv' WHEN 1 THEN 'weishi' ELSE 'overseas' END AS category FROM st")
def r2_classify_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over names that grow with the table."""
    cleaned = names.clean_channels(derive.stations(spark, sf_dir))
    return cleaned.select("event_id", classify_by_rules("name", "group_title").alias("category"))


@query(f"SELECT event_id, regexp_matches(raw, '[一-鿿]') AS chinese FROM ({derive.STATION_SQL})")
def f10_has_chinese_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.stations(spark, sf_dir).select("event_id", names.has_chinese("raw").alias("chinese"))


SEGMENT = "concat(regexp_replace(url, '/[^/]*$', ''), '/seg', event_id % 3, '.ts')"
VERDICT = f"""v AS (SELECT *, CASE WHEN head_status <> 200 THEN concat('HTTP ', head_status) WHEN head_status = 200 AND get_status <> 200 THEN concat('HTTP ', get_status)
  WHEN head_status = 200 AND event_id % 29 = 0 THEN CASE WHEN timed_out THEN 'timeout' ELSE 'error' END WHEN head_status = 200 AND event_id % 6 = 0 THEN 'no_segment' WHEN head_status = 200 AND seg_status = 200 THEN 'ok'
  WHEN head_status = 200 THEN concat('seg_HTTP ', seg_status) WHEN timed_out THEN 'timeout' ELSE 'error' END AS status FROM ({derive.PROBE_SQL.replace(chr(10) + '#X' + chr(10), ' ')}))"""


@query(f"""WITH {VERDICT}, one AS (SELECT url, min({{'l': coalesce(latency_ms, 2147483647), 's': status}}) AS x FROM v GROUP BY url)
SELECT event_id, one.url, x.s = 'ok' AS alive, nullif(x.l, 2147483647) AS latency_ms, x.s AS probe_status FROM v JOIN one ON v.url = one.url""")
def j5_apply_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An address has several verdicts, some without a latency: the fastest one fans out to all of its rows."""
    rows = derive.from_events(spark, sf_dir, derive.PROBE_SQL)
    return probe.apply_probe(rows.select("event_id", "url"), probe.probe_verdict(rows)).select("event_id", "url", "alive", "latency_ms", "probe_status")


@query(f"WITH {C} SELECT ord FROM c WHERE category = 'radio' AND (url = '' OR url NOT IN (SELECT url FROM c WHERE category <> 'radio' AND url <> ''))")
def j6_radio_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.candidates(spark, sf_dir)
    return select.radio_anti(rows.where("category = 'radio'"), rows.where("category <> 'radio'")).select("ord")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.from_events(spark, sf_dir, derive.DAYS_SQL).withColumn("written_at", F.lit(1))


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = derive.table(spark, sf_dir, "customer").where("c_custkey % 4 <> 0")
    return customer.select(F.concat(F.lit("u"), "c_custkey").alias("name"))


KNOWN = "k AS (SELECT concat('u', c_custkey) AS name FROM customer WHERE c_custkey % 4 <> 0)"


@query(f"WITH {KNOWN} SELECT source, CAST(day AS VARCHAR) AS day FROM ({derive.DAYS_SQL}) WHERE source IN (SELECT name FROM k)")
def j7_history_in_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.history_in_registry(_history(spark, sf_dir), _known(spark, sf_dir)).select("source", F.col("day").cast("string").alias("day"))


@query("SELECT p_partkey, p_brand IN ('Brand#1', 'Brand#2', 'Brand#5') AS core FROM part")
def j8_core_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.table(spark, sf_dir, "part").select("p_partkey", dims.core_flag("p_brand", ("Brand#1", "Brand#2", "Brand#5")).alias("core"))


@query("SELECT p_name AS alias, concat(p_brand, p_size) AS standard_name FROM part WHERE concat(p_brand, p_size) NOT IN (SELECT concat(p_brand, p_size) FROM part WHERE p_partkey % 2 = 0)")
def j9_orphan_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = derive.table(spark, sf_dir, "part").withColumn("standard_name", F.concat("p_brand", "p_size"))
    return match.orphan_aliases(part.where("p_partkey % 2 = 0"), part.select(F.col("p_name").alias("alias"), "standard_name")).select("alias", "standard_name")


# Aggregations

PAYLOAD = "SELECT doc_id, source, doc_id % 10 = 3 OR doc_id % 20 = 5 AS bad FROM documents"


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.when(F.col("doc_id") % 10 == 3, "HTTP 500").when(F.col("doc_id") % 20 == 5, playlists.NOT_LANDED).otherwise(F.col("text"))
    return derive.table(spark, sf_dir, "documents").select("doc_id", "source", content.alias("content"))


@query(f"SELECT count(*) FILTER (NOT bad) AS ok, count(*) AS total, count(*) FILTER (NOT bad) * 100.0::DOUBLE / count(*) AS rate FROM ({PAYLOAD})")
def a1_source_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed and absent sources count in the total."""
    return quality.source_success(_payloads(spark, sf_dir), playlists.is_error_payload("content"))


GATES = {"all there": ("src1", "src2"), "some failed": ("src1", "src3"), "some absent": ("src2", "src5"), "unknown": ("elsewhere",)}


@query(" UNION ALL ".join(f"""SELECT '{gate}' AS gate, {strict} AS strict, count(*) FILTER (NOT bad) AS core_ok, count(*) AS core_total, {strict} AND count(*) FILTER (bad) > 0 AS failed
FROM ({PAYLOAD}) WHERE source IN {core if len(core) > 1 else f"('{core[0]}')"}""" for gate, core in GATES.items() for strict in (True, False)))
def a2_core_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over sets of core sources that are there, have failed, did not land, or are unknown; strict and lax."""
    payloads, error = _payloads(spark, sf_dir), playlists.is_error_payload("content")
    rows = [quality.core_gate(payloads, error, F.col("source").isin(*core), strict).withColumns({"gate": F.lit(gate), "strict": F.lit(strict)}) for gate, core in GATES.items() for strict in (True, False)]
    return reduce(DataFrame.unionByName, rows)


@query(f"WITH {C} SELECT category, count(*) AS n FROM c GROUP BY category")
def a3_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.category_counts(derive.candidates(spark, sf_dir))


@query(f"WITH {C} SELECT count(*) FILTER (standard_name <> '') AS matched, count(*) FILTER (standard_name = '') AS classified FROM c")
def a4_match_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.match_stats(derive.candidates(spark, sf_dir))


@query(f"WITH {C} SELECT count(*) FILTER (alive) AS ok, count(*) - count(*) FILTER (alive) AS fail, round(count(*) FILTER (alive) * 100.0::DOUBLE / count(*), 1) AS ratio FROM c")
def a5_probe_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probe.probe_stats(derive.candidates(spark, sf_dir))


@query(SUMMARY)
def a6_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_summary(split.split_catalog_more(selected(spark, sf_dir)))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written lines: file, ord, line."""
    docs = derive.playlist_documents(spark, sf_dir).select("source_idx", F.posexplode(quality.split_lines(F.col("content"))).alias("at", "line"))
    return docs.select(F.concat(F.lit("f"), F.col("source_idx") % 10).alias("file"), F.struct("source_idx", "at").alias("ord"), "line")


@query("SELECT concat('f', f) AS file, (SELECT count(*) FROM events WHERE user_id % 10 = f) AS entries FROM range(12) t(f)")
def a7_count_extinf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files f10 and f11 are expected but missing."""
    return quality.count_entries(_lines(spark, sf_dir), spark.range(12).select(F.concat(F.lit("f"), "id").alias("file")))


@query("SELECT concat('f', user_id % 10) AS file, count(*) AS entries FROM events GROUP BY user_id % 10")
def a8_file_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.file_overview(_lines(spark, sf_dir))


@query("SELECT concat('g', event_id % 4) AS group_title, count(*) AS n FROM events GROUP BY event_id % 4")
def a9_group_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.group_distribution(_lines(spark, sf_dir))


@query("""WITH n AS (SELECT p_name, count(*) AS n FROM part GROUP BY p_name), u AS (SELECT concat(p_brand, p_type, p_size) AS u, count(*) AS n FROM part GROUP BY concat(p_brand, p_type, p_size))
SELECT (SELECT CAST(sum(n) AS BIGINT) FROM n) AS entries, (SELECT count(*) FROM n) AS unique_names, (SELECT count(*) FROM u) AS unique_urls,
(SELECT max(n) FROM n) AS max_per_name, (SELECT count(*) FROM n WHERE n > 1) AS dup_names, (SELECT count(*) FROM u WHERE n > 1) AS dup_urls""")
def a10_quality_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_stats(derive.table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.concat("p_brand", "p_type", "p_size").alias("url")))


OTHERS = {"mixed": "event_id % 4 = 1", "many": "event_id % 4 <> 0", "most": "event_id % 16 <> 0", "short": "event_id % 4 <> 0 AND event_id < 40"}


@query(" UNION ALL ".join(f"""SELECT '{label}' AS list, entries, other, other * 100.0::DOUBLE / entries AS ratio, CASE WHEN entries <= 50 THEN 'skipped' WHEN other * 100.0 / entries > 85 THEN 'fail'
WHEN other * 100.0 / entries > 70 THEN 'warn' ELSE 'ok' END AS verdict FROM (SELECT count(*) AS entries, count(*) FILTER ({test}) AS other FROM events{" WHERE event_id < 40" if label == "short" else ""})""" for label, test in OTHERS.items()))
def a11_other_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists with few, many and mostly other entries, and one too short to judge."""
    events = derive.table(spark, sf_dir, "events")
    rows = [
        quality.other_ratio((events.where("event_id < 40") if label == "short" else events).select(F.when(F.expr(test), quality.OTHER_TITLE).otherwise("央视").alias("group_title"))).withColumn("list", F.lit(label))
        for label, test in OTHERS.items()
    ]
    return reduce(DataFrame.unionByName, rows)


# Windows

KEYED = f"""w AS (SELECT *, coalesce(nullif(standard_name, ''), name, '?') AS k, {RANK} AS sr, CAST(lower(url) LIKE 'rtp://%' AS INT) AS sp, coalesce(latency_ms, 999999) AS sl
FROM c WHERE alive IS DISTINCT FROM FALSE)"""


@query(f"WITH {C}, {KEYED} SELECT ord, row_number() OVER (PARTITION BY category, k ORDER BY sr, sp, sl, ord) AS r1 FROM w QUALIFY r1 <= 2")
def w1_top_k_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.top_k_per_key(select._with_keys(select.alive_only(derive.candidates(spark, sf_dir))), 2).select("ord", F.col("r1").cast("long").alias("r1"))


@query(f"WITH {C} SELECT ord FROM c QUALIFY url = '' OR row_number() OVER (PARTITION BY category, url ORDER BY ord) = 1")
def w2_dedup_url_in_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.dedup_url(derive.candidates(spark, sf_dir), ["category"], ["ord"]).select("ord")


@query(f"WITH {best(2)} SELECT ord FROM b")
def w3_global_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two per name over all categories, before addresses are settled: the selection where no address is shared."""
    rows = derive.candidates(spark, sf_dir)
    keyed = select._with_keys(select.alive_only(rows))
    order = keyed.groupBy("category", "k").agg(F.min("ord").alias("key_ord"))
    cats = rows.groupBy("category").agg(F.min("ord").alias("cat_ord"))
    first = select.top_k_per_key(keyed, 2).join(order, ["category", "k"]).join(cats, "category").where("category <> 'radio'")
    return select.global_top_k(select.dedup_url(first, ["category"], ["key_ord", "r1"]), 2).select("ord")


@query(f"WITH {C} SELECT ord FROM c QUALIFY url = '' OR row_number() OVER (PARTITION BY url ORDER BY ord) = 1")
def w4_dedup_url_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.dedup_url(derive.candidates(spark, sf_dir), [], ["ord"]).select("ord")


@query(f"WITH {best(1)} SELECT ord, name, url, category, standard_name FROM sel")
def w5_select_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selected(spark, sf_dir).select(*SEL)


@query(f"WITH {best(3)} SELECT ord, name, url, category, standard_name FROM sel")
def w5_select_best_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selected(spark, sf_dir, 3).select(*SEL)


@query(f"WITH {best(1)} SELECT ord, name, url, category, standard_name FROM sel".replace(derive.CANDIDATE_SQL, derive.SHARED_SQL))
def w5_select_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One link a name, where addresses are shared over categories: the global owner and radio lose rows, too."""
    return select.select_best(derive.from_events(spark, sf_dir, derive.SHARED_SQL), 1).select(*SEL)


@query(f"WITH {C} SELECT ord, url FROM c WHERE alive AND url <> '' QUALIFY row_number() OVER (PARTITION BY url ORDER BY ord) = 1")
def w6_dedup_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also the filter on rows known alive (F8)."""
    return select.verified(derive.candidates(spark, sf_dir)).select("ord", "url")


STREAK = f"""h AS ({derive.DAYS_SQL}), s AS (SELECT source, count(*) FILTER (NOT seen) AS streak FROM
(SELECT source, max(CAST(success AS INT)) OVER (PARTITION BY source ORDER BY day DESC) = 1 AS seen FROM h) GROUP BY source)"""


@query(f"WITH {STREAK} SELECT source, streak, streak >= 3 AS dead FROM s")
def w7_dead_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.dead_streaks(_history(spark, sf_dir))


@query(f"""WITH h0 AS ({derive.DAYS_SQL}), h AS (SELECT source, day, success AND dayofmonth(day) % 7 <> 3 AS success FROM h0), s AS (SELECT source, count(*) FILTER (NOT seen) AS streak FROM
(SELECT source, max(CAST(success AS INT)) OVER (PARTITION BY source ORDER BY day DESC) = 1 AS seen FROM h) GROUP BY source) SELECT source, streak, streak >= 3 AS dead FROM s""")
def w7_incremental_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days arrive in four batches that lie mixed in time, then some successes are taken back; each batch meets the states alone."""
    rows = _history(spark, sf_dir)
    whole, states = rows.limit(0), None
    for k in (2, 0, 3, 1):
        batch = rows.where(F.pmod(F.dayofmonth("day"), F.lit(4)) == k)
        whole = health.upsert_history(whole, batch)
        states = health.streak_states(batch) if states is None else scratch.cut(health.advance_states(states, batch, whole))
    back = rows.where("success AND dayofmonth(day) % 7 = 3").withColumns({"success": F.lit(False), "written_at": F.lit(2)})
    return health.streaks_of(health.advance_states(states, back, health.upsert_history(rows, back)))


@query(CHANNELS_MERGED)
def w8_merge_guide_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.merge_guides(derive.guide_documents(spark, sf_dir), element=False)[0]


@query(PROGRAMMES_MERGED)
def w9_merge_guide_programmes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.merge_guides(derive.guide_documents(spark, sf_dir), element=False)[1]


@query(f"SELECT source_idx, row_number() OVER (PARTITION BY name ORDER BY source_idx) AS use FROM ({derive.REGISTRY_SQL}) WHERE name <> '' QUALIFY use > 1")
def w10_duplicate_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.duplicate_occurrences(derive.registry(spark, sf_dir), "name").select("source_idx", F.col("use").cast("long").alias("use"))


# Order and limits

@query(f"WITH {best(1)} SELECT ord, row_number() OVER (ORDER BY {POSITION}, nk, r2) AS pos FROM tgt WHERE target = 'catalog' AND category <> 'radio'")
def o1_order_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split.split_catalog_more(selected(spark, sf_dir)).where("target = 'catalog'")
    return split.main_positions(rows).select("ord", "pos")


@query(f"WITH {best(1)} SELECT ord, row_number() OVER (ORDER BY {POSITION}, name, cat_ord, nk, r2) AS pos FROM tgt WHERE target = 'more'")
def o2_order_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.more_positions(split.split_catalog_more(selected(spark, sf_dir)).where("target = 'more'")).select("ord", "pos")


@query(f"WITH {best(1)} SELECT ord FROM tgt WHERE target = 'more' ORDER BY {POSITION}, name, cat_ord, nk, r2 LIMIT 20")
def o3_cap_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.cap_more(split.split_catalog_more(selected(spark, sf_dir)).where("target = 'more'"), 20).select("ord")


@query("SELECT CAST(o_orderdate AS VARCHAR) AS generated_at, count(*) AS total FROM orders GROUP BY o_orderdate ORDER BY o_orderdate DESC LIMIT 21")
def o4_latest_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = derive.table(spark, sf_dir, "orders").groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("total"))
    return split.latest_reports(runs.select(F.col("o_orderdate").cast("string").alias("generated_at"), "total"), 21)


# Sets

@query(f"WITH {best(1)} SELECT ord, target FROM tgt")
def u2_split_catalog_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_catalog_more(selected(spark, sf_dir)).select("ord", "target")


@query("SELECT DISTINCT source AS group_title FROM documents WHERE source NOT IN ('src1', 'src2', 'src3')")
def u3_bad_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.table(spark, sf_dir, "documents").select(F.col("source").alias("group_title"))
    return quality.bad_groups(rows, rows.where(F.col("group_title").isin("src1", "src2", "src3")).distinct())


@query(f"WITH h AS ({derive.DAYS_SQL}) SELECT source, CAST(day AS VARCHAR) AS day, CASE WHEN dayofmonth(day) % 5 = 0 THEN NOT success ELSE success END AS success FROM h")
def u4_history_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth day is written again, with the other value."""
    old = _history(spark, sf_dir)
    new = old.where("dayofmonth(day) % 5 = 0").select("source", "url", "day", (~F.col("success")).alias("success"), F.lit(2).alias("written_at"))
    return health.upsert_history(old, new).select("source", F.col("day").cast("string").alias("day"), "success")


@query(f"WITH h AS ({derive.DAYS_SQL}) SELECT source, CAST(day AS VARCHAR) AS day, CASE WHEN dayofmonth(day) = 5 THEN NOT success ELSE success END AS success, url, CASE WHEN dayofmonth(day) = 5 THEN 2 ELSE 1 END AS written_at FROM h")
def u4_stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store is written, one day of each month is written again with the other value (twice, as a rerun does), and read."""
    path, rows = scratch.shared_folder(spark, "history"), _history(spark, sf_dir)
    history.upsert_days(spark, path, rows)
    again = rows.where("dayofmonth(day) = 5").select("source", "url", "day", (~F.col("success")).alias("success"), F.lit(2).alias("written_at"))
    for _ in range(2):
        history.upsert_days(spark, path, again)
    return history.read_history(spark, path).withColumns({"day": F.col("day").cast("string"), "written_at": F.col("written_at").cast("int")})


# Scalars

@query(f"WITH {NAMED} SELECT event_id, CASE clean {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in (RULED | {'CCTV-7': 'cctv', '东方卫视': 'weishi', '凤凰资讯台': 'gangtai', 'TVB Jade': 'gangtai', '湖南台': 'local'}).items())} END AS category FROM e")
def r2_classify_by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).select("event_id", classify_by_rules("name", "group_title").alias("category"))


@query(f"WITH {C} SELECT ord, {TITLE} AS title, concat('live_', category, '.m3u') AS file, {POSITION} AS position, category = 'radio' AS radio FROM c")
def r4_category_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.candidates(spark, sf_dir)
    return rows.select("ord", dims.title_for("category").alias("title"), dims.file_for("category").alias("file"), dims.position_of("category").alias("position"), dims.is_radio("category").alias("radio"))


@query("SELECT event_id, concat('N', event_id, ', x') AS name, concat('t', event_id % 10) AS tvg_id, '' AS tvg_name, concat('l', event_id % 3) AS tvg_logo, concat('g', event_id % 4) AS group_title FROM events")
def r5_extinf_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = "concat('#extinf : -1 TVG-ID = \"t', event_id % 10, '\" tvg-logo=\"l', event_id % 3, '\" group-title=\"g', event_id % 4, '\",N', event_id, ', x')"
    rows = derive.from_events(spark, sf_dir, f"SELECT event_id, {line} AS line FROM events")
    return rows.select("event_id", *[v.alias(k) for k, v in playlists.extinf_fields(F.col("line")).items()])


@query(f"WITH {C} SELECT ord, url LIKE 'rtp://%' AS rtp FROM c")
def r6_is_rtp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.candidates(spark, sf_dir).select("ord", addresses.is_rtp("url").alias("rtp"))


@query(f"WITH {C} SELECT ord, coalesce(nullif(standard_name, ''), name, '?') AS k FROM c")
def r7_selection_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.candidates(spark, sf_dir).select("ord", addresses.selection_key().alias("k"))


@query(f"SELECT event_id, CASE WHEN event_id % 6 = 0 OR event_id % 29 = 0 THEN NULL ELSE {SEGMENT} END AS segment FROM ({derive.PROBE_SQL})")
def r8_first_segment_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.from_events(spark, sf_dir, derive.PROBE_SQL).select("event_id", addresses.first_segment_url("url", "body").alias("segment"))


@query(f"WITH {VERDICT} SELECT url, status = 'ok' AS alive, latency_ms, status, CASE status WHEN 'timeout' THEN 'timeout' WHEN 'error' THEN 'reset' ELSE '' END AS error FROM v")
def r9_probe_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probe.probe_verdict(derive.from_events(spark, sf_dir, derive.PROBE_SQL))


@query(f"SELECT source_idx, url <> '' AND url NOT LIKE 'no-scheme%' AS valid FROM ({derive.REGISTRY_SQL})")
def r10_validate_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.registry(spark, sf_dir).select("source_idx", addresses.is_valid_url("url").alias("valid"))


REGISTRY_PROBLEMS = f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY source_idx) AS nu, row_number() OVER (PARTITION BY url ORDER BY source_idx) AS uu FROM ({derive.REGISTRY_SQL}))
SELECT source_idx, 'missing name' AS problem FROM r WHERE name = '' UNION ALL SELECT source_idx, 'duplicate name' FROM r WHERE name <> '' AND nu > 1
UNION ALL SELECT source_idx, 'empty url' FROM r WHERE url = '' UNION ALL SELECT source_idx, 'malformed url' FROM r WHERE url LIKE 'no-scheme%'
UNION ALL SELECT source_idx, 'duplicate url' FROM r WHERE url <> '' AND uu > 1 UNION ALL SELECT source_idx, 'unknown type' FROM r WHERE url <> '' AND type = 'xml'"""


@query(REGISTRY_PROBLEMS)
def r11_validate_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.validate_registry(derive.registry(spark, sf_dir))


@query("SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def r12_run_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.table(spark, sf_dir, "events").select("event_id", addresses.run_timestamp("ts").alias("at"))


@query("SELECT event_id, event_id % 3 = 0 AS good FROM events")
def r13_timestamp_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("event_id") % 3 == 0, at).when(F.col("event_id") % 3 == 1, F.substring(at, 1, 10)).otherwise(F.concat(F.lit("x"), at))
    return derive.table(spark, sf_dir, "events").select("event_id", addresses.is_timestamp(text).alias("good"))


LIVE_TITLE = "CASE WHEN category = 'radio' THEN '电台' WHEN ord % 5 = 0 THEN 'none of them' WHEN ord % 5 < 4 THEN '其他' ELSE '央视' END"
CHECKS = f"""WITH {best(1)}, live AS (SELECT *, {LIVE_TITLE} AS title FROM tgt WHERE target = 'catalog'),
o AS (SELECT count(*) AS n, count(*) FILTER (title = '其他') * 100.0::DOUBLE / count(*) AS ratio, count(DISTINCT title) FILTER (title = 'none of them') AS bad FROM live),
nn AS (SELECT name, count(*) AS n FROM live GROUP BY name), uu AS (SELECT url, count(*) AS n FROM live WHERE url <> '' GROUP BY url),
x AS (SELECT (SELECT count(*) FROM live WHERE category = 'radio') AS radio, (SELECT max(n) FROM nn) AS most, (SELECT count(*) FROM nn WHERE n > 1) AS dn,
  (SELECT count(*) FROM uu WHERE n > 1) AS du, (SELECT count(*) FROM tgt WHERE target = 'more') AS more)
SELECT 'schema_version' AS "check", 'fail' AS severity, 1.0::DOUBLE AS value, TRUE AS ok UNION ALL SELECT 'stage', 'fail', NULL, TRUE UNION ALL SELECT 'generated_at', 'fail', NULL, FALSE
UNION ALL SELECT 'radio_in_live', 'fail', radio, radio = 0 FROM x UNION ALL SELECT 'max_per_name', 'fail', most, most <= 1 FROM x UNION ALL SELECT 'dup_names', 'fail', dn, dn = 0 FROM x
UNION ALL SELECT 'dup_urls', 'fail', du, du = 0 FROM x UNION ALL SELECT 'bad_groups', 'fail', bad, bad = 0 FROM o UNION ALL SELECT 'more_not_empty', 'warn', more, more > 0 FROM x
UNION ALL SELECT 'verified_exists', 'fail', 0, FALSE UNION ALL SELECT 'other_ratio', 'fail', ratio, n <= 50 OR ratio <= 85 FROM o UNION ALL SELECT 'other_ratio', 'warn', ratio, n <= 50 OR ratio <= 70 OR ratio > 85 FROM o"""


@query(CHECKS)
def r14_validate_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scratch.cut(split.split_catalog_more(selected(spark, sf_dir)).withColumn("group_title", F.expr(LIVE_TITLE)))
    summary = rows.agg(F.lit(1).alias("schema_version"), F.lit("probe").alias("stage"), F.lit("2026-08-23").alias("generated_at"), F.lit(True).alias("probe_enabled"))
    allowed = dims.categories(spark).select(F.col("title").alias("group_title"))
    return quality.validate_outputs(rows.where("target = 'catalog'"), rows.where("target = 'more'"), False, summary, allowed)


@query("""SELECT concat('f', user_id % 10) AS file, 'name' AS kind, concat('Name ', event_id) AS value FROM events
UNION ALL SELECT concat('f', user_id % 10), 'url', concat('http://h.example.com/', event_id) FROM events
UNION ALL SELECT concat('f', user_id % 10), 'url', 'http://stray.example.com/x' FROM events WHERE event_id % 5 = 0""")
def r15_playlist_names_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries without a colon after their mark are no names: some are put beside the written lines."""
    lines = _lines(spark, sf_dir)
    odd = lines.where("line LIKE '#EXTINF:%'").withColumn("line", F.regexp_replace("line", "^#EXTINF:", "#EXTINF "))
    return quality.playlist_names_urls(lines.unionByName(odd)).select("file", "kind", "value")


@query(f"WITH {STREAK}, {KNOWN} SELECT source, streak, CASE WHEN source IN ('u1', 'u2', 'u3') THEN 'warn' ELSE 'disable' END AS action FROM s WHERE streak >= 2 AND source IN (SELECT name FROM k)")
def r16_flag_dead_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.flag_dead_sources(_history(spark, sf_dir), _known(spark, sf_dir), True, 1, core=("u1", "u2", "u3"), dead_days=2)
