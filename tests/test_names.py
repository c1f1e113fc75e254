"""Cleaning, classification and addresses, by example."""

import random
import time

import pytest
from pyspark.sql import functions as F

from chanweave.functions import addresses, dims, names
from chanweave.functions.rules import classify_by_rules, classify_with_region
from chanweave.plans import jobs
from chanweave.plans.derive import RAW_NAMES
from chanweave.sources import tables


def column(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression.alias("x")).collect()]


def test_clean_examples(spark):
    rows = [(raw,) for raw, _ in RAW_NAMES]
    assert column(spark, rows, "raw string", names.clean_channel_name("raw")) == [clean for _, clean in RAW_NAMES]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        (None, None), ("   ", None), ("###", None), ("CCTV-", "CCTV"), ("湖南卫视 [电信]", "湖南卫视"), ("TV  One   Two", "TV One Two"), ("A(HD)B", "AB"),
        ("　CCTV2　", "CCTV-2"), ("#EXTINF:-1,x", None), ("user-agent=z", None), ("Sky News [Not 24/7]", "Sky News"), ("Foo [geo-blocked]", "Foo ed]"),
    ],
)
def test_clean_more(spark, raw, clean):
    assert column(spark, [(raw,)], "raw string", names.clean_channel_name("raw")) == [clean]


def test_clean_channels_drops_and_keeps_rows(spark):
    df = spark.createDataFrame([(1, "CCTV1"), (2, None), (3, "CCTV1"), (4, "a")], "i int, name string")
    assert sorted(map(tuple, names.clean_channels(df).select("i", "name").collect())) == [(1, "CCTV-1"), (3, "CCTV-1")]


@pytest.mark.parametrize("phrases", [False, True])
def test_clean_channels_cleans_a_name_once(spark, phrases):
    """No filter on clean names is inferred for the raw ones, of which each has the whole cleaning in it."""
    df = spark.range(3).select("id", F.concat(F.lit("CCTV"), "id").alias("name"))
    table = spark.createDataFrame([("甲", "乙")], "traditional string, simplified string") if phrases else None
    found = names.clean_channels(df, phrases=table).join(spark.createDataFrame([("CCTV-1",)], "name string"), "name")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("KODIPROP") == 1
    assert [r.id for r in found.collect()] == [1]


def test_phrases_come_first(spark):
    df = spark.createDataFrame([("鳳凰衛視台",), ("abc",), (None,)], "name string")
    phrases = spark.createDataFrame([("衛視台", "X"), ("衛", "Y")], "traditional string, simplified string")
    assert [r.name for r in names.simplify_phrases(df, phrases).collect()] == ["凤凰X", "abc", None]


def test_catalogue_takes_conversion_tables(spark):
    schema = "traditional string, simplified string"
    phrases = spark.createDataFrame([("乾隆", "乾隆"), ("綜藝", "综艺")], schema)
    characters = spark.createDataFrame([("乾", "干"), ("競", "竞"), ("賽", "赛")], schema)
    df = spark.createDataFrame([(1, "江蘇綜藝 [HD]"), (2, "競技賽事"), (3, "乾隆電視"), (4, "餅乾臺"), (5, "#EXTM3U"), (6, "a"), (7, None)], "i int, name string")
    both = names.clean_channels(df, phrases=phrases, characters=characters)
    assert {r.i: r.name for r in both.collect()} == {1: "江苏综艺", 2: "竞技赛事", 3: "乾隆电视", 4: "餅干台"}
    assert {r.i: r.name for r in names.clean_channels(df, characters=characters).collect()} == {1: "江苏综藝", 2: "竞技赛事", 3: "干隆电视", 4: "餅干台"}
    text = "#EXTM3U\n#EXTINF:-1,江蘇綜藝\nhttp://h/1\n#EXTINF:-1,競技賽事\nhttp://h/2\n"
    payloads = spark.createDataFrame([(0, "s", "http://s", "m3u", "cn", text)], "source_idx int, source string, url string, type string, region string, content string")
    channels = spark.createDataFrame([("江苏综艺", "local", "JSZY", "江苏综艺", "")], "standard_name string, category string, tvg_id string, display_name string, group_title string")
    aliases = spark.createDataFrame([], "alias string, standard_name string")
    got = {r.name: r.standard_name for r in jobs.catalogue(payloads, channels, aliases, phrases=phrases, characters=characters).collect()}
    assert got == {"江苏综艺": "江苏综艺", "竞技赛事": ""}


@pytest.mark.parametrize(
    ("name", "group", "category"),
    [
        ("CCTV-1", "", "cctv"), ("CETV 1", "", "cctv"), ("湖南卫视", "", "weishi"), ("香港卫视", "", "weishi"), ("TVB", "", "gangtai"), ("ESPN", "", "sports"),
        ("虎牙一起看", "", "live"), ("FM 101", "", "radio"), ("BBC One", "", "overseas"), ("DW News", "", "overseas"), ("北京台", "", "local"), ("", "体育", "other"),
        ("Foo", "央视频道", "cctv"), ("Foo", "卫视频道", "weishi"), ("Foo", "Radio", "radio"), ("Foo", "酒店", "special"), ("未知", "", "local"), ("Foo", "", "overseas"),
    ],
)
def test_rules(spark, name, group, category):
    assert column(spark, [(name, group)], "n string, g string", classify_by_rules("n", "g")) == [category]


def test_regions(spark):
    rows = [("北京台", "", "hotel"), ("北京台", "", "overseas"), ("ESPN", "", "overseas"), ("ESPN", "", "cn"), ("ESPN", "", None)]
    assert column(spark, rows, "n string, g string, r string", classify_with_region("n", "g", "r")) == ["special", "local", "overseas", "sports", "sports"]


def test_categories(spark):
    rows = dims.categories(spark).collect()
    assert len(rows) == 10
    assert rows[0].category == "cctv" and rows[8].category == "other" and rows[9].ord is None and rows[9].is_radio
    got = spark.createDataFrame([("cctv",), ("radio",), ("nope",)], "c string").select(dims.file_for("c"), dims.title_for("c"), dims.position_of("c")).collect()
    assert [tuple(r) for r in got] == [("live_cctv.m3u", "央视", 0), ("live_radio.m3u", "电台", 999), (None, None, 999)]


@pytest.mark.parametrize(
    ("url", "body", "segment"),
    [
        ("http://h/a/b.m3u8", "#EXTM3U\n\n seg.ts \n", "http://h/a/seg.ts"), ("http://h/a/b", "/x/y.ts", "http://h/a/x/y.ts"), ("http://h/a", "https://o/z.ts", "https://o/z.ts"),
        ("http://h/a", "#only", None), ("http://h/a", None, None), ("http://h/a", "#c\r\nfirst\r\nsecond", "http://h/first"),
    ],
)
def test_first_segment(spark, url, body, segment):
    assert column(spark, [(url, body)], "u string, b string", addresses.first_segment_url("u", "b")) == [segment]


def test_urls_and_times(spark):
    rows = [("http://a/b c",), ("no-scheme",), ("rtp://1.2.3.4:5",), ("http://",), (None,)]
    assert column(spark, rows, "u string", addresses.is_valid_url("u")) == [True, False, True, False, False]
    assert column(spark, [("RTP://x",), (None,), ("http://x",)], "u string", addresses.is_rtp("u")) == [True, False, False]
    assert column(spark, [("2026-08-23 01:02:03",), ("2026-08-23",), (None,)], "t string", addresses.is_timestamp("t")) == [True, False, False]
    at = spark.range(1).select(addresses.run_timestamp(F.lit("2026-08-22 20:00:00").cast("timestamp")).alias("x")).first().x
    assert at == "2026-08-23 04:00:00"


def test_phrases_against_a_walk_from_the_left(spark):
    """Trie and join against the plain rule, over overlapping phrases of few characters."""
    rng = random.Random(7)
    for _ in range(6):
        table = {"".join(rng.choice("abcß衛") for _ in range(rng.randrange(1, 5))): rng.choice(["", "X", "yz", "衛"]) for _ in range(12)}
        texts = ["".join(rng.choice("abcß衛 ") for _ in range(rng.randrange(0, 14))) for _ in range(150)] + [None, "", "鳳凰"]

        def plain(text):
            out, k = [], 0
            both = dict(zip(names.TRADITIONAL, names.SIMPLIFIED, strict=True)) | table
            while k < len(text):
                n = next((n for n in range(5, 0, -1) if text[k : k + n] in both and k + n <= len(text)), 0)
                out.append(both[text[k : k + n]] if n else text[k])
                k += n or 1
            return "".join(out)

        df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, name string")
        phrases = spark.createDataFrame(list(table.items()), "traditional string, simplified string")
        want = {k: None if t is None else plain(t) for k, t in enumerate(texts)}
        assert {r.k: r.name for r in names.simplify_phrases(df, phrases).collect()} == want
        assert {r.k: r.name for r in names._by_join(df, "name", names.conversion(phrases, None, spark)).collect()} == want


def test_large_tables_take_the_join(spark, monkeypatch):
    df = spark.createDataFrame([("衛視台衛",)], "name string")
    phrases = spark.createDataFrame([("衛視台", "X")], "traditional string, simplified string")
    taken = []
    monkeypatch.setattr(names, "TABLE_BYTES", 10)
    monkeypatch.setattr(names, "_by_trie", lambda *a: taken.append(a))
    assert [r.name for r in names.simplify_phrases(df, phrases).collect()] == ["X卫"] and not taken


def test_conversion_table_is_read_from_its_path(spark, tmp_path):
    (tmp_path / "table.txt").write_text("衛視\tTV\textra\nno tab\n\tempty\n臺\t台\n")
    assert sorted(map(tuple, tables.read_conversion(spark, str(tmp_path)).collect())) == [("臺", "台"), ("衛視", "TV")]


def test_long_blanks_in_names(spark):
    blanks = " " * 200_000
    df = spark.createDataFrame([(f"a{blanks}b",), (f"{blanks}CCTV 1{blanks}[HD]{blanks}",), (f"—{blanks}x—y{blanks}，",)], "name string")
    began = time.time()
    assert [r.name for r in df.select(names.clean_channel_name("name").alias("name")).collect()] == ["a b", "CCTV-1", "x—y"]
    assert time.time() - began < 20


def _shuffled(spark, job):
    """Rows that the job writes to shuffles."""
    store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    spark.sparkContext.setJobGroup("measured", "measured")
    job()
    ids = {s for j in spark.sparkContext.statusTracker().getJobIdsForGroup("measured") for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = store.stageList(None, False, False, none, None)
    return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()) if stages.apply(k).stageId() in ids)


def test_join_shuffles_only_where_a_phrase_can_begin(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    phrases = session.createDataFrame([("龍12345678901", "x"), ("龍1", "y"), ("龍", "z")], "traditional string, simplified string")
    rows = session.createDataFrame([(k, f"龍1 {k:04d} {'m' * 40} 龍{k}") for k in range(300)], "k int, name string")
    want = {k: names.replaced(n, names.phrase_trie([("龍12345678901", "x"), ("龍1", "y"), ("龍", "z")])) for k, n in rows.collect()}
    got = []
    moved = _shuffled(session, lambda: got.extend(names._by_join(rows, "name", phrases).collect()))
    assert {r.k: r.name for r in got} == want
    assert moved < 60 * 300  # before: every piece of every name, over 500 a name
