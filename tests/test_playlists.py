"""Parsing and writing playlists, against a list model."""

import random
import re
from xml.etree import ElementTree

import pytest

from chanweave.operators import quality
from chanweave.plans import jobs, queries
from chanweave.sources import playlists, sinks, tables

SCHEMA = "source_idx int, source string, url string, type string, region string, content string"


def payload(spark, *contents, kind="m3u"):
    return spark.createDataFrame([(k, f"s{k}", "", kind, "cn", c) for k, c in enumerate(contents)], SCHEMA)


def names_urls(entries):
    return [(r.name, r.url, r.group_title) for r in entries.orderBy("ord").collect()]


def test_basic(spark):
    text = '#EXTM3U\n#EXTINF:-1 tvg-id="C1" tvg-logo="l.png" group-title="央视",CCTV-1\nhttp://a/1\n\n#EXTINF:-1,Two\n#EXTGRP:卫视\nrtp://b'
    rows = playlists.parse_m3u(payload(spark, text)).orderBy("ord").collect()
    assert [(r.name, r.url, r.tvg_id, r.tvg_logo, r.group_title, r.source) for r in rows] == [
        ("CCTV-1", "http://a/1", "C1", "l.png", "央视", "s0"), ("Two", "rtp://b", "", "", "卫视", "s0"),
    ]


def test_odd_lines(spark):
    text = (
        '#EXTINF:-1 group-title="a,b",N http://1\r\n#EXTINF:-1,\nhttp://dropped\n#EXTINF:-1,X\n#EXTINF:-1,Y\n#EXTVLCOPT:z\nhttp://2\nhttp://3\n'
        "#EXTGRP:early\n#EXTINF:-1.5 x,Z\n#EXTGRP:\nhttp://4"
    )
    assert names_urls(playlists.parse_m3u(payload(spark, text))) == [('b",N', "http://1", "a,b"), ("Y", "http://2", ""), ("Z", "http://4", "")]


def test_txt(spark):
    text = "A,http://0\nG1,#genre#\nB,https://1,2\nC,rtp://x\n#D,http://3\n ,http://4\nG2,#genre#,x\nE,http://5"
    assert names_urls(playlists.parse_txt(payload(spark, text, kind="txt"))) == [
        ("A", "http://0", ""), ("B", "https://1,2", "G1"), ("", "http://4", "G1"), ("E", "http://5", "G2"),
    ]


def test_errors_and_nulls(spark):
    rows = playlists.parse_payloads(payload(spark, "HTTP 404", "ERROR: x", None, "", "#EXTINF:-1,A\nu"))
    assert names_urls(rows) == [("A", "u", "")]


def model(text):
    """The list rules: a pending entry, replaced by a later one, sent off by an address."""
    out, now = [], None
    for line in re.split("\n", text):
        line = line.strip()
        m = re.match(r"#EXTINF\s*:\s*-?\d+\s*(?:[^,]*,)(.+)", line, re.I)
        if m:
            now = [m[1].strip(), ""]
        elif line.upper().startswith("#EXTGRP:"):
            if now:
                now[1] = line.split(":", 1)[1].strip()
        elif line and not line.startswith("#") and now:
            out.append((now[0], line, now[1]))
            now = None
    return out


def test_random_sequences(spark):
    rng = random.Random(1)
    pool = ["#EXTINF:-1,N{}", "#EXTGRP:g{}", "#EXTGRP:", "http://u/{}", "# c", "", "#EXTINF:-1,", "#EXTM3U"]
    texts = ["\n".join(rng.choice(pool).format(k) for k in range(rng.randrange(1, 12))) for _ in range(120)]
    got = {}
    for r in playlists.parse_m3u(payload(spark, *texts)).orderBy("ord").collect():
        got.setdefault(int(r.source[1:]), []).append((r.name, r.url, r.group_title))
    assert got == {k: model(t) for k, t in enumerate(texts) if model(t)}


def test_write_and_count(spark, tmp_path):
    rows = [("live", k, f"N{k}", f"http://{k}", "", "", "央视") for k in range(1, 30)]
    entries = spark.createDataFrame(rows, "playlist string, pos long, name string, url string, tvg_id string, tvg_logo string, group_title string")
    lists = spark.createDataFrame([("live",), ("empty",)], "playlist string")
    sinks.write_playlists(sinks.playlist_lines(entries, lists), str(tmp_path / "out"), part_entries=7)
    parts = sorted((tmp_path / "out" / "playlist=live").glob("part=*/part-*"))
    text = "".join(p.read_text() for p in parts)
    assert len(parts) == 5
    manifest = {(r.playlist, r.part): (r.first, r.entries) for r in spark.read.json(str(tmp_path / "out" / "_manifest")).collect()}
    assert manifest["live", "p000000000"] == (0, 6) and manifest["live", "p000000004"] == (28, 2) and manifest["empty", "p000000000"] == (0, 0)
    numbered = {(r.file, r.line_no): r.line for r in quality.line_numbers(quality.read_written(spark, str(tmp_path / "out"))).collect()}
    assert [numbered["live", k] for k in range(1, 60)] == text.splitlines() and numbered["empty", 1] == "#EXTM3U"
    assert text.splitlines()[:3] == ["#EXTM3U", '#EXTINF:-1 group-title="央视",N1', "http://1"]
    assert [f"http://{k}" for k in range(1, 30)] == [x for x in text.splitlines() if x.startswith("http")]
    counted = quality.count_entries(quality.read_lines(spark, str(tmp_path / "out")), spark.createDataFrame([("live",), ("empty",), ("missing",)], "file string"))
    assert {r.file: r.entries for r in counted.collect()} == {"live": 29, "empty": 0, "missing": 0}


def test_landing_files(spark, tmp_path):
    (tmp_path / "a.m3u").write_text("#EXTINF:-1,A\nhttp://a")
    (tmp_path / "b.m3u").write_text("#EXTINF:-1,B\nhttp://b")
    registry = spark.createDataFrame([(0, "a", "", None, None, None), (1, "b", "", "m3u", False, "cn")], "source_idx int, name string, url string, type string, enabled boolean, region string")
    read = playlists.read_payloads(spark, str(tmp_path), tables.with_registry_defaults(registry))
    assert names_urls(playlists.parse_payloads(read)) == [("A", "http://a", "")]


def test_dictionary_files(spark, tmp_path):
    (tmp_path / "channels.json").write_text('[{"standard_name": "CCTV-1", "category": "cctv", "tvg_id": "C1", "display_name": "D"}]')
    (tmp_path / "aliases.json").write_text('{"CCTV1": "CCTV-1",\n "X": "Y"}')
    channels, aliases = tables.read_dictionary(spark, str(tmp_path / "channels.json"), str(tmp_path / "aliases.json"))
    assert channels.first().tvg_id == "C1"
    assert sorted(map(tuple, aliases.collect())) == [("CCTV1", "CCTV-1"), ("X", "Y")]


def test_guides(spark):
    good = (
        '<?xml version="1.0"?><!DOCTYPE tv SYSTEM "x"><tv><channel id="c1"><display-name>One</display-name></channel><channel id=""/>'
        '<programme start="1" stop="2" channel="c1"><title>T</title><title>U</title></programme><programme start="1" channel="c1"><title/></programme>'
        '<x><programme start="9" channel="z"/></x></tv>'
    )
    docs = spark.createDataFrame([(0, good), (1, "<tv><broken"), (2, "no guide"), (3, None)], "doc_idx int, xml string")
    channels, programmes = tables.read_guides(docs)
    assert [(r.elem_idx, r.id, r.display_name) for r in channels.orderBy("elem_idx").collect()] == [(0, "c1", "One"), (1, "", None)]
    assert [(r.channel, r.start, r.title) for r in programmes.orderBy("elem_idx").collect()] == [("c1", "1", "T"), ("c1", "1", "")]


def test_guides_keep_whole_elements(spark, tmp_path):
    text = (
        '<tv><channel id="c1"><display-name lang="zh">One &amp; two</display-name><display-name>Uno</display-name><icon src="http://h/i?a=1&amp;b=2"/><url>u</url></channel>'
        '<channel id="c2"/><programme start="1" stop="2" channel="c1" showview="9"><title lang="en">T</title><title>U</title><sub-title>S</sub-title><desc lang="zh">a &lt; b</desc>'
        '<credits><director>D</director><actor role="r">N</actor><actor>M</actor></credits><category>k</category><category lang="en">l</category>'
        '<length units="minutes">60</length><episode-num system="onscreen">S1</episode-num><new/><rating system="x"><value>PG</value></rating></programme>'
        '<programme start="1" stop="3" channel="c1"><title>T</title><desc>later</desc></programme></tv>'
    )
    docs = spark.createDataFrame([(0, text), (1, text)], "doc_idx int, xml string")
    channels, programmes = jobs.merge_guides(docs)
    sinks.write_guide(channels, programmes, str(tmp_path / "guide"), part_entries=2)
    parts = sorted((tmp_path / "guide" / f"playlist={sinks.GUIDE}").glob("part=*/part-*"))
    whole = ElementTree.fromstring("".join(p.read_text() for p in parts).encode())
    assert len(parts) == 3 and [(e.tag, e.get("id") or e.get("channel")) for e in whole] == [("channel", "c1"), ("channel", "c2"), ("programme", "c1")]
    assert whole.find("programme/desc").text == "a < b" and whole.find("channel/icon").get("src") == "http://h/i?a=1&b=2"
    read = tables.read_written_guide(spark, str(tmp_path / "guide"))
    assert sorted(r.id for r in channels.collect()) == ["c1", "c2"]
    first = read[0].where("id = 'c1'").select("element.*").first()
    assert [(n["_lang"], n["_VALUE"]) for n in first["display-name"]] == [("zh", "One & two"), (None, "Uno")]
    assert (first.icon[0]["_src"], first.url) == ("http://h/i?a=1&b=2", ["u"])
    kept = read[1].select("element.*").collect()
    assert len(kept) == 1
    p = kept[0].asDict(recursive=True)
    assert (p["_stop"], p["_showview"], [t["_VALUE"] for t in p["title"]], p["sub-title"][0]["_VALUE"]) == ("2", "9", ["T", "U"], "S")
    assert (p["desc"], p["credits"]["director"]) == ([{"_lang": "zh", "_VALUE": "a < b"}], ["D"])
    assert [(a["_role"], a["_VALUE"]) for a in p["credits"]["actor"]] == [("r", "N"), (None, "M")]
    assert [c["_VALUE"] for c in p["category"]] == ["k", "l"]
    assert (p["length"], p["episode-num"][0]["_VALUE"], p["rating"][0]["value"]) == ({"_units": "minutes", "_VALUE": "60"}, "S1", "PG")
    assert p["new"] is not None and p["premiere"] is None


def test_registry_settings_file(spark, tmp_path):
    text = """# sources
settings:
  name: "no"
sources:
  # first
  - name: "a-b"   # a comment
    url: "https://h/x?y=1#z"
    type: "txt"
    enabled: false

  - url: 'http://nameless'
  -
    name: c
    url: http://c/d
    region: hk_tw
last: 1
"""
    (tmp_path / "sources.yaml").write_text(text)
    got = [tuple(r) for r in tables.read_registry_yaml(spark, str(tmp_path / "sources.yaml")).orderBy("source_idx").collect()]
    assert got == [(0, "a-b", "https://h/x?y=1#z", "txt", False, "cn"), (2, "c", "http://c/d", "m3u", True, "hk_tw")]


def test_landed_guides_equal_whole_texts(spark, tmp_path):
    parts = "".join(f'<channel id="c{k}"><display-name>D{k}</display-name></channel>' for k in range(4)), "".join(f'<programme start="{k}" channel="c{k}"><title>T</title></programme>' for k in range(5))
    texts = ["<?xml version='1.0'?><tv>" + "".join(parts) + "</tv>", "<tv>" + parts[0] + "</broken", "no guide", "<tv></tv>", "<tv>" + parts[1] + "</tv>"]
    for k, t in enumerate(texts):
        (tmp_path / f"g{k}.xml").write_text(t)
    registry = spark.createDataFrame([(k, f"g{k}", True) for k in range(5)], "source_idx int, name string, enabled boolean")
    whole = tables.read_guides(spark.createDataFrame(list(enumerate(texts)), "doc_idx int, xml string"))
    landed = tables.read_landed_guides(spark, str(tmp_path), registry)
    for a, b in zip(whole, landed, strict=True):
        assert sorted(map(tuple, a.drop("element").collect())) == sorted(map(tuple, b.drop("element").collect()))


def test_packed_guides_are_read_beside_files(spark, tmp_path):
    guide = lambda k: f'<tv><channel id="c{k}"><icon src="i"/></channel><programme start="{k}" channel="c{k}"/></tv>'
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "g0.xml").write_text(guide(0))
    spark.createDataFrame([("g1", guide(1)), ("g2", "<tv><broken"), ("g3", None), ("off", guide(4)), ("unknown", guide(5))], playlists.RECORD_SCHEMA).write.parquet(str(tmp_path / "records"))
    registry = spark.createDataFrame([(k, n, n != "off") for k, n in enumerate(("g0", "g1", "g2", "g3", "off"))], "source_idx int, name string, enabled boolean")
    for element in (True, False):
        channels, programmes = tables.read_landed_guides(spark, str(tmp_path / "files"), registry, records=str(tmp_path / "records"), element=element)
        assert sorted((r.doc_idx, r.elem_idx, r.id) for r in channels.collect()) == [(0, 0, "c0"), (1, 0, "c1")]
        assert sorted((r.doc_idx, r.elem_idx, r.start) for r in programmes.collect()) == [(0, 0, "0"), (1, 0, "1")]
        assert not element or [r.element.icon[0]["_src"] for r in channels.collect()] == ["i", "i"]


@pytest.mark.parametrize("query", ["s6_landed_programmes", "s6_landed_channels"])
def test_landed_guides_are_listed_once(spark, tmp_path, query):
    spark.range(80).selectExpr("id AS event_id", "id % 40 AS user_id").write.parquet(f"{tmp_path}/events.parquet")
    spark.sparkContext.setJobGroup(query, query)
    rows = queries.QUERIES[query](spark, str(tmp_path))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(query) for s in tracker.getJobInfo(j).stageIds]
    assert sum(s is not None and s.name.startswith("load ") for s in stages) == 1  # Spark lists so many folders in a job
    assert len(rows.collect()) == 2 * 39  # the guide of user 7 is broken


def test_guides_are_parsed_once_and_whole_only_where_winners_lie(spark):
    texts = [f'<tv><channel id="c{k % 3}"><display-name>D{k}</display-name></channel><programme start="{k % 2}" channel="c"><title>T</title></programme></tv>' for k in range(20)] + ["<tv></tv>", None]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_idx int, xml string").repartition(3)
    for rows in tables.read_guides(documents, element=False):
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_xml") == 1
    channels, programmes = jobs.merge_guides(documents)
    assert sorted((r.doc_idx, r.id, r.element["_id"]) for r in channels.collect()) == [(0, "c0", "c0"), (1, "c1", "c1"), (2, "c2", "c2")]
    assert sorted((r.doc_idx, r.start) for r in programmes.collect()) == [(0, "0"), (1, "1")]
    for rows in (channels, programmes):
        lines = rows._jdf.queryExecution().optimizedPlan().toString().lower().splitlines()
        parse, semi = [next(k for k, x in enumerate(lines) if mark in x) for mark in ("from_xml", "leftsemi")]
        assert parse < semi  # the join that leaves documents out lies below the parse
