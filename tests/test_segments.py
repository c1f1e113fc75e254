"""Playlists scanned in segments and splits give what one pass over the text gives."""

import random

import pytest

from chanweave import scratch
from chanweave.plans import derive, queries
from chanweave.sources import playlists

REGISTRY = "source_idx int, name string, url string, type string, enabled boolean, region string"


def text(seed, kind, lines):
    rng, out = random.Random(seed), []
    for k in range(lines):
        if kind == "txt":
            out.append(rng.choice([f"G{k},#genre#", f"N{k},http://h/{k},x", f"N{k},http://h/{k}", "# no,http://h", "", f"N{k},rtp://h", f"  N{k} , https://h/{k} "]))
        else:
            out.append(rng.choice([f'#EXTINF:-1 group-title="g{k}",N{k}', f"#EXTGRP: late{k}", f"http://h/{k}", "", "#EXTVLCOPT:x", f"a{k}\x0bhttp://h/v{k}", "   "]))
    return rng.choice(["\n", "\r\n"]).join(out)


def one_pass(kind, content):
    """Entries as a loop over lines finds them."""
    import re

    pending = group = None
    title, out = "", []
    for line in re.split("\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85  ]", content):
        line = line.strip()
        if kind == "txt":
            if "#genre#" in line:
                title = line.split(",")[0].strip()
            elif "," in line and not line.startswith("#"):
                name, url = line.split(",", 1)
                if re.match("https?://", url.strip()):
                    out.append((name.strip(), url.strip(), title))
        elif line.startswith("#EXTINF"):
            pending, group = line, None
        elif line.startswith("#EXTGRP:"):
            group = line.split(":", 1)[1].strip()
        elif line and not line.startswith("#"):
            if pending:
                own = re.search('group-title="([^"]*)"', pending)
                out.append((pending.split(",", 1)[1].strip(), line, group if group is not None else own.group(1) if own else ""))
            pending = None
    return out


@pytest.fixture
def payloads():
    rows = [(k, kind, text(k, kind, n)) for k, (kind, n) in enumerate([("m3u", 700), ("txt", 700), ("m3u", 5), ("txt", 0), ("m3u", 300)])]
    rows.append((5, "m3u", "HTTP 404\n#EXTINF:-1,x\nhttp://h/x"))
    rows.append((6, "m3u", "#EXTGRP: only a group\n" * 50 + "#EXTINF:-1,first\n" + "#c\n" * 300 + "http://h/late"))
    return rows


def plain(payloads):
    return sorted((k, *e) for k, kind, content in payloads if not content.startswith("HTTP ") for e in one_pass(kind, content))


@pytest.mark.parametrize("bits", [14, 5, 2])
def test_whole_texts(spark, monkeypatch, payloads, bits):
    monkeypatch.setattr(playlists, "SEGMENT_BITS", bits)
    table = spark.createDataFrame([(k, f"s{k}", "", kind, "cn", c) for k, kind, c in payloads], "source_idx int, source string, url string, type string, region string, content string")
    found = playlists.parse_payloads(table).collect()
    assert sorted((r.ord >> 40, r.name, r.url, r.group_title) for r in found) == plain(payloads)
    for k, kind, content in payloads:
        own = [(r.name, r.url, r.group_title) for r in sorted(found, key=lambda r: r.ord) if r.ord >> 40 == k]
        assert own == ([] if content.startswith("HTTP ") else one_pass(kind, content))


def test_landed_files_in_several_splits(spark, tmp_path, payloads):
    for k, _, content in payloads:
        (tmp_path / f"s{k}.txt").write_text(content, newline="")
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "700")
    small.conf.set("spark.sql.files.openCostInBytes", "1")
    rows = [(k, f"s{k}", "", kind, True, "cn") for k, kind, _ in payloads] + [(7, "s7", "", "m3u", True, "cn"), (8, "s8", "", "m3u", False, "cn")]
    registry = small.createDataFrame(rows, REGISTRY)
    lines = playlists.read_landed_lines(small, str(tmp_path), registry)
    assert lines.where("source_idx = 0").select("segment").distinct().count() > 5
    landed = playlists.parse_landed(small, str(tmp_path), registry).collect()
    whole = playlists.parse_payloads(playlists.read_payloads(small, str(tmp_path), registry)).collect()
    assert sorted((r.ord >> 40, r.name, r.url, r.group_title) for r in landed) == plain(payloads)
    assert sorted(map(tuple, landed)) == sorted(map(tuple, whole))


def test_sources_that_did_not_land_are_errors(spark, tmp_path):
    (tmp_path / "here.m3u").write_text("#EXTM3U")
    registry = spark.createDataFrame([(0, "here", "", "m3u", True, "cn"), (1, "gone", "", "m3u", None, "cn"), (2, "off", "", "m3u", False, "cn")], REGISTRY)
    read = {r.source: r.content for r in playlists.read_payloads(spark, str(tmp_path), registry).collect()}
    assert read == {"here": "#EXTM3U", "gone": playlists.NOT_LANDED}


def test_packed_sources_are_read_beside_files(spark, tmp_path):
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "a.m3u").write_text("A\n")
    (tmp_path / "files" / "void.m3u").write_text("")
    rows = [("b", 'B\r\n"\\,\x0b\n'), ("empty", ""), ("none", None), ("off", "O"), ("unknown", "U")]
    spark.createDataFrame(rows, playlists.RECORD_SCHEMA).write.parquet(str(tmp_path / "records"))
    wanted = ["a", "b", "empty", "gone", "none", "off", "void"]
    registry = spark.createDataFrame([(k, n, "", "m3u", n != "off", "cn") for k, n in enumerate(wanted)], REGISTRY)
    read = playlists.read_payloads(spark, str(tmp_path / "files"), registry, records=str(tmp_path / "records")).collect()
    want = {"a": "A\n", "b": rows[0][1]} | dict.fromkeys(("empty", "gone", "none", "void"), playlists.NOT_LANDED)
    assert len(read) == len(want) and {r.source: r.content for r in read} == want


@pytest.mark.parametrize(("query", "rows"), [("s1_read_payloads", 800), ("s6_landed_channels", 1170), ("s6_landed_programmes", 1170)])
def test_files_of_a_landing_are_few(spark, tmp_path, monkeypatch, query, rows):
    monkeypatch.setattr(scratch, "shared_folder", lambda spark, name: f"{tmp_path}/{name}")
    spark.range(1200).selectExpr("id AS event_id", "id AS user_id").write.parquet(f"{tmp_path}/events.parquet")
    assert len(queries.QUERIES[query](spark, str(tmp_path)).collect()) == rows
    assert len([f for f in tmp_path.glob("*/**/part-*") if "events" not in str(f)]) < 200


def test_long_lists_are_landed_with_keys_sorted_alone(spark, tmp_path):
    spark.range(600).selectExpr("id * 7 % 600 AS event_id", "id % 9 AS user_id").write.parquet(f"{tmp_path}/events.parquet")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsList().size()
    derive.land_long_lists(spark, str(tmp_path), derive.TXT_LINES, "txt", f"{tmp_path}/lists")
    plans = [store.executionsList().apply(k).physicalPlanDescription() for k in range(before, store.executionsList().size())]
    written = [p.split("== Initial Plan ==")[-1] for p in plans if "InsertInto" in p]
    assert len(written) == 1 and written[0].split("\n\n")[0].count("Sort (") == 1 and "Generate" not in written[0]
    for k in range(3):
        parts = list(tmp_path.glob(f"lists/source=l{k}/part-*"))
        events = sorted((u, e) for e, u in ((i * 7 % 600, i % 9) for i in range(600)) if u % 3 == k)
        want = []
        for _, e in events:
            want += [f"G{e % 6},#genre#"] if e % 64 == 0 else []
            want += [f"Name {e},{'rtp' if e % 9 == 0 else 'http'}://h.example.com/{e},x", "# comment, http://no.example.com"]
        assert len(parts) == 1 and parts[0].read_text().splitlines() == want
