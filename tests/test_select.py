"""Selection against a list model, splitting, matching, probing, health and checks."""

import random

import pytest
from pyspark.sql import functions as F

from chanweave.operators import health, match, probe, quality, select, split
from chanweave.plans import derive, jobs

SCHEMA = "ord long, name string, url string, category string, source_region string, standard_name string, alive boolean, latency_ms int"


def cost(r):
    region = {"cn": 0, "hk_tw": 1, "hotel": 2, "overseas": 3}.get(r["source_region"] or "cn", 99)
    return region, int(r["url"].lower().startswith("rtp://")), 999999 if r["latency_ms"] is None else r["latency_ms"]


def model(rows, keep):
    """Lists in arrival order: best per name, addresses, best per name over all, addresses over all, radio last."""
    groups = {}
    for r in sorted(rows, key=lambda r: r["ord"]):
        groups.setdefault(r["category"], []).append(r)
    key = lambda r: r["standard_name"] or r["name"]

    def first_urls(rows, seen):
        out = []
        for r in rows:
            if not r["url"] or r["url"] not in seen:
                out.append(r)
            seen.add(r["url"])
        return out

    chosen = {}
    for c, members in groups.items():
        by_key = {}
        for r in members:
            if r["alive"] is not False:
                by_key.setdefault(key(r), []).append(r)
        chosen[c] = first_urls([r for x in by_key.values() for r in sorted(x, key=cost)[:keep]], set())
    by_key = {}
    for c, members in chosen.items():
        for r in members if c != "radio" else []:
            by_key.setdefault(key(r), []).append(r)
    out = {c: [] for c in chosen}
    for x in by_key.values():
        for r in sorted(x, key=cost)[:keep]:
            out[r["category"]].append(r)
    seen = set()
    for c in out:
        if c != "radio":
            out[c] = first_urls(out[c], seen)
    seen.discard("")
    out["radio"] = [r for r in chosen.get("radio", []) if not r["url"] or r["url"] not in seen]
    return {c: [r["ord"] for r in x] for c, x in out.items() if x}


@pytest.mark.parametrize("keep", [1, 2, 3])
def test_select_best_equals_model(spark, keep):
    rng = random.Random(keep)
    for _ in range(6):
        rows = [
            {
                "ord": k, "name": f"n{rng.randrange(8)}", "url": rng.choice(["", *[f"{rng.choice(['http', 'rtp'])}://{x}" for x in range(12)]]),
                "category": rng.choice(["cctv", "local", "radio", "sports"]), "source_region": rng.choice(["cn", "hk_tw", "overseas", "x", None]),
                "standard_name": rng.choice(["", "s1", "s2"]), "alive": rng.choice([True, True, False, None]), "latency_ms": rng.choice([None, 1, 5, 9]),
            }
            for k in range(60)
        ]
        df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
        got = {}
        for r in select.select_best(df, keep).orderBy("category", "p1", "p2").collect():
            got.setdefault(r.category, []).append(r.ord)
        assert got == model(rows, keep)


def candidates(spark, *rows):
    base = {"name": "A", "url": "http://u", "category": "cctv", "source_region": "cn", "standard_name": "", "alive": True, "latency_ms": None}
    return spark.createDataFrame([tuple({"ord": k, **base, **r}.values()) for k, r in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize(
    ("rows", "keep", "urls"),
    [
        ([{"url": "1"}, {"url": "2"}, {"url": "3", "category": "local"}, {"url": "4", "category": "local"}], 2, ["1", "2"]),
        ([{"url": "1"}, {"url": "1"}], 2, ["1"]),
        ([{"url": "1"}, {"url": "2", "source_region": "overseas"}], 2, ["1", "2"]),
        ([{"url": "1", "category": "radio"}, {"url": "2"}], 1, ["1", "2"]),
        ([{"url": "1"}, {"url": "1", "name": "B"}], 1, ["1"]),
        ([{"url": "1"}, {"url": "1", "name": "B", "category": "radio"}], 1, ["1"]),
        ([{"url": "rtp://1"}, {"url": "http://2"}], 1, ["http://2"]),
        ([{"url": "rtp://1"}, {"url": "http://2"}], 2, ["http://2", "rtp://1"]),
        ([{"url": ""}, {"url": "", "name": "B"}], 1, ["", ""]),
        ([{"url": "1", "alive": False}, {"url": "2", "alive": None}], 2, ["2"]),
    ],
)
def test_select_cases(spark, rows, keep, urls):
    assert sorted(r.url for r in select.select_best(candidates(spark, *rows), keep).collect()) == sorted(urls)


def test_url_policy(spark):
    df = candidates(spark, {"url": "1", "source_region": "overseas"}, {"url": "1", "name": "B"})
    assert [r.name for r in select.select_best(df, 1).collect()] == ["A"]
    assert [r.name for r in select.select_best(df, 1, url_policy="best").collect()] == ["B"]


def test_empty(spark):
    assert select.select_best(candidates(spark, {}).limit(0), 1).count() == 0


def test_split(spark):
    df = candidates(spark, {"standard_name": "s"}, {"name": "B"}, {"category": "radio"}, {"category": "overseas", "standard_name": "s"}, {"category": "overseas"})
    assert [r.target for r in split.split_catalog_more(df).orderBy("ord").collect()] == ["catalog", "more", "catalog", "dropped", "dropped"]
    assert [r.target for r in split.split_catalog_more(df, include_overseas=True).orderBy("ord").collect()] == ["catalog", "more", "catalog", "catalog", "more"]


def test_match(spark):
    channels, aliases = derive.dictionary(spark)
    names = spark.createDataFrame([("CCTV-1",), (" CCTV1 ",), ("湖南台",), ("TVB",), ("CCTV-2",), ("nope",), ("",), (None,)], "name string")
    found = {r.name: (r.match_standard_name, r.matched_by) for r in match.match_channels(names, channels, aliases).collect()}
    assert found["CCTV-1"] == ("CCTV-1", "exact") and found[" CCTV1 "] == ("CCTV-1", "alias") and found["湖南台"][0] == "湖南卫视"
    assert found["TVB"] == ("TVB Jade", "alias") and found["CCTV-2"] == ("CCTV-2", "exact")
    assert found["nope"][0] is None and found[""][0] is None and found[None][0] is None
    assert [r.alias for r in match.orphan_aliases(channels, aliases).collect()] == ["无主"]
    fuzzy = match.match_fuzzy(spark.createDataFrame([("bbc",), ("cctv",), ("",), ("jade",)], "name string"), channels)
    assert sorted(map(tuple, fuzzy.collect())) == [("bbc", "BBC World News"), ("jade", "TVB Jade")]


def test_probe(spark):
    schema = "url string, head_status int, get_status int, body string, seg_status int, timed_out boolean, error string, latency_ms int"
    rows = [
        ("a", 404, None, None, None, False, None, 1), ("b", 200, 500, None, None, False, None, 1), ("c", 200, 200, "#x", None, False, None, 1),
        ("d", 200, 200, "s", 200, False, None, 7), ("e", 200, 200, "s", 403, False, None, 1), ("f", None, None, None, None, True, None, 1),
        ("g", None, None, None, None, False, "e" * 200, 1), ("h", 200, 200, "s", None, True, None, 1),
    ]
    verdicts = probe.probe_verdict(spark.createDataFrame(rows, schema))
    got = {r.url: (r.alive, r.status, len(r.error)) for r in verdicts.collect()}
    assert got == {
        "a": (False, "HTTP 404", 0), "b": (False, "HTTP 500", 0), "c": (False, "no_segment", 0), "d": (True, "ok", 0), "e": (False, "seg_HTTP 403", 0),
        "f": (False, "timeout", 7), "g": (False, "error", 120), "h": (False, "timeout", 7),
    }
    rows = candidates(spark, {"url": "d"}, {"url": ""}, {"url": "a"})
    assert [(r.alive, r.latency_ms) for r in probe.apply_probe(rows, verdicts).orderBy("ord").collect()] == [(True, 7), (None, None), (False, 1)]
    assert tuple(probe.probe_stats(probe.apply_probe(rows, verdicts)).first()) == (1, 2, 33.3)
    assert tuple(probe.probe_stats(rows.limit(0)).first()) == (0, 0, 0.0)
    assert select.verified(candidates(spark, {"alive": None}, {"url": ""}, {"url": "x"}, {"url": "x"})).count() == 1


def test_streaks(spark):
    rng = random.Random(3)
    rows = [(f"s{s}", "u", f"2026-01-{d:02d}", rng.random() < 0.4, 1) for s in range(30) for d in range(1, 12) if rng.random() < 0.8]
    history = spark.createDataFrame(rows, "source string, url string, day string, success boolean, written_at int").withColumn("day", F.col("day").cast("date"))
    want = {}
    for s in {r[0] for r in rows}:
        n = 0
        for r in sorted((r for r in rows if r[0] == s), key=lambda r: r[2], reverse=True):
            if r[3]:
                break
            n += 1
        want[s] = (n, n >= 3)
    for f in (health.dead_streaks, lambda h, *a: health.streaks_of(health.streak_states(h), *a)):
        assert {r.source: (r.streak, r.dead) for r in f(history).collect()} == want
    registry = spark.createDataFrame([(s,) for s in sorted(want)[:20]], "name string")
    flagged = {r.source: r.action for r in health.flag_dead_sources(history, registry, True, 5, core=("s0",)).collect()}
    assert flagged == {s: "warn" if s == "s0" else "disable" for s in sorted(want)[:20] if want[s][1]}
    assert health.flag_dead_sources(history, registry, False, 5).count() == 0


def test_upsert(spark):
    schema = "source string, url string, day date, success boolean, written_at int"
    row = lambda s, u, d, ok, at: spark.createDataFrame([(s, u, d, ok, at)], "source string, url string, day string, success boolean, written_at int").withColumn("day", F.col("day").cast("date"))
    old = row("a", "u1", "2026-01-01", True, 1).union(row("a", "u1", "2026-01-02", True, 1))
    out = health.upsert_history(old, row("a", "u2", "2026-01-02", False, 2)).orderBy("day").collect()
    assert [(r.url, r.success) for r in out] == [("u2", True), ("u2", False)] and schema


def test_registry(spark):
    rows = [(1, "a", "http://x", "m3u"), (2, "a", "http://x", "txt"), (3, "", "bad", "xml"), (4, None, None, None), (5, "b", "http://ok", "m3u")]
    got = health.validate_registry(spark.createDataFrame(rows, "source_idx int, name string, url string, type string"))
    assert sorted(map(tuple, got.collect())) == [
        (2, "duplicate name"), (2, "duplicate url"), (3, "malformed url"), (3, "missing name"), (3, "unknown type"), (4, "empty url"), (4, "missing name"),
    ]


def test_quality(spark):
    rows = spark.createDataFrame([("A", "1", "央视"), ("A", "2", "电台"), ("B", "2", "bad")], "name string, url string, group_title string")
    assert tuple(quality.quality_stats(rows).first()) == (3, 2, 2, 2, 1, 1)
    summary = spark.createDataFrame([(1, "collect", "2026-08-23 01:02:03", False)], "schema_version int, stage string, generated_at string, probe_enabled boolean")
    allowed = spark.createDataFrame([("央视",), ("电台",)], "group_title string")
    checks = {(r.check, r.severity): r.ok for r in quality.validate_outputs(rows, rows.limit(0), False, summary, allowed).collect()}
    assert [k for k, ok in checks.items() if not ok] == [
        ("radio_in_live", "fail"), ("max_per_name", "fail"), ("dup_names", "fail"), ("dup_urls", "fail"), ("bad_groups", "fail"), ("more_not_empty", "warn"),
    ]
    lines = spark.createDataFrame([(1, '#EXTINF:-1 group-title="a" group-title="b",N'), (2, "u"), (3, '#EXTINF:-1 group-title="b",M')], "ord int, line string")
    assert [tuple(r) for r in quality.group_distribution(lines).collect()] == [("b", 2), ("a", 1)]
    assert [(r.name, r.url, r.group_title) for r in quality.parse_written(lines).orderBy("ord").collect()][0] == ("N", "u", "a")


def test_whole_run(spark, tmp_path):
    schema = "source_idx int, source string, url string, type string, region string, content string"
    one = '#EXTM3U\n#EXTINF:-1 group-title="x",CCTV1 (HD)\nhttp://1\n#EXTINF:-1,某某台\nhttp://2\n#EXTINF:-1,Radio X\nhttp://3\n#EXTINF:-1,Foo TV\nhttp://4'
    two = "G,#genre#\nCCTV-1,http://5\n湖南台,http://6"
    payloads = spark.createDataFrame([(0, "iptv-org-cn", "", "m3u", "cn", one), (1, "b", "", "txt", "cn", two), (2, "c", "", "m3u", "cn", "HTTP 500")], schema)
    summary = jobs.run_catalogue(spark, payloads, *derive.dictionary(spark), str(tmp_path / "out")).first()
    assert (summary.total, summary.catalog_count, summary.more_count) == (5, 3, 1) and len(summary) == 15
    files = {r.file: r.entries for r in quality.file_overview(quality.read_lines(spark, str(tmp_path / "out" / "playlists"))).collect()}
    assert files == {"live.m3u": 2, "live_cctv.m3u": 1, "live_weishi.m3u": 1, "live_radio.m3u": 1, "live_local.m3u": 0, "live_overseas.m3u": 0, "live_more.m3u": 1}


@pytest.mark.parametrize("probing", [False, True])
def test_a_run_validates_itself(spark, tmp_path, probing):
    schema = "source_idx int, source string, url string, type string, region string, content string"
    one = '#EXTM3U\n#EXTINF:-1 group-title="x",CCTV1 (HD)\nhttp://1\n#EXTINF:-1,某某台\nhttp://2\n#EXTINF:-1,Radio X\nhttp://3\n#EXTINF:-1,Foo TV\nhttp://4'
    two = "G,#genre#\nCCTV-1,http://1\n湖南台,http://6"
    payloads = spark.createDataFrame([(0, "iptv-org-cn", "", "m3u", "cn", one), (1, "b", "", "txt", "cn", two)], schema)
    verdicts = spark.createDataFrame([(f"http://{k}", k != 6, 10 * k, "ok") for k in (1, 2, 3, 6)], "url string, alive boolean, latency_ms int, status string")
    out = str(tmp_path / "out")
    summary = jobs.run_catalogue(spark, payloads, *derive.dictionary(spark), out, verdicts if probing else None).first()
    assert (summary.schema_version, summary.stage, summary.probe_enabled) == (1, "probe" if probing else "collect", probing)
    assert (summary.ok, summary.fail, summary.ratio) == ((4, 2, 66.7) if probing else (0, 0, 0.0))
    checks = jobs.validate_run(spark, out).collect()
    assert not [r for r in checks if r.severity == "fail" and not r.ok], checks
    assert {r.check for r in checks} >= {"exists live.m3u", "exists live_more.m3u", "verified_exists", "dup_urls"}
    lines = {(r.file, r.line) for r in quality.read_lines(spark, f"{out}/playlists").collect()}
    if probing:
        assert {x for f, x in lines if f == "live_verified.m3u" and not x.startswith("#")} == {"http://1", "http://2", "http://3"}
    else:
        assert not [f for f, _ in lines if f == "live_verified.m3u"]


def test_a_run_without_its_core_sources_writes_nothing(spark, tmp_path):
    schema = "source_idx int, source string, url string, type string, region string, content string"
    rows = [(0, "iptv-org-cn", "", "m3u", "cn", "#EXTM3U\n#EXTINF:-1,CCTV1\nhttp://1"), (1, "iptv-org-hk", "", "m3u", "cn", "#EXTM3U\n#EXTINF:-1,TVB\nhttp://2")]
    good = spark.createDataFrame(rows, schema)
    failed = good.withColumn("content", F.when(F.col("source") == "iptv-org-hk", "ERROR: not landed").otherwise(F.col("content")))
    out = tmp_path / "out"
    jobs.run_catalogue(spark, good, *derive.dictionary(spark), str(out))
    before = {p: p.stat().st_mtime_ns for p in out.rglob("*") if p.is_file()}
    with pytest.raises(jobs.CoreSourcesFailed):
        jobs.run_catalogue(spark, failed, *derive.dictionary(spark), str(out))
    assert {p: p.stat().st_mtime_ns for p in out.rglob("*") if p.is_file()} == before
    lax = jobs.run_catalogue(spark, failed, *derive.dictionary(spark), str(out), settings=jobs.Settings(strict_sources=False)).first()
    assert lax.total == 1


def test_verdicts_without_latency_count(spark):
    rows = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("",)], "url string")
    verdicts = spark.createDataFrame([("u1", False, None, "timeout"), ("u2", False, None, "error"), ("u2", True, 7, "ok"), ("u3", True, 9, "ok"), ("u3", False, 9, "HTTP 404")], "url string, alive boolean, latency_ms int, status string")
    got = {r.url: (r.alive, r.latency_ms, r.probe_status) for r in probe.apply_probe(rows, verdicts).collect()}
    assert got == {"u1": (False, None, "timeout"), "u2": (True, 7, "ok"), "u3": (False, 9, "HTTP 404"), "": (None, None, None)}
    assert sorted(r.url for r in select.alive_only(probe.apply_probe(rows, verdicts)).collect()) == ["", "u2"]


def test_match_fuzzy(spark):
    channels = spark.createDataFrame([("CCTV-1",), ("CCTV-13",), ("湖南卫视",), ("Hunan TV",)], "standard_name string")
    names = spark.createDataFrame([("cctv-13",), ("CCTV",), ("南卫",), ("湖",), ("unan",), ("",), (None,), ("t",), ("nothing here",)], "name string")
    got = {tuple(r) for r in match.match_fuzzy(names, channels).collect()}
    assert got == {("cctv-13", "CCTV-13"), ("南卫", "湖南卫视"), ("湖", "湖南卫视"), ("unan", "Hunan TV")}
