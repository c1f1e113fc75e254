"""The stored history and streaks that go on day by day."""

import datetime
import random
from pathlib import Path

import pytest

from chanweave.operators import health
from chanweave.plans import jobs
from chanweave.sources import history

SCHEMA = "source string, url string, day date, success boolean, written_at long"


def day(k):
    return datetime.date(2026, 1, 1) + datetime.timedelta(days=k)


def plain_streaks(values, dead=3):
    """values: {(source, day): success}."""
    out = {}
    for source in {s for s, _ in values}:
        streak = 0
        for k in sorted((d for s, d in values if s == source), reverse=True):
            if values[source, k]:
                break
            streak += 1
        out[source] = (streak, streak >= dead)
    return out


def streaks(df):
    return {r.source: (r.streak, r.dead) for r in df.collect()}


def test_advancing_equals_the_whole_history(spark):
    rng = random.Random(11)
    values, states, written = {}, None, 0
    whole = spark.createDataFrame([], SCHEMA)
    for _ in range(7):
        batch = {}
        for _ in range(25):  # late days, new days and rewritten ones
            batch[f"s{rng.randrange(6)}", rng.randrange(12)] = rng.random() < 0.4
        written += 1
        rows = spark.createDataFrame([(s, f"u{written}", day(k), v, written) for (s, k), v in batch.items()], SCHEMA)
        whole = spark.createDataFrame(health.latest_days(whole.unionByName(rows)).select(*whole.columns).collect(), SCHEMA)
        values |= batch
        states = health.streak_states(rows) if states is None else health.advance_states(states, rows, whole)
        states = spark.createDataFrame(states.collect(), "source string, last_success date, fails array<date>")
        assert streaks(health.streaks_of(states)) == plain_streaks(values) == streaks(health.dead_streaks(whole))


def test_states_merge_in_any_order(spark):
    rng = random.Random(3)
    values = {(f"s{s}", k): rng.random() < 0.3 for s in range(5) for k in range(15) if rng.random() < 0.8}
    parts = [{x: v for x, v in values.items() if x[1] % 3 == k} for k in range(3)]
    frames = [health.streak_states(spark.createDataFrame([(s, "u", day(k), v, 1) for (s, k), v in p.items()], SCHEMA)) for p in parts]
    for a, b, c in ((0, 1, 2), (2, 1, 0), (1, 2, 0)):
        assert streaks(health.streaks_of(health.merge_states(health.merge_states(frames[a], frames[b]), frames[c]))) == plain_streaks(values)


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_upsert_touches_its_days_only_and_can_be_repeated(spark, tmp_path):
    store = str(tmp_path / "store")
    assert history.read_history(spark, store).count() == 0
    rows = [(f"s{s}", "old", day(k), True, 1) for s in range(3) for k in range(4)]
    assert history.upsert_days(spark, store, spark.createDataFrame(rows, SCHEMA)) == [str(day(k)) for k in range(4)]
    before = files(store)
    new = spark.createDataFrame([("s0", "new", day(2), False, 5), ("s9", "x", day(2), True, 5), ("s1", "late", day(2), False, 0)], SCHEMA)
    for _ in range(2):
        history.upsert_days(spark, store, new)
        read = {(r.source, r.day): (r.url, r.success, r.written_at) for r in history.read_history(spark, store).collect()}
        want = {(s, d): (u, v, w) for s, u, d, v, w in rows} | {("s0", day(2)): ("new", False, 5), ("s9", day(2)): ("x", True, 5)}
        assert read == want
        after = files(store)
        assert {p: after[p] for p in before} == before and all(str(day(2)) in p for p in set(after) - set(before))
    assert {r.source: r.url for r in history.latest_urls(history.read_history(spark, store)).collect()} == {"s0": "new", "s1": "old", "s2": "old", "s9": "x"}
    history.vacuum(spark, store)
    assert {(r.source, r.day) for r in history.read_history(spark, store).collect()} == set(want)
    assert len(list(Path(store).glob("day=*/version=*"))) == 4
    assert history.read_history(spark, store, [str(day(2))]).count() == 4


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2)])
def test_daily_health(spark, tmp_path, order):
    rng = random.Random(5)
    values = {(f"s{s}", k): rng.random() < 0.25 for s in range(6) for k in range(4)}
    registry = spark.createDataFrame([(f"s{s}",) for s in range(5)], "name string")
    seen = {}
    for k in order:
        own = {x: v for x, v in values.items() if x[1] == k}
        seen |= own
        new = spark.createDataFrame([(s, "u", day(d), v, 1) for (s, d), v in own.items()], SCHEMA)
        for _ in range(2):
            found = {r.source: (r.streak, r.action) for r in jobs.daily_health(spark, str(tmp_path / "h"), new, registry, dead_days=2).collect()}
            assert found == {s: (n, "disable") for s, (n, dead) in plain_streaks(seen, 2).items() if dead and s != "s5"}
