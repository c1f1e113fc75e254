"""Conversation repair against a plain search over edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from chanweave.llm import conversations as conv

SCHEMA = "turn long, text string, conv_id long, role string, rank string, at long, sequence string"


def rows_of(seed=0, n=40):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for t in range(rng.randrange(0, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "User"])
            out.append((t + rng.choice([0, 0, 0, 5]), rng.choice(["Hi.", "why", "yes!", " \t\n", "", "ok?", "a\x0b.", "b. \n "]), c, role, "x", 1, "s"))
    out += [(None, "first.", 3, "system", None, None, None), (None, None, 3, None, None, None, None), (2, "lost.", None, "user", None, None, None)]
    out += [(k, "same.", 100, "user" if k % 2 == 0 else "assistant", None, None, None) for k in range(200)]
    out += [(7, "copy.", 101, "user", None, None, None)] * 30
    out += [(1, "w" * 200_000 + ".", 102, "user", None, None, None), (2, " " * 200_000, 102, "assistant", None, None, None)]
    out += [(4, "tie b.", 103, "user", None, None, None), (4, "tie a.", 103, "user", None, None, None), (4, "tie a.", 103, "assistant", None, None, None)]
    return out


def damaged(rows):
    out = defaultdict(list)
    for turn, text, c, role, *_ in rows:
        text, role = " " if text is None else text, " " if role is None else role
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        own = out[c]
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        own += [(turn, role, text)] * (2 if hit == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, own in out.items()}


def search(rows):
    """Cheapest (cost, audit, output) by breadth over rows and whole outputs' states."""
    best = {"": (0, "", ())}  # state: what the output's end is ("", s, u, a)
    nexts = {"": "su", "s": "u", "u": "a", "a": "u"}

    def inserted(states):
        for _ in range(3):
            for state, (cost, audit, out) in list(states.items()):
                for x in nexts[state]:
                    if x != "s":
                        new = (cost + 2, audit + "I", (*out, ("user:" if x == "u" else "assistant:")))
                        if x not in states or new[:2] < states[x][:2]:
                            states[x] = new
        return states

    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        best, new = inserted(best), {}

        def offer(state, value, new=new):
            if state not in new or value[:2] < new[state][:2]:
                new[state] = value

        for state, (cost, audit, out) in best.items():
            offer(state, (cost + 3, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            for x in nexts[state]:
                if role[:1] == x:
                    offer(x, (cost + more, audit + "K", (*out, f"{role}:{text}")))
                if x != "s":
                    offer(x, (cost + 2 + more, audit + "R", (*out, ("user:" if x == "u" else "assistant:") + text)))
        best = new
    cost, audit, out = min((v for k, v in inserted(best).items() if k in ("", "a")), key=lambda v: v[:2])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((x[1][:1], y[1][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for x, y in zip(rows, rows[1:], strict=False))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()), out


@pytest.mark.parametrize("bits, rules", [(12, 256), (2, 3), (3, 0)])
def test_repair_against_search(spark, monkeypatch, bits, rules):
    monkeypatch.setattr(conv, "SEGMENT_BITS", bits)
    rows = rows_of()
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = {r[0]: tuple(r)[1:] for r in conv.repair(conv.damaged(table), rules=rules).collect()}
    wanted = {c: search(own) for c, own in damaged(rows).items()}
    assert found == {c: w for c, (w, _) in wanted.items()}
    assert None in found and found[100][1] >= 0


def test_repaired_rows(spark):
    rows = rows_of(1)
    out = defaultdict(list)
    for r in conv.repair(conv.damaged(spark.createDataFrame(rows, SCHEMA)), rows_out=True).collect():
        out[r.conv_id].append((r.pos, f"{r.role}:{r.text}"))
    for c, own in damaged(rows).items():
        assert [x for _, x in sorted(out[c])] == list(search(own)[1]) and [p for p, _ in sorted(out[c])] == list(range(1, len(out[c]) + 1))


def test_conversation_without_rows_and_empty_table(spark):
    gone = next(k for k in range(10_000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = [(0, "x.", gone, "user", None, None, None)]
    assert [tuple(r) for r in conv.repair(conv.damaged(spark.createDataFrame(rows, SCHEMA))).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert conv.repair(conv.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_rules_are_pairs_of_what_is_there(spark):
    table = spark.createDataFrame([("uaua",), ("uaua",), ("suaua",), ("ddd",)], "sequence string")
    rules = conv.learn_rules(table)
    assert rules[0] == "ua" and all(len(r) == 2 for r in rules)
    assert len(conv.encode("uauauaua", rules)) < 8
    assert conv.learn_rules(table, most=1) == ["ua"]


def test_ropes_compare_as_strings():
    rng = random.Random(2)
    ropes = [conv.Rope(c) for c in "DIKR"] + [conv.Rope()]
    for _ in range(300):
        ropes.append(rng.choice(ropes) + rng.choice(ropes))
        if ropes[-1].size > 300:
            ropes.pop()
    for _ in range(3000):
        a, b = rng.choice(ropes), rng.choice(ropes)
        assert (a < b) == (str(a) < str(b)) and a.size == len(str(a))
