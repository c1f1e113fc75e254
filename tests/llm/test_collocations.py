"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from chanweave.llm import collocations as col

SCHEMA = "rank string, text string, lang string, phrase string, n long, f long, w string"


def texts(seed=0, n=120):
    rng = random.Random(seed)
    words = ["New", "york", "Çité", "is", "big", "the", "a", "É", "\x1cq", "x\xa0y"]
    out = []
    for _ in range(n):
        lang = rng.choice(["en", "fr", None])
        line = " ".join(rng.choice(words[: rng.randrange(2, 10)]) for _ in range(rng.randrange(1, 30)))
        out.append((re.sub(" big", rng.choice([" big.", ", big", "\tbig", "  big\n"]), line), lang))
    out += [(None, "en"), ("", "fr"), (" \n.;", None), ("new york is big " * 400, "de"), ("z" * 3000 + " z", "de"), ("only three words", "es")]
    return out + out[:5]


def plain(rows, least, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 5):
                counts[lang].update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[k : k + len(p)] == p for k in range(len(q) - len(p) + 1)) for q, b in candidates.items()):
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("size, mass, top", [(col.CHUNK, col.PARTITION_MASS, 2000), (64, 500, 5)])
def test_against_plain_counting(spark, monkeypatch, size, mass, top):
    monkeypatch.setattr(col.frequent, "__defaults__", (*col.frequent.__defaults__[:-1], mass))
    rows = texts()
    table = spark.createDataFrame([("r", t, lang, "p", 1, 2, "w") for t, lang in rows], SCHEMA).repartition(3)
    found = sorted(tuple(r) for r in col.collocations(table, least=5, top=top, size=size).collect())
    assert found == plain(rows, 5, top)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert col.collocations(empty).collect() == []
    blank = spark.createDataFrame([("r", t, None, "p", 1, 2, "w") for t in ("", None, "...")], SCHEMA)
    assert col.collocations(blank, least=1).collect() == []


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(0)
    for least in (3, 10, 30):
        parts = [np.unique(np.minimum(rng.geometric(0.002, 3000), 5000).astype(np.uint32), return_counts=True) for _ in range(8)]
        whole = Counter()
        for keys, counts in parts:
            whole.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        summary = col.summarise([k for k, _ in parts], [c for _, c in parts], least)
        assert len(summary.keys) <= summary.capacity and summary.error * col.SLACK <= least
        held = dict(zip(summary.keys.tolist(), summary.counts.tolist(), strict=True))
        assert all(held.get(k, 0) <= n <= held.get(k, 0) + summary.error for k, n in whole.items())
        assert {k for k, n in whole.items() if n >= least} <= set(summary.possible(least).tolist())
        halves = [col.summarise([k for k, _ in half], [c for _, c in half], least) for half in (parts[:4], parts[4:])]
        merged = halves[0]
        merged.capacity = summary.capacity
        merged.merge(halves[1].keys, halves[1].counts, halves[1].error)
        assert {k for k, n in whole.items() if n >= least} <= set(merged.possible(least).tolist())


def test_words_with_equal_hashes_are_told_apart(monkeypatch):
    chunk = col.Chunk("en", b"aa bb aa cc. Aa bb, aa\tbb")
    monkeypatch.setattr(col.Chunk, "word_hashes", lambda self: np.full(len(self), 7, dtype=np.uint64))
    number, words = chunk.words()
    assert [words[k] for k in number] == [b"aa", b"bb", b"aa", b"cc", b"aa", b"bb", b"aa", b"bb"]
    found = Counter()
    for phrases, counts in chunk.counted(lambda h: np.ones(len(h), bool)):
        found.update(dict(zip(phrases, counts.tolist(), strict=True)))
    assert found == {"aa": 4, "bb": 3, "cc": 1, "aa bb": 3, "bb aa": 1, "aa cc": 1, "aa bb aa": 1, "bb aa cc": 1, "aa bb aa cc": 1}


def test_long_texts_are_counted_once():
    rng = random.Random(4)
    text = "".join(rng.choice(["a ", "bb ", "c. ", "\n", "dd\t", "e" * 40 + " "]) for _ in range(300))
    whole, parts = Counter(), Counter()
    for out, size in ((whole, 1 << 20), (parts, 37)):
        for chunk in col.chunks(iter([("en", text)]), size):
            for phrases, counts in chunk.counted(lambda h: np.ones(len(h), bool)):
                out.update(dict(zip(phrases, counts.tolist(), strict=True)))
    assert whole == parts


def test_planes_and_filter():
    x = np.array([0, 1, 255, 256, 70000, 2**32 - 1])
    assert (col.from_planes(col.planes(x)) == x).all()
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 1000, dtype=np.uint64) * np.uint64(2)
    marks = np.zeros((3, 64), bool)
    for s in col.slot(hashes[:20], 3):
        marks[int(s) >> 32, (int(s) & 0xFFFFFFFF) * 64 >> 32] = True
    wanted = col.tester(b"".join(np.packbits(m).tobytes() for m in marks), 64, 3)
    assert wanted(hashes[:20]).all() and not wanted(hashes[20:]).all()


def test_word_hashes_do_not_depend_on_places(monkeypatch):
    monkeypatch.setattr(col, "BLOCK", 8)
    monkeypatch.setattr(col, "_POWERS", {})
    chunk = col.Chunk("en", b"a bb a abcdefghijklmnopqrstuvw bb, a abcdefghijklmnopqrstuvw  a\nbb")
    raw, of = chunk.data.tobytes(), {}
    for a, b, h in zip(chunk.start, chunk.end, chunk.word_hashes().tolist(), strict=True):
        assert of.setdefault(raw[a:b], h) == h
    assert len(set(of.values())) == len(of) == 3
    assert set(of.values()).isdisjoint(col.Chunk("fr", b"a bb").word_hashes().tolist())
