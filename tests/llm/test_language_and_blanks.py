"""Language inference against plain loops; noise; long runs of blanks in every operator that strips or tokenises."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chanweave.llm import langid, line_dedup, packing

from .fixtures import SCHEMA, documents, sentence


def plain_em(counts, likelihood, shares, steps):
    n = max(1, sum(counts))
    for _ in range(steps):
        new = [0.0] * len(shares)
        for c, row in zip(counts, likelihood, strict=True):
            if c:
                whole = sum(s * p for s, p in zip(shares, row, strict=True))
                for k, (s, p) in enumerate(zip(shares, row, strict=True)):
                    new[k] += c * s * p / whole / n
        shares = [x / sum(new) for x in new]
    value = sum(c * math.log(sum(s * p for s, p in zip(shares, row, strict=True))) for c, row in zip(counts, likelihood, strict=True) if c)
    return shares, value


def plain_infer(counts, likelihood, most=4, steps=8):
    """Nested language sets, each with its likelihood less log(n) / 2 for each further language."""
    languages = len(likelihood[0])
    if not sum(counts):
        return [1 / languages] * languages
    penalty = 0.5 * math.log(sum(counts) / 3 + 1)
    full, _ = plain_em(counts, likelihood, [1 / languages] * languages, steps)
    order = sorted(range(languages), key=lambda k: (-full[k], k))
    alone = [sum(c * math.log(row[k]) for c, row in zip(counts, likelihood, strict=True) if c) / 3 for k in range(languages)]
    best = max(range(languages), key=lambda k: alone[k])
    chosen, score = [float(k == best) for k in range(languages)], alone[best]
    for k in range(2, min(most, languages) + 1):
        start = [max(full[x], 1e-6) if x in order[:k] else 0.0 for x in range(languages)]
        shares, value = plain_em(counts, likelihood, [x / sum(start) for x in start], steps)
        value = value / 3 - (k - 1) * penalty
        if value <= score:
            break
        chosen, score = shares, value
    return chosen


def test_inference_equals_plain_loops(spark):
    docs = documents(spark)
    model = langid.train(docs)
    rng = random.Random(3)
    texts = [r.text for r in docs.where("length(text) BETWEEN 1 AND 5000").collect()]
    texts += [sentence(rng, "en", 60) + " " + sentence(rng, "fr", 40), " ".join(sentence(rng, x, 50) for x in ("en", "fr", "de")), "qqq", "?"]
    place = {int(c): k for k, c in enumerate(model.trigrams)}
    likelihood = model.likelihood.astype(float).tolist()
    counts = np.zeros((len(texts), len(place)), dtype=np.float32)
    for k, t in enumerate(texts):
        for c in langid.trigram_codes([t])[1]:
            if int(c) in place:
                counts[k, place[int(c)]] += 1
    got = langid.infer(counts, model.likelihood)
    for row, c in zip(got, counts.tolist(), strict=True):
        want = plain_infer(c, likelihood)
        assert np.allclose(row, want, atol=2e-3) and int(row.argmax()) == max(range(len(want)), key=lambda k: (want[k], -k))
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    answers = {r.doc_id: r for r in langid.predict(rows, model, ["doc_id"]).collect()}
    for k, (t, c) in enumerate(zip(texts, counts.tolist(), strict=True)):
        want = plain_infer(c, likelihood)
        assert answers[k].lang_pred == (model.languages[int(np.argmax(want))] if langid.has_letter(t) else "und")


def test_noise_goes_and_languages_are_filled_in(spark):
    rng = random.Random(5)
    noise = " ".join("".join(rng.choice("qxzjkvwq") for _ in range(7)) for _ in range(60))
    mixed = " ".join(sentence(rng, x, 50) for x in ("en", "fr", "de"))
    extra = [(900, noise, None, "src0", 1, None, None, None), (901, mixed, None, "src0", 1, None, None, None), (902, sentence(rng, "de", 80), None, "src0", 1, None, None, None)]
    extra += [(903, "qx zj", None, "src0", 1, None, None, None)]  # too short to tell
    kept = {r.doc_id: r for r in langid.keep_known(documents(spark, extra=extra)).collect()}
    assert 900 not in kept and {901, 902, 903} <= set(kept)
    assert kept[902].lang == "de" and kept[901].lang in ("en", "fr", "de") and all(r.lang for r in kept.values())
    assert langid.is_noise(np.array([0, 0, 40]), np.array([6, 300, 60]), 0.5).tolist() == [False, True, False]


@pytest.fixture(scope="module")
def blanks():
    return " " * 2_000_000


def test_long_blanks_cost_linear_time(spark, blanks):
    texts = [f"a{blanks}b", f"{blanks}a", f"a{blanks}", f"x\n{blanks}", " \t" * 100_000 + "z"]
    rows = [(k, t, "en", "s", len(t), None, None, None) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    began = time.time()
    found = {r.doc_id: r for r in line_dedup.mark(docs, runs="runs", clean="clean").collect()}
    assert {k: found[k].clean for k in found} == dict(enumerate(texts))
    kept = {r.doc_id for r in corpus_pipeline.dedup_lines(spark, docs, "").collect()}
    assert kept == set(range(5))
    assert time.time() - began < 60


def test_packing_measures_runs_once():
    short, long = ("a" + " " * 19_999) * 50, "a" + " " * 20_000
    began = time.time()
    assert not packing.Encoder.long_blank(short) and packing.Encoder.long_blank(long) and not packing.Encoder.long_blank("a b" * 10_000)
    assert time.time() - began < 2


def test_documents_with_nothing_left_go(spark):
    line = " ".join(f"w{k}" for k in range(60))
    rows = [(1, line, "en", "s", 1, None, None, None), (2, f"\n\n{line}\n ", "en", "s", 1, None, None, None), (3, " ", "en", "s", 1, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert [r.doc_id for r in corpus_pipeline.dedup_lines(spark, docs, "").orderBy("doc_id").collect()] == [1]
    assert docs.where(F.col("text").rlike(r"(?U)\S")).count() == 2
