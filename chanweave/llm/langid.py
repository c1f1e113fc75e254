"""Language identification by inference of a multilingual mixture.

A document is a bag of byte trigrams of its folded letters, drawn from a mixture of languages. Expectation-maximisation
estimates the document's language proportions from the languages' trigram likelihoods. Language sets are nested (the
best one, two, ... languages of the full mixture), each is fitted again, and the set with the highest likelihood less a
penalty of log(n) / 2 for each further language is selected. The answer is the largest share of that set.
Two documented bounds of `infer`: a set has at most `most` (4) languages, and each fit makes `steps` (8) EM steps; both
hold for every document alike.

Training counts trigrams in Spark over a bounded sample of labelled documents: the `per_language` texts of each language
with the smallest hashes of the text (a documented bound, equal at every size), copies once; a filter on the hash thins
them before any shuffle. The model is a table of `vocabulary` trigrams by languages. Prediction is one narrow pass in
numpy batches: the trigram counts of a block of documents are a matrix, and an EM step is two products of matrices.

Defined cases: null text and text without a letter give `und` with score 0; a letter but no known trigram gives equal
shares (ties go to the first language by name); a numeral as "½" is no letter; without labelled rows everything is `und`; an empty table gives an empty
result; each row is answered by itself, so repeated rows get equal answers; texts are read whole; other columns pass
through `predict` if named in `keep`, and one named like a result gives way to it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read

#: Letters, and some numerals as "½", which has_letter tells apart.
WORD = re.compile(r"[^\W\d_]")
#: Letters of ASCII and all bytes of longer characters stay, everything else is a blank.
FOLD = np.array([c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)], dtype=np.uint8)
BLOCK_DOCS, BLOCK_CHARS = 256, 1_000_000
UNDETERMINED = "und"
#: A text is noise if its share of known trigrams is, by three standard errors, under this part of the training texts' median.
FLOOR, ERRORS = 0.5, 3


@dataclass
class Model:
    languages: list[str]
    trigrams: np.ndarray  # V codes
    likelihood: np.ndarray  # V x languages, columns sum to 1
    floor: float = 0.0  # least share of known trigrams of a text in some learned language


def trigram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document number, trigram code) of every trigram of all texts; runs of blanks count as one."""
    raw = [f" {t.lower()} ".encode("utf-8", "replace") for t in texts]
    lengths = np.array([len(x) for x in raw])
    data = FOLD[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(raw), dtype=np.int32), lengths)
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32) | (owner[1:] != owner[:-1])
    data, owner = data[keep].astype(np.int32), owner[keep]
    codes = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    inside = owner[:-2] == owner[2:]
    return owner[:-2][inside], codes[inside]


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in WORD.finditer(text))


def train(docs: DataFrame, lang: str = "lang", text: str = "text", per_language: int = 600, vocabulary: int = 3072) -> Model:
    """Model from the rows given; rows without language or text are left out."""
    chance = F.pmod(F.xxhash64(text), F.lit(1 << 30))
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    # About twice the texts wanted pass a narrow filter; the exact choice is then among few. Copies pass or fail together,
    # so the filter is sized by the distinct texts (within some 5 %), not by the rows.
    sizes = known.groupBy(lang).agg(F.approx_count_distinct(chance).alias("texts")).collect()  # one row per language
    limits = F.from_json(F.lit(json.dumps({r[lang]: int(min(1, 2 * per_language / r["texts"]) * (1 << 30)) for r in sizes})), "map<string,bigint>")
    few = known.where(chance < limits[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"), chance.alias("chance")).distinct()
    ranked = few.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("chance", "text")))
    sample = ranked.where(F.col("place") <= per_language).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                codes, n = np.unique(trigram_codes(rows["text"].tolist())[1], return_counts=True)
                yield pd.DataFrame({"lang": lang, "code": codes, "n": n})

    counts = sample.mapInPandas(count, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    shares = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("lang")))
    best = shares.groupBy("code").agg(F.max("share").alias("top"), F.collect_list(F.struct("lang", "n")).alias("by_lang"))
    table = best.orderBy(F.desc("top"), "code").limit(vocabulary).collect()  # vocabulary rows at most
    languages = sorted({x["lang"] for r in table for x in r["by_lang"]})
    number = {x: k for k, x in enumerate(languages)}
    likelihood = np.full((len(table), len(languages)), 0.5)
    for v, r in enumerate(table):
        for x in r["by_lang"]:
            likelihood[v, number[x["lang"]]] += x["n"]
    likelihood /= likelihood.sum(axis=0, keepdims=True) if len(table) else 1
    codes = np.array([r["code"] for r in table], dtype=np.int64)
    learned = np.sort(codes)

    def shares_known(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            owner, found = trigram_codes(batch["text"].tolist())
            known = np.bincount(owner[np.isin(found, learned)], minlength=len(batch)) / np.maximum(1, np.bincount(owner, minlength=len(batch)))
            yield pd.DataFrame({"known": known[np.array([has_letter(t) for t in batch["text"]], dtype=bool)]})

    middle = sample.mapInPandas(shares_known, "known double").agg(F.median("known")).first()[0]
    return Model(languages, codes, likelihood.astype(np.float32), (middle or 0.0) * FLOOR)


def fit(counts: np.ndarray, likelihood: np.ndarray, shares: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """EM from the given shares (a share of 0 stays 0). Gives shares and log likelihoods."""
    n = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    for _ in range(steps):
        shares = shares * ((counts / (shares @ likelihood.T)) @ likelihood) / n
        shares /= np.maximum(shares.sum(axis=1, keepdims=True), 1e-30)
    return shares, np.einsum("dv,dv->d", counts, np.log(shares @ likelihood.T))


def infer(counts: np.ndarray, likelihood: np.ndarray, most: int = 4, steps: int = 8) -> np.ndarray:
    """Shares of the selected language set of each document."""
    docs, languages = len(counts), likelihood.shape[1]
    even = np.full((docs, languages), 1 / languages, dtype=np.float32)
    empty = counts.sum(axis=1) == 0
    if languages == 1:
        return even
    # Trigrams overlap, so three of them count as one observation.
    penalty = 0.5 * np.log(counts.sum(axis=1) / 3 + 1)
    full, _ = fit(counts, likelihood, even, steps)
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
    single = (counts @ np.log(likelihood)) / 3
    first = single.argmax(axis=1)
    chosen = np.eye(languages, dtype=np.float32)[first]
    score = single.max(axis=1)
    open_ = np.arange(docs)
    for k in range(2, min(most, languages) + 1):
        start = np.where(rank[open_] < k, np.maximum(full[open_], 1e-6), 0)
        shares, value = fit(counts[open_], likelihood, (start / start.sum(axis=1, keepdims=True)).astype(np.float32), steps)
        value = value / 3 - (k - 1) * penalty[open_]
        better = value > score[open_]
        chosen[open_[better]], score[open_[better]] = shares[better], value[better]
        open_ = open_[better]
        if not len(open_):
            break
    chosen[empty] = 1 / languages
    return chosen


def is_noise(known: np.ndarray, trigrams: np.ndarray, floor: float) -> np.ndarray:
    """Whether the share of known trigrams is under the floor even at the upper end of its interval (Wilson's).

    Trigrams overlap, so three of them count as one observation.
    """
    n = np.maximum(trigrams, 1) / 3
    share, z = known / np.maximum(trigrams, 1), ERRORS**2 / n
    return (share + z / 2 + np.sqrt(z * share * (1 - share) + z * z / 4)) / (1 + z) < floor


def predict(docs: DataFrame, model: Model, keep: list[str | Column], text: str = "text") -> DataFrame:
    """The columns `keep`, then lang_pred, score, languages (the selected shares, as "en:0.93,fr:0.07") and noise (whether
    so few trigrams are known that no learned language fits; short texts get the benefit of the doubt).

    A column in `keep` with the name of a result gives way to it.
    """
    kept = docs.select(*keep).drop("lang_pred", "score", "languages", "noise").columns
    names, trigrams, likelihood, floor = np.array(model.languages, dtype=object), model.trigrams, model.likelihood, model.floor

    def blocks(texts: list[str]) -> Iterator[list[str]]:
        lo = size = 0
        for k, t in enumerate(texts):
            if k > lo and (k - lo == BLOCK_DOCS or size > BLOCK_CHARS):
                yield texts[lo:k]
                lo, size = k, 0
            size += len(t)
        if lo < len(texts):
            yield texts[lo:]

    # Only the texts go to Python; what is kept stays in the JVM.
    @F.pandas_udf("lang_pred string, score double, languages string, noise boolean")
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        place = np.full(1 << 24, -1, dtype=np.int16)
        place[trigrams] = np.arange(len(trigrams))
        for batch in batches:
            langs, scores, listed, noise = [], [], [], []
            for part in blocks([t or "" for t in batch]):
                letters = [has_letter(t) for t in part]
                if not len(names):
                    letters, shares, odd = [False] * len(part), np.zeros((len(part), 1)), np.zeros(len(part), dtype=bool)
                else:
                    owner, codes = trigram_codes(part)
                    at = place[codes]
                    odd = is_noise(np.bincount(owner[at >= 0], minlength=len(part)), np.bincount(owner, minlength=len(part)), floor)
                    owner, at = owner[at >= 0].astype(np.int64), at[at >= 0]
                    width = len(trigrams)
                    counts = np.bincount(owner * width + at, minlength=len(part) * width).reshape(len(part), width).astype(np.float32)
                    shares = infer(counts, likelihood)
                noise += (odd & np.array(letters, dtype=bool)).tolist()
                for has, row in zip(letters, shares, strict=True):
                    best = int(row.argmax())
                    langs.append(names[best] if has else UNDETERMINED)
                    scores.append(min(1.0, float(row[best])) if has else 0.0)
                    listed.append(",".join(f"{names[k]}:{row[k]:.2f}" for k in np.argsort(-row, kind="stable") if row[k] >= 0.005) if has else "")
            yield pd.DataFrame({"lang_pred": langs, "score": scores, "languages": listed, "noise": noise})

    # A filter on the answer is not pushed below it, which would ask twice.
    answered = answer.asNondeterministic()("__text")
    rows = docs.select(*keep, F.col(text).alias("__text")).withColumn("__answer", answered)
    return rows.select(*[F.col(f"`{c}`") for c in kept], "__answer.*")


def keep_known(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """The rows of `docs` whose language is determined, a null one filled in; trained on their own labels.

    Texts without a letter and noise in letters of no learned language go. The score takes no part: it is the share of
    one language, and a document may well be in several; all of its languages are known, so it stays.
    """
    inner = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    kept = predict(inner, train(docs, lang, text), ["row"]).where((F.col("lang_pred") != UNDETERMINED) & ~F.col("noise"))
    filled = {lang: F.coalesce(F.col("row")[lang], F.col("lang_pred")).alias(lang)}
    return kept.select(*[filled.get(c, F.col("row")[c].alias(c)) for c in docs.columns])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return predict(docs, model, ["doc_id", held_out().alias("held_out")]).drop("noise")
