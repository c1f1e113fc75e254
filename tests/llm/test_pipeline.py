"""The pipeline against a plain version of its stages, and the registered queries."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from chanweave.llm import langid, queries

from .fixtures import documents, sentence
from .test_operators import plain_components, plain_line_dedup


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    documents(spark, n=40).drop("score", "key", "row").write.parquet(f"{path}/documents.parquet")
    return str(path)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def key(r):
    return tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars"))


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    first, second, third, fourth, last = (f for _, f in corpus_pipeline.STAGES)

    kept = first(spark, docs, sf_dir).cache()
    assert kept.columns == docs.columns
    given = Counter(key(r | {"lang": None}) for r in rows_of(docs))
    gone = given - Counter(key(r | {"lang": None}) for r in rows_of(kept))
    known = {key(r) for r in rows_of(docs) if r["lang"]}
    assert all(r["lang"] for r in rows_of(kept)) and {key(r) for r in rows_of(kept)} >= {k for k in known if k[0] not in (301, 302, 303, 304)}
    assert {k[0] for k in gone} <= {300, 301, 302, 303, 304} and {k[0] for k in gone} >= {300, 301, 302, 303}

    lines = second(spark, kept, sf_dir).cache()
    deleted = plain_line_dedup(rows_of(kept), 50)
    want = Counter()
    for r in rows_of(kept):
        cut = deleted.get((-1 if r["doc_id"] is None else r["doc_id"], r["text"]), ())
        text = "\n".join(x for k, x in enumerate(r["text"].split("\n")) if k not in cut)
        if text.strip():
            want[(r["doc_id"], text, r["lang"], r["source"], len(text))] += 1
    assert Counter(map(key, rows_of(lines))) == want and lines.columns == docs.columns

    one = third(spark, lines, sf_dir).cache()
    groups = {g for i, n, g in plain_components(rows_of(lines), 5, 80)}
    assert {r["doc_id"] for r in rows_of(one)} == groups and one.columns == docs.columns
    assert set(map(key, rows_of(one))) <= set(map(key, rows_of(lines)))

    mixed = fourth(spark, one, sf_dir).cache()
    assert mixed.columns == docs.columns and set(map(key, rows_of(mixed))) <= set(map(key, rows_of(one)))
    assert max(Counter(map(key, rows_of(mixed))).values()) <= 3

    pieces = last(spark, mixed, sf_dir)
    assert sum(r.length for r in pieces.collect()) == sum(r.doc_tokens for r in pieces.collect() if r.start == 0)


def test_language_stage_keeps_mixed_documents(spark, sf_dir):
    rng = random.Random(7)
    three = "\n".join(sentence(rng, lang, 100) for lang in ("en", "fr", "de"))
    mixed = [(900, three, "en", "src1", len(three)), (901, "zzz qqq", None, "src1", 7), (902, "12345 !!", None, "src1", 8)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(mixed, docs.schema))
    score = langid.predict(docs.where("doc_id = 900"), langid.train(docs), ["doc_id"]).first().score
    assert score < 0.5
    kept = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, sf_dir).collect()}
    assert {900, 901} <= kept and 902 not in kept


def test_run_and_empty(spark, sf_dir, tmp_path):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
