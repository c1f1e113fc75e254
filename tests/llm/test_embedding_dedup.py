"""Epsilon grid order join against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chanweave.llm import embedding_dedup as dedup

SCHEMA = "label int, vec_id long, embedding array<{}>, number long, block long, vec string"


def brute(rows, cosine):
    """Links by vec_id over rows (id, vector); rows that repeat both count once."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    nodes = list({(i, x.tobytes()): (i, x) for i, x in good}.values())
    links = {}
    for i, x in nodes:
        x = x / np.abs(x).max()
        links[i, (x * 1).tobytes()] = []
    near = []
    for a, (_, x) in enumerate(nodes):
        for b, (_, y) in enumerate(nodes):
            if a != b and len(x) == len(y):
                p, q = x / np.abs(x).max(), y / np.abs(y).max()
                if p @ q / np.sqrt((p @ p) * (q @ q)) >= cosine:
                    near.append((a, b))
    top = list(range(len(nodes)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for a, b in near:
        top[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (i, _) in enumerate(nodes):
        least[find(k)] = min(least.get(find(k), i), i)
    at = {(i, x.tobytes()): k for k, (i, x) in enumerate(nodes)}
    out = []
    for i, v in rows:
        key = (i, np.array(v, float).tobytes()) if v and None not in v else None
        if key in at:
            k = at[key]
            out.append((i, sum(a == k for a, _ in near), least[find(k)], least[find(k)] == i))
        else:
            out.append((i, 0, i, True))
    return sorted(out, key=repr)


def vectors(seed=0):
    rng = np.random.default_rng(seed)
    rows = [(k, rng.normal(size=6).astype(np.float32).tolist()) for k in range(150)]
    base = rng.normal(size=6)
    rows += [(200 + k, (base + rng.normal(size=6) * 0.3).astype(np.float32).tolist()) for k in range(60)]
    rows += [(300 + k, rows[5][1]) for k in range(40)] + [rows[5], rows[5], (299, (np.array(rows[5][1], np.float32) * 2).tolist())]
    rows += [(400, None), (401, []), (402, [0.0] * 6), (403, [1.0, None, 0, 0, 0, 0]), (404, [float("nan")] + [1.0] * 5), (405, [float("inf")] + [1.0] * 5)]
    rows += [(406, [1.0, 2.0]), (407, [1.0, 2.1]), (None, rows[5][1]), (408, [-0.0, 0.0, 1.0, 0, 0, 0]), (409, [0.0, -0.0, 1.0, 0, 0, 0])]
    return [(i, v and [None if x is None else float(x) for x in v]) for i, v in rows]


@pytest.mark.parametrize("kind, bits", [("float", 12), ("double", 4)])
def test_against_all_pairs(spark, monkeypatch, kind, bits):
    monkeypatch.setattr(dedup, "BLOCK_BITS", bits)
    monkeypatch.setattr(dedup, "FANOUT_BITS", 2)
    rows = vectors()
    if kind == "double":
        rows += [(500, [1e200] * 6), (501, [1e-200] * 6), (502, [1e200, 1.1e200, 1e200, 1e200, 1e200, 1e200])]
    table = spark.createDataFrame([(1, i, v, 1, 2, "x") for i, v in rows], SCHEMA.format(kind)).repartition(4)
    found = sorted((tuple(r) for r in dedup.near_duplicates(table).collect()), key=repr)
    assert found == brute(rows, dedup.COSINE)


def test_empty_table(spark):
    assert dedup.near_duplicates(spark.createDataFrame([], SCHEMA.format("float"))).collect() == []
    nothing = spark.createDataFrame([(1, 7, None, None, None, None)], SCHEMA.format("float"))
    assert [tuple(r) for r in dedup.near_duplicates(nothing).collect()] == [(7, 0, 7, True)]


def test_distant_intervals_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK_BITS", 4)
    rng = np.random.default_rng(1)
    middles = np.eye(8)
    x = np.concatenate([m + rng.normal(size=(64, 8)) * 0.02 for m in middles])
    x = dedup.unit(x)
    planes, eps = dedup.fit_axes({8: x}, 8), dedup.epsilon(0.9)
    coords = dedup.coordinates(x, planes, 8)
    order = np.lexsort(np.floor(coords[:, :8] / eps).T[::-1])
    rows = spark.createDataFrame([(int(k) >> 4, coords[i].tolist()) for k, i in enumerate(order)], "block long, coords array<double>")
    pairs = {tuple(r) for r in dedup._interval_pairs(rows, len(x), eps, 8).collect()}
    apart = dedup.apart(*[np.array([f(coords[order][k : k + 16], axis=0) for k in range(0, len(x), 16)]) for f in (np.min, np.max)] * 2)
    wanted = {(a, b) for a, b in np.argwhere(apart <= eps * eps + dedup.BOX_MARGIN).tolist() if a <= b}
    assert pairs == wanted and len(pairs) < 32 * 33 // 2 / 3


def test_compare_counts_and_joins(monkeypatch):
    monkeypatch.setattr(dedup, "LEAF", 16)
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(100, 4)), rng.normal(size=(70, 4))
    nx, ny = rng.integers(1, 4, 100), rng.integers(1, 4, 70)
    planes = dedup.fit_axes({4: dedup.unit(x)}, 3)
    u, v = dedup.unit(x), dedup.unit(y)
    across, within = u @ v.T >= 0.9, u @ u.T >= 0.9
    np.fill_diagonal(within, False)
    found, links = dedup.compare(x, y, nx, ny, planes, 3, 0.9)
    assert (found == np.concatenate([across @ ny, across.T @ nx])).all() and all(across[a, b - 100] if a < 100 else across[b, a - 100] for a, b in links)
    found, links = dedup.compare(x, None, nx, nx, planes, 3, 0.9)
    assert (found == within @ nx).all() and all(within[a, b] for a, b in links)


def test_labels_do_not_matter(spark):
    rows = [(k, v) for k, v in vectors(5)[:80]]
    one = spark.createDataFrame([(1, i, v, 1, 1, "") for i, v in rows], SCHEMA.format("float"))
    two = one.withColumn("label", F.col("vec_id").cast("int"))
    assert sorted(map(tuple, dedup.near_duplicates(one).collect())) == sorted(map(tuple, dedup.near_duplicates(two).collect()))
