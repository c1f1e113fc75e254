"""Embedding near-dedup: epsilon grid order join on the cosine of all pairs.

Vectors with cosine >= c are, scaled to length one, at most epsilon = sqrt(2 - 2c) apart, and so are their projections.
Distinct vectors are sorted by the grid cells (side epsilon) of their leading principal coordinates, the epsilon grid order;
`BLOCK` neighbours in that order are a block. Intervals of the order are joined recursively: a pair of intervals survives
unless the bounding boxes of its coordinates (the length of what the projection leaves out is one more coordinate) are
more than epsilon apart, and its parts are tried next, `FANOUT` at a time, each level one join of Spark on the intervals'
numbers. What survives of block pairs is compared in numpy, where blocks are halved down to `LEAF` rows by the same test.
Single precision only rules leaves out, by a margin; links are decided in double precision on the original vectors.

The principal axes come from at most `SAMPLE` vectors (a documented bound). They decide how much is skipped, never what is
found: any axes give true lower bounds, so the join is exact.

A block pair gives at most one count and, for components, a spanning forest: at most two rows a vector, however many links
a group of near copies has. Equal vectors are one node with a number of copies, so a vector that a third of all rows hold
costs one node. Components come from alternating large and small stars over the forests.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without id, link with
nothing; each keeps its row with no links and its own id as component (null ids stay null). Vectors of different lengths
do not link. Rows that repeat id and vector count as one vector, each with a row. An empty table gives an empty result.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import numbered
from .common import cut, read, release
from .jaccard import components

COSINE = 0.9
BLOCK_BITS, LEAF, FANOUT_BITS = 12, 256, 4
SAMPLE, AXES = 4096, 8
SINGLE_MARGIN, BOX_MARGIN = 1e-4, 1e-7
#: Vectors of different lengths lie this far apart in the boxes.
LENGTH_STEP = 16.0


def epsilon(cosine: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)))


def _usable(vec_id: Column, v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vec_id.isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(vectors, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), dtype=kind).reshape(len(vectors), -1).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; very large and very small ones without overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_axes(sample: dict[int, np.ndarray], axes: int) -> dict[int, np.ndarray]:
    """By length of the vectors: the leading principal axes of the sampled ones, as columns."""
    out = {}
    for length, x in sample.items():
        _, _, rows = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
        out[length] = rows[:axes].T
    return out


def coordinates(x: np.ndarray, planes: dict[int, np.ndarray], axes: int) -> np.ndarray:
    """Leading coordinates of unit vectors, the length of the rest, and the place of the vectors' length."""
    own = planes.get(x.shape[1], np.empty((x.shape[1], 0)))
    c = np.zeros((len(x), axes + 2))
    c[:, : own.shape[1]] = x @ own
    c[:, axes] = np.sqrt(np.maximum(0, 1 - (c[:, :axes] ** 2).sum(axis=1)))
    c[:, axes + 1] = LENGTH_STEP * x.shape[1]
    return c


def _by_length(vectors, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the vectors of each length."""
    lengths = np.array([len(v) for v in vectors])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, _matrix([vectors[k] for k in at], kind)


def _located(nodes: DataFrame, planes: dict[int, np.ndarray], kind: str, eps: float, axes: int) -> DataFrame:
    """Adds length, cells and coords."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = batch["vec"].tolist()
            coords, lengths = np.empty((len(vectors), axes + 2)), np.empty(len(vectors), dtype=np.int64)
            for at, x in _by_length(vectors, kind):
                coords[at], lengths[at] = coordinates(unit(x), planes, axes), x.shape[1]
            cells = np.floor(coords[:, :axes] / eps).astype(np.int32)
            yield batch.assign(length=lengths, cells=list(cells), coords=list(coords))

    return nodes.mapInPandas(run, "vec binary, id long, copies long, length long, cells array<int>, coords array<double>")


def apart(low: np.ndarray, high: np.ndarray, low2: np.ndarray, high2: np.ndarray) -> np.ndarray:
    """Squared distances of all boxes to all others."""
    gap = np.maximum(0, np.maximum(low[:, None] - high2[None], low2[None] - high[:, None]))
    return (gap**2).sum(axis=2)


def _interval_pairs(rows: DataFrame, count: int, eps: float, axes: int) -> DataFrame:
    """(a, b), a <= b: pairs of blocks that are not provably distant."""
    spark, width = rows.sparkSession, axes + 2
    ends = [f(F.col("coords")[k]).alias(f"{n}{k}") for k in range(width) for f, n in ((F.min, "low"), (F.max, "high"))]
    boxes = cut(rows.groupBy("block").agg(*ends))
    depth = 0
    while ((count - 1) >> BLOCK_BITS) >> (FANOUT_BITS * depth) > 0:
        depth += 1
    pairs = spark.range(1 if count else 0).select(F.col("id").alias("a"), F.col("id").alias("b"))
    for level in range(depth - 1, -1, -1):
        key = F.shiftright("block", FANOUT_BITS * level)
        merged = [f(f"{n}{k}").alias(f"{n}{k}") for k in range(width) for f, n in ((F.min, "low"), (F.max, "high"))]
        parts = boxes.groupBy(key.alias("part")).agg(*merged)
        side = lambda s: parts.select(F.col("part").alias(f"{s}_part"), F.shiftright("part", FANOUT_BITS).alias(s), *[F.col(f"{n}{k}").alias(f"{s}_{n}{k}") for k in range(width) for n in ("low", "high")])  # noqa: B023, E731
        gap = lambda k: F.greatest(F.lit(0.0), F.col(f"a_low{k}") - F.col(f"b_high{k}"), F.col(f"b_low{k}") - F.col(f"a_high{k}"))
        distance = sum((gap(k) * gap(k) for k in range(1, width)), gap(0) * gap(0))
        tried = pairs.join(side("a"), "a").join(side("b"), "b").where("a_part <= b_part").where(distance <= eps * eps + BOX_MARGIN)
        pairs = tried.select(F.col("a_part").alias("a"), F.col("b_part").alias("b"))
    return pairs


class _Forest:
    """Which rows of a block pair are linked so far, and the links that first joined them."""

    def __init__(self, rows: int):
        self.label, self.links = np.arange(rows), []

    def join(self, row: int, others: np.ndarray) -> None:
        labels, first = np.unique(self.label[others], return_index=True)
        new = labels != self.label[row]
        if new.any():
            self.links += [(row, int(x)) for x in others[first[new]]]
            self.label[np.isin(self.label, labels[new])] = self.label[row]


def compare(x: np.ndarray, y: np.ndarray | None, x_copies: np.ndarray, y_copies: np.ndarray, planes: dict, axes: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of the rows of x among themselves (y is None), or with those of y: for each row of both, the copies it links
    with, and a spanning forest as pairs of row numbers, y's after x's."""
    limit = epsilon(cosine) ** 2 + BOX_MARGIN
    sides = [x] if y is None else [x, y]
    units = [unit(v) for v in sides]
    singles = [u.astype(np.float32) for u in units]
    lengths = [np.sqrt((v * v).sum(axis=1)) for v in sides]
    boxes = []
    for u in units:
        c = coordinates(u, planes, axes)
        starts = range(0, len(u), LEAF)
        boxes.append((np.array([c[k : k + LEAF].min(axis=0) for k in starts]), np.array([c[k : k + LEAF].max(axis=0) for k in starts])))
    other, shift = len(sides) - 1, 0 if y is None else len(x)
    copies = [x_copies, x_copies if y is None else y_copies]
    found, forest = np.zeros(sum(map(len, sides)), dtype=np.int64), _Forest(sum(map(len, sides)))
    near = apart(*boxes[0], *boxes[other]) <= limit
    if y is None:
        near = np.triu(near)
    overflow = not all(np.isfinite(n).all() and (n > 1e-150).all() for n in lengths)
    for i, j in np.argwhere(near):
        a, b = (slice(k * LEAF, min((k + 1) * LEAF, len(side))) for k, side in ((i, x), (j, sides[other])))
        if (singles[0][a] @ singles[other][b].T).max() < cosine - SINGLE_MARGIN:
            continue
        if overflow:
            hit = units[0][a] @ units[other][b].T >= cosine
        else:
            hit = (sides[0][a] @ sides[other][b].T) / (lengths[0][a][:, None] * lengths[other][b][None, :]) >= cosine
        within = y is None and i == j
        if within:
            np.fill_diagonal(hit, False)
            hit |= hit.T
        rows = np.flatnonzero(hit.any(axis=1))
        if not len(rows):
            continue
        found[a] += hit @ copies[1][b]
        if not within:
            found[shift + b.start : shift + b.start + hit.shape[1]] += hit.T @ copies[0][a]
        for r in rows:
            forest.join(int(a.start + r), shift + b.start + np.flatnonzero(hit[r]))
    return found, np.array(forest.links, dtype=np.int64).reshape(-1, 2)


def _compared(rows: DataFrame, pairs: DataFrame, planes: dict[int, np.ndarray], kind: str, axes: int, cosine: float) -> DataFrame:
    """(x, y, n): y null: node x links with n vectors in a pair of blocks; else a link between nodes x and y."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("number")
        out, blocks = [], group["block"].to_numpy()
        sides = []  # numbers, matrix, copies: by block and length, in order
        for block in np.unique(blocks):
            own = group[blocks == block]
            sides.append([(own["number"].to_numpy()[at], x, own["copies"].to_numpy()[at]) for at, x in _by_length(own["vec"].tolist(), kind)])
        tried = [(p, None) for p in sides[0]] if len(sides) == 1 else [(p, q) for p in sides[0] for q in sides[1] if p[1].shape[1] == q[1].shape[1]]
        for p, q in tried:
            found, links = compare(p[1], q and q[1], p[2], q and q[2], planes, axes, cosine)
            numbers = p[0] if q is None else np.concatenate([p[0], q[0]])
            some = found > 0
            out.append(pd.DataFrame({"x": numbers[some], "y": pd.array([None] * int(some.sum()), dtype="Int64"), "n": found[some]}))
            out.append(pd.DataFrame({"x": numbers[links[:, 0]], "y": pd.array(numbers[links[:, 1]], dtype="Int64"), "n": np.ones(len(links), np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"x": [], "y": [], "n": []}).astype("int64")

    sided = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    met = sided.join(rows.select("block", "number", "vec", "copies"), "block")
    return met.groupBy("a", "b").applyInPandas(run, "x long, y long, n long")


def near_duplicates(rows: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", vector: str = "embedding", axes: int = AXES) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of the table."""
    single = dict(rows.dtypes)[vector] == "array<float>"
    kind = "<f4" if single else "<f8"

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"vec_id": batch["vec_id"], "vec": [(np.asarray(v, dtype=kind) + 0.0).astype(kind).tobytes() for v in batch["v"]]})

    named = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("v"))
    good = _usable(F.col("vec_id"), F.col("v"))
    usable = named.where(good).mapInPandas(pack, "vec_id long, vec binary")
    alone = named.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    once = usable.groupBy("vec").agg(F.min("vec_id").alias("id"), F.count_distinct("vec_id").alias("copies"))
    nodes = cut(once)

    sampled: dict[int, list[bytes]] = {}
    for r in nodes.orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).select("vec").collect():
        sampled.setdefault(len(r["vec"]), []).append(r["vec"])
    planes = fit_axes({len(v[0]) // np.dtype(kind).itemsize: unit(_matrix(v, kind)) for v in sampled.values()}, axes)

    eps = epsilon(cosine)
    placed = numbered(_located(nodes, planes, kind, eps, axes), "length", "cells", F.xxhash64("vec"), "id")
    blocks = placed.withColumn("block", F.shiftright(F.col("number") - 1, BLOCK_BITS))
    count = nodes.count()
    pairs = cut(_interval_pairs(blocks, count, eps, axes))
    found = cut(_compared(blocks, pairs, planes, kind, axes, cosine))
    totals = found.where("y IS NULL").groupBy(F.col("x").alias("number")).agg(F.sum("n").alias("links"))
    joined = components(found.where("y IS NOT NULL").select(F.col("x").alias("a"), F.col("y").alias("b"))).withColumnRenamed("id", "number")
    known = cut(placed.select("number", "vec", "id", "copies").join(totals, "number", "left").join(joined, "number", "left"))
    least = known.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
    known = known.join(least, "component", "left").select("vec", F.coalesce("least", "id").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = usable.join(known, "vec").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    release(nodes)
    return linked.unionByName(alone)


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
n AS (SELECT vec_id, x, sqrt(list_dot_product(x, x)) AS n FROM v),
e AS (SELECT p.vec_id AS a, q.vec_id AS b FROM n p JOIN n q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x) WHERE list_dot_product(p.x, q.x) >= 0.9 * p.n * q.n),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT m.vec_id, (SELECT count(*) FROM e WHERE e.a = m.vec_id) AS n_links, min(r.b) AS component_id, min(r.b) = m.vec_id AS kept
FROM embeddings m JOIN r ON r.a = m.vec_id GROUP BY m.vec_id
"""
