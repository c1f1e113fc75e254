"""Approximate nearest neighbours: NN-descent graph and greedy graph search.

Equal vectors are one node (named by their least id), so a vector shared by a third of all rows costs one node. The
first graph comes from random-projection leaves: hyperplane trees fitted on a bounded sample (`SAMPLE` rows, a documented
bound) send every row to a leaf, and rows of a leaf, in chunks of bounded size, are compared. NN-descent then joins
neighbours of neighbours: every node's list, forward and sampled reverse, meets with the vectors attached, new pairs are
compared in a numpy block, and only pairs that improve one of the two lists are sent on. Lists without a new entry stay
out before vectors are attached, so later rounds move little. Rounds end when at most `STOP` of all entries are new; there
is no bound on their number. The reverse sample bounds what a hub collects; sampling is part of the method, and every row
is in the graph. The graph is built from vectors in single precision; scores come from the original ones.

Queries are searched together. Each hop expands the nearest unexpanded nodes of each query's beam by one join with the
graph and one with the vectors, and stops when no beam has an unexpanded node. The frontier is broadcast only while its
bound (queries * nodes a hop * bytes) is under `BROADCAST_BYTES`; beyond it Spark shuffles. Scores are Euclidean
distances in double precision on the original vectors.

Defined cases: null, zero, empty and non-finite vectors, vectors with a null component, and vectors whose length is not
the table's commonest take no part, as query or candidate; null ids take no part; rows that repeat id and vector count
once; ties go to the smaller id; with fewer candidates than asked for, all are returned; an empty table gives an empty
result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, delete, read, shared_folder

SAMPLE, LEAF, TREES = 4096, 256, 8
DEGREE, REVERSE, STOP = 32, 32, 0.02
BEAM, A_HOP = 160, 64
BROADCAST_BYTES = 32 << 20
SINGLE, DOUBLE = "<f4", "<f8"


def _stored(df: DataFrame) -> DataFrame:
    """Written once and read again: rounds and hops start from what the last one left, and compute nothing twice."""
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, "ann")
    df.write.parquet(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out.folder = folder
    return out


def _forget(df: DataFrame) -> None:
    """Delete what `_stored` wrote, when nothing reads it any more."""
    delete(df.sparkSession, df.folder)


def _usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = rows.where(F.col(vec_id).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0))
    good = good.select(F.col(vec_id).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
    length = good.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").first()
    return good.where(F.size("v") == (length["n"] if length else 0))


def _packed(rows: DataFrame, kind: str) -> DataFrame:
    """(vec_id, vec): components as bytes, in the column's own precision."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"vec_id": batch["vec_id"], "vec": [(np.asarray(x, dtype=kind) + 0.0).astype(kind).tobytes() for x in batch["v"]]})

    return rows.mapInPandas(run, "vec_id long, vec binary")


def _matrix(vectors, kind: str = DOUBLE) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), dtype=kind).reshape(len(vectors), -1).astype(np.float64) if len(vectors) else np.empty((0, 0))


def _narrow(nodes: DataFrame, kind: str) -> DataFrame:
    """(id, vec) in single precision, divided by the table's largest component, so that no value overflows."""

    def largest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [np.abs(_matrix(batch["vec"].tolist(), kind)).max(initial=0.0)]})

    most = nodes.mapInPandas(largest, "x double").agg(F.max("x")).first()[0] or 1.0

    def narrow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = (_matrix(batch["vec"].tolist(), kind) / most).astype(SINGLE)
            yield pd.DataFrame({"id": batch["id"], "vec": [row.tobytes() for row in x]})

    return nodes.mapInPandas(narrow, "id long, vec binary")


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y, taken about x's mean to keep digits."""
    middle = x.mean(axis=0)
    x, y = x - middle, y - middle
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T), 0)


def _fit_trees(sample: np.ndarray, depth: int, trees: int, seed: int = 0) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """For each tree, by level: the hyperplane of the level's nodes and their thresholds (medians of the sample)."""
    rng, found = np.random.default_rng(seed), []
    for _ in range(trees):
        levels, at = [], np.zeros(len(sample), dtype=np.int64)
        for level in range(depth):
            plane = rng.normal(size=sample.shape[1])
            if len(sample) > 1:  # between two sampled rows, so that it follows the data
                i, j = rng.choice(len(sample), 2, replace=False)
                plane = plane * 0.05 * np.linalg.norm(sample[i] - sample[j]) / np.sqrt(len(plane)) + sample[i] - sample[j]
            value, cuts = sample @ plane, np.empty(1 << level)
            overall = float(np.median(value))
            for node in range(1 << level):
                own = value[at == node]
                cuts[node] = np.median(own) if len(own) else overall
            levels.append((plane, cuts))
            at = at * 2 + (value > cuts[at])
        found.append(levels)
    return found


def _first_graph(nodes: DataFrame, count: int, degree: int, trees: int) -> DataFrame:
    """(u, v, d): for each node the nearest rows of its leaves."""
    depth = max(0, int(np.ceil(np.log2(max(1, count) / LEAF))))
    sample = nodes.orderBy(F.xxhash64("id")).limit(SAMPLE).select("vec").collect()
    planes = _fit_trees(_matrix([r["vec"] for r in sample], SINGLE), depth, trees if depth else 1)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch["vec"].tolist(), SINGLE)
            for tree, levels in enumerate(planes):
                at = np.zeros(len(x), dtype=np.int64)
                for plane, cuts in levels:
                    at = at * 2 + (x @ plane > cuts[at])
                yield pd.DataFrame({"tree": np.int32(tree), "leaf": at, "id": batch["id"], "vec": batch["vec"]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, vectors in zip(batch["ids"], batch["vecs"], strict=True):
                ids, x = np.asarray(ids), _matrix(list(vectors), SINGLE)
                d = squared(x, x)
                np.fill_diagonal(d, np.inf)
                k = min(degree, len(ids) - 1)
                if k:
                    near = np.argpartition(d, k - 1, axis=1)[:, :k]
                    yield pd.DataFrame({"u": np.repeat(ids, k), "v": ids[near].ravel(), "d": np.take_along_axis(d, near, 1).ravel()})

    rows = nodes.mapInPandas(assign, "tree int, leaf long, id long, vec binary")
    sizes = rows.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n"))
    chunk = F.pmod(F.xxhash64("id", "tree"), F.ceil(F.col("n") / (2 * LEAF))).alias("chunk")
    leaves = rows.join(sizes, ["tree", "leaf"]).groupBy("tree", "leaf", chunk).agg(F.collect_list(F.struct("id", "vec")).alias("m"))
    found = leaves.select(F.col("m.id").alias("ids"), F.col("m.vec").alias("vecs")).mapInPandas(compare, "u long, v long, d double")
    return _nearest(found.withColumn("new", F.lit(True)), degree)


def _nearest(edges: DataFrame, degree: int) -> DataFrame:
    """The `degree` nearest v of each u; an edge known before stays old."""
    once = edges.repartition("u").groupBy("u", "v").agg(F.min("d").alias("d"), F.min("new").alias("new"))
    place = F.row_number().over(Window.partitionBy("u").orderBy("d", "v"))
    return once.withColumn("place", place).where(F.col("place") <= degree).drop("place")


def _descend(graph: DataFrame, nodes: DataFrame, degree: int, reverse: int, turn: int) -> DataFrame:
    """One round of NN-descent."""
    back = graph.select(F.col("v").alias("c"), F.col("u").alias("m"), "new")
    place = F.row_number().over(Window.partitionBy("c").orderBy(F.xxhash64("m", F.lit(turn)), "m"))
    back = back.withColumn("place", place).where(F.col("place") <= reverse).drop("place")
    lists = graph.select(F.col("u").alias("c"), F.col("v").alias("m"), "new").union(back)
    lists = lists.repartition("c").groupBy("c", "m").agg(F.max("new").alias("new"))
    lists = lists.withColumn("any", F.max("new").over(Window.partitionBy("c"))).where("any").drop("any")
    worst = graph.groupBy("u").agg(F.when(F.count(F.lit(1)) >= degree, F.max("d")).otherwise(F.lit(float("inf"))).alias("worst"))
    attached = nodes.join(worst.withColumnRenamed("u", "id"), "id").select(F.col("id").alias("m"), "vec", "worst")
    met = lists.join(attached, "m").groupBy("c").agg(F.collect_list(F.struct("m", "new", "worst", "vec")).alias("l"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            us, vs, ds = [], [], []
            for ids, new, worst, vectors in zip(batch["ids"], batch["news"], batch["worsts"], batch["vecs"], strict=True):
                ids, new, worst, x = np.asarray(ids), np.asarray(new, dtype=bool), np.asarray(worst), _matrix(list(vectors), SINGLE)
                d = squared(x, x)
                tried = (new[:, None] | new[None, :]) & (d < worst[:, None])
                np.fill_diagonal(tried, False)
                i, j = np.nonzero(tried)
                us.append(ids[i])
                vs.append(ids[j])
                ds.append(d[i, j])
            yield pd.DataFrame({"u": np.concatenate([np.empty(0, np.int64), *us]), "v": np.concatenate([np.empty(0, np.int64), *vs]), "d": np.concatenate([np.empty(0), *ds])})

    flat = met.select(F.col("l.m").alias("ids"), F.col("l.new").alias("news"), F.col("l.worst").alias("worsts"), F.col("l.vec").alias("vecs"))
    better = flat.mapInPandas(compare, "u long, v long, d double").withColumn("new", F.lit(True))
    return _nearest(graph.withColumn("new", F.lit(False)).unionByName(better), degree)


def build_graph(nodes: DataFrame, kind: str = DOUBLE, degree: int = DEGREE, reverse: int = REVERSE, stop: float = STOP, trees: int = TREES) -> DataFrame:
    """(id, vec) -> (id, vec, near): every node with its neighbours' ids, reverse ones included. Can be written and reread.

    Each round lowers the sum of distances or changes nothing, so rounds end; stop = 1 leaves the first graph as it is.
    """
    small, turn = _stored(_narrow(nodes, kind)), 0
    graph = _stored(_first_graph(small, nodes.count(), degree, trees))
    while True:
        entries = graph.agg(F.count(F.lit(1)).alias("all"), F.count_if("new").alias("new")).first()
        if entries["new"] <= stop * entries["all"]:
            break
        before, graph, turn = graph, _stored(_descend(graph, small, degree, reverse, turn)), turn + 1
        _forget(before)
    _forget(small)
    back = graph.select(F.col("v").alias("id"), F.col("u").alias("to"), F.row_number().over(Window.partitionBy("v").orderBy("d", "u")).alias("place"))
    links = graph.select(F.col("u").alias("id"), F.col("v").alias("to")).union(back.where(F.col("place") <= reverse).select("id", "to"))
    return nodes.join(links.groupBy("id").agg(F.collect_set("to").alias("near")), "id", "left")


def _hop(batches: Iterator[pd.DataFrame], beam: int, a_hop: int, kind: str) -> Iterator[pd.DataFrame]:
    """Merge what a hop found into each query's list and choose what the next hop expands."""
    for batch in batches:
        out = []
        for q, vec, ids, ds, done, found, vectors in zip(*(batch[c] for c in ("q", "qvec", "ids", "ds", "done", "found", "vectors")), strict=True):
            ids, ds, done = np.asarray(ids, dtype=np.int64), np.asarray(ds, dtype=np.float64), np.asarray(done, dtype=np.int64)
            v, at = np.unique(np.asarray(found, dtype=np.int64), return_index=True)
            fresh = ~np.isin(v, ids)
            if fresh.any():
                d = np.sqrt(((_matrix([vectors[k] for k in at[fresh]], kind) - np.frombuffer(vec, dtype=kind).astype(np.float64)) ** 2).sum(axis=1))
                ids, ds = np.concatenate([ids, v[fresh]]), np.concatenate([ds, d])
                order = np.lexsort((ids, ds))
                ids, ds = ids[order], ds[order]
            todo = ids[:beam][~np.isin(ids[:beam], done)][:a_hop]
            # Everything seen stays in the list, so that nothing is compared twice.
            out.append((q, vec, ids, ds, np.concatenate([done, todo]), todo))
        yield pd.DataFrame(out, columns=["q", "qvec", "ids", "ds", "done", "todo"])


def search(index: DataFrame, queries: DataFrame, k: int, kind: str = DOUBLE, beam: int = BEAM, a_hop: int = A_HOP, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """index: (id, vec, near); queries: (q, qvec, entry), entry a node's id. Gives (q, ids, ds), nearest first, k nodes at most."""
    state_schema = "q long, qvec binary, ids array<long>, ds array<double>, done array<long>, todo array<long>"
    vectors = index.select(F.col("id").alias("v"), "vec")
    links = index.select(F.col("id").alias("e"), "near")
    size = queries.count()
    small = size * a_hop * (DEGREE + REVERSE) * 24 <= broadcast_bytes
    hint = F.broadcast if small else (lambda x: x)
    none = F.array().cast("array<long>")
    state = queries.select("q", "qvec", none.alias("ids"), none.cast("array<double>").alias("ds"), none.alias("done"), F.array("entry").alias("todo"))
    reached = state.select("q", F.explode("todo").alias("v"))
    fields = F.struct("qvec", "ids", "ds", "done").alias("s")
    before = None
    while True:
        # State and finds meet in one shuffle by query.
        found = hint(reached).join(vectors, "v").select("q", F.lit(None).alias("s"), F.struct("v", "vec").alias("f"))
        both = state.select("q", fields, F.lit(None).alias("f")).union(found).groupBy("q").agg(F.first("s", ignorenulls=True).alias("s"), F.collect_list("f").alias("found"))
        flat = both.select("q", "s.*", F.col("found.v").alias("found"), F.col("found.vec").alias("vectors"))
        state = _stored(flat.mapInPandas(lambda b: _hop(b, beam, a_hop, kind), state_schema))
        if before is not None:
            _forget(before)
        before = state
        frontier = state.select("q", F.explode("todo").alias("e"))
        if frontier.isEmpty():
            return state.select("q", F.slice("ids", 1, k).alias("ids"), F.slice("ds", 1, k).alias("ds"))
        reached = hint(frontier).join(links, "e").select("q", F.explode("near").alias("v"))


def nearest(rows: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", stop: float = STOP, trees: int = TREES) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest other rows of each row where `is_query` (over vec_id) holds."""
    kind = SINGLE if dict(rows.dtypes)[vector] == "array<float>" else DOUBLE
    usable = cut(_packed(_usable(rows, vec_id, vector), kind).distinct())
    nodes = cut(usable.groupBy("vec").agg(F.min("vec_id").alias("id")).select("id", "vec"))
    index = _stored(build_graph(nodes, kind, stop=stop, trees=trees))
    member = usable.join(nodes, "vec").select("id", "vec_id")
    asked = cut(member.where(is_query))
    queries = asked.select("id").distinct().join(nodes, "id").select(F.col("id").alias("q"), F.col("vec").alias("qvec"), F.col("id").alias("entry"))
    found = search(index, queries, k + 1, kind)
    near = found.select("q", F.explode(F.arrays_zip("ids", "ds")).alias("n")).select("q", F.col("n.ids").alias("id"), F.col("n.ds").alias("score"))
    # The k + 1 least ids of a node are all that can be asked for: first in parts of it, then whole.
    part = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    in_part = F.row_number().over(Window.partitionBy("id", part).orderBy("vec_id"))
    in_node = F.row_number().over(Window.partitionBy("id").orderBy("vec_id"))
    first = member.withColumn("place", in_part).where(F.col("place") <= k + 1).withColumn("place", in_node).where(F.col("place") <= k + 1).drop("place")
    # Once for each node asked for; rows with equal vectors then differ only in leaving themselves out.
    lists = near.join(first, "id").groupBy("q").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("all"))
    lists = lists.select("q", F.slice("all", 1, k + 1).alias("all"))
    each = asked.withColumnRenamed("vec_id", "query_id").join(lists, F.col("id") == F.col("q"))
    others = F.slice(F.filter("all", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = each.select("query_id", F.posexplode(others).alias("at", "n"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"), F.col("n.score").alias("score"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
