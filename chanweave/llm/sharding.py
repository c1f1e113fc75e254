"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

Each shard owns `vnodes` points of a ring of 2^60 positions (MD5 of "shard:vnode"); a document falls on the arc that
ends at the next point clockwise of the MD5 of its id. Loads are bounded: each shard may hold its exact share of the
rows (counts differ by one at most, law `rows`). Only counts per arc decide who overflows: a full shard's excess walks
clockwise to the next point whose shard has room. That walk is over shards * vnodes numbers (a constant, whatever the
input), so it runs on the driver and comes back as one literal. Rows get their rank in the arc from counts of hash
cells, so that no window holds more than about `rows_per_cell` of them.

Defined cases: null text has size 1 and checksum 0; rows with a null id are placed by checksum and size; rows that
repeat an id share its ring position and take neighbouring ranks; a text counts by its bytes, however long; an empty table
gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, text_of

RING_BITS, CELL_BITS = 60, 12


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes, clockwise."""
    return sorted((int(hashlib.md5(f"{s}:{v}".encode()).hexdigest()[:15], 16), s) for s in range(shards) for v in range(vnodes))


def position(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("long")


def arc_of(at: Column, points: list[tuple[int, int]]) -> Column:
    """Number of the first point at or after the position; past the last point the ring starts again."""
    shift = RING_BITS - CELL_BITS
    cells: list[list[int]] = [[] for _ in range(1 << CELL_BITS)]
    for p, _ in points:
        cells[p >> shift].append(p)
    before, total = [], 0
    for cell in cells:
        before.append(total)
        total += len(cell)
    cell = F.shiftright(at, shift).cast("int")
    start = F.from_json(F.lit(json.dumps(before)), "array<int>")[cell]
    inside = F.size(F.filter(F.from_json(F.lit(json.dumps(cells)), "array<array<bigint>>")[cell], lambda p: p < at))
    return ((start + inside) % len(points)).cast("int")


def spread(counts: list[int], owners: list[int], shards: int) -> list[list[dict]]:
    """For each arc, which ranks go to which shard and from which slot on. Every shard ends at its exact share."""
    total = sum(counts)
    wanted = [sum(c for c, o in zip(counts, owners, strict=True) if o == s) for s in range(shards)]
    largest = sorted(range(shards), key=lambda s: (-wanted[s], s))[: total % shards]
    free = [total // shards + (s in largest) for s in range(shards)]
    left, used, slots = list(counts), [0] * len(counts), [0] * shards
    parts: list[list[dict]] = [[] for _ in counts]

    def give(arc: int, shard: int) -> None:
        n = min(left[arc], free[shard])
        if n:
            parts[arc].append({"lo": used[arc], "hi": used[arc] + n, "shard": shard, "slot": slots[shard]})
            left[arc], free[shard] = left[arc] - n, free[shard] - n
            used[arc], slots[shard] = used[arc] + n, slots[shard] + n

    for arc, owner in enumerate(owners):
        give(arc, owner)
    for arc in range(len(owners)):
        for step in range(1, len(owners)):
            if not left[arc]:
                break
            give(arc, owners[(arc + step) % len(owners)])
    return parts


def shard(
    docs: DataFrame, shards: int = 8, vnodes: int = 64, doc_id: str = "doc_id", text: str = "text", rows_per_cell: int = 20_000
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot for each row of `docs`."""
    points = ring(shards, vnodes)
    owners = [s for _, s in points]
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(text_of(text)) + 1).cast("long").alias("size"), F.crc32(text_of(text).cast("binary")).alias("text_crc32")
    )
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat_ws(":", F.lit("null"), "text_crc32", "size"))
    rows = rows.withColumn("at", position(name)).withColumn("arc", arc_of(F.col("at"), points))
    by_arc = {r["arc"]: r["n"] for r in rows.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}  # shards * vnodes rows at most
    counts = [by_arc.get(a, 0) for a in range(len(points))]
    cells = sum(counts) // (len(points) * rows_per_cell) + 1
    parts = F.from_json(F.lit(json.dumps(spread(counts, owners, shards))), "array<array<struct<lo:bigint,hi:bigint,shard:int,slot:bigint>>>")

    rows = rows.withColumn("cell", F.pmod(F.col("at"), F.lit(cells)))
    by_cell = rows.groupBy("arc", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_cell = F.row_number().over(Window.partitionBy("arc", "cell").orderBy("at", "doc_id", "text_crc32", "size"))
    ranked = rows.withColumn("in_cell", in_cell).join(by_cell.select("arc", "cell", before.alias("before")), ["arc", "cell"])
    rank = F.col("before") + F.col("in_cell") - 1
    part = F.filter(parts[F.col("arc")], lambda p: (p["lo"] <= F.col("rank")) & (F.col("rank") < p["hi"]))[0]
    return (
        ranked.withColumn("rank", rank)
        .withColumn("part", part)
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("part.shard").alias("shard"),
            (F.col("part.slot") + F.col("rank") - F.col("part.lo")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"))
