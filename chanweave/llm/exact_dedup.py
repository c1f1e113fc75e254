"""Exact deduplication against a minimal perfect hash of the digests already seen.

History is a table of distinct SHA-256 digests. It is cut into shards of bounded size by digest; each shard gets a
minimal perfect hash (cascaded collision-free bit arrays, ranks by population count) whose slots hold the full digest,
the locator of the winning document and the size of its group. A new batch is first grouped by digest (so a text with a
third of all rows is one row), then looked up: the slot's digest is compared byte by byte, members join the slot's
group, and nonmembers form groups of their own.

Defined cases: null text counts as empty; the largest id of a group wins (a null id only where all are null); rows that
repeat id and text are one document and share the verdict; texts are hashed whole, however long; an empty table gives an
empty result; further columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, text_of

KEYS_PER_SHARD = 20_000
INDEX_SCHEMA = "shard int, levels array<binary>, widths array<int>, digests binary, winners array<long>, counts array<long>"
VERDICT_SCHEMA = "digest binary, keep_id long, group_size long, member boolean"


def _words(digests: np.ndarray) -> np.ndarray:
    """n digests of 32 bytes as an (n, 4) array of unsigned 64-bit words."""
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


def _positions(words: np.ndarray, level: int, width: int) -> np.ndarray:
    x = np.full(len(words), (0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for k in range(4):
        x = (x ^ words[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
    return (x % np.uint64(width)).astype(np.int64)


def build_hash(words: np.ndarray, load: float = 2.0) -> tuple[list[np.ndarray], np.ndarray]:
    """Minimal perfect hash of distinct keys: the bit array of each level, and the slot (0..n-1) of each key."""
    levels, slots = [], np.empty(len(words), dtype=np.int64)
    left, taken = np.arange(len(words)), 0
    while len(left):
        width = max(64, int(load * len(left)))
        at = _positions(words[left], len(levels), width)
        bits = np.bincount(at, minlength=width) == 1
        rank = np.cumsum(bits) - 1
        alone = bits[at]
        slots[left[alone]] = taken + rank[at[alone]]
        taken += int(bits.sum())
        left = left[~alone]
        levels.append(bits)
        if len(levels) > 200:
            raise ValueError("the keys of a perfect hash must be distinct")
    return levels, slots


def find_slots(words: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The only slot that each key can have, -1 where no level holds it."""
    slots, left, taken = np.full(len(words), -1, dtype=np.int64), np.arange(len(words)), 0
    for k, bits in enumerate(levels):
        at = _positions(words[left], k, len(bits))
        hit = bits[at]
        slots[left[hit]] = taken + (np.cumsum(bits) - 1)[at[hit]]
        taken += int(bits.sum())
        left = left[~hit]
    return slots


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    levels, slots = build_hash(_words(rows["digest"].to_numpy()))
    order = np.argsort(slots)
    return pd.DataFrame(
        {
            "shard": [rows["shard"].iloc[0]],
            "levels": [[np.packbits(x).tobytes() for x in levels]],
            "widths": [[len(x) for x in levels]],
            "digests": [b"".join(rows["digest"].to_numpy()[order])],
            "winners": [[None if pd.isna(x) else int(x) for x in rows["winner"].to_numpy()[order]]],
            "counts": [rows["n"].to_numpy()[order].tolist()],
        }
    )


def _look_up(batch: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Join one shard of the batch to its slots; every slot and every nonmember gives one verdict."""
    slots = np.full(len(batch), -1, dtype=np.int64)
    digests, winners, counts = np.empty(0, dtype=object), [], np.empty(0, dtype=np.int64)
    if len(index):
        row = index.iloc[0]
        levels = [np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=w).astype(bool) for x, w in zip(row["levels"], row["widths"], strict=True)]
        digests = np.array([row["digests"][i : i + 32] for i in range(0, len(row["digests"]), 32)], dtype=object)
        winners, counts = [None if x is None or pd.isna(x) else int(x) for x in row["winners"]], np.array(row["counts"], dtype=np.int64)
        if len(batch):
            slots = find_slots(_words(batch["digest"].to_numpy()), levels)
            same = np.array([s >= 0 and digests[s] == d for s, d in zip(slots, batch["digest"], strict=True)])  # byte check
            slots = np.where(same, slots, -1)
    new = []
    for s, digest, winner, n in zip(slots, batch["digest"], batch["winner"], batch["n"], strict=True):
        winner = None if pd.isna(winner) else int(winner)
        if s < 0:
            new.append((digest, winner, int(n), False))
            continue
        counts[s] += n
        if winner is not None and (winners[s] is None or winner > winners[s]):
            winners[s] = winner
    rows = [(d, w, int(n), True) for d, w, n in zip(digests, winners, counts, strict=True)] + new
    out = pd.DataFrame(rows, columns=["digest", "keep_id", "group_size", "member"])
    return out.astype({"keep_id": "Int64"})


def _grouped(digests: DataFrame, shards: int) -> DataFrame:
    """One row per distinct digest, combined before the shuffle, with the shard it belongs to."""
    return (
        digests.groupBy("digest")
        .agg(F.max("id").alias("winner"), F.count(F.lit(1)).alias("n"))
        .withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))
    )


def build_index(digests: DataFrame, shards: int) -> DataFrame:
    """Index of a table (id, digest): one row per shard with hash, slots, winners and group sizes. Can be written and reread."""
    return _grouped(digests, shards).groupBy("shard").applyInPandas(_build_shard, INDEX_SCHEMA)


def look_up(batch: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Verdict for each distinct digest of history and of a batch (id, digest)."""
    return _grouped(batch, shards).groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_look_up, VERDICT_SCHEMA)


def dedup(docs: DataFrame, historical: Column, doc_id: str = "doc_id", text: str = "text", shards: int | None = None) -> DataFrame:
    """Rows of `docs` where `historical` holds are indexed; the others are looked up. One row per row of `docs`.

    shards: by default one for each 20,000 rows, so an index row stays near a megabyte at every size.
    """
    shards = shards or max(1, docs.count() // KEYS_PER_SHARD + 1)
    rows = docs.select(F.col(doc_id).alias("id"), F.sha2(text_of(text), 256).alias("text_sha256"), F.coalesce(historical, F.lit(False)).alias("old"))
    keyed = rows.select("id", "old", F.unhex("text_sha256").alias("digest"))
    index = build_index(keyed.where("old"), shards)
    verdicts = look_up(keyed.where("NOT old"), index, shards).select(F.lower(F.hex("digest")).alias("text_sha256"), "keep_id", "group_size", "member")
    return rows.join(verdicts, "text_sha256").select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History is the older half of the id range, the batch is the newer half; together they are all documents."""
    docs = read(spark, sf_dir, "documents")
    first, last = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = 0 if first is None else (first + last) // 2
    return dedup(docs, F.col("doc_id") <= middle)


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
