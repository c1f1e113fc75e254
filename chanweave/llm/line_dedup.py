"""Line deduplication by winnowing over line hashes.

A document is the sequence of the hashes of its lines with words; blank lines take no part. A window is a shortest run of
lines with `min_words` words: from each line on, and up to each line. Each window selects its minimum line hash (the last
of equals); the distinct selected lines are the document's fingerprints, fewer than its lines. Two runs of `min_words`
words that are equal hold equal windows, which select equal minima, so a run that repeats always shares a fingerprint.

1. Fingerprints are counted. Those that occur once are dropped, and with them most windows.
2. Positions are joined: a window whose fingerprint occurs again is keyed by its whole content and joined to its first
   place (least id, then line). A minimum alone could be a common line whose first place hides a longer match.
3. The match is extended line by line both ways, and the lines of the later run are deleted.

The result, which tests hold against brute force: a line with words goes if and only if it lies in a run of `min_words`
words or more that equals a run which starts earlier in document order. Each line of such a run lies in a window inside
it, and each of those windows is deleted whole, so nothing depends on which earlier place is the first. A blank line goes
where the lines with words before and after it both go. The first copy of every line stays.

Texts are read once for hashes and word counts (some 16 bytes a line, cut to the checkpoint folder); all joins are over
those. A passage in a third of all documents is one row after the first aggregate, and its pairs go through joins that
adaptive execution can split; of the document that holds it first, a pair is sent no more lines than the later document
can match. Work in a document is linear in its lines: a window inside a run already deleted is not grown again.

Defined cases: lines end at "\\n" and are compared without the white space around them; null text stays null; null ids
come first; rows that repeat id and text are one document and get equal answers; an empty table gives an empty result;
other columns pass through whatever their names, except that input columns named like the two results give way to them.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read, release, text_of

MIN_WORDS = 50
DOCUMENT = "doc_id long, hash long"
NAMES = ["doc_id", "hash"]
#: A line without blanks at its ends, matched once from its start: linear however long its blanks are.
STRIPPED = r"(?sU)\A\s*(.*\S)?\s*\z"
#: More lines than a text can have.
ALL = (1 << 31) - 1


def _key(doc_id: str, text: str) -> Column:
    return F.struct(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text_of(text)).alias("hash"))


def line_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per document: d, then hash, number of words and place of each line with words."""
    lines = F.transform(F.split(text_of(text), "\n"), lambda x, k: F.struct(F.regexp_extract(x, STRIPPED, 1).alias("line"), k.alias("place")))
    counted = F.transform(lines, lambda x: F.struct(F.xxhash64(x["line"]).alias("hash"), F.regexp_count(x["line"], F.lit(r"\S+")).cast("int").alias("words"), x["place"].alias("place")))
    rows = docs.select(_key(doc_id, text).alias("d"), F.filter(counted, lambda x: x["words"] > 0).alias("lines"))
    return rows.select("d", F.col("lines.hash").alias("hashes"), F.col("lines.words").alias("words"), F.col("lines.place").alias("places"))


def windows_of(hashes: np.ndarray, words: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """(place of the minimum, first line, last line) of every window. Both ends only move on, so minima slide."""
    sums = np.concatenate(([0], np.cumsum(words)))
    ends = np.searchsorted(sums, sums[:-1] + min_words, side="left") - 1
    whole = np.flatnonzero(ends < len(words))
    spans = set(zip(whole.tolist(), ends[whole].tolist(), strict=True))
    enough = np.flatnonzero(sums[1:] >= min_words)
    spans.update(zip((np.searchsorted(sums, sums[enough + 1] - min_words, side="right") - 1).tolist(), enough.tolist(), strict=True))
    values, found, after = hashes.tolist(), [], 0
    rising: deque[int] = deque()
    for a, b in sorted(spans):
        while after <= b:
            while rising and values[rising[-1]] >= values[after]:
                rising.pop()
            rising.append(after)
            after += 1
        while rising[0] < a:
            rising.popleft()
        found.append((rising[0], a, b))
    return found


def fingerprints(lines: DataFrame, min_words: int) -> DataFrame:
    """(d, print, n): the distinct line hashes that windows select in a document, and at how many of its lines."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            owners, prints, counts = [], [], []
            for k, (hashes, words) in enumerate(zip(batch["hashes"], batch["words"], strict=True)):
                selected = sorted({least for least, _, _ in windows_of(np.asarray(hashes), np.asarray(words, dtype=np.int64), min_words)})
                if selected:
                    values, n = np.unique(np.asarray(hashes)[selected], return_counts=True)
                    owners += [k] * len(values)
                    prints.append(values)
                    counts.append(n)
            frame = batch[NAMES].iloc[owners].reset_index(drop=True).astype({"doc_id": "Int64"})
            empty = [np.empty(0, dtype=np.int64)]
            yield frame.assign(print=np.concatenate(prints or empty), n=np.concatenate(counts or empty))

    flat = lines.select("d.doc_id", "d.hash", "hashes", "words").mapInPandas(run, f"{DOCUMENT}, print long, n long")
    return flat.select(F.struct(*NAMES).alias("d"), "print", "n")


def shared_windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(d, content, start, end) of the windows whose fingerprint occurs again."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for batch in batches:
            rows, contents = [], []
            for k, (hashes, words, prints) in enumerate(zip(batch["hashes"], batch["words"], batch["prints"], strict=True)):
                hashes, again = np.asarray(hashes, dtype=np.int64), set(prints.tolist())
                values = hashes.tolist()
                for least, a, b in windows_of(hashes, np.asarray(words, dtype=np.int64), min_words):
                    if values[least] in again:
                        rows.append((k, a, b))
                        contents.append(xxhash.xxh64_intdigest(hashes[a : b + 1].tobytes()) - (1 << 63))
            at = np.array(rows, dtype=np.int32).reshape(-1, 3)
            frame = batch[NAMES].iloc[at[:, 0]].reset_index(drop=True).astype({"doc_id": "Int64"})
            yield frame.assign(content=np.array(contents, dtype=np.int64), start=at[:, 1], end=at[:, 2])

    prints = cut(fingerprints(lines, min_words))
    again = prints.groupBy("print").agg(F.sum("n").alias("times")).where("times > 1").select("print")
    by_doc = prints.join(again, "print").groupBy("d").agg(F.collect_list("print").alias("prints"))
    rows = lines.join(by_doc, "d").select("d.doc_id", "d.hash", "hashes", "words", "prints")
    return rows.mapInPandas(run, f"{DOCUMENT}, content long, start int, end int").select(F.struct(*NAMES).alias("d"), "content", "start", "end")


def _agree(x: np.ndarray, y: np.ndarray) -> int:
    """How many values agree from the start; compared in growing steps."""
    n, done, step = min(len(x), len(y)), 0, 64
    while done < n:
        unlike = np.flatnonzero(x[done : min(done + step, n)] != y[done : min(done + step, n)])
        if len(unlike):
            return done + int(unlike[0])
        done, step = done + step, 2 * step
    return n


def grow(later: np.ndarray, first: np.ndarray, windows: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Extend matches (start, end in the later document, start in the first one) both ways: runs of the later document.

    A window inside a run found before is left out, and growth to the left ends at the run before.
    """
    runs, done = [], -1
    for a, b, origin in sorted(windows):
        if b <= done:
            continue
        after = _agree(later[a:], first[origin:])
        if not after:  # two contents share a key
            continue
        reach = min(a - max(done + 1, 0), origin) if a > done else 0
        before = _agree(later[a - reach : a][::-1], first[origin - reach : origin][::-1])
        runs.append((a - before, a + after - 1))
        done = a + after - 1
    return runs


def _grow_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        owners, rows = [], []
        columns = (batch[c] for c in ("later", "places", "first", "base", "starts", "ends", "origins"))
        for k, (later, places, first, base, starts, ends, origins) in enumerate(zip(*columns, strict=True)):
            for a, b in grow(np.asarray(later), np.asarray(first), list(zip(starts.tolist(), ends.tolist(), (origins - base).tolist(), strict=True))):
                owners.append(k)
                rows.append((a, b, places[a], places[b]))
        at = np.array(rows, dtype=np.int32).reshape(-1, 4)
        frame = batch[NAMES].iloc[owners].reset_index(drop=True).astype({"doc_id": "Int64"})
        yield frame.assign(start=at[:, 0], end=at[:, 1], first=at[:, 2], last=at[:, 3])


def joined_runs(runs: np.ndarray) -> list[tuple[int, int]]:
    """(start, end, first, last) rows in any order -> (first, last) lines of the runs; neighbours in start and end are one run."""
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    reach = np.maximum.accumulate(runs[:, 1])
    begins = np.flatnonzero(np.concatenate(([True], runs[1:, 0] > reach[:-1] + 1)))
    return list(zip(runs[begins, 2].tolist(), np.maximum.reduceat(runs[:, 3], begins).tolist(), strict=True))


def _join_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        deleted, kept = [], []
        for columns in zip(batch["start"], batch["end"], batch["first"], batch["last"], strict=True):
            runs = joined_runs(np.stack([np.asarray(c) for c in columns], axis=1))
            deleted.append([{"start": a, "end": b} for a, b in runs])
            edges = [-1, *(x for run in runs for x in run)]
            kept.append([{"at": a + 1, "n": b - a - 1} for a, b in zip(edges[::2], [*edges[1::2], ALL], strict=True)])
        yield batch[NAMES].astype({"doc_id": "Int64"}).assign(runs=deleted, kept=kept)


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, runs, kept): the runs of lines (start, end inclusive) that repeat earlier ones, and what is between (at, n)."""
    lines = cut(line_table(docs, doc_id, text).dropDuplicates(["d"]))
    windows = cut(shared_windows(lines, min_words))
    place = F.struct("d", "start")
    first = windows.groupBy("content").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = windows.join(first, "content").where(place != F.col("first"))
    match = F.struct("start", "end", F.col("first.start").alias("origin"))
    pairs = later.groupBy("d", F.col("first.d").alias("d0")).agg(F.collect_list(match).alias("m"), F.min("first.start").alias("low"), F.max("first.start").alias("high"))
    both = pairs.join(lines.select("d", F.col("hashes").alias("later"), "places"), "d")
    both = both.join(lines.select(F.col("d").alias("d0"), F.col("hashes").alias("first")), "d0")
    # Of the first document, only lines that the later one can reach.
    reach = F.size("later")
    base = F.greatest(F.lit(0), F.col("low") - reach)
    flat = both.select(
        "d.doc_id", "d.hash", "later", "places", F.slice("first", base + 1, F.col("high") - base + reach).alias("first"), base.alias("base"),
        F.col("m.start").alias("starts"), F.col("m.end").alias("ends"), F.col("m.origin").alias("origins"),
    )
    runs = cut(flat.mapInPandas(_grow_rows, f"{DOCUMENT}, start int, end int, first int, last int"))
    release(windows, lines)
    by_doc = runs.groupBy(*NAMES).agg(F.collect_list(F.struct("start", "end", "first", "last")).alias("r"))
    by_doc = by_doc.select(*NAMES, *[F.col(f"r.{c}").alias(c) for c in ("start", "end", "first", "last")])
    joined = by_doc.mapInPandas(_join_rows, f"{DOCUMENT}, runs array<struct<start:int,end:int>>, kept array<struct<at:int,n:int>>")
    return joined.select(F.struct(*NAMES).alias("d"), "runs", "kept")


def mark(
    docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text", runs: str = "line_runs", clean: str = "clean_text",
) -> DataFrame:
    """The rows of `docs` with line_runs (null where nothing repeats) and clean_text."""
    rows = docs.select(_key(doc_id, text).alias("__d"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    found = repeated_runs(docs, min_words, doc_id, text).select(F.col("d").alias("__d"), F.col("runs").alias("__runs"), F.col("kept").alias("__kept"))
    joined = rows.join(found, "__d", "left")
    lines = F.split(F.col(f"__row.`{text}`"), "\n")
    left = F.array_join(F.flatten(F.transform("__kept", lambda k: F.slice(lines, k["at"] + 1, k["n"]))), "\n")
    passed = [F.col(f"__row.`{c}`") for c in docs.columns if c not in (runs, clean)]
    return joined.select(*passed, F.col("__runs").alias(runs), F.when(F.col("__runs").isNull(), F.col(f"__row.`{text}`")).otherwise(left).alias(clean))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lines, deleted_lines, kept_words, clean_sha256 of what stays, runs as "start-end" joined by commas."""
    marked = mark(read(spark, sf_dir, "documents"))
    runs = F.coalesce("line_runs", F.array().cast("array<struct<start:int,end:int>>"))
    name = F.array_join(F.transform(runs, lambda r: F.concat_ws("-", r["start"], r["end"])), ",")
    lines = F.size(F.split(text_of("text"), "\n"))
    gone = F.aggregate(runs, F.lit(0), lambda n, r: n + r["end"] - r["start"] + 1)
    return marked.select(
        "doc_id", lines.cast("long").alias("lines"), gone.cast("long").alias("deleted_lines"),
        F.regexp_count(text_of("clean_text"), F.lit(r"\S+")).cast("long").alias("kept_words"),
        F.sha2(text_of("clean_text"), 256).alias("clean_sha256"), name.alias("runs"),
    )
