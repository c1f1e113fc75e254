"""Phrase collocation mining: Misra-Gries summaries find what can be frequent, a second pass counts it exactly.

Texts are read in chunks of about `CHUNK` bytes per language (longer ones in several, with the last three words again in
front), and words and the 1- to 4-grams within pieces become 64-bit hashes by numpy over the chunk's bytes. The high bits
of a hash choose one of the hash partitions, the low 32 bits are its key there.

First pass: every task sends, for each hash partition, its keys and their counts; a partition merges them into a
Misra-Gries summary. Its capacity is `SLACK` times the partition's mass (occurrences) divided by the threshold: whatever a
full summary subtracts, it subtracts from more than that many counters, so the error stays under threshold / `SLACK`, and
every n-gram that occurs `least` times survives with a count above the threshold less the error. Keys under that are
dropped. Keys that share a hash share a counter, which can only keep more. The number of partitions grows with the bytes
of the texts, so a partition's mass, and with it a task's memory, is bounded; nothing is dropped by a cap.

Survivors become bits of a filter of fixed size (at most 2 ** `FILTER_BITS` bits, broadcast; what shares a bit is counted
too). Second pass: n-grams whose bit is set are counted by their exact words, words being told apart by their bytes, and
summed by Spark; those under the threshold go. Statistics follow by joins on phrases, in decimals where products can pass
64 bits. The best phrases of a language are chosen in parts first.

A phrase inside a longer one with at least `COVERED` percent of its count lies also inside one that is longer by one word
with at least that count, so only those are looked at. Every part of a frequent phrase is frequent, so all are counted.

Defined cases: a null text is empty, a null language is `und`; only A-Z are lower-cased; a language without frequent
phrases gives no row; ties go to the larger count, then to the smaller phrase by UTF-8 bytes; an empty table gives an empty
result; rows that repeat count each. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read, text_of

LEAST, TOP, COVERED, LONGEST = 30, 2000, 80, 4
CHUNK = 4 << 20
SLACK, PARTITION_MASS = 4, 8 << 20
FILTER_BITS, LEAST_BITS, MASS_A_BIT = 30, 20, 16
FLUSH_KEYS, TOP_PARTS = 4 << 20, 64
UNKNOWN = "und"

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
BLANK, BREAK = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(BLANK)] = 1
_KIND[list(BREAK)] = 2

# An odd base has an inverse modulo 2 ** 64, so the hash of a word is a difference of prefix sums.
BASE, MODULUS = 0x9E3779B97F4A7C15, 1 << 64
INVERSE = pow(BASE, -1, MODULUS)
STEP = np.uint64(0xD6E8FEB86659FD93)
#: Bytes whose prefix sums are held at a time.
BLOCK = 1 << 20
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int) -> np.ndarray:
    if base not in _POWERS:
        held = np.full(BLOCK, base, dtype=np.uint64)
        held[0] = 1
        _POWERS[base] = np.multiply.accumulate(held)
    return _POWERS[base]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * STEP
    x = (x ^ (x >> np.uint64(29))) * STEP
    return x ^ (x >> np.uint64(32))


class Chunk:
    """Words of some texts of one language: their bytes, places, pieces and hashes. The first `skip` words were in the
    chunk before; only n-grams that end after them are new."""

    def __init__(self, lang: str, raw: bytes, skip: int = 0):
        self.lang, self.skip = lang, skip
        data = np.frombuffer(raw.translate(LOWER) + b"\n", dtype=np.uint8)
        kind = _KIND[data]
        edge = np.diff((kind == 0).view(np.int8), prepend=np.int8(0))  # the last byte is a break
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), self.start).astype(np.int32)
        self.data = data

    def __len__(self) -> int:
        return len(self.start)

    def word_hashes(self) -> np.ndarray:
        seed = np.uint64(int.from_bytes(self.lang.encode()[:7], "little") * 2 + 1 & MODULUS - 1)
        own, before = np.empty(len(self), dtype=np.uint64), np.uint64(0)
        heads, tails = (np.searchsorted(x, np.arange(0, len(self.data) + BLOCK, BLOCK)) for x in (self.start, self.end))
        until = np.empty(len(self), dtype=np.uint64)
        for k, at in enumerate(range(0, len(self.data), BLOCK)):
            part = self.data[at : at + BLOCK].astype(np.uint64) + np.uint64(1)
            part *= _powers(BASE)[: len(part)]
            part *= np.uint64(pow(BASE, at, MODULUS))
            sums = np.empty(len(part) + 1, dtype=np.uint64)  # of all bytes before each of the block's
            sums[0] = before
            np.cumsum(part, out=sums[1:])
            sums[1:] += before
            first, last = slice(heads[k], heads[k + 1]), slice(tails[k], tails[k + 1])
            own[first], until[last] = sums[self.start[first] - at], sums[self.end[last] - at]
            before = sums[-1]
        own = until - own
        for k, at in enumerate(range(0, len(self.data), BLOCK)):
            first = slice(heads[k], heads[k + 1])
            own[first] *= _powers(INVERSE)[self.start[first] - at] * np.uint64(pow(INVERSE, at, MODULUS))
        return mix(own ^ seed)

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, places of first words, hashes) of all new n-grams within pieces."""
        words = self.word_hashes()
        hashes = words
        for n in range(1, LONGEST + 1):
            if n > 1:
                hashes = mix(hashes[:-1] * STEP + words[n - 1 :])
            if not len(hashes):
                return
            within = self.piece[: len(hashes)] == self.piece[n - 1 :]
            within[: max(0, self.skip - n + 1)] = False
            at = np.flatnonzero(within)
            yield n, at, hashes[at]

    def words(self) -> tuple[np.ndarray, list[bytes]]:
        """The number of each word's own bytes, and the words by number. Equal hashes are checked byte by byte."""
        raw, size = self.data.tobytes(), self.end - self.start
        _, first, number = np.unique(self.word_hashes(), return_index=True, return_inverse=True)
        like = first[number]
        same = size == size[like]
        if same.all():
            at = np.cumsum(size) - size
            inside = np.arange(int(size.sum())) - np.repeat(at, size)
            same = (self.data[np.repeat(self.start, size) + inside] == self.data[np.repeat(self.start[like], size) + inside]).all()
        if np.all(same):
            return number, [raw[a:b] for a, b in zip(self.start[first].tolist(), self.end[first].tolist(), strict=True)]
        known: dict[bytes, int] = {}
        number = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(self.start.tolist(), self.end.tolist(), strict=True)])
        return number, list(known)

    def counted(self, wanted: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[list[str], np.ndarray]]:
        """(phrases, counts) of the n-grams whose hashes are wanted, for each n."""
        number, words = self.words()
        for n, at, hashes in self.grams():
            at = at[wanted(hashes)]
            if not len(at):
                continue
            key = number[at]
            for k in range(1, n):  # exact: a key is the number of a shorter phrase and a word
                key = np.unique(key, return_inverse=True)[1] * len(words) + number[at + k]
            _, first, counts = np.unique(key, return_index=True, return_counts=True)
            columns = [number[at[first] + k].tolist() for k in range(n)]
            yield [b" ".join([words[w] for w in ws]).decode() for ws in zip(*columns, strict=True)], counts


def chunks(texts: Iterator[tuple[str, str]], size: int = CHUNK) -> Iterator[Chunk]:
    """(lang, text) pairs -> chunks. A text of over `size` bytes is cut between words."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for lang, text in texts:
        raw = text.encode()
        if len(raw) > size:
            yield from _long_text(lang, raw, size)
            continue
        held.setdefault(lang, []).append(raw)
        sizes[lang] = sizes.get(lang, 0) + len(raw) + 1
        if sum(sizes.values()) > size:
            largest = max(sizes, key=sizes.get)
            sizes.pop(largest)
            yield Chunk(largest, b"\n".join(held.pop(largest)))
    for lang, raws in held.items():
        yield Chunk(lang, b"\n".join(raws))


def _long_text(lang: str, raw: bytes, size: int) -> Iterator[Chunk]:
    """Blocks of whole words; each begins with the last words of the one before."""
    at, front = 0, b""
    while at < len(raw):
        end = min(len(raw), at + size)
        while end < len(raw) and not _KIND[raw[end]]:
            end += 1
        block = front + raw[at:end]
        chunk = Chunk(lang, block, skip=len(Chunk(lang, front)) if front else 0)
        yield chunk
        front = block[chunk.start[-min(LONGEST - 1, len(chunk))] :] if len(chunk) else b""
        at = end


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, str]]:
    return zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    for batch in batches:
        yield from _texts(batch)


def planes(x: np.ndarray) -> bytes:
    """Bytes by place, so that the high ones, mostly zero, compress."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def slot(hashes: np.ndarray, partitions: int) -> np.ndarray:
    """Partition and key in one number; sorted, partitions lie together."""
    return ((hashes >> np.uint64(32)) * np.uint64(partitions) & ~np.uint64(0xFFFFFFFF)) | (hashes & np.uint64(0xFFFFFFFF))


def _sketched(texts: DataFrame, partitions: int, size: int) -> DataFrame:
    """(part, lang, words, keys, counts): what each task has for each hash partition; rows with a language count its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, words = [], 0, {}

        def flushed() -> Iterator[pa.RecordBatch]:
            slots, counts = np.unique(np.concatenate(held), return_counts=True)
            part = (slots >> np.uint64(32)).astype(np.int64)
            ends = np.flatnonzero(np.diff(part, prepend=-1, append=partitions))
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                keys = np.diff(slots[a:b] & np.uint64(0xFFFFFFFF), prepend=np.uint64(0))
                yield batch_of([int(part[a])], [None], [None], [planes(keys)], [planes(counts[a:b])])

        def batch_of(part, lang, n, keys, counts) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array(lang, pa.string()), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], names=["part", "lang", "words", "keys", "counts"]
            )

        for chunk in chunks(_stream(batches), size):
            words[chunk.lang] = words.get(chunk.lang, 0) + len(chunk) - chunk.skip
            for _, _, hashes in chunk.grams():
                held.append(slot(hashes, partitions))
                total += len(hashes)
            if total >= FLUSH_KEYS:
                yield from flushed()
                held, total = [], 0
        if total:
            yield from flushed()
        yield batch_of([None] * len(words), list(words), list(words.values()), [None] * len(words), [None] * len(words))

    return texts.mapInArrow(run, "part long, lang string, words long, keys binary, counts binary")


class Summary:
    """Misra-Gries: at most `capacity` counters; a true count lies between a counter and the counter plus `error`."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, error: int = 0) -> None:
        """Add the counters of another summary, or plain counts."""
        self.error += error
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.diff(keys.astype(np.int64), prepend=-1))
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(self.keys) > self.capacity:
            less = np.partition(self.counts, -self.capacity - 1)[-self.capacity - 1]
            self.error += int(less)
            stay = self.counts > less
            self.keys, self.counts = self.keys[stay], self.counts[stay] - less

    def possible(self, least: int) -> np.ndarray:
        """Keys that can have occurred so often."""
        return self.keys[self.counts + self.error >= least]


def summarise(keys: list[np.ndarray], counts: list[np.ndarray], least: int) -> Summary:
    mass = sum(int(c.sum()) for c in counts)
    out = Summary(SLACK * mass // least + 1)
    held, size = [], 0
    for k, (x, n) in enumerate(zip(keys, counts, strict=True)):
        held.append((x, n))
        size += len(x)
        if size >= out.capacity or k == len(keys) - 1:  # several at once cost one sort
            out.merge(np.concatenate([x for x, _ in held]), np.concatenate([n for _, n in held]))
            held, size = [], 0
    return out


def survivors(sketched: DataFrame, least: int, bits: int, partitions: int) -> DataFrame:
    """(part, bits): for each hash partition, its region of the filter."""
    region = bits // partitions

    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(from_planes(x), dtype=np.uint32) for x in group["keys"]]
        found = summarise(keys, [from_planes(x).astype(np.int64) for x in group["counts"]], least).possible(least)
        marks = np.zeros(region, dtype=bool)
        marks[(found.astype(np.uint64) * np.uint64(region)) >> np.uint64(32)] = True
        return pd.DataFrame({"part": [group["part"].iloc[0]], "bits": [np.packbits(marks).tobytes()]})

    return sketched.where("part IS NOT NULL").groupBy("part").applyInPandas(run, "part long, bits binary")


def tester(bits: bytes, region: int, partitions: int) -> Callable[[np.ndarray], np.ndarray]:
    """Whether the bits of hashes are set."""
    held = np.frombuffer(bits, dtype=np.uint8)

    def wanted(hashes: np.ndarray) -> np.ndarray:
        slots = slot(hashes, partitions)
        at = (slots >> np.uint64(32)) * np.uint64(region) + (((slots & np.uint64(0xFFFFFFFF)) * np.uint64(region)) >> np.uint64(32))
        return (held[at >> np.uint64(3)] >> (7 - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1

    return wanted


def frequent(docs: DataFrame, least: int = LEAST, size: int = CHUNK, lang: str = "lang", text: str = "text", partition_mass: int = PARTITION_MASS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f): all phrases of 1 to 4 words that occur `least` times; (lang, n): all words of each language."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), text_of(text).alias("text")).where("text <> ''")
    most_mass = LONGEST * ((texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0) // 2 + 1)
    partitions = -(-most_mass // partition_mass)
    bits = 1 << min(FILTER_BITS, max(LEAST_BITS, (most_mass // MASS_A_BIT).bit_length()))
    region = max(8, bits // partitions // 8 * 8)
    sketched = cut(_sketched(texts, partitions, size))
    words = sketched.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("words").alias("n"))
    marks = {r["part"]: r["bits"] for r in survivors(sketched, least, region * partitions, partitions).collect()}  # at most 2 ** FILTER_BITS bits in all
    none = bytes(region // 8)
    shared = spark.sparkContext.broadcast(b"".join(marks.get(k, none) for k in range(partitions)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = tester(shared.value, region, partitions)
        for chunk in chunks(_stream(batches), size):
            for phrases, counts in chunk.counted(wanted):
                yield pa.RecordBatch.from_arrays([pa.array([chunk.lang] * len(phrases), pa.string()), pa.array(phrases, pa.string()), pa.array(counts, pa.int64())], names=["lang", "phrase", "n"])

    counted = texts.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return cut(counted), words


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, size: int = CHUNK, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language."""
    counts, words = frequent(docs, least, size, lang, text)
    split = counts.withColumn("w", F.split("phrase", " ")).withColumn("k", F.size("w"))
    candidates = split.where("k > 1")
    joined = lambda first, length: F.array_join(F.slice("w", first, length), " ")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "w", F.col("k").alias("size"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("k"))
    sides = F.explode(F.array(F.struct(F.lit("l").alias("side"), joined(F.lit(1), F.col("k")).alias("part")), F.struct(F.lit("r").alias("side"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("part"))))
    asked = cuts.select("lang", "phrase", "a", "k", sides.alias("s")).select("lang", "phrase", "a", "k", "s.side", "s.part")
    found = asked.join(counts.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("f"))).alias(side)
    scored = found.groupBy("lang", "phrase", "a", "k").agg(of("l"), of("r"))
    scored = scored.withColumn("score", F.expr("CAST(a AS DECIMAL(20, 0)) * 2000000 div CAST(CAST(l AS DECIMAL(20, 0)) + r AS DECIMAL(21, 0))"))
    worst = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    longer = split.where("k > 2").select("lang", "f", F.explode(F.array(joined(F.lit(1), F.col("k") - 1), joined(F.lit(2), F.col("k") - 1))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = worst.join(longer, ["lang", "phrase"], "left").where(F.expr(f"longer IS NULL OR CAST(longer AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * {covered}"))
    order = (F.desc("score"), F.desc("a"), "phrase")
    in_part = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))).orderBy(*order))
    first = kept.withColumn("rank", in_part).where(F.col("rank") <= top).drop("rank")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    columns = ["phrase", "a", "l", "r", "n", "score"]
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), *columns)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase, k FROM w, range(1, 5) s(k) WHERE len(w) >= k),
f AS (SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY lang, phrase, k HAVING count(*) >= 30),
c AS (SELECT lang, phrase, k AS size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
x AS (SELECT c.*, s.k, l.f AS l, r.f AS r, (2000000::HUGEINT * a // (l.f + r.f))::BIGINT AS score FROM c JOIN range(1, 4) s(k) ON s.k < size
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:s.k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[s.k + 1:], ' ')),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
z AS (SELECT * FROM y WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = y.lang AND c.size > y.size AND 100 * c.a >= 80 * y.a AND contains(concat(' ', c.phrase, ' '), concat(' ', y.phrase, ' '))))
SELECT z.lang, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) QUALIFY rank <= 2000
"""
