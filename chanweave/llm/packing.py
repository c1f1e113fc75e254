"""Packing by power-of-two decomposition.

A document's token ids (with the end id) are cut into pieces whose lengths are the powers of two of its length in
binary, with as many whole pieces of `capacity` (itself a power of two) as fit. Each piece is a sequence of its own in
the bucket of its length, so no sequence crosses documents and none needs padding; a batch is filled from one bucket.

Tokenising is local to a row; only the pieces' numbers are shuffled (or the pieces, where the ids are asked for). The ids are those the tokenizers library gives. Texts of Latin
letters go through tiktoken with the same vocabulary (`ranks`), which gives the same ids several times faster (a test
compares them); texts with any character from U+0250 on, where the two might disagree on a character's class, and texts
with a run of 20,000 blanks go through the tokenizers library.

Defined cases: null text is empty and gives the end id alone; rows that repeat an id are packed each; an empty table
gives an empty result; special-token strings in a text are ordinary text; a text of any length stays in its row; only the id and text columns are
read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import numbered
from .common import cut, read

LATIN_END = "\u0250"
#: A run of white space this long goes to the tokenizers library: tiktoken's expression recurses over such runs.
LONG_BLANK = 20_000
BLANKS = re.compile(r"\s{8,}")
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, offset long, bucket int"


class Encoder:
    """Token ids of a text as packed little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        """path: tokenizers file; ranks, pattern: tiktoken file and split pattern of the same vocabulary, if there is one."""
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as file:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("same", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary

    @staticmethod
    def latin(text: str) -> bool:
        try:
            text.encode("latin-1")  # much faster than max(), and enough for most texts
        except UnicodeEncodeError:
            return max(text) < LATIN_END
        return True

    @staticmethod
    def long_blank(text: str) -> bool:
        """Each run is matched once and measured."""
        return len(text) >= LONG_BLANK and any(m.end() - m.start() >= LONG_BLANK for m in BLANKS.finditer(text))

    def encode(self, text: str) -> bytes:
        fast = self.fast and self.latin(text) and not self.long_blank(text)
        ids = self.fast(text) if fast else self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole capacities, then the remainder's powers of two, largest first."""
    found = [(i * capacity, capacity) for i in range(n // capacity)]
    at, bit = n - n % capacity, capacity >> 1
    while bit:
        if n & bit:
            found.append((at, bit))
            at += bit
        bit >>= 1
    return found


def pack(
    docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, capacity: int = 1024, end_id: int = 0,
    doc_id: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """One row per piece. bucket is the base-2 logarithm of the length. with_ids adds the ids.

    sequence_id counts the pieces from 1 in the order of bucket, document and place, so it does not depend on how the
    rows lie in files or tasks.

    tokenizer, ranks: paths of files at the same place on every executor.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(tokenizer, ranks, pattern)
        for batch in batches:
            ids, texts = batch["id"].tolist(), batch["text"].tolist()
            for lo in range(0, len(texts), 256):
                out = []
                for i, content in zip(ids[lo : lo + 256], texts[lo : lo + 256], strict=True):
                    packed = encoder.encode(content) + end
                    n = len(packed) // 4
                    for start, length in cuts(n, capacity):
                        piece, bucket = packed[4 * start : 4 * (start + length)], length.bit_length() - 1
                        row = (i, start, length, zlib.crc32(piece), n, 0, bucket)
                        out.append((*row, np.frombuffer(piece, dtype="<u4").astype(np.int32)) if with_ids else row)
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset", "bucket"] + ["ids"] * with_ids
                yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Cut, as dealing out by ranges reads its input twice.
    pieces = cut(rows.mapInPandas(run, PIECE_SCHEMA + ", ids array<int>" * with_ids))
    return numbered(pieces, "bucket", "doc_id", "start", "ids_crc32", "doc_tokens", name="sequence_id")


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write pieces (with ids) with one folder per length, as a trainer reads them."""
    pieces.write.mode("overwrite").partitionBy("bucket").parquet(path)


def pack_public(docs: DataFrame) -> DataFrame:
    """pack() with the public byte-level vocabulary of 50,257 ids and production parameters."""
    import public_tokenizers as public

    return pack(docs, public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_public(read(spark, sf_dir, "documents"))
