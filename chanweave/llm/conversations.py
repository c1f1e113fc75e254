"""Conversation structure repair: grammar-compressed dynamic programming over roles and faults.

Every row of a conversation is one of nine symbols: a row that must go (blank, or seen before), or the class of its role
(system, user, assistant, other) with or without a truncated text. A symbol is a min-plus matrix over the four states of
the pattern `(s?(ua)+)?` (nothing yet, after system, after user, after assistant); an entry holds the cost of the cheapest
edits from one state to another and their audit as a rope, of which equal costs keep the ASCII-least. Equally cheap audits
of the same rows never begin with one another (further inserts cost), so the least one of a product is a product of least
ones, and matrices multiply in any grouping.

Re-Pair: the symbol sequences of all conversations, each distinct one once with its number of occurrences, are compressed
together. Each round counts neighbouring symbols, makes rules of the commonest pairs (at most `A_ROUND`, counted at least
twice) and rewrites the sequences; there are at most `RULES` rules, a bound on compression alone. A rule's matrix is the
product of its two symbols' matrices, made once, bottom up, in every task; a conversation is the product of the few
symbols that are left.

Rows are put in order by ranges, and a sequence is cut where its range or 4096 rows end, so a long conversation is
compressed and multiplied in many tasks. The last step streams each conversation in order through one task in memory that
its audit bounds: SHA-256 is sequential. Equal rows of a conversation are counted first and are one row until then.

Defined cases: null role or text counts as one space; in order, null turns come first, and rows of one turn follow by role
and text (each by its first 64 characters, the rest by hash). A role's class is its first character; an empty role is of
class other. Conversations whose id is null are one conversation. A conversation without rows keeps its place in the
result with zeros. Very long texts are read whole, once each for its fault and its digest. An empty table gives an empty
result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import cut, read, release

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SEGMENT_BITS, PREFIX = 12, 64
RULES, A_ROUND, FIRST_RULE = 256, 32, 0x100
REMEMBERED = 1 << 16

#: States of the pattern: nothing yet, after system, after user, after assistant. Where each role leads from each state.
STATES, FINAL = 4, (0, 3)
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
GONE = "d"
LEGAL = ("su", "ua", "au")


class Rope:
    """A string as a tree that shares its parts; equal hashes stand for equal parts in comparisons."""

    __slots__ = ("size", "hash", "left", "right", "text")
    BASE, MODULUS = 1_000_003, (1 << 61) - 1

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.left, self.right, self.text = left, right, text
        if left is None:
            self.size, self.hash = len(text), ord(text) if text else 0
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * pow(self.BASE, right.size, self.MODULUS) + right.hash) % self.MODULUS

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return other if not self.size else self
        return Rope(left=self, right=other)

    def __lt__(self, other: Rope) -> bool:
        mine, theirs = [self], [other]
        while mine and theirs:
            x, y = mine.pop(), theirs.pop()
            if x is y or (x.size == y.size and x.hash == y.hash):
                continue
            if x.left is None and y.left is None:
                return x.text < y.text
            if x.left is not None and (y.left is None or x.size >= y.size):
                mine += [x.right, x.left]
                theirs.append(y)
            else:
                theirs += [y.right, y.left]
                mine.append(x)
        return bool(theirs)

    def __str__(self) -> str:
        out, rest = [], [self]
        while rest:
            x = rest.pop()
            if x.left is None:
                out.append(x.text)
            else:
                rest += [x.right, x.left]
        return "".join(out)


EMPTY, KEPT, REROLED, DELETED, INSERTED = Rope(), Rope("K"), Rope("R"), Rope("D"), Rope("I")
Entry = tuple[int, Rope] | None


def cheaper(x: Entry, y: Entry) -> Entry:
    if x is None or y is None:
        return x or y
    return x if x[0] < y[0] or (x[0] == y[0] and not y[1] < x[1]) else y


def applied(row: list[Entry], matrix: list[list[Entry]]) -> list[Entry]:
    """A row of the min-plus product."""
    out: list[Entry] = [None] * STATES
    for k, x in enumerate(row):
        if x is not None:
            for j, y in enumerate(matrix[k]):
                if y is not None and (out[j] is None or x[0] + y[0] <= out[j][0]):
                    out[j] = cheaper(out[j], (x[0] + y[0], x[1] + y[1]))
    return out


def times(a: list[list[Entry]], b: list[list[Entry]]) -> list[list[Entry]]:
    return [applied(row, b) for row in a]


def start(state: int) -> list[Entry]:
    return [(0, EMPTY) if k == state else None for k in range(STATES)]


def inserts() -> list[list[Entry]]:
    """Any number of inserted rows; going around costs more than staying."""
    out = [start(k) for k in range(STATES)]
    for k in range(STATES):
        at, rope, cost = k, EMPTY, 0
        for _ in range(2):
            at = NEXT["u"].get(at, NEXT["a"].get(at))
            rope, cost = rope + INSERTED, cost + INSERT
            out[k][at] = cheaper(out[k][at], (cost, rope))
    return out


def symbol_matrix(symbol: str) -> list[list[Entry]]:
    """Inserts before a row, then what becomes of the row. An upper-case symbol is a truncated row."""
    out: list[list[Entry]] = [[None] * STATES for _ in range(STATES)]
    for state in range(STATES):
        out[state][state] = (DELETE, DELETED)
        if symbol != GONE:
            more = TRUNCATED if symbol.isupper() else 0
            for role in "ua":
                if state in NEXT[role]:
                    out[state][NEXT[role][state]] = (REROLE + more, REROLED)
            kept = NEXT.get(symbol.lower(), {}).get(state)
            if kept is not None:
                out[state][kept] = (more, KEPT)
    return times(inserts(), out)


SYMBOLS = "suaxSUAX" + GONE


def matrices(rules: list[str]) -> dict[str, list[list[Entry]]]:
    """The matrix of every symbol, those of rules bottom up."""
    out = {s: symbol_matrix(s) for s in SYMBOLS}
    for k, (left, right) in enumerate(rules):
        out[chr(FIRST_RULE + k)] = times(out[left], out[right])
    return out


def encode(sequence: str, rules: list[str]) -> str:
    for k, pair in enumerate(rules):
        sequence = sequence.replace(pair, chr(FIRST_RULE + k))
    return sequence


def learn_rules(sequences: DataFrame, most: int = RULES, a_round: int = A_ROUND) -> list[str]:
    """sequence -> pairs of symbols; rule k is the symbol FIRST_RULE + k. Counts cover all sequences."""
    rules: list[str] = []
    table = cut(sequences.where(F.length("sequence") > 1).groupBy("sequence").agg(F.count(F.lit(1)).alias("n")))
    while len(rules) < most:
        symbols = F.split("sequence", "")
        pairs = F.zip_with(symbols, F.slice(symbols, 2, F.size(symbols)), lambda x, y: F.concat(x, y))
        counted = table.select(F.explode(pairs).alias("pair"), "n").where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        common = [r["pair"] for r in counted.orderBy(F.desc("n"), "pair").limit(min(a_round, most - len(rules))).collect()]
        if not common:
            break
        first, before = FIRST_RULE + len(rules), table
        encoded = reduce(lambda x, kp: F.replace(x, F.lit(kp[1]), F.lit(chr(first + kp[0]))), enumerate(common), F.col("sequence"))
        table = cut(table.select(encoded.alias("sequence"), "n").where(F.length("sequence") > 1))
        release(before)
        rules += common
    release(table)
    return rules


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copies: rows after damage by the checksum of `conv_id:turn`; dropped ones have no copies."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(space(conv_id), F.lit(":"), space(turn))) % 20
    said = F.when(hit == 1, "").when(hit == 2, F.translate(space(text), ENDS, "")).otherwise(space(text))
    return rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.when(hit == 4, "user").otherwise(space(role)).alias("role"), said.alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _placed(rows: DataFrame) -> DataFrame:
    """Distinct rows with their copies and `at`, which grows along each conversation."""
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    order = {"role_start": F.left("role", F.lit(PREFIX)), "text_start": F.left("text", F.lit(PREFIX)), "rest": F.xxhash64("role", "text")}
    keys = ["conv_id", "turn", *order]
    dealt = once.withColumns(order).repartitionByRange(*keys).sortWithinPartitions(*keys, "role", "text")
    return cut(dealt.drop(*order).withColumn("at", F.monotonically_increasing_id()))


def _symbols(placed: DataFrame) -> DataFrame:
    """conv_id, at, copies, initial, kind (blank, duplicate, truncated or none) and run, the symbols of all copies."""
    said = F.rtrim("text", F.lit(BLANKS))
    again = lambda x: F.concat(F.length(x).cast("string"), F.lit(":"), x)
    own = F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.col("conv_id").isNull().cast("string"), again(F.col("role")), F.col("text")), 256)
    first = F.left("role", F.lit(1))
    rows = placed.select(
        "conv_id", "at", "copies", own.alias("own"), F.when(first.isin("s", "u", "a"), first).otherwise("x").alias("initial"),
        F.when(said == "", "blank").when(~F.right(said, F.lit(1)).isin(*ENDS), "truncated").alias("kind"),
    )
    repeated = rows.where("copies > 0 AND kind IS DISTINCT FROM 'blank'").groupBy("own").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(repeated.select("own", "first"), "own", "left")
    seen = F.coalesce(F.col("at") > F.col("first"), F.lit(False)) & ~F.col("kind").eqNullSafe("blank")
    rows = rows.withColumn("kind", F.when(seen, "duplicate").otherwise(F.col("kind"))).drop("own", "first")
    symbol = F.when(F.col("kind").isin("blank", "duplicate"), GONE).when(F.col("kind") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    run = F.when(F.col("copies") > 0, F.concat(symbol, F.repeat(F.lit(GONE), (F.col("copies") - 1).cast("int")))).otherwise("")
    return rows.withColumn("run", run)


def _segments(symbols: DataFrame) -> DataFrame:
    """conv_id, segment, sequence, initials and counts: at most 4096 rows of one conversation, in order."""
    of = lambda kind, n: F.sum(F.when(F.col("kind") == kind, n).otherwise(0)).alias(kind)
    copies, there = F.col("copies"), F.when(F.col("copies") > 0, F.col("initial")).otherwise("")
    rows = F.sort_array(F.collect_list(F.struct("at", "run", there.alias("initial"))))
    again = F.greatest(copies - 1, F.lit(0))
    counted = symbols.groupBy("conv_id", F.shiftright("at", SEGMENT_BITS).alias("segment")).agg(
        rows.alias("rows"), of("blank", copies), F.sum(F.when(F.col("kind") == "duplicate", copies).when(F.col("kind") == "blank", 0).otherwise(again)).alias("duplicate"),
        of("truncated", F.least(copies, F.lit(1))), F.sum(again).alias("illegal"),
    )
    joined = lambda f: F.array_join(F.transform("rows", lambda x: x[f]), "")
    return counted.withColumns({"sequence": joined("run"), "initials": joined("initial")}).drop("rows")


SEGMENT_FIELDS = ("blank", "duplicate", "truncated", "illegal")


def illegal_pairs(initials: str) -> int:
    return sum(initials[k : k + 2] not in LEGAL for k in range(len(initials) - 1))


def _evaluated(segments: DataFrame, rules: list[str]) -> DataFrame:
    """Adds costs and audits: a segment's matrix, row by row; null where no edits lead from one state to the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, known = matrices(rules), {}
        for batch in batches:
            costs, audits, illegal, ends = [], [], [], []
            for sequence, initials, more in zip(batch["sequence"].to_pylist(), batch["initials"].to_pylist(), batch["illegal"].to_pylist(), strict=True):
                if sequence not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    rows = [reduce(applied, (of[x] for x in encode(sequence, rules)), start(s)) for s in range(STATES)]
                    flat = [x for row in rows for x in row]
                    known[sequence] = [x and x[0] for x in flat], [x and str(x[1]) for x in flat]
                c, a = known[sequence]
                costs.append(c)
                audits.append(a)
                illegal.append(more + illegal_pairs(initials))
                ends.append(initials[:1] + initials[-1:])
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in ("conv_id", "segment", "blank", "duplicate", "truncated")], pa.array(illegal, pa.int64()), pa.array(ends, pa.string()), pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))],
                names=["conv_id", "segment", "blank", "duplicate", "truncated", "illegal", "ends", "costs", "audits"],
            )

    kind = dict(segments.dtypes)["conv_id"]
    rows = segments.select("conv_id", "segment", "sequence", "initials", *SEGMENT_FIELDS)
    return rows.mapInArrow(run, f"conv_id {kind}, segment long, blank long, duplicate long, truncated long, illegal long, ends string, costs array<long>, audits array<string>")


class _Conversation:
    """One conversation as it streams by: first its segments, then its rows, both in order."""

    def __init__(self, conv_id):
        self.conv_id, self.counts, self.row, self.last = conv_id, dict.fromkeys(SEGMENT_FIELDS, 0), [(0, ""), None, None, None], ""
        self.audit, self.cost, self.at, self.state, self.pos = None, 0, 0, 0, 0
        self.digest, self.least, self.most, self.turns, self.turn = hashlib.sha256(), None, None, 0, None

    def add_segment(self, s: dict) -> None:
        out: list[tuple[int, str] | None] = [None] * STATES
        for k, x in enumerate(self.row):
            if x is not None:
                for j in range(STATES):
                    cost, audit = s["costs"][k * STATES + j], s["audits"][k * STATES + j]
                    if cost is not None:
                        found = (x[0] + cost, x[1] + audit)
                        out[j] = found if out[j] is None else min(out[j], found)
        self.row = out
        for c in SEGMENT_FIELDS:
            self.counts[c] += s[c]
        if s["ends"]:
            self.counts["illegal"] += bool(self.last) and self.last + s["ends"][0] not in LEGAL
            self.last = s["ends"][-1]

    def settle(self) -> None:
        if self.audit is None:
            last = inserts()
            ways = [(x[0] + y[0], x[1] + str(y[1])) for k, x in enumerate(self.row) if x is not None for y in (last[k][j] for j in FINAL) if y is not None]
            self.cost, self.audit = min(ways)

    def _put(self, role: str, text: str) -> tuple:
        self.digest.update((("\n" if self.pos else "") + role + ":" + text).encode())
        self.pos += 1
        self.state = NEXT[role[0]][self.state]
        return self.conv_id, self.pos, role, text

    def _inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield (*self._put("assistant" if self.state == 2 else "user", ""), "I")

    def add_row(self, turn, role: str, text: str, copies: int) -> Iterator[tuple]:
        """Repaired rows that lie before the row's end."""
        self.settle()
        if turn is not None:
            self.turns += self.turns == 0 or turn != self.turn
            self.least, self.most, self.turn = turn if self.least is None else self.least, turn, turn
        for _ in range(copies):
            yield from self._inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                yield (*self._put(role if edit == "K" else "assistant" if self.state == 2 else "user", text), edit)

    def end(self) -> Iterator[tuple]:
        self.settle()
        yield from self._inserted()

    def summary(self) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, *(self.counts[c] for c in SEGMENT_FIELDS), self.cost, self.audit, self.digest.hexdigest()


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
REPAIRED = "pos long, role string, text string, edit string"
FLUSH_ROWS = 4096


def _streamed(placed: DataFrame, evaluated: DataFrame, rows_out: bool) -> DataFrame:
    kind = dict(placed.dtypes)["conv_id"]
    heads = evaluated.select("conv_id", F.lit(0).alias("kind"), F.col("segment").alias("at"), F.struct(*SEGMENT_FIELDS, "ends", "costs", "audits").alias("s"))
    body = placed.where("copies > 0").select("conv_id", F.lit(1).alias("kind"), "at", F.struct(F.col("turn").cast("long").alias("turn"), "role", "text", "copies").alias("r"))
    both = heads.unionByName(body, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "at")
    schema = f"conv_id {kind}, {REPAIRED if rows_out else SUMMARY}"
    as_arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(as_arrow)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, as_arrow, strict=True)], schema=as_arrow)

        def ended() -> None:
            if now is not None:
                rest = list(now.end())
                out.extend(rest if rows_out else [now.summary()])

        for batch in batches:
            for conv_id, head, s, r in zip(*(batch[c].to_pylist() for c in ("conv_id", "kind", "s", "r")), strict=True):
                if now is None or now.conv_id != conv_id:
                    ended()
                    now = _Conversation(conv_id)
                if head == 0:
                    now.add_segment(s)
                    continue
                for x in now.add_row(r["turn"], r["role"], r["text"], r["copies"]):
                    if rows_out:
                        out.append(x)
                if len(out) >= FLUSH_ROWS:
                    yield flushed()
        ended()
        yield flushed()

    return both.select("conv_id", "kind", "s", "r").mapInArrow(run, schema)


def repair(rows: DataFrame, rows_out: bool = False, rules: int = RULES) -> DataFrame:
    """conv_id, turn, role, text, copies -> a summary of each conversation, or its repaired rows (conv_id, pos, role, text, edit)."""
    placed = _placed(rows)
    segments = cut(_segments(_symbols(placed)))
    return _streamed(placed, _evaluated(segments, learn_rules(segments, rules)), rows_out)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(read(spark, sf_dir, "conversations")))


ORACLE_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT range AS byte, 0 AS k, range::BIGINT AS v FROM range(256)
  UNION ALL SELECT byte, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY byte) AS t FROM bits WHERE k = 8),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  [ord(x)::BIGINT FOR x IN string_split(concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')), '')] AS bytes FROM conversations),
h AS (SELECT c.*, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS hit FROM c, crc),
d AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN hit = 1 THEN '' WHEN hit = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM h, range(2) r(copy) WHERE hit <> 0 AND (copy = 0 OR hit = 3)),
p AS (SELECT *, row_number() OVER w AS pos, lag(role) OVER w AS before FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
q AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again FROM p),
f AS (SELECT *, left(role, 1) AS i, CASE WHEN said = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM q),
g AS (SELECT conv_id, (max(turn) - min(turn) + 1 - count(DISTINCT turn))::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (pos > 1 AND left(before, 1) || ',' || i NOT IN ('s,u', 'u,a', 'a,u')) AS illegal, count(*) AS n FROM f GROUP BY conv_id),
v AS (
  SELECT conv_id, 0::BIGINT AS pos, {'c': 0, 'a': ''} AS w0, {'c': 99999999, 'a': ''} AS w1, {'c': 99999999, 'a': ''} AS w2, {'c': 99999999, 'a': ''} AS w3 FROM g
  UNION ALL
  SELECT conv_id, pos, list_sort([d0])[1], list_sort([d1, s1])[1], list_sort([d2, k2, r2])[1], list_sort([d3, k3, r3])[1] FROM (
    SELECT conv_id, pos,
      {'c': j0.c + 3, 'a': j0.a || 'D'} AS d0, {'c': j1.c + 3, 'a': j1.a || 'D'} AS d1, {'c': j2.c + 3, 'a': j2.a || 'D'} AS d2, {'c': j3.c + 3, 'a': j3.a || 'D'} AS d3,
      {'c': CASE WHEN free AND i = 's' THEN j0.c + t ELSE 99999999 END, 'a': j0.a || 'K'} AS s1,
      {'c': CASE WHEN free AND i = 'u' THEN u.c + t ELSE 99999999 END, 'a': u.a || 'K'} AS k2, {'c': CASE WHEN free THEN u.c + t + 2 ELSE 99999999 END, 'a': u.a || 'R'} AS r2,
      {'c': CASE WHEN free AND i = 'a' THEN j2.c + t ELSE 99999999 END, 'a': j2.a || 'K'} AS k3, {'c': CASE WHEN free THEN j2.c + t + 2 ELSE 99999999 END, 'a': j2.a || 'R'} AS r3
    FROM (SELECT *, list_sort([j0, j1, j3])[1] AS u FROM (
      SELECT v.conv_id, v.pos + 1 AS pos, w0 AS j0, w1 AS j1, f.i, f.fault IS NULL OR f.fault = 'truncated' AS free, CASE WHEN f.fault = 'truncated' THEN 1 ELSE 0 END AS t,
        list_sort([w2, {'c': w0.c + 2, 'a': w0.a || 'I'}, {'c': w1.c + 2, 'a': w1.a || 'I'}, {'c': w3.c + 2, 'a': w3.a || 'I'}])[1] AS j2,
        list_sort([w3, {'c': w2.c + 2, 'a': w2.a || 'I'}, {'c': w0.c + 4, 'a': w0.a || 'II'}, {'c': w1.c + 4, 'a': w1.a || 'II'}])[1] AS j3
      FROM v JOIN f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.pos = v.pos + 1)))),
e AS (SELECT v.conv_id, list_sort([w0, w3, {'c': w2.c + 2, 'a': w2.a || 'I'}, {'c': w0.c + 4, 'a': w0.a || 'II'}, {'c': w1.c + 4, 'a': w1.a || 'II'}])[1] AS best
  FROM v JOIN g ON g.conv_id IS NOT DISTINCT FROM v.conv_id AND v.pos = g.n),
o AS (SELECT conv_id, k, x, sum((x <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY k) AS pos
  FROM (SELECT conv_id, unnest(string_split(best.a, '')) AS x, generate_subscripts(string_split(best.a, ''), 1) AS k FROM e)),
m AS (SELECT o.conv_id, k, x, row_number() OVER (PARTITION BY o.conv_id ORDER BY k) AS place, f.role, f.text,
  first_value(x = 'K' AND f.i = 's') OVER (PARTITION BY o.conv_id ORDER BY k) AS headed
  FROM o LEFT JOIN f ON x <> 'I' AND f.conv_id IS NOT DISTINCT FROM o.conv_id AND f.pos = o.pos WHERE x IN ('K', 'R', 'I')),
r AS (SELECT conv_id, string_agg(CASE WHEN x = 'K' THEN role WHEN (place - coalesce(headed, FALSE)::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END
  || ':' || CASE WHEN x = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS whole FROM m GROUP BY conv_id)
SELECT n.conv_id, coalesce(g.gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) n LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM n.conv_id
LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM n.conv_id
"""
