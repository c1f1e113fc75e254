"""Secret scanning with a trigram inverted index, in DataFrame operations only.

Each rule's regular expression gives a Boolean trigram query: every stretch of the pattern that can only be one of a few
strings asks for one of them, and a string asks for all its trigrams. The index has a posting (trigram, document) for
each trigram of the queries that a document holds, letters folded. Postings are intersected per document, and only the
candidates of a rule meet its expression. A rule without mandatory trigrams (runs of hexadecimal digits) scans all texts.

Match places come from the lengths of the matches and of what stands between them, summed in a window over the
document's matches of a rule; lengths are in code points.

Defined cases: null text is empty; a document without a match gives zero counts and the digest of an empty string; rows
that repeat id and text get the same answer; an empty table gives an empty result; texts are scanned whole, however long.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product
from operator import and_, or_
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, text_of


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # whose length counts
    least: int = 1
    base: bool = True


#: The base rules as the task states them, then further kinds of well-known public key formats. The least
#: length of a run is part of its pattern, which gives the same matches (runs are maximal) and no rows for short runs.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}", base=False),
)
MOST_STRINGS = 64


def _joined(left: set[str], right: set[str]) -> set[str] | None:
    return {a + b for a, b in product(left, right)} if len(left) * len(right) <= MOST_STRINGS else None


def _exact(items) -> set[str] | None:
    """The strings (folded) that the items match, if they are few; else None."""
    found: set[str] | None = {""}
    for kind, value in items:
        if kind is op.LITERAL:
            own = {chr(value).lower()}
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value):
            own = {chr(v).lower() for _, v in value}
        elif kind is op.SUBPATTERN:
            own = _exact(value[-1])
        elif kind is op.BRANCH:
            each = [_exact(x) for x in value[1]]
            own = None if None in each else set().union(*each)
        elif kind is op.MAX_REPEAT and value[1] == 1:
            own = _exact(value[2])
            own = own and own | ({""} if value[0] == 0 else set())
        else:
            own = None
        found = own and _joined(found, own)
        if found is None:
            return None
    return found


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """AND of ORs of trigram sets that any match must hold; empty where nothing is mandatory."""
    stretches, now = [], {""}
    for item in parser.parse(pattern):
        own = _exact([item])
        longer = own and _joined(now, own)
        if longer is None:
            stretches.append(now)
            now = own or {""}
        else:
            now = longer
    stretches.append(now)
    sets = [{frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in x} for x in stretches if min(map(len, x)) >= 3]
    return [sorted((s for s in x if not any(t < s for t in x)), key=sorted) for x in sets]  # a wider set adds nothing to its subset


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, key) of documents (key, text) for the trigrams asked for."""
    held = F.array_compact(F.array(*[F.when(F.col("folded").contains(t), F.lit(t)) for t in trigrams]))
    return docs.select("key", F.lower("text").alias("folded")).select(F.explode(held).alias("trigram"), "key")


def candidates(postings: DataFrame, queries: dict[str, list[list[frozenset[str]]]]) -> DataFrame:
    """(key, kinds): the kinds whose trigram query a document's postings satisfy."""
    def holds(query) -> Column:
        has = lambda t: F.array_contains("held", t)
        return reduce(and_, [reduce(or_, [reduce(and_, map(has, sorted(s))) for s in strings]) for strings in query])

    held = postings.groupBy("key").agg(F.collect_set("trigram").alias("held"))
    kinds = F.array_compact(F.array(*[F.when(holds(q), F.lit(k)) for k, q in queries.items()]))
    return held.select("key", kinds.alias("kinds")).where(F.size("kinds") > 0)


def _matches(rows: DataFrame, rules: list[Rule], wanted) -> DataFrame:
    """(key, kind, at, gap, length, counted): every match of the rules for which wanted(rule) holds."""
    def lengths(parts: Column) -> Column:
        return F.transform(parts, F.length)

    def found(rule: Rule) -> Column:
        pattern = F.lit(rule.pattern)
        fields = F.struct(
            F.lit(rule.kind).alias("kind"), lengths(F.split("text", rule.pattern, -1)).alias("gap"),
            lengths(F.regexp_extract_all("text", pattern, F.lit(0))).alias("length"),
            lengths(F.regexp_extract_all("text", pattern, F.lit(rule.group))).alias("counted"),
        )
        return F.when(wanted(rule) & F.col("text").rlike(rule.pattern), fields)

    each = rows.select("key", F.explode(F.array_compact(F.array(*map(found, rules)))).alias("m"))
    place = F.posexplode(F.arrays_zip("m.gap", "m.length", "m.counted")).alias("at", "z")
    return each.select("key", "m.kind", place).select("key", "kind", "at", "z.gap", "z.length", "z.counted").where("length IS NOT NULL")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, kind, start, end) for every span of every rule; key is struct(doc_id, hash of the text)."""
    texts = docs.select(F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("hash")).alias("key"), text_of(text).alias("text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed, full = [r for r in rules if queries[r.kind]], [r for r in rules if not queries[r.kind]]
    found = []
    if full:
        found.append(_matches(texts, full, lambda r: F.lit(True)))
    if indexed:
        asked = {r.kind: queries[r.kind] for r in indexed}
        trigrams = sorted({t for q in asked.values() for strings in q for s in strings for t in s})
        chosen = texts.join(candidates(build_index(texts, trigrams), asked), "key")
        found.append(_matches(chosen, indexed, lambda r: F.array_contains("kinds", r.kind)))
    matches = reduce(DataFrame.unionByName, found).distinct()  # rows that repeat id and text
    so_far = Window.partitionBy("key", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    least = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.least)])
    placed = matches.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(so_far))
    return placed.where(F.col("counted") >= least[F.col("kind")]).select("key", "kind", (F.col("end") - F.col("length")).alias("start"), "end")


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: counts of the base kinds, the digest of the base spans, and all spans."""
    base = [r.kind for r in rules if r.base]
    order = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.kind, k)])
    name = F.concat_ws(":", "kind", "start", "end")
    spans = scan(docs, rules, doc_id, text).withColumn("span", F.struct("start", order[F.col("kind")].alias("order"), name.alias("name"), "kind"))
    listed = spans.groupBy("key").agg(F.sort_array(F.collect_list("span")).alias("all"))
    joined = lambda x: F.array_join(F.transform(x, lambda s: s["name"]), ",")
    of_base = F.filter("all", lambda s: s["kind"].isin(base))
    count = lambda kind: F.size(F.filter("all", lambda s: s["kind"] == kind)).alias(f"n_{kind}")
    listed = listed.select("key", joined(F.col("all")).alias("spans"), joined(of_base).alias("base"), *map(count, base))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("hash")).alias("key"))
    return rows.join(listed, "key", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(read(spark, sf_dir, "documents"))


def _oracle() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rules = ", ".join(f"({k}, {quoted(r.kind)}, {quoted(r.pattern)}, {r.least}, {r.base})" for k, r in enumerate(RULES))
    counts = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in RULES if r.base)
    counted = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in RULES if r.base)
    return f"""
WITH r AS (SELECT * FROM (VALUES {rules}) AS t(k, kind, pattern, least, base)),
x AS (SELECT doc_id, r.*, regexp_extract_all(text, pattern) AS m, string_split_regex(text, pattern) AS s,
             CASE WHEN kind = 'assign' THEN regexp_extract_all(text, pattern, 2) ELSE regexp_extract_all(text, pattern) END AS g
      FROM documents JOIN r ON regexp_matches(text, pattern)),
y AS (SELECT doc_id, k, kind, least, base, unnest(m) AS m, unnest(g) AS g, unnest(s[1:len(m)]) AS s, unnest(range(len(m))) AS i FROM x),
z AS (SELECT *, CAST(sum(length(m) + length(s)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS e FROM y),
f AS (SELECT *, e - length(m) AS a, concat(kind, ':', e - length(m), ':', e) AS span FROM z WHERE length(g) >= least),
o AS (SELECT doc_id, {counted}, string_agg(span, ',' ORDER BY a, k) FILTER (base) AS base, string_agg(span, ',' ORDER BY a, k) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents d LEFT JOIN o ON d.doc_id = o.doc_id"""


ORACLE_SQL = _oracle()


def spans_by_brute_force(text: str | None, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """What the tests compare with."""
    found = []
    for k, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or ""):
            if len(m.group(r.group)) >= r.least:
                found.append((m.start(), k, r.kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]
