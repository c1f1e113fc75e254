"""N-gram Jaccard join: a forest of signature trees over an exact partition of the documents.

A document is the set of its distinct word shingles (64-bit hashes). Equal sets are one class. Two classes link when
100 * intersection >= percent * union.

Roots. With sizes in one band, linked sets differ in at most d tokens. The hash range is cut into more than d segments,
so linked sets agree in whole segments, and non-empty ones among them (a set with too many empty segments also files
those). All classes that share a segment are put into the group of the least class among them, so every link lies inside
a group; the many segments that two near copies share lead to few groups. There are `spare` segments more than needed, so
a set leaves out its most frequent ones, as many as are spare after its empty ones, among those that over `HOT` sets
share. Frequency is one order for all sets: of the segments in which two linked sets agree, which are more than either may
leave out, the rarest stays in both. Nothing is lost, and a frequent passage does not bring unlike documents together.

Trees. Each group is a tree whose nodes hold the OR of their members' token bitmaps and the range of their sizes. The
dual traversal starts at the root paired with itself and drops a pair of nodes when the largest possible overlap (common
bits, plus the tokens that share bits, at most the larger size) is below what their sizes need, or when all members are
already connected. What leaves the task are the members with a surviving partner, not the pairs.

Leaves. The whole sets of those members meet in the tree's task, which walks the links breadth first: a member is held
against the members not reached yet, and each link found is one of a spanning forest. So a group of m near copies emits
at most m - 1 links and never its pairs.

Large groups (over `CHUNK` members or `CHUNK_TOKENS` tokens) are dealt out in chunks. First each chunk is settled alone
and together with the first one, so rows stay in proportion to members, and the components are computed. The members of
groups of over two chunks are then filed a second time, in a fine layout of little more than a token a segment, where
sets that have a long passage in common and are unlike otherwise leave the whole passage out; groups of one component are
done with. Then only
members outside the group's largest component remain to be held against the rest: pairs of chunks inside it are left out.
Components come from alternating star contraction, every step an aggregation with map-side combine and a join that
adaptive execution can split.

Defined cases: null or wordless text has an empty set and links with nothing (component_id is the document's own id);
fewer words than a shingle give the whole sequence as one; rows that repeat an id and text share the class; null ids take
part, and a component of null ids alone has a null id; an empty table gives an empty result. Only the id and text columns
are read, so other columns may have any name; `keep_one` passes them through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read, release

SHINGLE_WORDS, PERCENT = 5, 80
LEAF, FAN_OUT = 16, 4
#: Members and tokens of a chunk; a task holds two chunks at most.
CHUNK, CHUNK_TOKENS = 1024, 3_000_000
#: Up to so many members a tree has one level.
FEW = 8
FLUSH_ROWS, BLOCK_DOCS = 8192, 500
#: Sets that share a segment from which on it may be left out.
HOT = 128
#: The last bits of a key tell its band.
BAND_BITS = 3
BAND_RATIO = 1.5
BROADCAST_BYTES = 16 << 20
MIX1, MIX2, MIX3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX2
    x = (x ^ (x >> np.uint64(27))) * MIX3
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; A-Z folded, words between ASCII white space."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    h = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
    n = len(h) - k + 1
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total = (total ^ h[j : j + n]) * MIX1 + np.uint64(j + 1)
    return np.unique(_mix(total))


def class_of(tokens: np.ndarray) -> int:
    """64-bit identity of a set."""
    import xxhash

    return xxhash.xxh64_intdigest(tokens.tobytes()) - (1 << 63)


def _bands(largest: int = 1 << 40) -> list[int]:
    found = [1]
    while found[-1] < largest:
        found.append(int(found[-1] * BAND_RATIO) + 1)
    return found


#: The least size of each band.
BANDS = np.array(_bands())


def layout(band: int, percent: int, fine: bool = False) -> tuple[int, int, np.ndarray]:
    """(most differing tokens, spare segments, where segments begin) for pairs whose larger set is in the band.

    fine: segments of about a token at 0.85, most of them spare.
    """
    differ = (100 - percent) * 2 * (int(BANDS[band + 1]) - 1) // (100 + percent)
    spare = 8 + (4 * differ if fine else differ // 8)
    segments = differ + 1 + spare
    step = (1 << 64) / segments
    return differ, spare, np.array([min(int(j * step), (1 << 64) - 1) for j in range(segments)], dtype=np.uint64)


def block_keys(tokens: np.ndarray, percent: int, layouts: dict[int, tuple], fine: bool = False) -> tuple[np.ndarray, dict[int, int]]:
    """Keys such that linked, unequal sets share one; and by band how many of them may be left out, the last ones in an
    order of all keys that is the same for all sets. layouts: remembers the layout of each band met."""
    n = len(tokens)
    own = int(np.searchsorted(BANDS, n, side="right")) - 1
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_mix(tokens), dtype=np.uint64)))
    found, room = [], {}
    for band in range(own, len(BANDS) - 1):
        if 100 * n < percent * BANDS[band]:
            break
        if band not in layouts:
            layouts[band] = layout(band, percent, fine)
        differ, spare, begins = layouts[band]
        if not differ:
            continue
        at = np.append(np.searchsorted(tokens, begins), n)
        filed = np.flatnonzero(np.diff(at))
        left_out = len(begins) - len(filed)
        if left_out > spare:
            filed = np.arange(len(begins))
        inside = sums[at[filed + 1]] - sums[at[filed]]
        keys = _mix(_mix(inside) + filed.astype(np.uint64) * MIX1 + np.full(1, band + 1, dtype=np.uint64) * MIX3)
        found.append((keys >> np.uint64(BAND_BITS) << np.uint64(BAND_BITS)) | np.uint64(band % (1 << BAND_BITS)))
        room[band % (1 << BAND_BITS)] = spare - left_out
    return np.concatenate(found).view(np.int64) if found else np.empty(0, dtype=np.int64), room


def bitmap(tokens: np.ndarray) -> bytes:
    """Token bitmap of one to two bits a token, a power of two wide: at 0.8 that rules out similarities below about 0.45."""
    width = max(64, 1 << max(0, len(tokens) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(maps: list[bytes]) -> np.ndarray:
    """Bitmaps folded to the narrowest width among them."""
    width = min(map(len, maps))
    rows = np.empty((len(maps), width), dtype=np.uint8)
    for k, m in enumerate(maps):
        rows[k] = np.bitwise_or.reduce(np.frombuffer(m, dtype=np.uint8).reshape(-1, width), axis=0)
    return rows


class Level:
    """Nodes of one level of a signature tree; members are nodes of level 0."""

    def __init__(self, bits, low, high, spare, first, last):
        self.bits, self.low, self.high, self.spare, self.first, self.last = bits, low, high, spare, first, last

    @classmethod
    def of_members(cls, maps: list[bytes], sizes: np.ndarray, groups: np.ndarray) -> Level:
        bits = _folded(maps)
        return cls(bits, sizes, sizes, sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64), groups, groups)

    def above(self, fan_out: int) -> Level:
        at = np.arange(0, len(self.low), fan_out)
        return Level(
            np.bitwise_or.reduceat(self.bits, at, axis=0), np.minimum.reduceat(self.low, at), np.maximum.reduceat(self.high, at),
            np.maximum.reduceat(self.spare, at), np.minimum.reduceat(self.first, at), np.maximum.reduceat(self.last, at),
        )

    def possible(self, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Whether nodes a and b can hold a link between different components."""
        keep = (100 * self.high[a] >= percent * self.low[b]) & (100 * self.high[b] >= percent * self.low[a])
        keep &= ~((self.first[a] == self.last[b]) & (self.first[a] == self.last[a]) & (self.first[b] == self.last[b]))
        at = np.flatnonzero(keep)
        step = max(1, 4_000_000 // self.bits.shape[1])
        for lo in range(0, len(at), step):
            k = at[lo : lo + step]
            x, y = a[k], b[k]
            common = np.bitwise_count(self.bits[x] & self.bits[y]).sum(axis=1, dtype=np.int64) + np.minimum(self.spare[x], self.spare[y])
            overlap = np.minimum(common, np.minimum(self.high[x], self.high[y]))
            keep[k] = (100 + percent) * overlap >= percent * (self.low[x] + self.low[y])
        return keep


def dual_traversal(maps: list[bytes], sizes: np.ndarray, groups: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members of different groups that the bitmaps and sizes cannot rule out."""
    order = np.argsort(sizes, kind="stable")
    levels = [Level.of_members([maps[k] for k in order], sizes[order], groups[order])]
    fans = []
    while len(levels[-1].low) > LEAF:
        fans.append(LEAF if len(levels) == 1 else FAN_OUT)
        levels.append(levels[-1].above(fans[-1]))
    a, b = np.triu_indices(len(levels[-1].low))
    for depth in range(len(levels) - 1, -1, -1):
        keep = levels[depth].possible(a, b, percent)
        a, b = a[keep], b[keep]
        if depth:
            fan, n = fans[depth - 1], len(levels[depth - 1].low)
            i, j = np.divmod(np.arange(fan * fan), fan)
            a, b = (a[:, None] * fan + i).ravel(), (b[:, None] * fan + j).ravel()
            keep = (a < n) & (b < n) & (a <= b)
            a, b = a[keep], b[keep]
    keep = a < b
    return order[a[keep]], order[b[keep]]


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of longs -> (id, component): the least id of the component, for every id that a link names."""
    def mark() -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    state, after = None, mark()
    while state != after:
        state = after
        up = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        least = edges.union(up).groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = up.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
        edges = cut(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        after = mark()
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _sets(docs: DataFrame, k: int, percent: int, fine: bool = False) -> DataFrame:
    """(doc_id, hash, n, class, bits, keys, rooms) of every row; classes met before in the task have no keys.

    rooms: how many keys of each band (by its number modulo 8) may be left out.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layouts: dict[int, tuple] = {}
        for batch in (b.iloc[lo : lo + BLOCK_DOCS] for b in batches for lo in range(0, len(b), BLOCK_DOCS)):
            found = [shingles(t, k) for t in batch["text"]]
            classes = [class_of(x) for x in found]
            seen: set[int] = set()
            keys, rooms = [], []
            for own, tokens in zip(classes, found, strict=True):
                filed = (None, {}) if own in seen or not len(tokens) else block_keys(tokens, percent, layouts, fine)
                keys.append(filed[0])
                rooms.append([filed[1].get(band, -1) for band in range(1 << BAND_BITS)] if filed[1] else None)
                seen.add(own)
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            yield batch[["doc_id", "hash"]].assign(n=sizes, **{"class": classes}, bits=[bitmap(x) for x in found], keys=keys, rooms=rooms)

    return docs.mapInPandas(run, f"{fields}, n long, class long, bits binary, keys array<long>, rooms array<int>")


def _lead_groups(sets: DataFrame) -> DataFrame:
    """(lead, id): classes that share a key, in the group of the least of them."""
    filed = sets.select(F.explode("keys").alias("key"), F.col("class").alias("id"))
    shared = filed.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("most"), F.count(F.lit(1)).alias("times"))
    # Cut, so that in the join adaptive execution can split a key that many sets share.
    shared = cut(shared.where("lead <> most").select("key", "lead", "times"))
    known = cut(filed.join(shared, "key").select("lead", "id", "key", "times"))
    release(shared)
    band = F.col("key").bitwiseAND(F.lit((1 << BAND_BITS) - 1)).cast("int").alias("band")
    # Distinct, since several tasks may have filed a class.
    hot = known.where(F.col("times") > HOT).select("lead", "id", "key", "times", band).distinct()
    rooms = sets.where("rooms IS NOT NULL").select(F.col("class").alias("id"), "rooms").dropDuplicates(["id"])
    place = F.row_number().over(Window.partitionBy("id", "band").orderBy(F.desc("times"), F.desc("key")))
    rest = hot.withColumn("place", place).join(rooms, "id").where(F.col("place") > F.get("rooms", "band"))
    groups = known.where(F.col("times") <= HOT).select("lead", "id").union(rest.select("lead", "id")).distinct()
    found = cut(groups)
    release(known)
    return found


def _few(rows: DataFrame, bytes_each: int) -> DataFrame:
    """With a broadcast hint, if the rows' number keeps them under the bound; else as they are, and Spark shuffles."""
    return F.broadcast(rows) if rows.count() * bytes_each <= BROADCAST_BYTES else rows


def _texts_of(docs: DataFrame, owners: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, doc_id, hash, text) of the classes named, from one document each."""
    named = cut(owners.join(ids, "id").select("id", "d"))
    texts = docs.select(F.struct("doc_id", "hash").alias("d"), "text").join(_few(named, 64), "d")
    return texts.select("id", "d.doc_id", "d.hash", "text")


def _tokens_of(docs: DataFrame, owners: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(id, tokens) of the classes named, from one document each; tokens are packed 64-bit integers."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (b.iloc[lo : lo + BLOCK_DOCS] for b in batches for lo in range(0, len(b), BLOCK_DOCS)):
            yield pd.DataFrame({"id": batch["id"], "tokens": [shingles(t, k).tobytes() for t in batch["text"]]})

    return _texts_of(docs, owners, ids).select("id", "text").mapInPandas(run, "id long, tokens binary").dropDuplicates(["id"])


def _trees(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
    """The columns of each tree's rows as arrays, from batches sorted by tree."""
    held: dict = {}
    for batch in batches:
        columns = {c: batch[c].to_numpy() for c in batch.columns}
        key = columns["tree"]
        if not len(key):
            continue
        bounds = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            own = {c: v[lo:hi] for c, v in columns.items()}
            if held and held["tree"][0] == own["tree"][0]:
                own = {c: np.concatenate((held[c], v)) for c, v in own.items()}
            elif held:
                yield held
            held = own
    if held:
        yield held


def few_possible(maps: list[bytes], sizes: list[int], groups: list[int], percent: int) -> list[int]:
    """Members of a tree of one level that have a possible partner; the test is that of Level.possible."""
    width = min(map(len, maps)) * 8
    bits = []
    for m in maps:
        x, own = int.from_bytes(m, "little"), len(m) * 8
        while own > width:
            own //= 2
            x = (x & ((1 << own) - 1)) | (x >> own)
        bits.append(x)
    spare = [n - x.bit_count() for n, x in zip(sizes, bits, strict=True)]
    found = set()
    for i in range(len(bits)):
        for j in range(i):
            overlap = min((bits[i] & bits[j]).bit_count() + min(spare[i], spare[j]), sizes[i], sizes[j])
            if groups[i] != groups[j] and (100 + percent) * overlap >= percent * (sizes[i] + sizes[j]):
                found.update((i, j))
    return sorted(found)


def _in_trees(rows: DataFrame, names: tuple[str, str], work) -> DataFrame:
    """work(rows of a tree) -> two arrays of longs, the columns of the result. One tree after the other in each task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, right, held = [], [], 0
        for tree in _trees(batches):
            x, y = work(tree)
            left.append(x)
            right.append(y)
            held += len(x)
            if held >= FLUSH_ROWS:
                yield pd.DataFrame({names[0]: np.concatenate(left), names[1]: np.concatenate(right)})
                left, right, held = [], [], 0
        if held:
            yield pd.DataFrame({names[0]: np.concatenate(left), names[1]: np.concatenate(right)})

    return rows.repartition("tree").sortWithinPartitions("tree").mapInPandas(run, f"{names[0]} long, {names[1]} long")


def settle(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links of a spanning forest: each member is held against the members that no link has reached yet."""
    if len(sets) == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if (100 + percent) * common >= percent * (len(sets[0]) + len(sets[1])) else []
    sizes = np.array([len(x) for x in sets])
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    flat, owner = np.concatenate([sets[k] for k in order]), np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    # Only tokens of two sets or more can be common: they are numbered from 1 on. A 0 at the start stands in for the rest.
    ranked = np.sort(flat)
    shared = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    number = np.searchsorted(shared, flat)
    hit = np.append(shared, np.zeros(1, dtype=np.uint64))[number] == flat
    hit &= number < len(shared)
    owner, number = owner[hit], number[hit]
    at = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(sets)) + 1)))
    tokens = np.zeros(at[-1], dtype=np.int32)
    tokens[np.arange(len(owner)) + owner + 1] = number + 1
    marks = np.zeros(len(shared) + 1, dtype=np.int32)
    open_ = np.ones(len(sets), dtype=bool)
    links = []
    for root in range(len(sets)):
        waiting = [root] if open_[root] else []
        open_[root] = False
        while waiting:
            x = waiting.pop()
            n = int(sizes[x])
            lo = int(np.searchsorted(sizes, -(-percent * n // 100)))
            hi = int(np.searchsorted(sizes, 100 * n // percent, side="right"))
            rest = np.flatnonzero(open_[lo:hi]) + lo
            if not len(rest):
                continue
            marks[tokens[at[x] + 1 : at[x + 1]]] = 1
            if 4 * len(rest) > hi - lo:
                common = np.add.reduceat(marks[tokens[at[lo] : at[hi]]], at[lo:hi] - at[lo])[rest - lo]
            else:
                common = np.array([marks[tokens[at[y] : at[y + 1]]].sum() for y in rest])
            marks[tokens[at[x] : at[x + 1]]] = 0
            near = rest[(100 + percent) * common.astype(np.int64) >= percent * (n + sizes[rest])]
            open_[near] = False
            waiting += near.tolist()
            links += [(int(order[x]), int(order[y])) for y in near]
    return links


def _links(trees: DataFrame, docs: DataFrame, owners: DataFrame, k: int, percent: int) -> DataFrame:
    """(tree, id, g, n, bits) -> links (a, b): a spanning forest of each tree's links between members of different g."""
    def traverse(tree: dict) -> tuple[np.ndarray, np.ndarray]:
        maps, found = tree["bits"].tolist(), []
        if 1 < len(maps) <= FEW:
            found = few_possible(maps, tree["n"].tolist(), tree["g"].tolist(), percent)
        elif len(maps) > FEW:
            found = np.unique(np.concatenate(dual_traversal(maps, tree["n"], tree["g"], percent)))
        return np.full(len(found), tree["tree"][0]), tree["id"][found] if len(found) else np.empty(0, np.int64)

    def link(tree: dict) -> tuple[np.ndarray, np.ndarray]:
        found = np.array(settle([np.frombuffer(x, dtype=np.uint64) for x in tree["tokens"]], percent), dtype=np.int64).reshape(-1, 2)
        return tree["id"][found[:, 0]], tree["id"][found[:, 1]]

    members = cut(_in_trees(trees, ("tree", "id"), traverse))
    tokens = _tokens_of(docs, owners, members.select("id").distinct(), k)
    return _in_trees(members.join(tokens, "id"), ("a", "b"), link)


def _chunks(members: str, tokens: str):
    return F.ceil(F.greatest(F.col(members) / CHUNK, F.col(tokens) / CHUNK_TOKENS)).cast("int")


def _first_trees(groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lead, id, g, n, bits): each chunk of a group alone, and together with the group's first chunk."""
    rows = groups.join(sizes, "lead").withColumn("own", F.pmod(F.xxhash64("id"), "chunks").cast("int"))
    others = F.when(F.col("own") == 0, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array(F.lit(0), F.col("own")))
    rows = rows.select("lead", "id", "g", "n", "bits", "own", F.explode(others).alias("other"))
    pair = (F.when((F.col("own") == 0) | (F.col("other") == 0), 0).otherwise(F.col("own")), F.greatest("own", "other"))
    return rows.select(F.xxhash64("lead", *pair).alias("tree"), "id", "g", "n", "bits")


def _last_trees(groups: DataFrame, sizes: DataFrame, known: DataFrame) -> DataFrame:
    """Of groups with over two chunks: members outside the largest component against each other and against that one."""
    rows = groups.drop("g").join(sizes.where("chunks > 2").select("lead"), "lead").join(known, "id", "left").withColumn("g", F.coalesce("component", "id"))
    counts = rows.groupBy("lead", "g").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("tokens"))
    whole = counts.groupBy("lead").agg(
        F.max_by(F.struct("g", "members", "tokens"), F.struct("members", "g")).alias("most"), F.sum("members").alias("members"), F.sum("tokens").alias("tokens"),
    )
    whole = whole.select(
        "lead", F.col("most.g").alias("most"), _chunks("most.members", "most.tokens").alias("inner"),
        (F.col("members") - F.col("most.members")).alias("members"), (F.col("tokens") - F.col("most.tokens")).alias("tokens"),
    ).where("members > 0").withColumn("outer", _chunks("members", "tokens"))
    rows = rows.join(whole.select("lead", "most", "inner", "outer"), "lead").withColumn("inside", F.col("g") == F.col("most"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.when(F.col("inside"), F.col("inner")).otherwise(F.col("outer"))).cast("int"))
    up_to = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    pair = lambda kind, p, q: F.struct(F.lit(kind).alias("kind"), p.alias("p"), q.alias("q"))
    own = F.col("own")
    to_inner = F.transform(up_to("inner"), lambda d: pair(1, own, d))
    to_outer = F.transform(up_to("outer"), lambda c: pair(0, F.least(own, c), F.greatest(own, c)))
    from_inner = F.transform(up_to("outer"), lambda c: pair(1, c, own))
    rows = rows.select("lead", "id", "g", "n", "bits", F.explode(F.when(F.col("inside"), from_inner).otherwise(F.concat(to_inner, to_outer))).alias("pair"))
    return rows.select(F.xxhash64("lead", "pair").alias("tree"), "id", "g", "n", "bits")


def classes_of(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """docs: doc_id, hash, text -> (doc_id, hash, n, class) of every row; (id, component) of linked classes."""
    sets = cut(_sets(docs, k, percent))
    pairs = _lead_groups(sets)
    # One document of each class in a group stands for it. Of copies in a block only the first has keys, so few meet here.
    own = F.struct("doc_id", "hash")
    owners = sets.where("size(keys) > 0").join(pairs.select(F.col("id").alias("class")).distinct(), "class", "left_semi")
    owners = cut(owners.groupBy(F.col("class").alias("id")).agg(F.min(own).alias("d"), F.first("n").alias("n"), F.first("bits").alias("bits")))
    named = cut(sets.select("doc_id", "hash", "n", "class"))
    release(sets)

    groups = cut(pairs.join(owners.select("id", F.col("id").alias("g"), "n", "bits"), "id"))
    release(pairs)
    sizes = cut(_chunks_of(groups))
    known = cut(components(cut(_links(_first_trees(groups, sizes), docs, owners, k, percent))))
    large = sizes.where("chunks > 2").select("lead")
    if not large.isEmpty():
        again = cut(groups.join(large, "lead").select("id").distinct())
        release(groups, sizes)
        groups = cut(_fine_groups(_texts_of(docs, owners, again), owners, known, k, percent))
        sizes = cut(_chunks_of(groups))
        known = _extended(known, _links(_first_trees(groups, sizes), docs, owners, k, percent))
        if not sizes.where("chunks > 2").isEmpty():
            known = _extended(known, _links(_last_trees(groups, sizes, known), docs, owners, k, percent))
    release(groups, sizes, owners)
    return named, known


def _chunks_of(groups: DataFrame) -> DataFrame:
    counts = groups.groupBy("lead").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("tokens"))
    return counts.select("lead", _chunks("members", "tokens").alias("chunks"))


def _fine_groups(texts: DataFrame, owners: DataFrame, known: DataFrame, k: int, percent: int) -> DataFrame:
    """(lead, id, g, n, bits): groups of the classes of `texts` in the fine layout that hold more than one component."""
    sets = cut(_sets(texts.select("doc_id", "hash", "text"), k, percent, fine=True))
    pairs = _lead_groups(sets)
    release(sets)
    rows = cut(pairs.join(owners.select("id", "n", "bits"), "id").join(known, "id", "left").withColumn("g", F.coalesce("component", "id")).drop("component"))
    release(pairs)
    mixed = rows.groupBy("lead").agg(F.min("g").alias("least"), F.max("g").alias("most")).where("least <> most").select("lead")
    return rows.join(cut(mixed), "lead")


def _extended(known: DataFrame, links: DataFrame) -> DataFrame:
    """Components with further links. Those join whole components, so only the contracted graph is settled again."""
    of = lambda c: known.select(F.col("id").alias(c), F.col("component").alias(f"g{c}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ga", "a").alias("a"), F.coalesce("gb", "b").alias("b"))
    return cut(_merged(known, components(cut(between))))


def _merged(known: DataFrame, joined: DataFrame) -> DataFrame:
    """Components of ids, and of those components, as one table."""
    joined = joined.select(F.col("id").alias("component"), F.col("component").alias("top"))
    inner = known.join(joined, "component", "left").select("id", F.coalesce("top", "component").alias("component"))
    return inner.union(joined.select(F.col("component").alias("id"), F.col("top").alias("component")).join(known, "id", "left_anti"))


def label(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, hash (of the text), n_shingles, component_id (least doc_id), first (the document that stays)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    classes, known = classes_of(rows, k, percent)
    own = F.struct("doc_id", "hash")
    named = classes.join(known.withColumnRenamed("id", "class"), "class", "left").withColumn("g", F.coalesce("component", "class"))
    # Cut, so that in the join below adaptive execution can split a component that holds a great part of all rows.
    least = cut(named.where("n > 0").groupBy("g").agg(F.min("doc_id").alias("component_id"), F.min(own).alias("least")))
    columns = ["doc_id", "hash", F.col("n").alias("n_shingles"), "component_id"]
    linked = named.where("n > 0").join(least, "g").select(*columns, (own == F.col("least")).alias("first"))
    alone = named.where("n = 0").withColumn("component_id", F.col("doc_id")).select(*columns, F.lit(True).alias("first"))
    return linked.unionByName(alone)


def join(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id (least doc_id of the component)."""
    return label(docs, k, percent, doc_id, text).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` without near copies: the least id of each component stays, rows that repeat it once."""
    named = label(docs, k, percent, doc_id, text).where("first").select(F.struct("doc_id", "hash").alias("__key")).distinct()
    keyed = docs.withColumn("__key", F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("hash")))
    return keyed.join(named, "__key").dropDuplicates(["__key"]).drop("__key")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(read(spark, sf_dir, "documents"), k=4, percent=85)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 4 THEN [array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)]
                                          WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b USING (shingle) JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
      WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 185 * count(*) >= 85 * (x.n + y.n)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(b) FROM r WHERE r.a = d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""
