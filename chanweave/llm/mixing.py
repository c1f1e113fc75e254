"""Mixing sources to target weights by capped water-filling.

Sources, in code-point order with null last, weigh 1, 2, 3, repeating. All weights together share the corpus's whole
size; a source takes at most `max_epochs` times its own size, and what it can't take goes to the others by weight, again
and again until none is above its cap. Only the water level, one number, is on the driver; sources may be as many as rows.

A source of size S and target T repeats every document floor(T / S) times; the words still missing are taken in seeded
order, the last document in part. The order is by MD5 of "seed:doc_id"; running sums go over hash cells first, so a
source with a third of all rows never meets in one task.

Defined cases: null or empty text has size 0 and takes 0; a null source is a source; rows that repeat an id are counted
each; null ids are ordered by the MD5 of their text; an empty table gives an empty result; a text counts by its words, however long; only the three named columns are read,
and `repeat` passes all columns through whatever their names. Rows of one repeated id share a hash cell: an id that
repeats in a great part of all rows is sorted in one task, which spills.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.order import numbered
from .common import cut, read, text_of

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = 3
#: Hash cells of a source: four hexadecimal digits, so a source of 10^9 rows has about 15,000 rows in a cell.
CELL_DIGITS = 4


def targets(sizes: DataFrame, max_epochs: int = 3) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    The water level is the words a unit of weight gets. Starting from all sources, those whose cap lies below the level
    are clamped, and what is left over raises the level for the others, until none is above its cap. Each step is one
    aggregate over the source table; the level only rises, on a curve of straight pieces, so few steps are needed.
    """
    order = F.col("source").asc_nulls_last()
    ranked = numbered(sizes, order).withColumn("weight", (F.col("number") - 1) % WEIGHTS + 1).withColumn("cap", F.col("source_size") * max_epochs)
    ranked = cut(ranked.drop("number"))
    clamped = lambda level: F.lit(level) * F.col("weight") > F.col("cap")
    level, after = -1.0, 0.0
    while level != after:
        level = after
        capped = clamped(level)
        total, taken, weight = ranked.agg(F.sum("source_size"), F.sum(F.when(capped, F.col("cap"))), F.sum(F.when(~capped, F.col("weight")))).first()
        rest = (total or 0) - (taken or 0)
        after = max(level, rest / weight) if weight else level
    share = F.lit(float(rest)) * F.col("weight") / F.lit(weight or 1)
    return ranked.select("source", "source_size", F.when(clamped(level), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", max_epochs: int = 3, seed: int = 0,
    carry: bool = False,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies; with carry also `__row`, the whole input row.

    taken: words that the mix takes of the row, repeats counted. copies: the same in whole documents (rounded).
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.md5(text_of(text))))).alias("draw"),
        *([F.struct("*").alias("__row")] if carry else []),
    ).withColumn("cell", F.substring("draw", 1, CELL_DIGITS))
    cells = cut(rows.drop("__row").groupBy("source", "cell").agg(F.sum("size").alias("cell_size")))
    sizes = cells.groupBy("source").agg(F.sum("cell_size").alias("source_size"))
    # Running sums in two steps, so that no window holds more than 256 rows of a source.
    cells = cells.withColumn("top", F.substring("cell", 1, CELL_DIGITS // 2))
    earlier = lambda by, order: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    tops = cells.groupBy("source", "top").agg(F.sum("cell_size").alias("top_size"))
    tops = tops.select(F.col("source").alias("ts"), F.col("top").alias("tt"), F.coalesce(F.sum("top_size").over(earlier(["source"], "top")), F.lit(0)).alias("top_before"))
    cells = cells.withColumn("in_top", F.coalesce(F.sum("cell_size").over(earlier(["source", "top"], "cell")), F.lit(0)))
    cells = cells.join(tops, F.col("source").eqNullSafe(F.col("ts")) & (F.col("top") == F.col("tt")))
    cells = cells.select(F.col("source").alias("s"), F.col("cell").alias("c"), (F.col("top_before") + F.col("in_top")).alias("cell_before"))
    goals = targets(sizes, max_epochs).withColumnRenamed("source", "g")
    plan = cells.join(goals, F.col("s").eqNullSafe(F.col("g"))).drop("g")
    in_cell = Window.partitionBy("source", "cell").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(in_cell), F.lit(0)))
    placed = placed.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    placed = placed.withColumn("whole", whole).withColumn("before", F.col("before") + F.col("cell_before"))
    placed = placed.withColumn("missing", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long") - F.col("before"))
    part = F.greatest(F.lit(0), F.least("missing", "size"))
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("whole") * F.col("size") + part).cast("long").alias("taken"),
        (F.col("whole") + (F.col("missing") * 2 > F.col("size")).cast("int")).cast("int").alias("copies"),
        *(["__row"] if carry else []),
    )


def repeat(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", max_epochs: int = 3, seed: int = 0) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, in whole documents."""
    mixed = mix(docs, doc_id, text, source, max_epochs, seed, carry=True).where("copies > 0")
    return mixed.select("__row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("__row.*")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('0:' || doc_id) AS draw FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap,
             sum(source_size) OVER () AS total FROM s),
p AS (SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST) AS place FROM w),
c AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                / sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) * weight > cap AS capped FROM p),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE
        (total - coalesce(sum(cap) FILTER (capped) OVER (), 0))::DOUBLE * weight / sum(weight) FILTER (NOT capped) OVER () END AS target FROM c),
x AS (SELECT doc_id, size, source_size, target,
             CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(round(target - whole * source_size)::BIGINT - before, size)))::BIGINT AS taken FROM x
"""
