"""Positions of rows in a total order, without a window over all of them."""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import cut

#: monotonically_increasing_id: the partition from this bit on, the place in it below.
PLACE_BITS = 33


def numbered(rows: DataFrame, *order: Column | str, name: str = "number") -> DataFrame:
    """rows with their place (1 on, long) in the order given. Equal keys get neighbouring places in any order.

    Rows are dealt out by ranges, sorted in each, and cut; the places of a range start after the rows before it, which
    one count per range tells.
    """
    at = "__at"
    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()))
    part = F.shiftright(at, PLACE_BITS)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # a row per range
    held = {r["part"]: r["n"] for r in counts}
    before = list(accumulate((held.get(k, 0) for k in range(max(held, default=0))), initial=0))
    first = F.from_json(F.lit(json.dumps(before)), "array<bigint>")[part.cast("int")]
    return placed.withColumn(name, first + F.col(at).bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + 1).drop(at)
