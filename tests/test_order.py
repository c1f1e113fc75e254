"""Places in a total order, and what jobs write beside their results."""

import random

from pyspark.sql import functions as F

from chanweave import scratch
from chanweave.operators.order import numbered


def test_numbered(spark):
    rng = random.Random(0)
    values = [(rng.choice([None, "a", "b", "zz"]), rng.randrange(9)) for _ in range(400)]
    rows = spark.createDataFrame(values, "s string, n int").repartition(7)
    got = numbered(rows, F.col("s").asc_nulls_last(), "n").collect()
    assert sorted(r.number for r in got) == list(range(1, 401))
    want = sorted(values, key=lambda v: (v[0] is None, v[0] or "", v[1]))
    assert [(r.s, r.n) for r in sorted(got, key=lambda r: r.number)] == want
    assert numbered(rows.limit(0), "n").collect() == []


def test_release_deletes_what_cut_wrote(spark):
    table = scratch.cut(spark.range(100).repartition(3).selectExpr("id + 1 AS id"))
    assert table.count() == 100
    file = table._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert system.exists(path)
    scratch.release(table)
    assert not system.exists(path)
