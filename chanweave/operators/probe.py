"""Liveness from recorded observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.addresses import probe_status

ERROR_LENGTH = 120
SLOWEST = (1 << 31) - 1


def probe_verdict(observations: DataFrame) -> DataFrame:
    """probe_obs -> url, alive, latency_ms, status, error."""
    status = probe_status("head_status", "get_status", "url", "body", "seg_status", "timed_out", "error")
    error = F.when(F.col("status") == "timeout", "timeout").when(F.col("status") == "error", F.substring(F.coalesce("error", F.lit("")), 1, ERROR_LENGTH)).otherwise("")
    rows = observations.withColumn("status", status)
    return rows.select("url", (F.col("status") == "ok").alias("alive"), "latency_ms", "status", error.alias("error"))


def urls_to_probe(rows: DataFrame) -> DataFrame:
    return rows.where(F.coalesce("url", F.lit("")) != "").select("url").distinct()


def apply_probe(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Each row gets the verdict on its address; rows without address get none.

    Of several verdicts the fastest counts, those without a latency last, ties by status.
    """
    order = F.struct(F.coalesce("latency_ms", F.lit(SLOWEST)), "status", "alive")
    one = verdicts.groupBy("url").agg(F.min_by(F.struct("alive", "latency_ms", "status"), order).alias("v"))
    joined = rows.drop("alive", "latency_ms", "probe_status").join(one, "url", "left")
    return joined.select(*[c for c in joined.columns if c != "v"], F.col("v.alive").alias("alive"), F.col("v.latency_ms").alias("latency_ms"), F.col("v.status").alias("probe_status"))


def default_alive(rows: DataFrame) -> DataFrame:
    return rows.withColumn("alive", F.lit(True))


def probe_stats(rows: DataFrame) -> DataFrame:
    """ok, fail (unknown is a failure), ratio in percent to one decimal, 0.0 for no rows."""
    counted = rows.agg(F.count_if(F.col("alive").eqNullSafe(F.lit(True))).alias("ok"), F.count(F.lit(1)).alias("total"))
    ratio = F.when(F.col("total") > 0, F.round(F.col("ok") * 100 / F.col("total"), 1)).otherwise(F.lit(0.0))
    return counted.select("ok", (F.col("total") - F.col("ok")).alias("fail"), ratio.alias("ratio"))
