"""What a job writes and reads again: in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _shared(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. A local one only where that is unset and the master is local (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext._jsc.sc().isLocal():
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder or tempfile.mkdtemp(prefix="spark-shared-")


def shared_folder(spark: SparkSession, name: str) -> str:
    return f"{_shared(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in any store that Spark reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(_shared(spark))


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder, forget the lineage, and release the shuffle files behind it.

    Tables that a result still reads stay until Spark drops them (spark.cleaner.referenceTracking.cleanCheckpoints).
    """
    ensure_checkpoint_dir(df.sparkSession)
    written = df.checkpoint()
    df._jdf.queryExecution().toRdd().cleanShuffleDependencies(False)
    return written


def release(*tables: DataFrame) -> None:
    """Delete what `cut` wrote for tables that nothing reads any more."""
    for df in tables:
        file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            delete(df.sparkSession, file.get())
