"""The stored history of sources: one folder per day, each day in versions.

A day is replaced by writing its rows beside the store and moving them in as the day's next version, with one rename that
readers see whole or not at all; they take each day's last version. Other days' folders are not touched. Writing the same
rows again gives a further version with the same content. `vacuum` deletes versions that a later one has replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.health import latest_days
from ..scratch import delete

HISTORY = "source string, url string, success boolean, written_at long"


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _folders(spark: SparkSession, path: str, key: str) -> dict[str, str]:
    """Values of `key=value` folders in a folder, with their paths."""
    system, at = _file_system(spark, path)
    if not system.exists(at):
        return {}
    names = [f.getPath() for f in system.listStatus(at) if f.isDirectory()]
    return {p.getName().split("=", 1)[1]: p.toString() for p in names if p.getName().startswith(f"{key}=")}


def switch(spark: SparkSession, written: str, path: str, key: str = "version") -> int:
    """Move a written folder in as the next version below `path`: one rename."""
    version = max(map(int, _folders(spark, path, key)), default=0) + 1
    system, source = _file_system(spark, written)
    _, parent = _file_system(spark, path)
    system.mkdirs(parent)
    _, target = _file_system(spark, f"{path}/{key}={version}")
    if not system.rename(source, target):
        raise RuntimeError(f"{written} could not become {target}")
    return version


def last_version(spark: SparkSession, path: str) -> str | None:
    versions = _folders(spark, path, "version")
    return versions[max(versions, key=int)] if versions else None


def read_history(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """source, url, success, written_at, day: the last version of all days, or of those given (only their folders are listed and read)."""
    there = _folders(spark, path, "day")
    folders = [last_version(spark, there[d]) for d in sorted(there) if days is None or d in days]
    folders = [f for f in folders if f]
    if not folders:
        return spark.createDataFrame([], f"{HISTORY}, day date")
    rows = spark.read.option("basePath", path).schema(f"{HISTORY}, day date, version int").parquet(*folders)
    return rows.drop("version")


def upsert_days(spark: SparkSession, path: str, new: DataFrame) -> list[str]:
    """Add rows (source, url, day, success, written_at) to their days; one value per source and day, the one written last.

    Gives the days, of which an upsert has few. Only their folders are read and written.
    """
    new = new.select("source", "url", "success", F.col("written_at").cast("long").alias("written_at"), F.col("day").cast("date").alias("day"))
    days = sorted(str(r["day"]) for r in new.select("day").distinct().collect())
    staged = f"{path}/_staged"
    delete(spark, staged)
    merged = latest_days(read_history(spark, path, days).unionByName(new))
    merged.repartition("day").write.mode("overwrite").partitionBy("day").parquet(staged)
    for day, folder in sorted(_folders(spark, staged, "day").items()):
        switch(spark, folder, f"{path}/day={day}")
    delete(spark, staged)
    return days


def vacuum(spark: SparkSession, path: str) -> None:
    """Delete every version but the last of each day, when no reader is at an older one any more."""
    for folder in _folders(spark, path, "day").values():
        versions = _folders(spark, folder, "version")
        for v in sorted(versions, key=int)[:-1]:
            delete(spark, versions[v])


def latest_urls(history: DataFrame) -> DataFrame:
    """(source, url): the address written last."""
    return history.groupBy("source").agg(F.max_by("url", F.struct("written_at", "day")).alias("url"))


def read_streaks(spark: SparkSession, path: str) -> DataFrame | None:
    """The last version of the stored streak states."""
    folder = last_version(spark, path)
    return spark.read.parquet(folder) if folder else None


def write_streaks(spark: SparkSession, states: DataFrame, path: str) -> None:
    staged = f"{path}/_staged"
    states.write.mode("overwrite").parquet(staged)
    switch(spark, staged, path)
