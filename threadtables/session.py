"""Working folder and staged tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders of a partitioned table that a task writes at a time; rows are sorted only where there are more.
WRITERS = 16
#: Staged texts take two thirds of the room they take by Spark's own choice, for little time.
CODEC = "zstd"
#: Names of the tables (all, if none) and paths to be emptied, those of the innermost `scratch` last.
_SCRATCH: ContextVar[tuple[tuple[tuple[str, ...], list[str]], ...]] = ContextVar("scratch", default=())


def work_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: `spark.checkpoint.dir`, or what the caller gave `setCheckpointDir`."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return shared.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path in the working folder that nothing else uses."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _set(spark: SparkSession, setting: str, value: str) -> Iterator[None]:
    before = spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Drop the shuffle files of each query run inside once it has ended; what it wrote is read from then on."""
    with _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


@contextmanager
def scratch(spark: SparkSession, *names: str) -> Iterator[None]:
    """Tables staged inside are emptied at the end: for work whose results are written elsewhere by then, or staged with
    `keep`, which leaves a table to the scratch around this one, if there is any. With `names` only tables of these names
    are, since each costs a short job, and the others are left to the scratch around."""
    paths: list[str] = []
    token = _SCRATCH.set((*_SCRATCH.get(), (names, paths)))
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        nothing = spark.sql("select cast(null as int) as empty where false")
        for path in paths:
            nothing.write.mode("overwrite").parquet(path)


def stage(df: DataFrame, name: str, *partition_by: str, keep: bool = False) -> DataFrame:
    """Write a table once and read it back: later branches prune columns and survive lost executors."""
    path = fresh_dir(df.sparkSession, name)
    around = _SCRATCH.get()[:-1] if keep else _SCRATCH.get()
    if open_ := [paths for names, paths in around if not names or name in names]:
        open_[-1].append(path)
    with released_shuffles(df.sparkSession), _set(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(WRITERS)):
        df.write.partitionBy(*partition_by).parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repeated_apart(df: DataFrame, keys: list[str], among: Column | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rest, repeated): the rows whose keys may occur more than once apart from the others, which are left in place.

    Keys are compared by a hash of 8 bytes, so that only hashes are shuffled to find the repeated ones; keys that share a
    hash by chance go with them, so `repeated` is still to be grouped by its keys. `among` says which rows count. Without
    a repeated hash there is no second table.
    """
    counts = among if among is not None else F.lit(True)
    hashed = F.xxhash64(*keys)
    again = df.where(counts).groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_hash")
    again = stage(again, "repeated-keys")
    if again.isEmpty():
        return df, None
    marked = df.withColumn("_hash", F.when(counts, hashed))
    own = lambda how: marked.join(again, "_hash", how).select(*df.columns)
    return own("left_anti"), own("left_semi")
