"""Incremental profiles: each requested id is kept once; an id whose attempts failed stays pending."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadtables.sources import schemas
from threadtables.sources.readers import STRICT, with_query_id
from threadtables.streaming.tables import TIER, BatchStore, Run, first_copies, slot_of

_TABLES = {"profiles": schemas.PROFILES, "attempts": "query_id string, found boolean, attempts bigint"}


class ProfileStream:
    """A new `version` starts over.

    A landed row without `id` is an attempt that failed. Every attempt is counted, and a profile that was found is not
    replaced by a later one. A batch reads only the slots its own ids fall into.
    """

    def __init__(self, base: str, version: int = 1, tier: int = TIER):
        self.root = f"{base.rstrip('/')}/profiles/v{version}"
        self.store = BatchStore(self.root, _TABLES, tier)

    def run(self, spark: SparkSession, landing: str, max_files_per_batch: int | None = None) -> None:
        """Take in everything that landed since the last run, then stop."""
        source = spark.readStream.schema(schemas.PROFILES).options(**STRICT)
        if max_files_per_batch:
            source = source.option("maxFilesPerTrigger", max_files_per_batch)
        query = (
            source.json(landing).writeStream.foreachBatch(self._batch)
            .option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()

    def _batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self.store.merge(spark, batch_id, self._current)
        own = Run(batch_id, batch_id)
        landed = with_query_id(batch).where("query_id IS NOT NULL").withColumn("slot", slot_of("query_id"))
        tried = landed.groupBy("query_id", "slot").agg(F.max(F.col("id").isNotNull()).alias("found"), F.count(F.lit(1)).alias("attempts"))
        self.store.write("attempts", tried.select("query_id", "found", "attempts", "slot"), own)
        slots = [r["slot"] for r in self.store.read(spark, "attempts", [own]).select("slot").distinct().collect()]
        runs = [r for r in self.store.record(spark).runs if r.last < batch_id]
        done = self.store.read(spark, "profiles", runs).where(F.col("slot").isin(slots)).select("query_id")
        fresh = first_copies(landed.where("id IS NOT NULL"), ["query_id"], ["id"])
        self.store.write("profiles", fresh.join(done, "query_id", "left_anti"), own)
        self.store.commit(spark, batch_id)

    def _current(self, spark: SparkSession, name: str, runs: list[Run]) -> DataFrame:
        rows = self.store.read(spark, name, runs).drop("batch")
        if name == "profiles":
            return rows
        return rows.groupBy("query_id", "slot").agg(F.max("found").alias("found"), F.sum("attempts").alias("attempts")).select("query_id", "found", "attempts", "slot")

    def profiles(self, spark: SparkSession) -> DataFrame:
        return self._current(spark, "profiles", self.store.record(spark).runs).drop("slot")

    def attempts(self, spark: SparkSession) -> DataFrame:
        """query_id, found, attempts of every id that was asked for."""
        return self._current(spark, "attempts", self.store.record(spark).runs).drop("slot")

    def pending(self, spark: SparkSession, ids: DataFrame, max_attempts: int | None = None) -> DataFrame:
        """author_id, attempts of the ids still to be asked for: never tried, or tried without success, fewer than
        `max_attempts` times where that is given."""
        tried = self.attempts(spark).withColumnRenamed("query_id", "author_id")
        left = ids.select("author_id").join(tried, "author_id", "left").where("not coalesce(found, false)")
        left = left.select("author_id", F.coalesce("attempts", F.lit(0).cast("bigint")).alias("attempts"))
        return left if max_attempts is None else left.where(F.col("attempts") < max_attempts)
